import gzip
import random

import pytest
from pyspark.sql import functions as F

from weftline.functions import names, text
from weftline.operators import cliques, diff, export, graph, merge, query, resolve, stats, validate
from weftline.plans import adapters, plugins
from weftline.plans.pipeline import build
from weftline.sources import readers
from weftline.streaming.incremental import sessions, sliding


def write(path, content):
    path.write_text(content)
    return str(path)


def test_gzip_and_named_sets(spark, tmp_path):
    with gzip.open(tmp_path / "a.gmt.gz", "wt") as f:
        f.write("http://x/R-1\tname: One; datasource: reactome; organism: 9606\tA\tB\n" + "R-2\tname: Two; datasource: kegg\tC\nR-3\tno name\tD\n")
    rows = readers.named_sets(readers.gmt(spark, str(tmp_path / "a.gmt.gz")), ("kegg",), ("http://x/",)).collect()
    assert sorted((r.id, r.name, r.source, r.url, r.member) for r in rows) == [("R-1", "One", "reactome", "http://x/R-1", "A"), ("R-1", "One", "reactome", "http://x/R-1", "B")]
    sets = spark.createDataFrame([("Title", "R-HSA-1", "A"), ("Other", "x", "B")], "name string, url string, member string")
    assert readers.titled_sets(sets, "R-HSA-").collect() == [("Title", "R-HSA-1", "A")]


def test_rdf_xml(spark, tmp_path):
    doc = """<rdf:RDF xmlns:rdf="r"><rdf:Description rdf:about="http://r/1"><rdf:type rdf:resource="http://r/T"/>
    <rh:equation xml:lang="en">a &lt; b</rh:equation><rh:left rdf:resource="http://r/2"/></rdf:Description>
    <rdf:Description rdf:about="http://r/2"><rh:name>two</rh:name></rdf:Description></rdf:RDF>"""
    rows = sorted(tuple(r) for r in readers.rdf_xml(spark, write(tmp_path / "a.rdf", doc)).collect())
    assert rows == [("http://r/1", "rdf:type", "http://r/T", True), ("http://r/1", "rh:equation", "a < b", False), ("http://r/1", "rh:left", "http://r/2", True), ("http://r/2", "rh:name", "two", False)]


def test_soft_and_isa(spark, tmp_path):
    soft = "^DATABASE = GEO\n!Database_name = x\n^SAMPLE = GSM1\n!Sample_title = one\n!Sample_characteristics_ch1 = age: 3\n!Sample_characteristics_ch1 = sex: f\n^SAMPLE = GSM2\n!Sample_title = two = 2\n"
    rows = {(r.id, r.key): r["values"] for r in readers.soft(spark, write(tmp_path / "a.soft", soft)).collect()}
    assert rows == {("GSM1", "title"): ["one"], ("GSM1", "characteristics_ch1"): ["age: 3", "sex: f"], ("GSM2", "title"): ["two = 2"]}
    isa = 'ONTOLOGY\nStudy Title\t"A study"\nStudy Person Last Name\t"Doe"\t"Roe"\t\n'
    rows = sorted(tuple(r) for r in readers.isa_investigation(spark, write(tmp_path / "i.txt", isa)).collect())
    assert rows == [("Study Person Last Name", 0, "Doe"), ("Study Person Last Name", 1, "Roe"), ("Study Title", 0, "A study")]


def test_pages_and_map_sheets(spark):
    fetch = lambda page: [{"id": f"{page}-{k}", "extra": 1} for k in range(page)]
    assert sorted(r.id for r in readers.paged(spark, fetch, 4, "id string, name string").collect()) == ["1-0", "2-0", "2-1", "3-0", "3-1", "3-2"]
    sheet = spark.createDataFrame([("a", "b", "c")], "`My Id` string, Alt string, z string")
    assert readers.renamed(sheet, {"id": " my id", "name": "NA", "other": ""}, {"name": ["alias", "ALT"]}).collect() == [("a", "b", None)]


def test_merge_rules(spark):
    df = spark.createDataFrame([("k", 0, ["a"], "s0", (1,)), ("k", 1, ["b", "a", "c", "d", "e", "f", "g"], "s1", (2,))], "id string, pos int, tags array<string>, prov string, odd struct<x int>")
    with pytest.raises(TypeError, match="odd"):
        merge.merge_records(df, ["id"], ["pos"])
    row = merge.merge_records(df.drop("odd"), ["id"], ["pos"], provenance="prov").first()
    assert row.tags == list("abcdefg") and row.updates == ['tags\t+\t["b","c","d","e","f"] (+1 more)\ts1\tKeepFirst']
    objects = spark.createDataFrame([("k", 0, "", "x", "p0"), ("k", 1, "v", "y", "p1"), ("k", 2, " ", "x", "p2")], "id string, pos int, a string, b string, prov string")
    first, last = (merge.merge_objects(objects, ["id"], ["pos"], "prov", p).first() for p in (merge.KEEP_FIRST, merge.KEEP_LAST))
    assert (first.a, first.b, first.prov) == ("v", "x", "creation: p0\na\tNULL\tv\tp1\tKeepFirst")
    assert (last.a, last.b, last.prov) == ("v", "x", "creation: p0\na\t\tv\tp1\tKeepLast\nb\tx\ty\tp1\tKeepLast\nb\ty\tx\tp2\tKeepLast")
    assert merge.merge_objects(objects, ["id"], ["pos"], "prov", insert_only=True).count() == 3


def test_resolvers(spark):
    aliases = spark.createDataFrame([("gard:0012",), ("ORPHANET:7",), ("plain",), (":x",)], "a string")
    got = {r.a: set(r.v) for r in aliases.select("a", resolve.alias_variants(F.col("a")).alias("v")).collect()}
    assert got["gard:0012"] == {"gard:0012", "GARD:0012", "GARD:0000012", "gard:0000012", "GARD:12", "gard:12"}
    assert got["ORPHANET:7"] == {"ORPHANET:7", "orphanet:7", "Orphanet:7"} and got["plain"] == {"plain"} and got[":x"] == {":x"}
    rows = spark.createDataFrame([(1, "a", "f"), (1, None, None), (2, "b", None)], "id int, label string, family string")
    assert sorted((r.id, r.family, r.filled) for r in resolve.fill_shared(rows, "id", "family").collect() if r.id == 1) == [(1, "f", False), (1, "f", True)]
    with pytest.raises(Exception, match="family differs"):
        resolve.fill_shared(rows.union(spark.createDataFrame([(1, "z", "g")], rows.schema)), "id", "family").collect()


def test_groups_of_identifiers(spark):
    structures = spark.createDataFrame([("a", "ABCDEFGHIJKLMN-ABCDEFGHIJ-N", 600.0), ("b", "ABCDEFGHIJKLMN-XXXXXXXXXX-N", 700.0), ("c", "abcdefghijklmn-abcdefghij-m", 100.0), ("d", "bad", None)], "id string, inchi_key string, mass double")
    active = structures.select("id")
    by = lambda merge_by: sorted(tuple(r) for r in cliques.structure_links(structures, active, cliques.Rules(merge=merge_by)).collect())
    assert by("prefix") == [("b", "a"), ("c", "a")] and by("duplex") == [("c", "a")] and by("mass") == [("b", "a")]
    edges = spark.createDataFrame([("x:1", "y:1", [("HMDB", "f")]), ("x:1", "z:1", []), ("x:1", "q:9", [("a", "f")])], "start_id string, end_id string, details array<struct<source string, source_field string>>")
    live = cliques.surviving_edges(edges, spark.createDataFrame([("x:1",), ("y:1",), ("z:1",)], "id string"), structures, cliques.Rules(prefixes={"hmdb": ["Y"]}))
    assert [(r.start_id, r.end_id) for r in live.collect()] == [("x:1", "z:1")]


def test_closure_of_a_long_chain_and_a_ring(spark):
    n = 300
    edges = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(k, 1000 + (k - 999) % 7) for k in range(1000, 1007)], "parent long, child long")
    rows = {tuple(r) for r in graph.transitive_closure(spark, edges).collect()}
    assert rows == {(a, b) for a in range(n + 1) for b in range(a, n + 1)} | {(a, b) for a in range(1000, 1007) for b in range(1000, 1007)}
    rng = random.Random(3)
    pairs = [(rng.randrange(40), rng.randrange(40)) for _ in range(60)]
    reach = {(a, a) for p in pairs for a in p if p[0] != p[1]}
    step = {p for p in pairs if p[0] != p[1]}
    while True:
        more = reach | {(a, d) for a, b in reach for c, d in step if b == c}
        if more == reach:
            break
        reach = more
    assert {tuple(r) for r in graph.transitive_closure(spark, spark.createDataFrame(pairs, "parent long, child long")).collect()} == reach


def test_numbers_of_keys(spark):
    keys = [f"k{k * 37 % 1000:04}" for k in range(1000)] * 2
    rows = diff.surrogates(spark, spark.createDataFrame([(k,) for k in keys] + [(None,)], "key string"), "key").collect()
    assert [r.surrogate for r in sorted(rows, key=lambda r: r.key)] == list(range(1, 1001))


def test_batches_halve_until_they_pass():
    seen = []

    def store(batch):
        if len(batch) > 2 or 7 in batch:
            raise ValueError("too large")
        seen.extend(batch)

    with pytest.raises(ValueError):
        export.in_batches(list(range(10)), store, 8)
    seen.clear()
    assert export.in_batches([k for k in range(10) if k != 7], store, 8) >= 5 and sorted(seen) == [0, 1, 2, 3, 4, 5, 6, 8, 9]


def test_clustered_files(spark, tmp_path):
    export.write_clustered(spark.range(1000).withColumn("v", F.col("id") % 7), str(tmp_path / "t"), ["id"], 4)
    assert len(list((tmp_path / "t").glob("part-*"))) == 4 and spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_names(spark):
    df = spark.createDataFrame([("alpha kinase", "alpha kinases", None), ("a b c", "c a b x", None), (None, "only", ""), ("p", "q", "p")], "e string, u string, n string")
    got = [tuple(r.x) for r in df.select(names.combined_name(F.col("e"), F.col("u"), F.col("n")).alias("x")).collect()]
    assert got[0][0] == "alpha kinases" and got[0][2] == "Fuzzy-Ensembl-Uniprot" and got[2] == ("only", 0.0, "None") and got[3] == ("p", 1.0, "Exact")
    assert got[1][0] == "c a b x" and got[1][2] in ("Fuzzy-Ensembl-Uniprot", "Token-Ensembl-Uniprot")
    score = [r.s for r in spark.createDataFrame([("", "a"), ("A b", "a-b"), ("night", "nacht"), ("heart failure", "failure")], "a string, b string").select(text.lexical_score(F.col("a"), F.col("b")).alias("s")).collect()]
    assert score[:2] == [0.0, 1.0] and score[2] == 0.6 and score[3] == 0.96


def test_filters(spark):
    df = spark.createDataFrame([("1.5",), ("2",), (None,), ("x",)], "q string")
    count = lambda wanted: df.where(query.quality_range(F.col("q"), wanted)).count()
    assert (count("1.5-2"), count("0-3"), count("2"), count("a-b")) == (1, 2, 1, 4)
    assert query.coerce(["True", "NULL", "x", "false"]) == [True, None, "x", False]


def test_typed_and_endogenous_terms(spark):
    terms = spark.createDataFrame([("role", None, False, False), ("r1", None, False, False), ("chem", "c", False, False), ("c1", "a drug-like", False, False), ("c2", "x", True, False), ("exo", "x", False, False), ("e1", "x", False, False), ("c3", "fine", False, False)], "id string, label string, obsolete boolean, drug boolean")
    parents = spark.createDataFrame([("role", "r1"), ("chem", "c1"), ("chem", "c2"), ("chem", "exo"), ("exo", "e1"), ("chem", "c3")], "parent string, child string")
    kinds = {r.id: r.kind for r in adapters.typed_terms(spark, terms.select("id"), parents, "role", "chem", terms.where("id = 'e1'"), terms.where("id = 'c1'")).collect()}
    assert {k for k, v in kinds.items() if v == "role"} == {"role", "r1", "e1"}
    assert sorted(r.id for r in adapters.endogenous(spark, terms, parents, "chem", ["exo"], ["drug"]).collect()) == ["c3", "chem"]


def make_numbers(spark, tables, params):
    return spark.range(params["n"]).withColumn("twice", F.col("id") * 2)


def make_total(spark, tables, params):
    return tables["numbers"].agg(F.sum("twice").alias("total"))


def test_builds_from_configuration(spark, tmp_path):
    config = plugins.parsed('{"steps": [{"name": "total", "make": "tests.test_more_operators:make_total", "needs": ["numbers"]}, {"name": "numbers", "make": "tests.test_more_operators:make_numbers", "params": {"n": 5}}]}')
    tables, made = build(spark, plugins.steps(config), str(tmp_path))
    assert made == ["numbers", "total"] and tables["total"].first()["total"] == 20
    assert build(spark, plugins.steps(config), str(tmp_path))[1] == []
    with pytest.raises(ValueError, match="each other"):
        plugins.steps({"steps": [{"name": "a", "make": "json:loads", "needs": ["a"]}]})
    with pytest.raises(ValueError, match="form"):
        plugins.named("json.loads")
    out = plugins.convert({"numbers": tables["numbers"]}, {"numbers": [lambda df: ("ids", df.select("id")), lambda df: ("ids", df.select(F.col("twice").alias("id")))]})
    assert out["ids"].count() == 10


def test_report_columns_and_empty_sheets(spark):
    rows = spark.createDataFrame([(1, None, {"unit": "kg"}, "A"), (2, "x", None, "a")], "k int, name string, props map<string,string>, kind string")
    report = validate.placed(validate.required(rows, "k", "part", "name"), "Sheet", "Name", "f.xlsx").collect()
    assert [tuple(r) for r in report] == [("error", "part", "name", "name is required", "Sheet", "Name", "1", "f.xlsx")]
    assert [r["row"] for r in validate.conditional_required_map_key(rows, "k", "part", "props", "unit", "kind", ["a"]).collect()] == ["2"]


def test_windows_on_streams(spark, tmp_path):
    spark.sql("SELECT timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id * 10, 0) AS ts, id % 2 AS u FROM range(60)").write.parquet(str(tmp_path / "in"))
    for k, make in enumerate((lambda s: sliding(s, "ts", "1 hour", "30 minutes"), lambda s: sessions(s, "ts", "30 minutes", "u"))):
        source = spark.readStream.schema("ts timestamp, u long").parquet(str(tmp_path / "in"))
        q = make(source).writeStream.format("memory").queryName(f"windows{k}").outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.table(f"windows{k}").count() >= (15 if k == 0 else 0)


def test_mapped_coverage_and_sources(spark):
    rows = spark.createDataFrame([("a", "x | y"), ("a", "x"), ("b", None), ("", "x")], "k string, alts string")
    found = stats.mapped_coverage(rows, "k", "alts", spark.createDataFrame([("x",), ("x",)], "input string")).first()
    assert (found.total, found.mapped, found.percent) == (2, 1, 50.0)
