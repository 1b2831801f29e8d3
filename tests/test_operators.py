import pytest
from pyspark.sql import functions as F

from weftline.functions import ids, text
from weftline.operators import diff, export, graph, merge, query, resolve, rules
from weftline.plans.pipeline import Step, build
from weftline.streaming.incremental import mirror


def test_merge_scalars_lists_maps_and_log(spark):
    df = spark.createDataFrame(
        [("k", 0, "a", None, ["x", "y"], {"p": "1"}, ["i"], "s0"), ("k", 1, "b", "n", ["y", "z"], {"p": "2", "q": "3"}, ["j"], "s1"), ("l", 1, None, None, None, None, None, "s1")],
        "id string, pos int, name string, extra string, tags array<string>, props map<string,string>, xref array<string>, prov string",
    )
    first = {r.id: r for r in merge.merge_records(df, ["id"], ["pos"], fixed=("xref",), provenance="prov").collect()}
    last = {r.id: r for r in merge.merge_records(df, ["id"], ["pos"], merge.KEEP_LAST, fixed=("xref",), provenance="prov").collect()}
    k = first["k"]
    assert (k.name, k.extra, k.tags, k.props, k.xref, k.creation) == ("a", "n", ["x", "y", "z"], {"p": "1", "q": "3"}, ["i"], "s0")
    assert sorted(k.updates) == ["extra\tNULL\tn\ts1\tKeepFirst", "name\ta\tb\ts1\tKeepFirst", 'tags\t+\t["z"]\ts1\tKeepFirst']  # additions to lists are logged as well
    assert (last["k"].name, last["k"].props) == ("b", {"p": "2", "q": "3"})
    assert first["l"].name is None and first["l"].tags is None and first["l"].updates is None


def test_upsert(spark):
    now = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "c", False), (3, "d", None), (1, None, True)], "id int, v string, gone boolean")
    assert sorted(merge.upsert(now, new, ["id"], "gone").collect()) == [(2, "c"), (3, "d")]


def test_resolve_policies(spark):
    nodes = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    matches = spark.createDataFrame([("a", "X", 0), ("a", "Y", 0), ("a", "Z", 1)], "input string, match string, priority int")
    rows = sorted(resolve.resolve(nodes, matches).collect())
    assert [(r.id, r.old_id, r.xref, r.resolver_miss) for r in rows] == [("X", "a", ["X", "Y", "a"], False), ("Y", "a", ["X", "Y", "a"], False), ("b", "b", ["b"], True)]
    assert [r.id for r in resolve.resolve(nodes, matches, resolve.SKIP, resolve.FIRST).collect()] == ["X"]
    for policy in ({"no_match": resolve.ERROR}, {"many": resolve.ERROR}):
        with pytest.raises(Exception, match="match"):
            resolve.resolve(nodes, matches, **policy).collect()
    edges = spark.createDataFrame([("a", "b", 5), ("a", "q", 6)], "start_id string, end_id string, w int")
    ends = spark.createDataFrame([("b", "B")], "input string, match string")
    assert sorted((r.start_id, r.end_id, r.w) for r in resolve.resolve_edges(edges, matches, ends).collect()) == [("X", "B", 5), ("Y", "B", 5), ("Z", "B", 5)]


def test_closure_on_cycles_and_unknown_nodes(spark):
    edges = spark.createDataFrame([("A", "B"), ("B", "C"), ("C", "A"), ("C", "D"), ("D", "Q")], "parent string, child string")
    nodes = spark.createDataFrame([(x,) for x in "ABCD"], "node string")
    got = {tuple(r) for r in graph.transitive_closure(spark, edges, nodes).collect()}
    assert got == {(a, b) for a in "ABC" for b in "ABCD"} | {("D", "D")}
    chain = spark.createDataFrame([("B", "A"), ("C", "B")], "child string, parent string")
    assert graph.transitive_closure(spark, chain, nodes).count() == 7


def test_components_and_hops(spark):
    path = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (200, 200)]
    edges = spark.createDataFrame(path, "src long, dst long")
    got = {r.node: r.component for r in graph.connected_components(spark, edges).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 200: 200}
    assert graph.connected_components(spark, edges.limit(0)).collect() == []
    seeds = spark.createDataFrame([(0,)], "node long")
    assert sorted(map(tuple, graph.hops(edges, seeds, 2).collect())) == [(0, 0), (1, 1), (2, 2)]


def test_partition_changes(spark):
    left = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, "d"), (6, "e"), (7, "f")], "item int, grp string")
    right = spark.createDataFrame([(1, "p"), (2, "q"), (3, "r"), (4, "r"), (6, "s"), (8, "s"), (7, "t"), (9, "u")], "item int, grp string")
    got = {(r.side, r.grp): r.change for r in graph.partition_changes(left, right).collect()}
    assert got == {("left", "a"): "split", ("left", "b"): "merged", ("left", "c"): "merged", ("left", "d"): "removed", ("left", "e"): "membership changed", ("left", "f"): "same", ("right", "u"): "new"}


def test_agreement_and_cardinality(spark):
    rows = [(None, None, None), (["a"], None, None), (["a"], ["a"], None), (["a", "b"], ["a"], ["b"]), (["a"], ["a"], ["b"]), (["a"], ["b"], ["c"])]
    df = spark.createDataFrame(rows, "x array<string>, y array<string>, z array<string>")
    cols = [F.col(c) for c in "xyz"]
    assert [r[0] for r in df.select(rules.agreement(cols)).collect()] == ["no_data", "single", "agree", "subset", "majority", "conflict"]
    assert [r[0] for r in df.select(rules.agreement(cols, subset=False)).collect()][3] == "conflict"
    assert df.select(rules.cardinality(F.col("x"), F.col("y"))).collect()[3][0] == "n:1"


def test_null_aware_filters(spark):
    df = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None), (4, ["b"])], "id int, tags array<string>")
    pick = lambda *v: [r.id for r in df.where(query.field_filter(df, "tags", list(v))).collect()]
    assert pick("a") == [1] and pick("b", None) == [2, 3, 4] and pick(None) == [2, 3]


def test_names_and_values(spark):
    df = spark.createDataFrame([("DO:12", "a|b | ", "NA", "yes"), ("plain", "", "1.5", "no")], "c string, l string, n string, b string")
    got = df.select(ids.curie_prefix(F.col("c")), ids.curie_local(F.col("c")), text.split_list(F.col("l")), text.safe_double(F.col("n")), text.safe_bool(F.col("b"))).collect()
    assert [tuple(r) for r in got] == [("DOID", "12", ["a", "b"], None, True), (None, "plain", None, 1.5, False)]
    one = spark.createDataFrame([("Heart Disease", "heart disease"), ("heart", "heart attack"), ("", "x"), (None, "x"), ("abc", "xyz")], "a string, b string")
    assert [r[0] for r in one.select(text.lexical_score(F.col("a"), F.col("b"))).collect()][:4] == [1.0, 0.96, 0.0, 0.0]


def test_versions(spark):
    df = spark.createDataFrame([("k", "1.9"), ("k", "1.10"), ("k", "2024-01-01"), ("k", "beta")], "key string, version string")
    assert diff.latest(df, ["key"], "version").collect() == [("k", "1.10")]
    assert diff.fingerprint(df).collect() == diff.fingerprint(df.orderBy("version")).collect()


def test_flatten_and_triples(spark):
    df = spark.createDataFrame([(1, ["x", "y"], {"k": 2.0}, (5, 'q"')), (2, None, None, None)], "id int, names array<string>, props map<string,double>, place struct<at int, note string>")
    tables = export.flatten(df, "GeneNode", "id")
    assert {k: v.count() for k, v in tables.items()} == {"gene_node": 2, "gene_node__names": 2, "gene_node__props": 1, "gene_node__place": 1}
    assert export.triples(df.select("id", "place.note"), F.col("id").cast("string"), "http://x/", ["note"]).collect()[0][0] == r'<http://x/1> <http://x/note> "q\"" .'


def test_build_resumes(spark, tmp_path):
    steps = [Step("a", lambda s, t, p: s.range(p["n"]), params={"n": 3}), Step("b", lambda s, t, p: t["a"].where("id > 0"), ("a",))]
    tables, made = build(spark, steps, str(tmp_path))
    assert made == ["a", "b"] and tables["b"].count() == 2
    assert build(spark, steps, str(tmp_path))[1] == []
    steps[0].params["n"] = 4
    assert build(spark, steps, str(tmp_path))[1] == ["a", "b"]


def test_mirror_replays_changes(spark, tmp_path):
    schema = "id int, v string, seq int, gone boolean"
    for k, rows in enumerate([[(1, "a", 0, False), (2, "b", 1, False)], [(2, "c", 2, False), (1, None, 3, True), (3, "d", 4, False)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        mirror(spark, source, str(tmp_path / "out"), str(tmp_path / "cp"), "id", ["seq"], "gone").awaitTermination()
    assert sorted((r.id, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(2, "c"), (3, "d")]
