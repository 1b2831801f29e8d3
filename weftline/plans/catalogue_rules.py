"""More of the catalogue: record merges, resolvers, groups of identifiers, roll-ups, sheets, names, source families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.core import load, materialize
from weftline.functions import ids, names, text
from weftline.operators import cliques, diff, export, graph, merge, query, resolve, stats, validate
from weftline.plans import adapters
from weftline.plans.catalogue import entry
from weftline.sources import readers


def cid(prefix: str, c: Column | str) -> Column:
    return F.concat(F.lit(f"{prefix}:"), F.col(c).cast("string") if isinstance(c, str) else c.cast("string"))


def joined(c: str | Column) -> Column:
    return F.array_join(c, "|")


# --- record merge

RECORDS = """SELECT o_custkey AS id, o_orderkey AS pos, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS label, o_orderstatus AS prov, CASE WHEN o_orderkey % 4 > 0 THEN ['t' || (o_orderkey % 5), 't' || (o_orderkey % 7)] END AS tags FROM orders"""


def records(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    return load(spark, d, "orders").select(F.col("o_custkey").alias("id"), k.alias("pos"), F.when(k % 3 > 0, F.col("o_orderpriority")).alias("label"), F.col("o_orderstatus").alias("prov"), F.when(k % 4 > 0, F.array(F.concat(F.lit("t"), k % 5), F.concat(F.lit("t"), k % 7))).alias("tags"))


@entry(f"""WITH r AS ({RECORDS}), s AS (SELECT *, row_number() OVER w AS nth, last_value(label IGNORE NULLS) OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held FROM r WINDOW w AS (PARTITION BY id ORDER BY pos))
SELECT id, concat_ws(chr(9), 'label', coalesce(held, 'NULL'), label, prov, 'KeepLast') AS entry FROM s WHERE nth > 1 AND label IS NOT NULL AND label IS DISTINCT FROM held""")
def merge_log_text(spark, d):
    return merge.change_log(records(spark, d).drop("tags"), ["id"], ["pos"], merge.KEEP_LAST, (), "prov")


@entry(f"""WITH r AS ({RECORDS}), s AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS nth FROM r), i AS (SELECT id, pos, nth, prov, t, min(k) AS k FROM (SELECT id, pos, nth, prov, unnest(tags) AS t, generate_subscripts(tags, 1) AS k FROM s) GROUP BY ALL),
f AS (SELECT *, min(pos) OVER (PARTITION BY id, t) AS first FROM i)
SELECT id, 'tags' || chr(9) || '+' || chr(9) || '["' || string_agg(t, '","' ORDER BY k) || '"]' || chr(9) || prov || chr(9) || 'KeepFirst' AS entry FROM f WHERE pos = first AND nth > 1 GROUP BY id, pos, prov""")
def merge_log_lists(spark, d):
    return merge.change_log(records(spark, d).drop("label"), ["id"], ["pos"], merge.KEEP_FIRST, (), "prov")


@entry(f"""WITH r AS ({RECORDS}), f AS (SELECT id, label || '/' || prov AS how, min(pos) AS pos FROM r WHERE label IS NOT NULL GROUP BY 1, 2) SELECT id, string_agg(how, '|' ORDER BY pos) AS resolved_ids FROM f GROUP BY 1""")
def merge_resolutions(spark, d):
    how = records(spark, d).select("id", "pos", F.when(F.col("label").isNotNull(), F.concat("label", F.lit("/"), "prov")).alias("how")).where("how is not null")
    return merge.resolutions(how, ["id"], ["pos"], "how").select("id", joined("resolved_ids").alias("resolved_ids"))


@entry("""WITH n AS (SELECT o_custkey AS c_custkey, max_by(o_orderpriority, o_orderkey) AS label FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) SELECT c_custkey, coalesce(n.label, c_mktsegment) AS label FROM customer LEFT JOIN n USING (c_custkey)""")
def merge_single_source(spark, d):
    new = load(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("label"), "o_orderkey")
    return merge.overwrite(load(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("label")), new, ["c_custkey"], ["o_orderkey"])


@entry(f"""WITH r AS (SELECT id, pos, CASE WHEN pos % 3 = 0 THEN ' ' ELSE label END AS label, prov FROM ({RECORDS})), s AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS nth, min(CASE WHEN trim(label) <> '' THEN pos END) OVER (PARTITION BY id) AS filled FROM r)
SELECT id, coalesce(max(label) FILTER (pos = filled), max(label) FILTER (nth = 1)) AS label, 'creation: ' || max(prov) FILTER (nth = 1) || coalesce(max(chr(10) || 'label' || chr(9) || 'NULL' || chr(9) || label || chr(9) || prov || chr(9) || 'KeepFirst') FILTER (pos = filled AND nth > 1), '') AS prov FROM s GROUP BY 1""")
def merge_objects(spark, d):
    rows = records(spark, d).drop("tags").withColumn("label", F.when(F.col("pos") % 3 == 0, " ").otherwise(F.col("label")))
    return merge.merge_objects(rows, ["id"], ["pos"], "prov")


@entry(f"""WITH r AS ({RECORDS}), i AS (SELECT id, pos, unnest(tags) AS t, generate_subscripts(tags, 1) AS k FROM r) SELECT r.id, min_by(label, pos) FILTER (label IS NOT NULL) AS label, coalesce(max(s.tags), '') AS tags FROM r LEFT JOIN (SELECT id, string_agg(t, '|' ORDER BY pos, k) AS tags FROM i GROUP BY 1) s ON r.id = s.id GROUP BY 1""")
def merge_append(spark, d):
    out = merge.append_lists(records(spark, d).drop("prov"), ["id"], ["pos"])
    return out.withColumn("tags", joined("tags"))


@entry("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def existing_fetch(spark, d):
    wanted = load(spark, d, "orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return merge.existing(load(spark, d, "customer"), wanted, "c_custkey", ["c_name"])


# --- filters and pages


@entry("SELECT p_partkey, p_size > 25 AS large FROM part WHERE p_size > 25 AND p_brand IN ('Brand#2', 'true')")
def filter_coerced(spark, d):
    p = load(spark, d, "part").select("p_partkey", "p_brand", (F.col("p_size") > 25).alias("large"))
    return p.where(query.filters(p, {"large": query.coerce(["TRUE"]), "p_brand": ["Brand#2", "true"]})).select("p_partkey", "large")


CONCEPTS = """SELECT p_partkey::VARCHAR AS id, p_name AS name, CASE p_size % 3 WHEN 0 THEN 'multi' WHEN 1 THEN 'single' ELSE 'needs_review' END AS tier, CASE WHEN p_size % 10 > 0 THEN (p_size / 10.0)::DECIMAL(4, 1)::VARCHAR END AS quality, CASE WHEN p_partkey % 2 = 0 THEN 'True' ELSE 'false' END AS is_rare, p_type AS kind FROM part"""


def concepts(spark, d) -> DataFrame:
    size = F.col("p_size")
    tier = F.when(size % 3 == 0, "multi").when(size % 3 == 1, "single").otherwise("needs_review")
    quality = F.when(size % 10 > 0, F.format_string("%.1f", size / 10))
    return load(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), tier.alias("tier"), quality.alias("quality"), F.when(F.col("p_partkey") % 2 == 0, "True").otherwise("false").alias("is_rare"), F.col("p_type").alias("kind"))


@entry(f"SELECT id, quality FROM ({CONCEPTS}) WHERE try_cast(quality AS DOUBLE) >= 1.5 AND try_cast(quality AS DOUBLE) < 3.1")
def quality_range(spark, d):
    c = concepts(spark, d)
    return c.where(query.quality_range(F.col("quality"), "1.5-3.1")).select("id", "quality")


@entry(f"SELECT id, tier FROM ({CONCEPTS}) WHERE contains(lower(name), 'red') AND tier <> 'multi' AND tier = 'single' AND is_rare = 'True' AND try_cast(quality AS DOUBLE) BETWEEN 0.5 AND 4.7 AND id IN (SELECT l_partkey::VARCHAR FROM lineitem WHERE l_returnflag = 'R')")
def concept_filter(spark, d):
    sources = load(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("id"), F.col("l_returnflag").alias("source")).distinct()
    found = query.concepts(concepts(spark, d), sources, text="RED", tier="Single", quality="0.5-4.75", rare="true", source="R", flagged=F.col("tier") != "multi")
    return found.select("id", "tier")


@entry("SELECT p_partkey, p_name FROM part WHERE p_partkey > 57 ORDER BY p_partkey LIMIT 25")
def page_by_key(spark, d):
    return query.keyset_page(load(spark, d, "part").select("p_partkey", "p_name"), "p_partkey", 57, 25)


@entry("SELECT p_partkey, p_brand, p_size FROM part ORDER BY p_size DESC NULLS LAST, p_brand ASC NULLS FIRST, p_partkey LIMIT 15 OFFSET 30")
def sort_many_keys(spark, d):
    return query.sorted_page(load(spark, d, "part").select("p_partkey", "p_brand", "p_size"), [("p_size", True), ("p_brand", False)], "p_partkey", 30, 15)


@entry("SELECT o_orderkey FROM orders ORDER BY sha256('sample:' || o_orderkey::VARCHAR), o_orderkey LIMIT 500")
def sample_500(spark, d):
    return query.sample_rows(load(spark, d, "orders").select("o_orderkey"), "o_orderkey")


# --- identifiers of structures, groups


STRUCTURES = """SELECT 'S:' || p_partkey AS id, 'src' || (p_partkey % 3) AS source, CASE p_partkey % 11 WHEN 0 THEN 'C*CO' WHEN 1 THEN 'OC[R1]' ELSE 'CCO' END AS smiles, CASE p_partkey % 13 WHEN 0 THEN 'C2H5R' WHEN 1 THEN 'C2RuH' ELSE 'C2H6O' END AS formula, 'InChI=1S/C2H6O*' || p_size AS inchi,
upper(substr(translate(sha256((p_partkey // 2 % 211)::VARCHAR), '0123456789', 'ghijklmnop'), 1, 14)) || '-' || upper(substr(translate(sha256((p_partkey // 3 % 5)::VARCHAR), '0123456789', 'ghijklmnop'), 1, 10)) || '-N' AS inchi_key, CASE WHEN p_partkey % 5 > 0 THEN p_size * 20.0::DOUBLE END AS mass FROM part"""


def structures(spark, d) -> DataFrame:
    k = F.col("p_partkey")
    letters = lambda c, n: F.upper(F.substring(F.translate(F.sha2(c.cast("string"), 256), "0123456789", "ghijklmnop"), 1, n))
    key = F.concat(letters(F.floor(k / 2) % 211, 14), F.lit("-"), letters(F.floor(k / 3) % 5, 10), F.lit("-N"))
    return load(spark, d, "part").select(
        cid("S", "p_partkey").alias("id"),
        F.concat(F.lit("src"), k % 3).alias("source"),
        F.when(k % 11 == 0, "C*CO").when(k % 11 == 1, "OC[R1]").otherwise("CCO").alias("smiles"),
        F.when(k % 13 == 0, "C2H5R").when(k % 13 == 1, "C2RuH").otherwise("C2H6O").alias("formula"),
        F.concat(F.lit("InChI=1S/C2H6O*"), "p_size").alias("inchi"),
        key.alias("inchi_key"),
        F.when(k % 5 > 0, F.col("p_size") * 20.0).alias("mass"),
    )


@entry(f"SELECT id FROM ({STRUCTURES}) WHERE smiles LIKE '%*%' OR smiles LIKE '%[R%' OR formula = 'C2H5R'")
def generic_structures(spark, d):
    return structures(spark, d).where(cliques.is_generic(F.col("smiles"), F.col("formula"), F.col("inchi"))).select("id")


LINKS = """SELECT 'S:' || l_partkey AS start_id, 'S:' || ((l_partkey + l_linenumber) % (SELECT count(*) FROM part)) AS end_id, list_sort(list_distinct(list({'source': CASE l_returnflag WHEN 'A' THEN 'HMDB' WHEN 'N' THEN 'wikipathways' ELSE 'refmet' END, 'source_field': CASE WHEN l_suppkey % 2 = 0 THEN 'bdb' ELSE 'xref' END}))) AS details
FROM lineitem WHERE l_quantity = 50 GROUP BY 1, 2"""


def links(spark, d) -> DataFrame:
    parts = load(spark, d, "part").count()
    source = F.when(F.col("l_returnflag") == "A", "HMDB").when(F.col("l_returnflag") == "N", "wikipathways").otherwise("refmet")
    rows = load(spark, d, "lineitem").where("l_quantity = 50")
    detail = F.struct(source.alias("source"), F.when(F.col("l_suppkey") % 2 == 0, "bdb").otherwise("xref").alias("source_field"))
    return rows.groupBy(cid("S", "l_partkey").alias("start_id"), cid("S", (F.col("l_partkey") + F.col("l_linenumber")) % parts).alias("end_id")).agg(F.collect_set(detail).alias("details"))


def active(spark, d) -> DataFrame:
    return load(spark, d, "part").where("p_size <> 7").select(cid("S", "p_partkey").alias("id"))


def denied(spark, d) -> DataFrame:
    return load(spark, d, "part").select(cid("S", "p_partkey").alias("left"), cid("S", F.col("p_partkey") + 1).alias("right"))


def rules(spark, d, **more) -> cliques.Rules:
    return cliques.Rules(generic_mismatch=True, denied=denied(spark, d).where("substring(left, 3, 20) % 3 = 0"), prefixes={"hmdb": ["s"]}, fields={"wikipathways": ["bdb"]}, **more)


ALIVE = f"""WITH s AS ({STRUCTURES}), g AS (SELECT id FROM s WHERE smiles LIKE '%*%' OR smiles LIKE '%[R%' OR formula = 'C2H5R'), a AS (SELECT 'S:' || p_partkey AS id FROM part WHERE p_size <> 7), e AS ({LINKS}),
den AS (SELECT least('S:' || p_partkey, 'S:' || (p_partkey + 1)) AS l, greatest('S:' || p_partkey, 'S:' || (p_partkey + 1)) AS r FROM part WHERE p_partkey % 3 = 0),
alive AS (SELECT start_id, end_id, list_filter(details, lambda x: lower(x.source) <> 'hmdb' AND NOT (lower(x.source) = 'wikipathways' AND x.source_field = 'bdb')) AS kept FROM e WHERE start_id IN (FROM a) AND end_id IN (FROM a) AND (start_id IN (FROM g)) = (end_id IN (FROM g)) AND (least(start_id, end_id), greatest(start_id, end_id)) NOT IN (SELECT (l, r) FROM den))"""


@entry(f"""{ALIVE} SELECT start_id, end_id, len(kept)::BIGINT AS n, array_to_string(list_sort(list_distinct(list_transform(kept, lambda x: x.source))), '|') AS sources FROM alive WHERE len(kept) > 0""")
def edge_rules(spark, d):
    out = cliques.surviving_edges(links(spark, d), active(spark, d), structures(spark, d), rules(spark, d))
    return out.select("start_id", "end_id", F.size("details").cast("long").alias("n"), joined("sources").alias("sources"))


KEYED = f"""{ALIVE}, m AS (SELECT id, min(mass) AS mass FROM s GROUP BY 1), keyed AS (SELECT DISTINCT s.id, CASE WHEN coalesce(m.mass >= 500, false) THEN 'p' || split_part(inchi_key, '-', 1) ELSE 'd' || split_part(inchi_key, '-', 1) || '-' || split_part(inchi_key, '-', 2) END AS key FROM s JOIN m USING (id) WHERE s.id IN (FROM a))"""


@entry(f"""{KEYED} SELECT id AS src, low AS dst FROM (SELECT id, min(id) OVER (PARTITION BY key) AS low FROM keyed) WHERE id <> low""")
def structure_links(spark, d):
    return cliques.structure_links(structures(spark, d), active(spark, d), cliques.Rules(merge="mass"))


def grouped(spark, d) -> tuple[DataFrame, DataFrame]:
    edges = materialize(spark, cliques.surviving_edges(links(spark, d), active(spark, d), structures(spark, d), rules(spark, d)), "alive")
    return materialize(spark, cliques.groups(spark, active(spark, d), edges, structures(spark, d), cliques.Rules(merge="mass")), "groups"), edges


GROUPS = KEYED.replace("WITH s AS", "WITH RECURSIVE s AS", 1) + """, lk AS (SELECT start_id AS x, end_id AS y FROM alive WHERE len(kept) > 0 UNION SELECT id, low FROM (SELECT id, min(id) OVER (PARTITION BY key) AS low FROM keyed) WHERE id <> low), ways AS (SELECT x, y FROM lk UNION SELECT y, x FROM lk),
reach AS (SELECT id, id AS other FROM a UNION SELECT reach.id, ways.y FROM reach JOIN ways ON reach.other = ways.x), grp AS (SELECT id, min(other) AS component FROM reach GROUP BY 1)"""


@entry(f"{GROUPS} SELECT id, component FROM grp")
def structure_merge(spark, d):
    return grouped(spark, d)[0].select("id", "component")


@entry(f"""{GROUPS}, sized AS (SELECT component, count(*) AS size, min(id) AS first, string_agg(id, '|' ORDER BY id) AS members FROM grp GROUP BY 1 HAVING count(*) > 1) SELECT size::BIGINT AS size, first, sha1(members) AS digest, row_number() OVER (ORDER BY size DESC, first)::INT AS rank FROM sized""")
def clique_digest(spark, d):
    return cliques.ranked(grouped(spark, d)[0]).select("size", "first", "digest", "rank")


@entry(f"""{GROUPS}, p AS (SELECT least('S:' || p_partkey, 'S:' || (p_partkey + 1)) AS l, greatest('S:' || p_partkey, 'S:' || (p_partkey + 1)) AS r FROM part) SELECT DISTINCT l AS "left", r AS "right", x.component FROM p JOIN grp x ON l = x.id JOIN grp y ON r = y.id AND x.component = y.component""")
def denied_pairs(spark, d):
    return cliques.denied_still_joined(grouped(spark, d)[0], denied(spark, d))


@entry(f"""{GROUPS}, sized AS (SELECT component, count(*) AS n FROM grp GROUP BY 1) SELECT sum(n)::BIGINT AS active_ids, count(*) FILTER (n > 1)::BIGINT AS non_singletons, count(*) FILTER (n = 1)::BIGINT AS singletons, count(*)::BIGINT AS cliques, (SELECT count(*) FROM alive WHERE len(kept) > 0)::BIGINT AS active_edges,
(SELECT string_agg(n::VARCHAR, ',') FROM (SELECT n FROM sized WHERE n > 1 ORDER BY n DESC LIMIT 10)) AS largest FROM sized""")
def stage_summary(spark, d):
    return cliques.stage_summary(*grouped(spark, d)).withColumn("largest", F.array_join(F.col("largest").cast("array<string>"), ","))


@entry(f"""{GROUPS}, w AS (SELECT component, min(mass) AS low, max(mass) AS high FROM grp JOIN s USING (id) WHERE mass IS NOT NULL GROUP BY 1), z AS (SELECT component, count(*) AS size FROM grp GROUP BY 1)
SELECT component, size::BIGINT AS size, low, high, (high - low) / low AS spread FROM w JOIN z USING (component) WHERE low > 0 AND (high - low) / low > 0.1 ORDER BY spread DESC, size DESC, component LIMIT 50""")
def mass_warnings(spark, d):
    return cliques.mass_warnings(grouped(spark, d)[0], structures(spark, d))


@entry(f"SELECT id, split_part(inchi_key, '-', 1) AS skeleton, split_part(inchi_key, '-', 1) || '-' || split_part(inchi_key, '-', 2) AS duplex FROM ({STRUCTURES})")
def stereo_free_keys(spark, d):
    return structures(spark, d).select("id", cliques.key_prefix(F.col("inchi_key")).alias("skeleton"), cliques.key_duplex(F.col("inchi_key")).alias("duplex"))


# --- resolvers


@entry("""WITH x AS (SELECT 'P:' || p_partkey AS own, ['B:' || p_brand, 'T:' || p_type] AS refs FROM part), every AS (SELECT own, unnest(list_append(refs, own)) AS id FROM x), asked AS (SELECT 'B:' || p_brand AS id FROM part WHERE p_size = 3 UNION SELECT 'P:' || p_partkey FROM part WHERE p_size = 4) SELECT id, own FROM asked JOIN every USING (id)""")
def array_membership(spark, d):
    p = load(spark, d, "part")
    documents = p.select(cid("P", "p_partkey").alias("own"), F.array(cid("B", "p_brand"), cid("T", "p_type")).alias("refs"))
    asked = p.where("p_size = 3").select(cid("B", "p_brand").alias("id")).union(p.where("p_size = 4").select(cid("P", "p_partkey")))
    return resolve.match_any(asked, documents, "own", "refs")


@entry("""WITH c AS (SELECT 'Mondo:' || c_custkey AS own, CASE WHEN c_custkey % 2 = 0 THEN 'gard:' || c_nationkey ELSE 'Orphanet:' || c_nationkey END AS nn FROM customer), v AS (SELECT own, unnest([own, 'Mondo:' || split_part(own, ':', 2), 'MONDO:' || split_part(own, ':', 2), 'mondo:' || split_part(own, ':', 2)]) AS input, 0 AS priority FROM c
UNION ALL SELECT own, unnest(CASE WHEN nn LIKE 'gard%' THEN [nn, 'GARD:' || split_part(nn, ':', 2), 'GARD:' || lpad(split_part(nn, ':', 2), 7, '0'), 'gard:' || lpad(split_part(nn, ':', 2), 7, '0')] ELSE [nn, 'ORPHANET:' || split_part(nn, ':', 2), 'orphanet:' || split_part(nn, ':', 2)] END), 1 FROM c)
SELECT DISTINCT input, own AS match, priority::INT AS priority FROM v""")
def disease_aliases(spark, d):
    c = load(spark, d, "customer")
    rows = c.select(cid("Mondo", "c_custkey").alias("standard_id"), F.concat(F.lit(" "), F.when(F.col("c_custkey") % 2 == 0, cid("gard", "c_nationkey")).otherwise(cid("Orphanet", "c_nationkey")), F.lit(" ; ")).alias("nn"), F.lit("").alias("x"))
    return resolve.disease_matches(rows, "standard_id", "nn", ["x"])


@entry("""WITH t AS (SELECT 'UBERON:' || n_nationkey AS id, n_regionkey FROM nation) SELECT 'bto:' || n_regionkey AS input, max(id) AS match FROM t GROUP BY 1 UNION ALL SELECT id, id FROM t""")
def tissue_references(spark, d):
    n = load(spark, d, "nation")
    terms = n.select(cid("UBERON", "n_nationkey").alias("id"), F.array(F.concat(F.lit("BTO:"), "n_regionkey", F.lit(" ! a comment")), F.concat(F.lit("XYZ:"), "n_nationkey"), F.lit("nothing")).alias("xref"))
    return resolve.reference_map(terms, ["Bto"])


@entry("""WITH p AS (SELECT 'P:' || c_custkey AS id, CASE WHEN c_custkey % 4 <> 0 THEN 'P:' || (c_custkey - c_custkey % 4 + 1) END AS canonical FROM customer), h AS (SELECT * FROM p WHERE canonical IS NOT NULL AND canonical IN (SELECT id FROM p)), o AS (SELECT 'P:' || o_custkey AS id, 'T:' || o_orderkey AS t FROM orders WHERE o_orderpriority = '1-URGENT'),
ht AS (SELECT DISTINCT canonical AS match, t FROM h JOIN o USING (id)), tg AS (SELECT 'T:' || l_orderkey AS t, 'G:' || l_suppkey AS g FROM lineitem)
SELECT DISTINCT input, match, kind FROM (SELECT id AS input, canonical AS match, CASE WHEN id = canonical THEN 'exact' ELSE 'isoform' END AS kind FROM h UNION ALL SELECT 'U' || id, canonical, 'alias' FROM h UNION ALL SELECT t, match, 'transcript' FROM ht
UNION ALL SELECT g, match, 'gene' FROM ht JOIN tg USING (t) WHERE g IN (SELECT 'G:' || s_suppkey FROM supplier) UNION ALL SELECT 'N:' || s_nationkey, match, 'gene' FROM ht JOIN tg USING (t) JOIN supplier ON g = 'G:' || s_suppkey)""")
def target_aliases(spark, d):
    k = F.col("c_custkey")
    c, o, li, s = (load(spark, d, x) for x in ("customer", "orders", "lineitem", "supplier"))
    own = o.where("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_set(cid("T", "o_orderkey")).alias("transcripts"))
    proteins = c.select(cid("P", "c_custkey").alias("id"), "c_custkey", F.when(k % 4 != 0, cid("P", k - k % 4 + 1)).alias("canonical"))
    known = proteins.select(F.col("id").alias("canonical"))
    none = F.array().cast("array<string>")
    proteins = proteins.join(known, "canonical", "left_semi").join(own, "c_custkey", "left").select("id", "canonical", F.array(F.concat(F.lit("U"), "id")).alias("aliases"), F.coalesce("transcripts", none).alias("transcripts"), none.alias("genes"))
    genes_of = li.groupBy(cid("T", "l_orderkey").alias("id")).agg(F.collect_set(cid("G", "l_suppkey")).alias("genes"))
    transcripts = o.select(cid("T", "o_orderkey").alias("id")).join(genes_of, "id", "left").select(F.array("id").alias("aliases"), F.coalesce("genes", none).alias("genes"))
    genes = s.select(F.array(cid("G", "s_suppkey"), cid("N", "s_nationkey")).alias("aliases"))
    # a gene is found by its own id only: names of other kinds are what it brings
    by_own = genes.select("aliases", F.get("aliases", F.lit(0)).alias("own"))
    found = resolve.roll_up_aliases(proteins, transcripts, by_own.select("aliases"))
    return found


@entry("""SELECT 'N:' || c_nationkey AS match, 'C:' || c_custkey AS input FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def allowed_matches(spark, d):
    matches = load(spark, d, "customer").select(cid("C", "c_custkey").alias("input"), cid("N", "c_nationkey").alias("match"))
    return resolve.allow_list(matches, load(spark, d, "supplier").where("s_acctbal > 5000").select(cid("N", "s_nationkey").alias("id")))


@entry("""SELECT p_partkey AS id, CASE WHEN p_size % 4 = 0 OR p_size % 4 = 1 THEN 'Protein' ELSE 'Gene' END AS type FROM part""")
def cross_type(spark, d):
    size = F.col("p_size")
    nodes = load(spark, d, "part").select(F.col("p_partkey").alias("id"), F.lit("Gene").alias("type"), F.col("p_name").alias("name"), F.when(size % 4 == 2, "chr1").when(size % 4 == 1, " ").alias("location"), F.when(size % 4 == 3, F.array("p_brand")).when(size % 4 == 0, F.array().cast("array<string>")).alias("synonyms"))
    return resolve.retype(nodes, ["name"], "Protein").select("id", "type")


@entry("""SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 AND o_orderkey % 3 = 0 THEN 'ProteinDiseaseEdge' WHEN o_custkey % 2 = 0 AND o_orderkey % 3 = 1 THEN 'GenePathwayEdge' ELSE CASE o_orderkey % 3 WHEN 0 THEN 'GeneDiseaseEdge' WHEN 1 THEN 'GenePathwayEdge' ELSE 'ProteinGoTermEdge' END END AS kind FROM orders""")
def edge_classes(spark, d):
    k = F.col("o_orderkey") % 3
    kind = F.when(k == 0, "GeneDiseaseEdge").when(k == 1, "GenePathwayEdge").otherwise("ProteinGoTermEdge")
    start = F.when(F.col("o_custkey") % 2 == 0, "Protein").otherwise("Gene")
    return load(spark, d, "orders").select("o_orderkey", resolve.canonical_edge(kind, start, F.lit("Disease")).alias("kind"))


@entry("""WITH m AS (SELECT c_custkey AS k, c_nationkey || '|' || (c_nationkey + 100) AS listed, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS label FROM customer), home AS (SELECT own, min(k) AS k FROM (SELECT k, unnest(string_split(listed, '|')) AS own FROM m) GROUP BY 1),
o AS (SELECT (s_nationkey + 100 * (s_suppkey % 3))::VARCHAR AS own, s_name AS label FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey, s_suppkey % 3 ORDER BY s_suppkey) AS r FROM supplier) WHERE r = 1), b AS (SELECT k, min_by(label, own) AS label FROM o JOIN home USING (own) GROUP BY 1)
SELECT m.k::VARCHAR AS k, coalesce(m.label, b.label) AS label, 'main' AS side FROM m LEFT JOIN b USING (k) UNION ALL SELECT own, label, 'orphan' FROM o WHERE own NOT IN (SELECT own FROM home)""")
def pipe_orphans(spark, d):
    c, s = load(spark, d, "customer"), load(spark, d, "supplier")
    main = c.select(F.col("c_custkey").alias("k"), F.concat("c_nationkey", F.lit("|"), F.col("c_nationkey") + 100).alias("listed"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("label"))
    orphans = s.groupBy((F.col("s_nationkey") + 100 * (F.col("s_suppkey") % 3)).cast("string").alias("own")).agg(F.min_by("s_name", "s_suppkey").alias("label"))
    kept, left = resolve.reconcile_lists(main, orphans, "k", "listed", "own", ["label"])
    return kept.select(F.col("k").cast("string").alias("k"), "label", F.lit("main").alias("side")).union(left.select("own", "label", F.lit("orphan")))


@entry("""WITH l AS (SELECT n_nationkey AS k, n_regionkey AS r FROM nation WHERE n_nationkey < 9), r AS (SELECT s_suppkey, s_nationkey AS k FROM supplier), u AS (SELECT k, min(s_suppkey) AS m FROM r GROUP BY 1 HAVING count(*) = 1)
SELECT l.k, m AS s_suppkey, CASE WHEN m IS NULL THEN 'none' ELSE 'k' END AS match_source FROM l LEFT JOIN u USING (k) UNION ALL SELECT k, s_suppkey, 'right' FROM r WHERE s_suppkey NOT IN (SELECT m FROM l JOIN u USING (k))""")
def precedence_append(spark, d):
    left = load(spark, d, "nation").where("n_nationkey < 9").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("r"))
    right = load(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k"))
    return resolve.cascade(left, right, ["k"], "s_suppkey", append=True).select("k", "s_suppkey", "match_source")


# --- aggregates


@entry("""WITH x AS (SELECT l_orderkey, list_sort(list(l_returnflag)) AS sources FROM lineitem GROUP BY 1) SELECT 'marginal' AS kind, value, count(*)::BIGINT AS n FROM (SELECT unnest(list_distinct(sources)) AS value FROM x) GROUP BY 2 UNION ALL SELECT 'joint', array_to_string(sources, '|'), count(*)::BIGINT FROM x GROUP BY 2""")
def source_counts(spark, d):
    return stats.source_counts(load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_returnflag").alias("sources")), "sources")


@entry("""SELECT l_returnflag AS platform, l_linestatus AS kind, sum(len(items) * q)::BIGINT AS n FROM (SELECT l_returnflag, l_linestatus, [l_quantity, l_linenumber] AS items, 1 AS q FROM lineitem) GROUP BY 1, 2""")
def unnested_sum(spark, d):
    items = load(spark, d, "lineitem").select(F.col("l_returnflag").alias("platform"), F.col("l_linestatus").alias("kind"), F.explode(F.array(F.col("l_quantity"), F.col("l_linenumber").cast("double"))).alias("item"))
    return items.groupBy("platform", "kind").agg(F.sum(F.lit(1)).alias("n"))


@entry("""WITH RECURSIVE node AS (SELECT 'r' || r_regionkey AS node FROM region UNION ALL SELECT 'n' || n_nationkey FROM nation), cl AS (SELECT node AS ancestor, node AS descendant FROM node UNION SELECT 'r' || n_regionkey, 'n' || n_nationkey FROM nation),
l AS (SELECT 'n' || c_nationkey AS node, CASE WHEN c_custkey % 9 > 0 THEN c_custkey % 40 END AS target, CASE c_custkey % 5 WHEN 0 THEN 'Tclin' WHEN 1 THEN 'Tchem' WHEN 2 THEN 'Tbio' ELSE 'Tdark' END AS tier, c_acctbal > 9000 AS direct FROM customer UNION ALL SELECT 'r' || (c_custkey % 4), c_custkey, 'Tbio', true FROM customer WHERE c_acctbal > 9900),
own AS (SELECT node, count(DISTINCT target) AS d, max(CASE tier WHEN 'Tclin' THEN 4 WHEN 'Tchem' THEN 3 WHEN 'Tbio' THEN 2 ELSE 1 END) AS code FROM l WHERE direct GROUP BY 1), below AS (SELECT ancestor AS node, count(DISTINCT target) AS t FROM cl JOIN l ON descendant = l.node GROUP BY 1)
SELECT node, coalesce(t, 0)::BIGINT AS target_count, coalesce(d, 0)::BIGINT AS direct_target_count, CASE code WHEN 4 THEN 'Tclin' WHEN 3 THEN 'Tchem' WHEN 2 THEN 'Tbio' WHEN 1 THEN 'Tdark' END AS max_tier FROM node LEFT JOIN own USING (node) LEFT JOIN below USING (node)""")
def closure_rollup(spark, d):
    n, c, k = load(spark, d, "nation"), load(spark, d, "customer"), F.col("c_custkey")
    pre = lambda p, x: F.concat(F.lit(p), x)
    nodes = load(spark, d, "region").select(pre("r", "r_regionkey").alias("node")).union(n.select(pre("n", "n_nationkey")))
    edges = n.select(pre("r", "n_regionkey").alias("parent"), pre("n", "n_nationkey").alias("child"))
    tier = F.when(k % 5 == 0, "Tclin").when(k % 5 == 1, "Tchem").when(k % 5 == 2, "Tbio").otherwise("Tdark")
    own = c.select(pre("n", "c_nationkey").alias("node"), F.when(k % 9 > 0, k % 40).alias("target"), tier.alias("tier"), (F.col("c_acctbal") > 9000).alias("direct"))
    top = c.where("c_acctbal > 9900").select(pre("r", k % 4), k, F.lit("Tbio"), F.lit(True))
    return stats.closure_rollup(graph.transitive_closure(spark, edges, nodes), own.union(top), nodes, "target", "tier")


@entry("""SELECT p_brand, p_type, string_agg(DISTINCT p_size::VARCHAR, '|' ORDER BY p_size::VARCHAR) AS p_size FROM part GROUP BY 1, 2""")
def collapse_rows(spark, d):
    return stats.collapse(load(spark, d, "part").select("p_brand", "p_type", F.col("p_size").cast("string").alias("p_size")), "p_size")


@entry("""WITH x AS (SELECT p_brand, unnest([p_type, 'x' || p_size % 3]) AS a, CASE WHEN p_size > 48 THEN p_name END AS b FROM part) SELECT p_brand, string_agg(DISTINCT a, '|' ORDER BY a) AS a, string_agg(DISTINCT b, '|' ORDER BY b) AS b FROM x GROUP BY 1""")
def union_lists(spark, d):
    p = load(spark, d, "part")
    return stats.union_lists(p.select("p_brand", F.concat("p_type", F.lit(" |x"), F.col("p_size") % 3).alias("a"), F.when(F.col("p_size") > 48, F.col("p_name")).alias("b")), "p_brand")


@entry("""SELECT field, value, count(*)::BIGINT AS n FROM (SELECT 'c_mktsegment' AS field, c_mktsegment AS value FROM customer UNION ALL SELECT 'c_nationkey', c_nationkey::VARCHAR FROM customer) GROUP BY 1, 2""")
def distributions(spark, d):
    return stats.distributions(load(spark, d, "customer"), ["c_mktsegment", "c_nationkey"])


@entry("""WITH f AS (SELECT c_custkey::VARCHAR AS k, c_nationkey || '|n' || (c_custkey % 50) AS alts FROM customer), m AS (SELECT o_custkey::VARCHAR AS input FROM orders WHERE o_totalprice > 400000 UNION SELECT 'n' || s_suppkey FROM supplier WHERE s_suppkey < 30),
h AS (SELECT k, max((i IN (FROM m))::INT) AS hit FROM (SELECT k, unnest(list_prepend(k, string_split(alts, '|'))) AS i FROM f) GROUP BY 1) SELECT count(*)::BIGINT AS total, sum(hit)::BIGINT AS mapped, 100.0::DOUBLE * sum(hit) / count(*) AS percent FROM h""")
def mapped_coverage(spark, d):
    c, k = load(spark, d, "customer"), F.col("c_custkey")
    rows = c.select(k.cast("string").alias("k"), F.concat("c_nationkey", F.lit(" | n"), k % 50).alias("alts"))
    m = load(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").cast("string").alias("input")).union(load(spark, d, "supplier").where("s_suppkey < 30").select(F.concat(F.lit("n"), "s_suppkey")))
    return stats.mapped_coverage(rows.union(rows), "k", "alts", m)


@entry("""WITH s AS (SELECT p_brand AS source, count(DISTINCT p_partkey) AS n FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, source) AS r, max(n) OVER () AS top FROM s) SELECT source FROM r WHERE CASE WHEN top >= 40 THEN n >= 40 AND r <= 10 ELSE r <= 6 END""")
def large_sources(spark, d):
    return stats.large_sources(load(spark, d, "part"), "p_brand", "p_partkey", 40)


@entry("""SELECT 'C:' || l_partkey AS compound, year(o_orderdate)::INT AS year, count(DISTINCT o_custkey)::BIGINT AS families FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey > 0 AND year(o_orderdate) BETWEEN 1950 AND 1997 AND l_returnflag = 'R' GROUP BY 1, 2""")
def families_by_year(spark, d):
    mentions = load(spark, d, "lineitem").where("l_returnflag = 'R'").select(cid("C", "l_partkey").alias("compound"), F.col("l_orderkey").alias("patent"))
    patents = load(spark, d, "orders").select(F.col("o_orderkey").alias("patent"), F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("family"))
    return adapters.patent_families(mentions, patents, 1997)


@entry("""SELECT l_suppkey AS gene_id, l_returnflag || l_linenumber AS text, strftime(max(l_shipdate), '%Y-%m-%d') AS date, string_agg(DISTINCT l_quantity::INT::VARCHAR, '|' ORDER BY l_quantity::INT::VARCHAR) AS papers FROM lineitem WHERE l_linenumber > 1 GROUP BY 1, 2""")
def grouped_notes(spark, d):
    notes = load(spark, d, "lineitem").select(F.col("l_suppkey").alias("gene_id"), F.when(F.col("l_linenumber") > 1, F.concat("l_returnflag", "l_linenumber")).alias("text"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"), F.col("l_quantity").cast("int").cast("string").alias("paper"))
    return adapters.grouped_notes(notes).withColumn("papers", joined("papers"))


@entry("""SELECT p_partkey, array_to_string(list_sort(list_distinct(list(p_type) OVER (PARTITION BY p_brand))), '|') AS types FROM part""")
def group_strings(spark, d):
    p = load(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    return p.join(p.groupBy("p_brand").agg(joined(F.array_sort(F.collect_set("p_type"))).alias("types")), "p_brand").select("p_partkey", "types")


@entry("""WITH s AS (SELECT p_brand, p_partkey, p_size / 100.0::DOUBLE AS score FROM part), r AS (SELECT *, row_number() OVER w AS r, lead(score) OVER w AS next FROM s WINDOW w AS (PARTITION BY p_brand ORDER BY score DESC, p_partkey)) SELECT p_brand, p_partkey, coalesce(score - next <= 0.03, false) AS ambiguous FROM r WHERE r = 1""")
def ambiguous_best(spark, d):
    s = load(spark, d, "part").select("p_brand", "p_partkey", (F.col("p_size") / 100.0).alias("score"))
    two = query.top_per_group(s, ["p_brand"], [F.desc("score"), F.asc("p_partkey")], 2)
    best = two.groupBy("p_brand").agg(F.min_by("p_partkey", "rank").alias("p_partkey"), F.min_by("score", "rank").alias("a"), F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("b"))
    return best.select("p_brand", "p_partkey", F.coalesce(F.col("a") - F.col("b") <= 0.03, F.lit(False)).alias("ambiguous"))


# --- names, dates, ids


@entry("""WITH x AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'ES_' || p_type || '__vs_' || p_brand WHEN 1 THEN 'ESPval_' || p_type || '_VS_Mock' WHEN 2 THEN 'ESadjPval_Age' WHEN 3 THEN 'ES2_' || p_type ELSE 'other__name' END AS c FROM part)
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'effect_size' WHEN 1 THEN 'pvalue' WHEN 2 THEN 'adjusted_pvalue' WHEN 3 THEN 'effect_size_2' END AS stat_type, CASE p_partkey % 5 WHEN 2 THEN 'Age' WHEN 4 THEN 'other_name' ELSE split_part(split_part(c, '_', 2), '_', 1) END AS group1, CASE p_partkey % 5 WHEN 0 THEN split_part(c, '__vs_', 2) WHEN 1 THEN 'Mock' END AS group2 FROM x""")
def column_grammar(spark, d):
    k = F.col("p_partkey") % 5
    name = F.when(k == 0, F.concat(F.lit("ES_"), "p_type", F.lit("__vs_"), "p_brand")).when(k == 1, F.concat(F.lit("ESPval_"), "p_type", F.lit("_VS_Mock"))).when(k == 2, "ESadjPval_Age").when(k == 3, F.concat(F.lit("ES2_"), "p_type")).otherwise("other__name")
    return load(spark, d, "part").select("p_partkey", names.comparison(name).alias("x")).select("p_partkey", "x.stat_type", "x.group1", "x.group2")


SIDES = """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'E' || p_size % 6 ELSE '' END AS a, CASE WHEN p_size % 3 = 0 THEN 'E' || p_size % 6 || '.2' END AS b, CASE WHEN p_size % 5 = 0 THEN 'E' || p_size % 4 || '-1|X9' END AS c FROM part"""


def sides(spark, d) -> DataFrame:
    s = F.col("p_size")
    return load(spark, d, "part").select("p_partkey", F.when(s % 2 == 0, F.concat(F.lit("E"), s % 6)).otherwise("").alias("a"), F.when(s % 3 == 0, F.concat(F.lit("E"), s % 6, F.lit(".2"))).alias("b"), F.when(s % 5 == 0, F.concat(F.lit("E"), s % 4, F.lit("-1|X9"))).alias("c"))


@entry(f"""WITH x AS ({SIDES}), y AS (SELECT p_partkey, list_filter([CASE WHEN a <> '' THEN {{'s': 'ensembl', 'i': [a]}} END, CASE WHEN b IS NOT NULL THEN {{'s': 'refseq', 'i': [split_part(b, '.', 1)]}} END, CASE WHEN c IS NOT NULL THEN {{'s': 'uniprot', 'i': [split_part(c, '-', 1), 'X9']}} END], lambda z: z IS NOT NULL) AS f FROM x),
z AS (SELECT p_partkey, f, flatten(list_transform(f, lambda q: q.i)) AS i FROM y), w AS (SELECT p_partkey, CASE WHEN len(f) = 0 THEN NULL WHEN len(f) = 1 OR len(list_distinct(i)) < len(i) THEN array_to_string(list_transform(f, lambda q: q.s), ', ') ELSE 'error' END AS provenance, len(f) AS n FROM z)
SELECT p_partkey, provenance, CASE WHEN provenance IS NULL OR provenance = 'error' THEN 0 ELSE least(n, 2) END::INT AS score FROM w""")
def provenance_overlap(spark, d):
    p = names.provenance_overlap({"ensembl": F.col("a"), "refseq": F.col("b"), "uniprot": F.col("c")})
    return sides(spark, d).select("p_partkey", p.alias("provenance")).withColumn("score", names.provenance_score(F.col("provenance"), 2))


@entry(f"""WITH x AS (SELECT p_partkey, a, coalesce(split_part(b, '.', 1), '') AS b, coalesce(split_part(c, '-', 1), '') AS c FROM ({SIDES})), y AS (SELECT *, list_filter([a, b, c], lambda z: z <> '') AS f FROM x)
SELECT p_partkey, CASE WHEN len(f) = 0 THEN NULL WHEN len(list_distinct(f)) = 1 THEN array_to_string(list_filter([CASE WHEN a <> '' THEN 'ensembl' END, CASE WHEN b <> '' THEN 'ncbi' END, CASE WHEN c <> '' THEN 'hgnc' END], lambda z: z IS NOT NULL), ', ') ELSE 'error' END AS provenance, len(f)::INT AS score FROM y""")
def provenance_equal(spark, d):
    v = {"ensembl": F.col("a"), "ncbi": F.substring_index("b", ".", 1), "hgnc": F.substring_index("c", "-", 1)}
    return sides(spark, d).select("p_partkey", names.provenance_equal(v).alias("provenance"), names.filled_score(v).alias("score"))


@entry("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN p_name WHEN p_size % 4 = 1 THEN p_name ELSE p_name || ' | ' || 'zq zq' END AS name, CASE WHEN p_size % 4 = 0 THEN 0.0 WHEN p_size % 4 = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS score, CASE WHEN p_size % 4 = 0 THEN 'None' WHEN p_size % 4 = 1 THEN 'Exact' ELSE 'Token-Fallback' END AS method FROM part""")
def name_methods(spark, d):
    s = F.col("p_size") % 4
    found = names.combined_name(F.col("p_name"), F.when(s == 1, F.col("p_name")).when(s > 1, "zq zq"), F.lit(None).cast("string"))
    return load(spark, d, "part").select("p_partkey", found.alias("x")).select("p_partkey", "x.name", "x.score", "x.method")


@entry("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y') END AS day, strftime(o_orderdate, '%Y-%m-%d') AS from_sheet FROM orders""")
def publication_dates(spark, d):
    k, date = F.col("o_orderkey") % 4, F.col("o_orderdate")
    part = lambda f: F.date_format(date, f)
    found = text.publication_date(F.when(k < 3, part("yyyy")), F.when(k == 0, part("M")).when(k == 1, F.concat(part("MMM"), F.lit("ember"))), F.when(k == 0, part("d")), F.when(k == 3, F.concat(F.lit("Spring "), part("yyyy"), F.lit("-Fall"))))
    serial = F.datediff(date.cast("date"), F.lit("1899-12-30").cast("date")).cast("string")
    return load(spark, d, "orders").select("o_orderkey", found.alias("day"), text.excel_date(serial).cast("string").alias("from_sheet"))


@entry("""SELECT s_name, CASE WHEN s_suppkey % 3 = 0 THEN 'OLD:' || s_suppkey ELSE 'NEW:' || upper(substr(sha256(upper(trim(s_name))), 1, 12)) END AS id FROM supplier""")
def reused_ids(spark, d):
    s = load(spark, d, "supplier")
    known = s.where("s_suppkey % 3 = 0").select(F.concat(F.lit(" "), F.lower("s_name")).alias("s_name"), cid("OLD", "s_suppkey").alias("id"))
    return diff.allocate_ids(s.select("s_name"), known, "s_name", "NEW")


@entry("""SELECT p_partkey, CASE p_size % 8 WHEN 0 THEN 'merged' WHEN 1 THEN 'absorbed as xref' WHEN 2 THEN 'all obsolete' WHEN 3 THEN 'dropped by decision' WHEN 4 THEN 'source only' WHEN 5 THEN 'evidence lost' WHEN 6 THEN 'no evidence' ELSE 'absent' END AS reason FROM part""")
def removal_reasons(spark, d):
    at = lambda k: F.col("p_size") % 8 == k
    return load(spark, d, "part").select("p_partkey", diff.removal_reason(at(0), at(0) | at(1), at(2), at(2) | at(3), at(4), at(5), ~at(6)).alias("reason"))


@entry("""SELECT p_brand, p_type, CASE WHEN p_size % 7 = 0 THEN 'error' ELSE 'ensembl' END AS provenance, count(*)::BIGINT AS copies, count(*) > 1 OR p_size % 7 = 0 AS flagged FROM part GROUP BY p_brand, p_type, p_size % 7 = 0""")
def review_flags(spark, d):
    rows = load(spark, d, "part").select("p_brand", "p_type", F.when(F.col("p_size") % 7 == 0, "error").otherwise("ensembl").alias("provenance"))
    return diff.flag_for_review(rows, ["provenance"])


# --- sheets


@entry("""SELECT p_partkey::VARCHAR AS "row", 'props' AS field FROM part WHERE p_brand = 'Brand#2' AND p_size % 3 <> 0""")
def validate_conditional_key(spark, d):
    size = F.col("p_size")
    rows = load(spark, d, "part").withColumn("props", F.create_map(F.when(size % 3 == 1, "other").otherwise("unit"), F.when(size % 3 == 2, "N/A").otherwise("kg")))
    return validate.conditional_required_map_key(rows, "p_partkey", "part", "props", "unit", "p_brand", ["BRAND#2"]).select("row", "field")


@entry("""SELECT 'error' AS severity, 'GeneMeta' AS field, NULL::VARCHAR AS sheet, 'missing sheet: GeneMeta' AS message UNION ALL SELECT DISTINCT 'warning', p_type, p_type, 'unknown sheet: ' || p_type FROM part WHERE p_type <> 'ECONOMY'""")
def sheet_structure(spark, d):
    columns = load(spark, d, "part").select(F.col("p_type").alias("sheet"), F.col("p_brand").alias("column"))
    return validate.sheets(columns, ["ECONOMY", "GeneMeta"], ["ECONOMY", "GeneMeta"], "a.xlsx").select("severity", "field", "sheet", "message")


@entry("""SELECT 'key' || p_partkey AS field, 'Map' AS sheet, 'no such column in ECONOMY: ' || p_brand AS message FROM part WHERE p_type <> 'ECONOMY' AND p_size > 3 AND p_brand NOT IN (SELECT p_brand FROM part WHERE p_type = 'ECONOMY')
UNION ALL SELECT DISTINCT 'unit' || n_nationkey || 'x', 'Map', 'unknown key: unit' || n_nationkey || 'x' FROM nation""")
def sheet_columns(spark, d):
    p = load(spark, d, "part")
    columns = p.select(F.col("p_type").alias("sheet"), F.col("p_brand").alias("column"))
    mapping = p.where("p_type <> 'ECONOMY'").select(F.concat(F.lit("key"), "p_partkey").alias("key"), F.when(F.col("p_size") > 3, F.col("p_brand")).otherwise("NA").alias("column"))
    lost = validate.mapped_columns(mapping, columns, "Map", "ECONOMY", "a.xlsx")
    keys = load(spark, d, "nation").select(F.concat(F.lit("unit"), "n_nationkey", F.lit("x")).alias("key")).union(load(spark, d, "nation").select(F.concat(F.lit("name"), "n_nationkey")))
    return lost.union(validate.unknown_keys(keys, ["name{}"], "Map", "a.xlsx")).select("field", "sheet", "message")


@entry("""SELECT 'error' AS severity, 'p_name' AS "column", p_partkey::VARCHAR AS "row", 'Parts' AS sheet, 'parts.xlsx' AS source_file FROM part WHERE p_size % 9 = 0""")
def report_places(spark, d):
    rows = load(spark, d, "part").withColumn("p_name", F.when(F.col("p_size") % 9 > 0, F.col("p_name")))
    return validate.placed(validate.required(rows, "p_partkey", "part", "p_name"), "Parts", source_file="parts.xlsx").select("severity", "column", "row", "sheet", "source_file")


# --- exports


@entry("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS nth FROM orders) SELECT sha1(o_custkey || '|' || nth) AS parent_id, i::INT AS position, CASE i WHEN 0 THEN o_orderpriority ELSE o_orderstatus END AS value FROM o, (VALUES (0), (1)) AS v(i)""")
def export_grandchildren(spark, d):
    o = load(spark, d, "orders")
    item = F.struct("o_orderkey", F.array("o_orderpriority", "o_orderstatus").alias("notes"))
    nested = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(item)).alias("orderLines"))
    return export.flatten(nested, "Customer", "o_custkey")["customer__order_lines__notes"]


@entry("""SELECT 'c' || o_custkey AS from_id, 'o' || o_orderkey AS to_id, o_totalprice AS price, unnest([o_orderpriority, o_orderstatus]) AS source FROM orders""")
def export_edges(spark, d):
    edges = load(spark, d, "orders").select(F.concat(F.lit("c"), "o_custkey").alias("start_id"), F.concat(F.lit("o"), "o_orderkey").alias("end_id"), F.col("o_totalprice").alias("price"), F.array("o_orderpriority", "o_orderstatus").alias("sources"), F.array(F.struct("o_orderkey")).alias("details"))
    return export.edge_table(edges)


@entry("""WITH e AS (SELECT DISTINCT p_brand AS source, p_type AS target FROM part WHERE p_size < 4), f AS (SELECT DISTINCT p_brand AS c FROM part WHERE p_size = 1), o AS (SELECT target, count(DISTINCT source) AS n FROM e WHERE source NOT IN (FROM f) GROUP BY 1)
SELECT source AS parent, e.target, source || '>' || e.target AS edge, CASE coalesce(n, 0) WHEN 0 THEN 'analyte' WHEN 1 THEN 'sample' ELSE 'edge' END AS role FROM e LEFT JOIN o USING (target) WHERE source IN (FROM f)""")
def export_table_plan(spark, d):
    p = load(spark, d, "part")
    edges = p.where("p_size < 4").select(F.col("p_brand").alias("source"), F.col("p_type").alias("target")).distinct().withColumn("edge", F.concat("source", F.lit(">"), "target"))
    return export.plan_data_tables(edges, p.where("p_size = 1").select(F.col("p_brand").alias("collection")))


@entry("""SELECT '<http://kg/c%20' || o_custkey || '> <' || p || '> <http://kg/o' || o_orderkey || '> .' AS value FROM orders, (VALUES ('http://kg/placed'), ('http://biolink/related_to')) AS v(p)
UNION ALL SELECT '<http://kg/' || n_nationkey || '> <http://kg/note> "a\\"b\\\\c\\n' || n_name || '" .' FROM nation UNION ALL SELECT '<http://kg/' || n_nationkey || '> <http://kg/n_regionkey> <http://kg/' || n_regionkey || '> .' FROM nation""")
def ntriples_edges(spark, d):
    edges = load(spark, d, "orders").select(F.concat(F.lit("c "), "o_custkey").alias("start_id"), F.concat(F.lit("o"), "o_orderkey").alias("end_id"))
    nodes = load(spark, d, "nation").withColumn("note", F.concat(F.lit('a"b\\c\n'), "n_name"))
    return export.edge_triples(edges, "http://kg/", F.lit("placed"), {"placed": "http://biolink/related_to"}).union(export.triples(nodes, F.col("n_nationkey").cast("string"), "http://kg/", ["note", "n_regionkey"], links=("n_regionkey",)))


# --- source families


@entry("""SELECT 'UniProtKB:' || l_partkey AS start_id, 'GO:' || lpad(l_suppkey::VARCHAR, 7, '0') AS end_id, string_agg(DISTINCT l_returnflag || '/' || l_linestatus, ',' ORDER BY l_returnflag || '/' || l_linestatus) AS evidence FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2""")
def annotation_edges(spark, d):
    rows = load(spark, d, "lineitem").select(F.col("l_partkey").alias("object_id"), F.concat(F.lit("GO:"), F.lpad(F.col("l_suppkey").cast("string"), 7, "0")).alias("term"), F.when(F.col("l_returnflag") == "N", "ND").otherwise(F.col("l_returnflag")).alias("evidence"), F.col("l_linestatus").alias("assigned_by"))
    return adapters.annotation_edges(rows).withColumn("evidence", F.array_join(F.transform("evidence", lambda e: F.concat(e["code"], F.lit("/"), e["assigned_by"])), ","))


@entry("""SELECT 'NCBIGene:' || o_custkey AS start_id, 'MESH:' || o_orderkey % 30 AS end_id, 'name' || o_orderkey % 30 AS name, count(*)::BIGINT AS n FROM orders WHERE o_orderkey % 30 > 0 GROUP BY ALL""")
def curated_diseases(spark, d):
    k = F.col("o_orderkey") % 30
    rows = load(spark, d, "orders").select(F.when(k > 0, F.concat(F.lit(" MESH:"), k)).otherwise("").alias("DiseaseID"), F.concat(F.lit("name"), k).alias("DiseaseName"), F.col("o_custkey").cast("string").alias("GeneID"), F.lit("marker|therapeutic").alias("DirectEvidence"), F.lit(None).cast("string").alias("PubMedIDs"))
    return adapters.curated_diseases(rows).select("start_id", "end_id", "name", F.size("details").cast("long").alias("n"))


@entry("""SELECT 'MGI:' || l_partkey AS start_id, 'MP:' || l_suppkey AS end_id, count(*)::BIGINT AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2""")
def phenotype_edges(spark, d):
    a = F.col("l_returnflag") == "A"
    rows = load(spark, d, "lineitem").select(cid("MGI", "l_partkey").alias("marker_accession_id"), F.when(a, cid("MP", "l_suppkey")).otherwise("-").alias("mp_term_id"))
    return adapters.phenotype_edges(rows)


@entry("""SELECT o_orderkey, o_orderpriority AS "AssociationType" FROM orders WHERE o_orderpriority <> '5-LOW'""")
def implicated_rows(spark, d):
    rows = load(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", "is_not_implicated_in").otherwise(F.col("o_orderpriority")).alias("AssociationType"))
    return adapters.implicated(rows)


@entry("""SELECT 'R-' || p_partkey AS id, p_partkey::VARCHAR AS source_id, p_name AS name, p_brand AS source, CASE WHEN p_partkey % 2 = 0 THEN 'http://bio/R-' || p_partkey END AS url, p_type AS member FROM part WHERE p_brand <> 'Brand#2'""")
def named_sets(spark, d):
    p = load(spark, d, "part")
    sets = p.select(F.concat(F.when(F.col("p_partkey") % 2 == 0, "http://bio/").otherwise(""), F.lit("R-"), "p_partkey").alias("name"), F.concat(F.lit("name: "), "p_name", F.lit("; datasource: "), "p_brand", F.lit("; organism: 9606")).alias("url"), F.col("p_type").alias("member"))
    out = readers.named_sets(sets, ("Brand#2",), ("http://bio/",))
    return out.withColumn("source_id", F.regexp_replace("source_id", "^R-", ""))


TERMS = "SELECT 'n' || n_nationkey AS id, 'r' || n_regionkey AS parent, n_name FROM nation"


@entry(f"""SELECT id, CASE WHEN parent = 'r1' OR id = 'n0' THEN 'role' ELSE 'chemical' END AS kind FROM ({TERMS}) UNION ALL SELECT 'r' || r_regionkey, CASE WHEN r_regionkey = 1 THEN 'role' ELSE 'chemical' END FROM region""")
def typed_terms(spark, d):
    n = load(spark, d, "nation")
    pre = lambda p, x: F.concat(F.lit(p), x)
    terms = n.select(pre("n", "n_nationkey").alias("id")).union(load(spark, d, "region").select(pre("r", "r_regionkey")))
    parents = n.select(pre("r", "n_regionkey").alias("parent"), pre("n", "n_nationkey").alias("child"))
    return adapters.typed_terms(spark, terms, parents, "r1", "r2", terms.where("id = 'n0'"), terms.where("id = 'n3'"))


@entry(f"""SELECT id FROM ({TERMS}) WHERE parent IN ('r1', 'r2') AND id NOT IN ('n6', 'n7') AND n_name NOT LIKE '%11%' UNION ALL SELECT 'r' || r_regionkey FROM region WHERE r_regionkey = 1""")
def endogenous_terms(spark, d):
    n = load(spark, d, "nation")
    pre = lambda p, x: F.concat(F.lit(p), x)
    terms = n.select(pre("n", "n_nationkey").alias("id"), F.col("n_name").alias("label"), (F.col("n_nationkey") == 6).alias("obsolete"), (F.col("n_nationkey") == 7).alias("drug")).union(load(spark, d, "region").select(pre("r", "r_regionkey"), F.lit(""), F.lit(False), F.lit(False)))
    parents = n.select(pre("r", "n_regionkey").alias("parent"), pre("n", "n_nationkey").alias("child")).union(spark.createDataFrame([("r1", "r2"), ("r1", "r3")], "parent string, child string"))
    out = adapters.endogenous(spark, terms, parents, "r1", ["r3"], ["_11"])
    return out.where("id <> 'r2'")


@entry("""SELECT 'ENSEMBL:' || o_custkey AS start_id, 'test' || chr(9) || 'v1' AS provenance, count(*)::BIGINT AS n FROM (SELECT DISTINCT o_custkey, 'MP:' || o_orderkey AS mp FROM orders) GROUP BY 1""")
def adapter_contract(spark, d):
    rows = load(spark, d, "orders").select(cid("ENSEMBL", "o_custkey").alias("marker_accession_id"), cid("MP", "o_orderkey").alias("mp_term_id"))
    return adapters.run_adapter("impc_phenotypes", rows, source="test", version="v1").groupBy("start_id", "provenance").agg(F.count(F.lit(1)).alias("n"))


@entry("""SELECT e.start_id, e.end_id, e.o_orderkey FROM (SELECT 'c' || o_custkey AS start_id, 'p' || o_orderpriority AS end_id, o_orderkey FROM orders) e""")
def edge_fan_out(spark, d):
    o = load(spark, d, "orders")
    edges = o.select(F.col("o_custkey").cast("string").alias("start_id"), F.col("o_orderpriority").alias("end_id"), "o_orderkey")
    starts = o.select(F.col("o_custkey").cast("string").alias("input"), F.concat(F.lit("c"), "o_custkey").alias("match")).distinct()
    ends = o.select(F.col("o_orderpriority").alias("input"), F.concat(F.lit("p"), "o_orderpriority").alias("match")).distinct()
    return resolve.resolve_edges(edges, starts, ends).select("start_id", "end_id", "o_orderkey")


@entry("""SELECT regexp_replace(trim(c_name), '[^A-Za-z0-9_:.@()+,=;$!*''%-]', '_', 'g') AS key, c_custkey FROM customer""")
def safe_keys(spark, d):
    return load(spark, d, "customer").select(ids.safe_key(F.col("c_name")).alias("key"), "c_custkey")


@entry("""SELECT p_partkey, string_agg(trim(x), ',' ORDER BY i) AS items FROM (SELECT p_partkey, unnest([p_brand, p_type]) AS x, unnest([1, 2]) AS i FROM part) GROUP BY 1""")
def split_and_trim(spark, d):
    return load(spark, d, "part").select("p_partkey", F.array_join(text.split_list(F.concat("p_brand", F.lit(" | |"), "p_type", F.lit(" "))), ",").alias("items"))
