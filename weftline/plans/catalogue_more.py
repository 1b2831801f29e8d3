"""More of the catalogue: pairs, mappings, versions, sets, ordered groups, scalar families."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weftline.core import load
from weftline.functions import ids, text
from weftline.operators import diff, export, graph, query, resolve, rules
from weftline.plans import adapters
from weftline.plans.catalogue import entry

PAIRS = "SELECT 'ENSEMBL:' || o_custkey AS a, 'ENSEMBL:' || (o_orderkey % 97) AS b, CAST(floor(o_totalprice / 500) AS INT) AS s FROM orders"


def pair_rows(spark, d):
    o = load(spark, d, "orders")
    return o.select(F.concat(F.lit("9606."), "o_custkey").alias("protein1"), F.concat(F.lit("9606."), F.col("o_orderkey") % 97).alias("protein2"), F.floor(F.col("o_totalprice") / 500).cast("string").alias("combined_score"))


@entry(f"SELECT least(a, b) AS start_id, greatest(a, b) AS end_id, s AS score FROM ({PAIRS}) WHERE a <> b AND s >= 400")
def interaction_cutoff(spark, d):
    return adapters.interactions(pair_rows(spark, d))


@entry(f"""WITH p AS (SELECT least(a, b) AS x, greatest(a, b) AS y, max(s) AS score FROM ({PAIRS}) WHERE a <> b AND s >= 400 GROUP BY 1, 2) SELECT x AS start_id, y AS end_id, score, 'StringDB' AS sources FROM p UNION ALL SELECT y, x, score, 'StringDB' FROM p""")
def interaction_directions(spark, d):
    rows = adapters.interaction_rows(adapters.interactions(pair_rows(spark, d)).withColumn("source", F.lit("STRING")))
    return rows.withColumn("sources", F.array_join("sources", "|"))


@entry("""SELECT 'PART:' || p_partkey AS subject_id, CASE p_size % 4 WHEN 0 THEN 'skos:exactMatch' WHEN 1 THEN 'skos:broadMatch' WHEN 2 THEN 'skos:narrowMatch' ELSE 'skos:relatedMatch' END AS predicate_id, 'BRAND:' || p_brand AS object_id, 'PART' AS subject_source, 'BRAND' AS object_source, 'semapv:DatabaseCrossReference' AS mapping_justification FROM part""")
def sssom_export(spark, d):
    kind = F.element_at(F.array(*map(F.lit, ("equivalentTo", "hasBroadSynonym", "NARROW", "related"))), (F.col("p_size") % 4 + 1))
    edges = load(spark, d, "part").select(ids.curie("PART", F.col("p_partkey")).alias("s"), kind.alias("p"), ids.curie("BRAND", F.col("p_brand")).alias("o"))
    return export.mappings(edges, "s", "p", "o")


@entry("""SELECT '<http://kg/' || n_nationkey || '> <http://kg/n_name> "' || n_name || '" .' AS value FROM nation UNION ALL SELECT '<http://kg/' || n_nationkey || '> <http://kg/n_regionkey> "' || n_regionkey || '" .' FROM nation""")
def ntriples_export(spark, d):
    return export.triples(load(spark, d, "nation"), F.col("n_nationkey").cast("string"), "http://kg/", ["n_name", "n_regionkey"])


@entry("""WITH v AS (SELECT p_brand, CASE p_partkey % 3 WHEN 0 THEN '1.' || p_size WHEN 1 THEN '2.' || p_size || '.1' ELSE 'draft' END AS version FROM part), k AS (SELECT *, CASE WHEN version = 'draft' THEN [0, 0, 0, 0] ELSE [2, split_part(version, '.', 1)::INT, split_part(version, '.', 2)::INT, len(string_split(version, '.'))] END AS key FROM v)
SELECT p_brand, max_by(version, key) AS version FROM k GROUP BY 1""")
def latest_version(spark, d):
    k = F.col("p_partkey") % 3
    v = load(spark, d, "part").select("p_brand", F.when(k == 0, F.concat(F.lit("1."), "p_size")).when(k == 1, F.concat(F.lit("2."), "p_size", F.lit(".1"))).otherwise("draft").alias("version"))
    return diff.latest(v, ["p_brand"], "version")


@entry("SELECT k, min(p_brand) AS p_brand FROM (SELECT p_type || p_size AS k, p_brand FROM part) GROUP BY 1 HAVING count(DISTINCT p_brand) = 1")
def unambiguous_map(spark, d):
    return resolve.unambiguous(load(spark, d, "part").select(F.concat("p_type", "p_size").alias("k"), "p_brand"), "k", "p_brand")


@entry("""WITH o AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), p AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P')
SELECT 'both' AS part, k FROM (SELECT k FROM o INTERSECT SELECT k FROM p) UNION ALL SELECT 'first', k FROM (SELECT k FROM o EXCEPT SELECT k FROM p) UNION ALL SELECT 'second', k FROM (SELECT k FROM p EXCEPT SELECT k FROM o)""")
def set_operations(spark, d):
    keys = lambda s: load(spark, d, "orders").where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k")).distinct()
    f, p = keys("F"), keys("P")
    tag = lambda df, name: df.select(F.lit(name).alias("part"), "k")
    return tag(f.intersect(p), "both").union(tag(f.subtract(p), "first")).union(tag(p.subtract(f), "second"))


@entry("""WITH a AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1), b AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT k, least(a.n, b.n)::BIGINT AS shared, (greatest(a.n, b.n) - least(a.n, b.n))::BIGINT AS apart FROM a JOIN b USING (k)""")
def bag_overlap(spark, d):
    bag = lambda f, n: load(spark, d, "lineitem").where(F.col("l_returnflag") == f).groupBy(F.col("l_partkey").alias("k")).agg(F.count(F.lit(1)).alias(n))
    both = bag("A", "a").join(bag("R", "b"), "k")
    return both.select("k", F.least("a", "b").alias("shared"), (F.greatest("a", "b") - F.least("a", "b")).alias("apart"))


@entry("SELECT o_orderkey, (year(o_orderdate)::BIGINT << 32) | o_custkey AS packed, year(o_orderdate)::BIGINT AS year, o_custkey AS family FROM orders")
def bit_packing(spark, d):
    packed = F.shiftleft(F.year("o_orderdate").cast("long"), 32).bitwiseOR(F.col("o_custkey"))
    return load(spark, d, "orders").select("o_orderkey", packed.alias("packed")).select("o_orderkey", "packed", F.shiftright("packed", 32).alias("year"), F.col("packed").bitwiseAND(F.lit((1 << 32) - 1)).alias("family"))


@entry("SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS plain FROM pages")
def html_strip(spark, d):
    return load(spark, d, "pages").select("page_id", text.strip_html(F.col("html")).alias("plain"))


@entry("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def date_formats(spark, d):
    k = F.col("o_orderkey") % 4
    shown = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "dd-MMM-yyyy")).when(k == 2, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return load(spark, d, "orders").select("o_orderkey", text.any_date(shown).cast("string").alias("day"))


@entry("""SELECT c_nationkey, count(*)::BIGINT AS total, count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders))::BIGINT AS resolved, round((count(*) - count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders)))::DOUBLE / count(*) * 10000) / 100 AS percent FROM customer GROUP BY 1""")
def percent_unresolved(spark, d):
    known = load(spark, d, "orders").select("o_custkey").distinct().withColumn("hit", F.lit(1))
    agg = load(spark, d, "customer").join(known, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("total"), F.count("hit").alias("resolved"))
    return agg.withColumn("percent", F.round((F.col("total") - F.col("resolved")) / F.col("total") * 10000) / 100)


@entry("""WITH n AS (SELECT c_custkey AS id FROM customer WHERE c_nationkey = 3), e AS (SELECT o_custkey AS src, o_orderkey AS dst FROM orders), r AS (SELECT DISTINCT dst FROM e WHERE src IN (SELECT id FROM n))
SELECT src, dst FROM e WHERE src IN (SELECT id FROM n) AND dst IN (SELECT dst FROM r)""")
def seeded_subgraph(spark, d):
    edges = load(spark, d, "orders").select(F.concat(F.lit("c"), "o_custkey").alias("src"), F.concat(F.lit("o"), "o_orderkey").alias("dst"))
    seeds = load(spark, d, "customer").where("c_nationkey = 3").select(F.concat(F.lit("c"), "c_custkey").alias("node"))
    near = graph.hops(edges, seeds, 1).select("node")
    induced = graph.drop_dangling(edges, near, near)
    return induced.select(F.substring("src", 2, 20).cast("long").alias("src"), F.substring("dst", 2, 20).cast("long").alias("dst"))


@entry("""WITH g AS (SELECT p_brand, p_type, count(*) AS n, min(p_partkey) AS first FROM part GROUP BY 1, 2) SELECT p_brand, p_type, n::BIGINT AS n, row_number() OVER (ORDER BY n DESC, first)::INT AS rank FROM g ORDER BY rank LIMIT 25""")
def largest_groups(spark, d):
    g = load(spark, d, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first"))
    top = g.orderBy(F.desc("n"), "first").limit(25)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "first"))).select("p_brand", "p_type", "n", "rank")


@entry("""WITH x AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 0 THEN event_type END AS kind FROM events) SELECT event_id, coalesce(last_value(kind IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(kind IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS kind FROM x""")
def fill_forward_back(spark, d):
    x = load(spark, d, "events").select("event_id", "user_id", "ts", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("kind"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    return x.select("event_id", F.coalesce(F.last("kind", True).over(before), F.first("kind", True).over(after)).alias("kind"))


@entry("""WITH x AS (SELECT p_partkey, p_size / 50.0::DOUBLE AS lex, (p_partkey % 5)::INT AS sources FROM part), s AS (SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.86::DOUBLE * lex + 0.08::DOUBLE * 0.92::DOUBLE + 0.04::DOUBLE * least(1.0::DOUBLE, 0.55::DOUBLE + 0.09::DOUBLE * sources) + 0.02::DOUBLE + CASE WHEN lex >= 0.98 THEN 0.02::DOUBLE ELSE 0.0::DOUBLE END)) AS score FROM x)
SELECT p_partkey, round(score, 6) AS score, CASE WHEN lex >= 0.98 AND score >= 0.9 THEN 'exact' WHEN score >= 0.82 THEN 'probable' WHEN score >= 0.68 THEN 'possible' ELSE 'weak' END AS status FROM s""")
def candidate_score(spark, d):
    lex, one = F.col("p_size") / 50.0, F.lit(1.0)
    score = rules.resolver_score(lex, F.lit(0.92), F.lit(0.5), (F.col("p_partkey") % 5).cast("int"), one, F.lit(0.0), F.lit(True))
    return load(spark, d, "part").select("p_partkey", F.round(score, 6).alias("score"), rules.match_status(lex, score).alias("status"))


@entry("""WITH s AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'no_data' WHEN 1 THEN 'single' WHEN 2 THEN 'agree' WHEN 3 THEN 'conflict' ELSE 'majority' END AS label, (p_partkey % 7)::INT AS n FROM part)
SELECT p_partkey, CASE label WHEN 'no_data' THEN 0 WHEN 'conflict' THEN -1 WHEN 'single' THEN 1 WHEN 'majority' THEN 2 ELSE least(n, 4) END::INT AS quality FROM s""")
def mapping_score(spark, d):
    label = F.element_at(F.array(*map(F.lit, ("no_data", "single", "agree", "conflict", "majority"))), F.col("p_size") % 5 + 1)
    return load(spark, d, "part").select("p_partkey", rules.quality(label, (F.col("p_partkey") % 7).cast("int")).alias("quality"))


@entry("""SELECT s_suppkey, 'SUP:' || upper(substr(sha256(upper(trim(s_name))), 1, 12)) AS id FROM supplier""")
def stable_ids(spark, d):
    return load(spark, d, "supplier").select("s_suppkey", ids.minted_id("SUP", F.col("s_name")).alias("id"))


@entry("""SELECT c_name, dense_rank() OVER (ORDER BY c_name)::BIGINT AS surrogate FROM customer""")
def surrogate_ids(spark, d):
    return diff.surrogates(spark, load(spark, d, "customer").select("c_name"), "c_name")


@entry("""SELECT conv_id, count(*)::BIGINT AS turns, string_agg(role, '>' ORDER BY turn) AS roles, max_by(turn, turn)::BIGINT AS last FROM conversations GROUP BY 1""")
def conversation_shape(spark, d):
    roles = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]), ">")
    return load(spark, d, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), roles.alias("roles"), F.max("turn").alias("last"))


@entry("""SELECT event_type, user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS r FROM events) WHERE r <= 3""")
def top_per_group(spark, d):
    return query.top_per_group(load(spark, d, "events"), ["event_type"], [F.desc("value"), F.asc("event_id")], 3).select("event_type", "user_id", "event_id")
