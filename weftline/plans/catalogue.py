"""The query catalogue on the driver tables, with the SQL that each one answers to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.core import load
from weftline.functions import ids, text
from weftline.operators import export, graph, merge, query, resolve, rules, stats, validate

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def entry(sql: str | None):
    """Register a query and its SQL under the function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@entry("""SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE (c_mktsegment IN ('BUILDING', 'MACHINERY') OR c_mktsegment IS NULL) AND c_acctbal >= 0""")
def filter_in_null(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "customer")
    return c.where(query.field_filter(c, "c_mktsegment", ["BUILDING", "MACHINERY", None]) & (F.col("c_acctbal") >= 0)).select("c_custkey", "c_mktsegment", "c_acctbal")


@entry("SELECT p_partkey, p_name, p_type FROM part WHERE contains(lower(p_name), 'old') OR contains(lower(p_type), 'old')")
def search_contains(spark, d):
    p = load(spark, d, "part")
    return p.where(query.search(p, ["p_name", "p_type"], "OLD")).select("p_partkey", "p_name", "p_type")


@entry("SELECT o_orderpriority AS value, count(*)::BIGINT AS n FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1 ORDER BY n DESC, value LIMIT 20")
def facet_topn(spark, d):
    return query.facet(load(spark, d, "orders"), "o_orderpriority", {"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT"]})


@entry("""SELECT p_brand AS value, count(DISTINCT l_orderkey)::BIGINT AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY n DESC, value LIMIT 20""")
def facet_array(spark, d):
    brands = load(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(load(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return query.facet(brands.select("l_orderkey", "p_brand").distinct(), "p_brand")


@entry("""SELECT value, count(*)::BIGINT AS n FROM (SELECT unnest(list_distinct([l_returnflag, l_linestatus, l_returnflag])) AS value FROM lineitem) GROUP BY 1 ORDER BY n DESC, value LIMIT 20""")
def facet_list(spark, d):
    return query.facet(load(spark, d, "lineitem").select(F.array("l_returnflag", "l_linestatus", "l_returnflag").alias("flags")), "flags")


@entry("""SELECT flags AS combination, count(*)::BIGINT AS n FROM (SELECT l_orderkey, string_agg(DISTINCT l_returnflag, '|' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY 1) GROUP BY 1""")
def upset_combo(spark, d):
    return query.upset(load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("flags")), "flags")


@entry("""SELECT p_partkey, p_name, (SELECT count(*) FROM part)::BIGINT AS total, 3::BIGINT AS page FROM part ORDER BY p_partkey LIMIT 10 OFFSET 20""")
def page_total(spark, d):
    return query.page(load(spark, d, "part").select("p_partkey", "p_name"), "p_partkey", 3, 10)


@entry("""WITH alias AS (SELECT s_name AS input, s_suppkey AS match, 0 AS priority FROM supplier UNION ALL SELECT 'S:' || s_suppkey, s_suppkey, 1 FROM supplier UNION ALL SELECT 'N:' || s_nationkey, s_suppkey, 2 FROM supplier),
asked AS (SELECT 'S:' || s_suppkey AS id FROM supplier UNION SELECT 'N:' || n_nationkey FROM nation),
best AS (SELECT id, match, priority, rank() OVER (PARTITION BY id ORDER BY priority) AS r FROM asked JOIN alias ON id = input)
SELECT id, match, nth::INT AS nth FROM (SELECT id, match, row_number() OVER (PARTITION BY id ORDER BY match) AS nth FROM best WHERE r = 1) WHERE nth <= 11""")
def resolve_best(spark, d):
    s, n = load(spark, d, "supplier"), load(spark, d, "nation")
    alias = s.select(F.col("s_name").alias("input"), F.col("s_suppkey").alias("match"), F.lit(0).alias("priority"))
    alias = alias.union(s.select(F.concat(F.lit("S:"), F.col("s_suppkey")), "s_suppkey", F.lit(1))).union(s.select(F.concat(F.lit("N:"), F.col("s_nationkey")), "s_suppkey", F.lit(2)))
    asked = s.select(F.concat(F.lit("S:"), F.col("s_suppkey")).alias("id")).union(n.select(F.concat(F.lit("N:"), F.col("n_nationkey")))).distinct()
    return query.top_per_group(resolve.best_matches(asked, alias), ["id"], [F.asc("match")], 11, "nth").select("id", "match", "nth")


@entry("""WITH m AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'), hit AS (SELECT c_custkey, count(o_orderkey) AS k FROM customer LEFT JOIN m ON o_custkey = c_custkey GROUP BY 1)
SELECT 'c' || c_custkey AS id, k = 0 AS resolver_miss, k::BIGINT AS n FROM hit""")
def resolve_policy(spark, d):
    c, o = load(spark, d, "customer"), load(spark, d, "orders")
    nodes = c.select(F.concat(F.lit("c"), F.col("c_custkey")).alias("id"))
    matches = o.where("o_orderstatus = 'F'").select(F.concat(F.lit("c"), F.col("o_custkey")).alias("input"), F.col("o_orderkey").cast("string").alias("match"), F.lit(0).alias("priority"))
    out = resolve.resolve(nodes, matches)
    return out.groupBy(F.col("old_id").alias("id"), "resolver_miss").agg(F.sum(F.when(~F.col("resolver_miss"), 1).otherwise(0)).alias("n"))


@entry("""SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' AND o_totalprice > 200000""")
def linked_list(spark, d):
    c, o = load(spark, d, "customer"), load(spark, d, "orders")
    return c.where("c_mktsegment = 'BUILDING'").join(o.where("o_totalprice > 200000"), F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@entry("""SELECT o_orderpriority AS value, count(*)::BIGINT AS n FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1""")
def linked_facets(spark, d):
    c, o = load(spark, d, "customer").where("c_mktsegment = 'BUILDING'"), load(spark, d, "orders")
    return query.facet(o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi"), "o_orderpriority")


@entry("""SELECT 'region' AS kind, r_regionkey::BIGINT AS id, 0 AS depth FROM region WHERE r_name = 'ASIA' UNION ALL SELECT 'nation', n_nationkey, 1 FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'
UNION ALL SELECT 'customer', c_custkey, 2 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""")
def networked_2hop(spark, d):
    r, n, c = load(spark, d, "region"), load(spark, d, "nation"), load(spark, d, "customer")
    name = lambda kind, k: F.concat(F.lit(f"{kind}:"), F.col(k))
    edges = n.select(name("region", "n_regionkey").alias("src"), name("nation", "n_nationkey").alias("dst")).union(c.select(name("nation", "c_nationkey"), name("customer", "c_custkey")))
    found = graph.hops(edges, r.where("r_name = 'ASIA'").select(name("region", "r_regionkey").alias("node")), 2)
    return found.select(ids.curie_prefix(F.col("node")).alias("kind"), ids.curie_local(F.col("node")).cast("long").alias("id"), "depth")


@entry("""SELECT DISTINCT r_name, n_name, c_mktsegment, o_orderpriority, p_brand, s.s_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey JOIN supplier s ON l_suppkey = s_suppkey WHERE l_quantity > 45 AND o_orderstatus = 'F'""")
def star_join_distinct(spark, d):
    t = {x: load(spark, d, x) for x in ("lineitem", "orders", "customer", "nation", "region", "part", "supplier")}
    out = t["lineitem"].where("l_quantity > 45").join(t["orders"].where("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"))
    for other, a, b in (("customer", "o_custkey", "c_custkey"), ("nation", "c_nationkey", "n_nationkey"), ("region", "n_regionkey", "r_regionkey"), ("part", "l_partkey", "p_partkey"), ("supplier", "l_suppkey", "s_suppkey")):
        out = out.join(t[other], F.col(a) == F.col(b))
    return out.select("r_name", "n_name", "c_mktsegment", "o_orderpriority", "p_brand", "s_name").distinct()


@entry("""SELECT DISTINCT l_orderkey, cn.n_name AS customer_nation, sn.n_name AS supplier_nation FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey WHERE l_returnflag = 'R'""")
def left_alias_dims(spark, d):
    li, o, c, s, n = (load(spark, d, x) for x in ("lineitem", "orders", "customer", "supplier", "nation"))
    cn, sn = n.select(F.col("n_nationkey").alias("ck"), F.col("n_name").alias("customer_nation")), n.select(F.col("n_nationkey").alias("sk"), F.col("n_name").alias("supplier_nation"))
    out = li.where("l_returnflag = 'R'").join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(cn, F.col("c_nationkey") == F.col("ck"), "left")
    return out.join(s, F.col("l_suppkey") == F.col("s_suppkey"), "left").join(sn, F.col("s_nationkey") == F.col("sk"), "left").select("l_orderkey", "customer_nation", "supplier_nation").distinct()


@entry("""WITH a AS (SELECT c_nationkey AS k, count(*) AS customers FROM customer WHERE c_acctbal > 5000 GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier GROUP BY 1), n AS (SELECT n_nationkey AS k, n_name FROM nation WHERE n_regionkey < 3)
SELECT coalesce(a.k, b.k, n.k) AS k, customers::BIGINT AS customers, suppliers::BIGINT AS suppliers, n_name FROM a FULL JOIN b ON a.k = b.k FULL JOIN n ON coalesce(a.k, b.k) = n.k""")
def full_outer_cascade(spark, d):
    a = load(spark, d, "customer").where("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("customers"))
    b = load(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("suppliers"))
    n = load(spark, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("k"), "n_name")
    return a.join(b, "k", "full").join(n, "k", "full").select("k", "customers", "suppliers", "n_name")


@entry("""WITH p AS (SELECT s_suppkey, s_nationkey, CAST(floor(s_acctbal) AS BIGINT) AS bal FROM supplier), k1 AS (SELECT bal, min(s_suppkey) AS m FROM p GROUP BY 1 HAVING count(DISTINCT s_suppkey) = 1), k2 AS (SELECT s_nationkey, min(s_suppkey) AS m FROM p GROUP BY 1 HAVING count(DISTINCT s_suppkey) = 1)
SELECT c_custkey, coalesce(k1.m, k2.m) AS s_suppkey, CASE WHEN k1.m IS NOT NULL THEN 'bal' WHEN k2.m IS NOT NULL THEN 'nation' ELSE 'none' END AS match_source FROM customer LEFT JOIN k1 ON CAST(floor(c_acctbal) AS BIGINT) = k1.bal LEFT JOIN k2 ON c_nationkey = k2.s_nationkey""")
def precedence_match(spark, d):
    left = load(spark, d, "customer").select("c_custkey", F.floor("c_acctbal").alias("bal"), F.col("c_nationkey").alias("nation"))
    right = load(spark, d, "supplier").select("s_suppkey", F.floor("s_acctbal").alias("bal"), F.col("s_nationkey").alias("nation"))
    return resolve.cascade(left, right, ["bal", "nation"], "s_suppkey").select("c_custkey", "s_suppkey", "match_source")


@entry("SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.08 AND l_quantity < 5)")
def semi_prefilter(spark, d):
    li = load(spark, d, "lineitem").where("l_discount > 0.08 AND l_quantity < 5")
    return load(spark, d, "part").join(li, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey", "p_brand")


@entry("SELECT c_custkey AS node FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def anti_leaf(spark, d):
    edges = load(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("parent"))
    return graph.leaves(load(spark, d, "customer").select(F.col("c_custkey").alias("node")), edges)


@entry("""SELECT count(*)::BIGINT AS n, sum(src)::BIGINT AS sum_src FROM (SELECT l_orderkey AS src, l_partkey AS dst FROM lineitem) WHERE src IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') AND dst IN (SELECT p_partkey FROM part WHERE p_size > 10)""")
def dangling_edges(spark, d):
    edges = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"))
    starts, ends = load(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("node")), load(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("node"))
    return graph.drop_dangling(edges, starts, ends).agg(F.count(F.lit(1)).alias("n"), F.sum("src").alias("sum_src"))


@entry("""WITH o AS (SELECT o_custkey, count(*) FILTER (o_orderpriority = '1-URGENT' AND o_totalprice > 480000) AS drugs, count(*) FILTER (o_totalprice > 470000) AS ligands, count(*) AS papers, count(DISTINCT o_orderpriority) AS notes FROM orders GROUP BY 1),
l AS (SELECT o_custkey, count(*) FILTER (l_quantity >= 50 AND l_discount >= 0.1) AS terms, sum(l_quantity) AS antibodies FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT c_custkey, CASE WHEN coalesce(drugs, 0) > 0 THEN 'Tclin' WHEN coalesce(ligands, 0) > 0 THEN 'Tchem' WHEN coalesce(terms, 0) > 0 THEN 'Tbio'
 WHEN (coalesce(papers, 0) < 5)::INT + (coalesce(notes, 0) <= 3)::INT + (coalesce(antibodies, 0) <= 50)::INT >= 2 THEN 'Tdark' ELSE 'Tbio' END AS tier
FROM customer LEFT JOIN o ON c_custkey = o.o_custkey LEFT JOIN l ON c_custkey = l.o_custkey""")
def tier_rules(spark, d):
    orders, li = load(spark, d, "orders"), load(spark, d, "lineitem")
    o = orders.groupBy("o_custkey").agg(F.count_if((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 480000)).alias("drugs"), F.count_if(F.col("o_totalprice") > 470000).alias("ligands"), F.count(F.lit(1)).alias("papers"), F.countDistinct("o_orderpriority").alias("notes"))
    per_order = li.groupBy("l_orderkey").agg(F.count_if((F.col("l_quantity") >= 50) & (F.col("l_discount") >= 0.1)).alias("terms"), F.sum("l_quantity").alias("antibodies"))
    lines = per_order.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.sum("terms").alias("terms"), F.sum("antibodies").alias("antibodies"))
    c = load(spark, d, "customer").select("c_custkey")
    both = c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey").join(lines, F.col("c_custkey") == F.col("o_custkey"), "left")
    return both.select("c_custkey", rules.tier(*[F.col(x) for x in ("drugs", "ligands", "terms", "papers", "notes", "antibodies")]).alias("tier"))


@entry("""SELECT p_partkey, coalesce(max(l_quantity / 6.5::DOUBLE) >= CASE WHEN p_brand = 'Brand#1' THEN 7.52288 WHEN p_brand = 'Brand#2' THEN 7.0 WHEN p_brand = 'Brand#3' THEN 5.0 ELSE 6.0 END, false) AS meets FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey, p_brand""")
def category_threshold(spark, d):
    best = load(spark, d, "lineitem").groupBy("l_partkey").agg(F.max(F.col("l_quantity") / 6.5).alias("best"))  # one value a part is enough to reach a cut-off
    family = F.when(F.col("p_brand") == "Brand#1", "Kinase").when(F.col("p_brand") == "Brand#2", "GPCR").when(F.col("p_brand") == "Brand#3", "Ion Channel")
    joined = load(spark, d, "part").join(best, F.col("p_partkey") == F.col("l_partkey"), "left")
    return joined.select("p_partkey", rules.meets_cutoff(family, F.array("best")).alias("meets"))


@entry("""SELECT c_custkey, 'family' || c_nationkey % 7 AS family, c_custkey % 3 = 0 AS filled FROM customer WHERE c_custkey % 3 > 0 OR c_nationkey IN (SELECT c_nationkey FROM customer WHERE c_custkey % 3 > 0) UNION ALL
SELECT c_custkey, NULL, false FROM customer WHERE c_custkey % 3 = 0 AND c_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_custkey % 3 > 0)""")
def xor_null_fill(spark, d):
    x = load(spark, d, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("family"), F.col("c_nationkey") % 7)).alias("family"))
    return resolve.fill_shared(x, "c_nationkey", "family").select("c_custkey", "family", "filled")


@entry("""SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_name) = 1 AND trim(p_name) <> '' THEN p_name ELSE 'P' || p_partkey END AS preferred FROM part""")
def preferred_label(spark, d):
    p = load(spark, d, "part").select("p_partkey", "p_name", F.concat(F.lit("P"), F.col("p_partkey")).alias("own"))
    return resolve.preferred_label(p, "p_name", "own").select("p_partkey", "preferred")


MENTIONS = "SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H') AS paper FROM events"


def mentions(spark, d):
    return load(spark, d, "events").select("user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH").alias("paper"))


@entry(f"""WITH p AS (SELECT DISTINCT user_id, paper FROM ({MENTIONS})), s AS (SELECT paper, 1.0::DOUBLE / count(*) AS share FROM p GROUP BY 1) SELECT user_id, round(1 / sum(share), 6) AS novelty FROM p JOIN s USING (paper) GROUP BY 1""")
def novelty(spark, d):
    return stats.novelty(mentions(spark, d), "user_id", "paper").select("user_id", F.round("novelty", 6).alias("novelty"))


@entry(f"""WITH m AS ({MENTIONS}), t AS (SELECT paper, count(*)::DOUBLE AS n FROM m GROUP BY 1), u AS (SELECT paper, user_id, count(*)::DOUBLE AS c FROM m GROUP BY 1, 2), e AS (SELECT paper, event_type, count(*)::DOUBLE AS c FROM m GROUP BY 1, 2)
SELECT user_id, event_type, round(sum(u.c * e.c / (t.n * t.n)), 6) AS importance FROM u JOIN e USING (paper) JOIN t USING (paper) GROUP BY 1, 2""")
def importance(spark, d):
    m = mentions(spark, d)
    return stats.importance(m, m, "paper", "user_id", "event_type").withColumn("importance", F.round("importance", 6))


@entry("""WITH c AS (SELECT o_custkey, o_orderpriority, year(o_orderdate)::INT AS year, count(*) AS n FROM orders GROUP BY 1, 2, 3), t AS (SELECT o_custkey, year, sum(n) AS t FROM c GROUP BY 1, 2)
SELECT o_orderpriority, year, round(sum(n::DOUBLE / t), 6) AS score FROM c JOIN t USING (o_custkey, year) GROUP BY 1, 2""")
def fractional_count(spark, d):
    return stats.shares(load(spark, d, "orders"), "o_custkey", "o_orderpriority", F.year("o_orderdate")).withColumn("score", F.round("score", 6))


@entry("""SELECT o_custkey, count(*)::BIGINT AS total, string_agg(year || ':' || n, ',' ORDER BY year) AS history FROM (SELECT o_custkey, year(o_orderdate) AS year, count(*) AS n, any_value(o_custkey) FROM orders GROUP BY 1, 2) GROUP BY 1""".replace("count(*)::BIGINT AS total", "sum(n)::BIGINT AS total"))
def yearly_history(spark, d):
    per = load(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    history = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("year", "n"))), lambda x: F.concat_ws(":", x["year"], x["n"])), ",")
    return per.groupBy("o_custkey").agg(F.sum("n").alias("total"), history.alias("history"))


@entry("SELECT l_partkey, median(l_extendedprice) AS price, median(l_extendedprice) FILTER (l_returnflag = 'R') AS price_r, median(l_extendedprice) FILTER (l_returnflag = 'N') AS price_n FROM lineitem GROUP BY 1")
def median_by_group(spark, d):
    only = lambda f: F.median(F.when(F.col("l_returnflag") == f, F.col("l_extendedprice")))
    return load(spark, d, "lineitem").groupBy("l_partkey").agg(F.median("l_extendedprice").alias("price"), only("R").alias("price_r"), only("N").alias("price_n"))


@entry("""SELECT l_suppkey, max(l_quantity) FILTER (l_returnflag = 'A') AS a, max(l_quantity) FILTER (l_returnflag = 'N') AS n, max(l_quantity) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1""")
def pivot_columns(spark, d):
    return load(spark, d, "lineitem").groupBy("l_suppkey").pivot("l_returnflag", ["A", "N", "R"]).agg(F.max("l_quantity")).toDF("l_suppkey", "a", "n", "r")


@entry("""WITH t AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2), a AS (SELECT l_partkey, count(q) AS n, max(q) AS m, sum(q) AS s FROM t GROUP BY 1)
SELECT l_partkey, round(CASE WHEN n <= 1 OR m = 0 THEN 0.0::DOUBLE ELSE (n - s / m) / (n - 1) END, 6) AS tau FROM a""")
def tau_specificity(spark, d):
    t = load(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("q"))
    return stats.tau(t, "l_partkey", "q").withColumn("tau", F.round("tau", 6))


@entry("""WITH t AS (SELECT c_nationkey, c_custkey, floor(c_acctbal / 500) AS v FROM customer), r AS (SELECT *, (rank() OVER (PARTITION BY c_nationkey ORDER BY v) + (count(*) OVER (PARTITION BY c_nationkey, v) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY c_nationkey) AS r FROM t),
w AS (SELECT *, min(r) OVER (PARTITION BY c_nationkey) AS lo, max(r) OVER (PARTITION BY c_nationkey) AS hi, max(v) OVER (PARTITION BY c_nationkey) AS mv FROM r)
SELECT c_custkey, round(CASE WHEN mv = 0 THEN 0.0::DOUBLE WHEN hi = lo THEN r ELSE (r - lo) / (hi - lo) END, 6) AS rank FROM w""")
def rank_norm(spark, d):
    t = load(spark, d, "customer").select("c_nationkey", "c_custkey", F.floor(F.col("c_acctbal") / 500).alias("v"))
    return stats.normalised_rank(t, "c_nationkey", "v").select("c_custkey", F.round("rank", 6).alias("rank"))


@entry("""SELECT l_orderkey, max(l_extendedprice) AS price, max_by(l_partkey, (l_extendedprice, l_partkey)) AS l_partkey FROM lineitem GROUP BY 1""")
def max_by_detail(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", F.col("l_extendedprice").alias("price"), "l_partkey")
    return merge.keep_greatest(li, ["l_orderkey"], "price", "l_partkey")


@entry("""SELECT l_partkey, min(l_extendedprice) AS low, median(l_extendedprice) AS middle, max(l_extendedprice) AS high, count(*)::BIGINT AS n, round(CASE WHEN min(l_extendedprice) > 0 THEN (max(l_extendedprice) - min(l_extendedprice)) / min(l_extendedprice) END, 6) AS spread,
coalesce((max(l_extendedprice) - min(l_extendedprice)) / min(l_extendedprice) > 0.1, false) AS flagged FROM lineitem GROUP BY 1""")
def spread_flag(spark, d):
    return stats.spread(load(spark, d, "lineitem"), "l_partkey", "l_extendedprice").withColumn("spread", F.round("spread", 6))


@entry("""SELECT o_orderpriority, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END)::BIGINT AS f, count(DISTINCT CASE WHEN o_totalprice > 100000 THEN o_custkey END)::BIGINT AS big FROM orders GROUP BY 1""")
def cond_distinct(spark, d):
    return load(spark, d, "orders").groupBy("o_orderpriority").agg(F.countDistinct(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))).alias("f"), F.countDistinct(F.when(F.col("o_totalprice") > 100000, F.col("o_custkey"))).alias("big"))


@entry("SELECT p_brand, string_agg(DISTINCT p_type, ';' ORDER BY p_type) AS types FROM part GROUP BY 1")
def ordered_string_agg(spark, d):
    return load(spark, d, "part").groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_set("p_type")), ";").alias("types"))


TREE = "SELECT 'r' || n_regionkey AS parent, 'n' || n_nationkey AS child FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer"


@entry(f"""WITH RECURSIVE e AS ({TREE}), reach(a, b) AS (SELECT parent, parent FROM e UNION SELECT child, child FROM e UNION SELECT reach.a, e.child FROM reach JOIN e ON reach.b = e.parent)
SELECT a AS ancestor, count(*)::BIGINT AS n FROM reach GROUP BY 1""")
def closure_counts(spark, d):
    edges = load(spark, d, "nation").select(F.concat(F.lit("r"), F.col("n_regionkey")).alias("parent"), F.concat(F.lit("n"), F.col("n_nationkey")).alias("child"))
    edges = edges.union(load(spark, d, "customer").select(F.concat(F.lit("n"), F.col("c_nationkey")), F.concat(F.lit("c"), F.col("c_custkey"))))
    return graph.transitive_closure(spark, edges).groupBy("ancestor").agg(F.count(F.lit(1)).alias("n"))


@entry("""WITH RECURSIVE links AS (SELECT s_suppkey AS a, 1000000 + s_nationkey AS b FROM supplier UNION SELECT 1000000 + s_nationkey, s_suppkey FROM supplier UNION SELECT s_suppkey, 2000000 + floor(s_acctbal / 10)::BIGINT FROM supplier UNION SELECT 2000000 + floor(s_acctbal / 10)::BIGINT, s_suppkey FROM supplier),
reach(a, b) AS (SELECT a, a FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a) SELECT a::BIGINT AS node, min(b)::BIGINT AS component FROM reach GROUP BY 1""")
def components(spark, d):
    s = load(spark, d, "supplier")
    keys = s.select(F.col("s_suppkey").alias("src"), (F.lit(1000000) + F.col("s_nationkey")).cast("long").alias("dst")).union(s.select("s_suppkey", (F.lit(2000000) + F.floor(F.col("s_acctbal") / 10)).cast("long")))
    return graph.connected_components(spark, keys)


@entry("""WITH x AS (SELECT p_partkey AS item, p_brand AS lg, CASE WHEN p_size > 40 THEN p_brand || 'x' WHEN p_size < 5 THEN NULL ELSE p_brand END AS rg FROM part), o AS (SELECT lg, rg, count(*) AS n FROM x GROUP BY 1, 2)
SELECT lg AS grp, count(rg)::BIGINT AS fragments, sum(CASE WHEN rg IS NULL THEN n ELSE 0 END)::BIGINT AS lost, CASE WHEN count(rg) = 0 THEN 'removed' WHEN count(rg) > 1 THEN 'split' WHEN sum(CASE WHEN rg IS NULL THEN n ELSE 0 END) > 0 THEN 'membership changed' ELSE 'same' END AS change FROM o GROUP BY 1""")
def partition_compare(spark, d):
    p = load(spark, d, "part")
    right = F.when(F.col("p_size") > 40, F.concat("p_brand", F.lit("x"))).when(F.col("p_size") >= 5, F.col("p_brand"))
    l, r = p.select(F.col("p_partkey").alias("item"), F.col("p_brand").alias("grp")), p.select(F.col("p_partkey").alias("item"), right.alias("grp")).where("grp is not null")
    change = graph.partition_changes(l, r).where("side = 'left'")
    over = l.withColumnRenamed("grp", "lg").join(r.withColumnRenamed("grp", "rg"), "item", "left").groupBy("lg").agg(F.countDistinct("rg").alias("fragments"), F.count_if(F.col("rg").isNull()).alias("lost"))
    return change.join(over, change["grp"] == over["lg"]).select("grp", "fragments", "lost", "change")


VERSIONS = """SELECT c_custkey, 0 AS pos, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_mktsegment END AS segment, c_acctbal AS balance FROM customer WHERE c_custkey % 5 <> 0
UNION ALL SELECT c_custkey, 1, c_name || '*', c_mktsegment, c_acctbal + 1 FROM customer WHERE c_custkey % 3 <> 0"""


def versions(spark, d):
    c = load(spark, d, "customer")
    a = c.where("c_custkey % 5 <> 0").select("c_custkey", F.lit(0).alias("pos"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 2 != 0, F.col("c_mktsegment")).alias("segment"), F.col("c_acctbal").alias("balance"))
    return a.union(c.where("c_custkey % 3 <> 0").select("c_custkey", F.lit(1), F.concat("c_name", F.lit("*")), "c_mktsegment", F.col("c_acctbal") + 1))


def _merged(pick: str) -> str:
    one = lambda c: f"{pick}({c}, pos) FILTER ({c} IS NOT NULL) AS {c}"
    return f"WITH v AS ({VERSIONS}) SELECT c_custkey, {one('name')}, {one('segment')}, {one('balance')} FROM v GROUP BY 1"


@entry(_merged("min_by"))
def merge_keep_first(spark, d):
    return merge.merge_records(versions(spark, d), ["c_custkey"], ["pos"])


@entry(_merged("max_by"))
def merge_keep_last(spark, d):
    return merge.merge_records(versions(spark, d), ["c_custkey"], ["pos"], merge.KEEP_LAST)


@entry(f"""WITH v AS ({VERSIONS}), j AS (SELECT a.c_custkey, a.name AS an, b.name AS bn, a.segment AS sa, b.segment AS sb, a.balance AS ba, b.balance AS bb FROM v a JOIN v b ON a.c_custkey = b.c_custkey AND a.pos = 0 AND b.pos = 1)
SELECT c_custkey, (an IS DISTINCT FROM bn)::INT + (sa IS DISTINCT FROM sb)::INT + (ba IS DISTINCT FROM bb)::INT AS n_updates, 'p0' AS creation FROM j""")
def merge_log(spark, d):
    v = versions(spark, d).withColumn("prov", F.concat(F.lit("p"), F.col("pos")))
    both = v.join(v.groupBy("c_custkey").count().where("count = 2"), "c_custkey", "left_semi")
    out = merge.merge_records(both, ["c_custkey"], ["pos"], provenance="prov")
    return out.select("c_custkey", F.size("updates").alias("n_updates"), "creation")


@entry("""WITH x AS (SELECT l_orderkey AS k, l_returnflag AS f, l_partkey AS p FROM lineitem) SELECT k, string_agg(p, ',' ORDER BY first, p) AS parts FROM (SELECT k, p, min(f) AS first FROM x GROUP BY 1, 2) GROUP BY 1""")
def merge_lists(spark, d):
    per = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("f")).agg(F.array_sort(F.collect_set("l_partkey")).alias("parts"))
    return merge.merge_records(per, ["k"], ["f"]).select("k", F.array_join(F.col("parts").cast("array<string>"), ",").alias("parts"))


@entry("""WITH a AS (SELECT * FROM customer WHERE c_custkey % 4 <> 0), b AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN c_name || '!' ELSE c_name END AS c_name, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 5 <> 0)
SELECT c_custkey, CASE WHEN a.c_name IS NULL THEN 'added' WHEN b.c_name IS NULL THEN 'removed' ELSE 'changed' END AS change, CASE WHEN a.c_name IS NULL OR b.c_name IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.c_name IS DISTINCT FROM b.c_name THEN 'c_name' END, CASE WHEN a.c_mktsegment IS DISTINCT FROM b.c_mktsegment THEN 'c_mktsegment' END) END AS changed
FROM a FULL JOIN b USING (c_custkey) WHERE a.c_name IS DISTINCT FROM b.c_name OR a.c_mktsegment IS DISTINCT FROM b.c_mktsegment""")
def entity_diff(spark, d):
    from weftline.operators import diff

    c = load(spark, d, "customer")
    b = c.where("c_custkey % 5 <> 0").select("c_custkey", F.when(F.col("c_custkey") % 7 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name")).alias("c_name"), F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    return diff.entity_diff(c.where("c_custkey % 4 <> 0"), b, "c_custkey", ["c_name", "c_mktsegment"])


@entry("""WITH y AS (SELECT DISTINCT year(o_orderdate)::INT AS y, o_custkey AS k FROM orders), p AS (SELECT y + 1 AS y, k FROM y)
SELECT coalesce(y.y, p.y)::INT AS year, count(*) FILTER (p.k IS NULL)::BIGINT AS added, count(*) FILTER (y.k IS NULL)::BIGINT AS removed, count(*) FILTER (y.k IS NOT NULL AND p.k IS NOT NULL)::BIGINT AS kept FROM y FULL JOIN p ON y.y = p.y AND y.k = p.k GROUP BY 1""")
def version_diff(spark, d):
    y = load(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("k")).distinct()
    now, then = y.withColumn("now", F.lit(1)), y.select((F.col("year") + 1).alias("year"), "k").withColumn("then", F.lit(1))
    both = now.join(then, ["year", "k"], "full")
    return both.groupBy("year").agg(F.count_if(F.col("then").isNull()).alias("added"), F.count_if(F.col("now").isNull()).alias("removed"), F.count_if(F.col("now").isNotNull() & F.col("then").isNotNull()).alias("kept"))


@entry("""WITH s AS (SELECT l_partkey, l_returnflag AS f, list_sort(list(DISTINCT l_suppkey % 3)) AS v FROM lineitem GROUP BY 1, 2), g AS (SELECT l_partkey, list(v ORDER BY f) AS vs, count(*) AS n FROM s GROUP BY 1),
m AS (SELECT *, len(list_distinct(vs)) AS kinds, len(list_distinct(flatten(vs))) AS u, list_max([len(x) for x in vs]) AS big, list_max([len([y for y in vs if y = x]) for x in vs]) AS most FROM g)
SELECT l_partkey, CASE WHEN n = 1 THEN 'single' WHEN kinds = 1 THEN 'agree' WHEN u = big THEN 'subset' WHEN most > n / 2.0 THEN 'majority' ELSE 'conflict' END AS label FROM m""")
def agreement_label(spark, d):
    li = load(spark, d, "lineitem")
    sets = [F.array_sort(F.collect_set(F.when(F.col("l_returnflag") == f, F.col("l_suppkey") % 3))) for f in "ANR"]
    wide = li.groupBy("l_partkey").agg(*[s.alias(f"s{k}") for k, s in enumerate(sets)])
    return wide.select("l_partkey", rules.agreement([F.col(f"s{k}") for k in range(3)]).alias("label"))


@entry("""WITH p AS (SELECT DISTINCT l_shipmode AS s, i FROM (SELECT l_returnflag || l_linestatus AS l_shipmode, l_partkey AS i FROM lineitem)), z AS (SELECT s, count(*) AS n FROM p GROUP BY 1), b AS (SELECT x.s AS a, y.s AS b, count(*) AS shared FROM p x JOIN p y USING (i) GROUP BY 1, 2)
SELECT a, b, shared::BIGINT AS shared, round(shared::DOUBLE / (za.n + zb.n - shared), 4) AS jaccard FROM b JOIN z za ON a = za.s JOIN z zb ON b = zb.s""")
def jaccard_matrix(spark, d):
    li = load(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("s"), "l_partkey")
    return stats.jaccard_matrix(li, "s", "l_partkey")


@entry("""WITH top AS (SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY count(DISTINCT o_custkey) DESC, 1 LIMIT 3)
SELECT o_orderpriority AS source, o_orderstatus AS target, count(DISTINCT o_custkey)::BIGINT AS n FROM orders WHERE o_orderpriority IN (SELECT o_orderpriority FROM top) GROUP BY 1, 2""")
def flow_counts(spark, d):
    o = load(spark, d, "orders").select("o_orderpriority", "o_orderstatus", "o_custkey").distinct()
    top = o.groupBy("o_orderpriority").agg(F.countDistinct("o_custkey").alias("n")).orderBy(F.desc("n"), "o_orderpriority").limit(3)
    return o.join(top, "o_orderpriority", "left_semi").groupBy(F.col("o_orderpriority").alias("source"), F.col("o_orderstatus").alias("target")).agg(F.countDistinct("o_custkey").alias("n"))


@entry("""WITH p AS (SELECT DISTINCT l_partkey AS node, l_orderkey AS k FROM lineitem), m AS (SELECT a.node, b.node AS other, count(*) AS shared FROM p a JOIN p b ON a.k = b.k AND a.node <> b.node GROUP BY 1, 2)
SELECT node, other, shared::BIGINT AS shared, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY shared DESC, other) AS rank FROM m) WHERE rank <= 10""")
def neighbours_topk(spark, d):
    return stats.neighbours(load(spark, d, "lineitem"), "l_partkey", "l_orderkey", 10)


LABELS = (("region", "r_name"), ("nation", "n_name"), ("customer", "c_name"), ("customer", "c_mktsegment"), ("supplier", "s_name"), ("part", "p_name"), ("part", "p_brand"), ("part", "p_type"), ("orders", "o_orderpriority"), ("events", "event_type"), ("documents", "lang"), ("documents", "source"))


@entry(" UNION ALL ".join(f"SELECT DISTINCT '{c}' AS kind, left({c}, 255) AS label FROM {t} WHERE {c} IS NOT NULL" for t, c in LABELS))
def typeahead_union(spark, d):
    return export.label_index([(load(spark, d, t), c, c) for t, c in LABELS])


SOURCES = (("customer", "c_custkey", "c_acctbal > 0", "Balance"), ("customer", "c_custkey", "c_mktsegment = 'BUILDING'", "Segment"), ("orders", "o_custkey", "o_orderstatus = 'F'", "Orders"), ("orders", "o_custkey", "o_totalprice > 300000", "Large orders"))


@entry(" UNION ".join(f"SELECT {k} AS id, '{label}' AS source FROM {t} WHERE {w}" for t, k, w, label in SOURCES))
def datasource_map(spark, d):
    out = None
    for t, k, w, label in SOURCES:
        part = load(spark, d, t).where(w).select(F.col(k).alias("id"), F.lit(label).alias("source"))
        out = part if out is None else out.union(part)
    return out.distinct()


CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@entry(" UNION ALL ".join(f"SELECT '{c}' AS field, count({c})::BIGINT AS filled, count(*)::BIGINT AS total, round(100.0::DOUBLE * count({c}) / count(*), 2) AS percent FROM (SELECT * REPLACE (nullif(c_mktsegment, 'BUILDING') AS c_mktsegment) FROM customer)" for c in CUSTOMER))
def coverage_stats(spark, d):
    return query.coverage(load(spark, d, "customer").withColumn("c_mktsegment", F.expr("nullif(c_mktsegment, 'BUILDING')")))


@entry(" UNION ALL ".join(f"SELECT '{c}' AS field, count({c})::BIGINT AS n, min({c})::DOUBLE AS low, max({c})::DOUBLE AS high, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, count(DISTINCT {c})::BIGINT AS distinct FROM events" for c in ("value", "user_id")).replace("AS distinct", 'AS "distinct"'))
def col_stats(spark, d):
    return query.column_stats(load(spark, d, "events"), ["value", "user_id"]).withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@entry("""WITH w AS (SELECT doc_id, unnest(list_distinct([lower(x) for x in regexp_extract_all(text, '[A-Za-z0-9]+') if len(x) <= 128])) AS word FROM documents) SELECT word, count(*)::BIGINT AS n FROM w GROUP BY 1
UNION ALL SELECT '__DOCUMENT_COUNT__', count(*)::BIGINT FROM documents""")
def doc_frequency(spark, d):
    docs = load(spark, d, "documents")
    words = docs.select(F.explode(text.tokens(F.col("text"), "[A-Za-z0-9]+")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return words.union(docs.agg(F.count(F.lit(1))).select(F.lit("__DOCUMENT_COUNT__"), "count(1)"))


@entry("""WITH n AS (SELECT DISTINCT p_name AS name, list_distinct(string_split(lower(p_name), ' ')) AS t FROM part), w AS (SELECT name, t, unnest(t) AS w FROM n), m AS (SELECT DISTINCT a.name AS a, b.name AS b, a.t AS ta, b.t AS tb FROM w a JOIN w b USING (w) WHERE a.name < b.name)
SELECT a, b, round(len(list_intersect(ta, tb))::DOUBLE / len(list_distinct(list_concat(ta, tb))), 6) AS jaccard, round(2.0::DOUBLE * len(list_intersect(ta, tb)) / (len(ta) + len(tb)), 6) AS dice FROM m""")
def name_similarity(spark, d):
    n = load(spark, d, "part").select(F.col("p_name").alias("name")).distinct().withColumn("t", F.array_distinct(F.split(F.lower("name"), " ")))
    w = n.withColumn("w", F.explode("t"))
    m = w.alias("x").join(w.alias("y"), (F.col("x.w") == F.col("y.w")) & (F.col("x.name") < F.col("y.name"))).select(F.col("x.name").alias("a"), F.col("y.name").alias("b"), F.col("x.t").alias("ta"), F.col("y.t").alias("tb")).distinct()
    return m.select("a", "b", F.round(text.jaccard(F.col("ta"), F.col("tb")), 6).alias("jaccard"), F.round(text.dice(F.col("ta"), F.col("tb")), 6).alias("dice"))


@entry(None)
def lexical_match(spark, d):
    """Names of parts against types and brands, by the combined lexical score (its ratio has no SQL form)."""
    p = load(spark, d, "part").select("p_name", "p_type").distinct()
    return p.select("p_name", "p_type", text.lexical_score(F.col("p_name"), F.col("p_type")).alias("score"))


@entry(r"""SELECT page_id, trim(regexp_replace(lower(url), '[^a-z0-9]+', ' ', 'g')) AS normal, regexp_replace(trim(regexp_replace(lower(url), '[^a-z0-9]+', ' ', 'g')), ' ', '_', 'g') AS slug FROM pages""")
def token_normalise(spark, d):
    return load(spark, d, "pages").select("page_id", text.normalise(F.col("url")).alias("normal"), text.slug(F.col("url")).alias("slug"))


@entry("""SELECT page_id, CASE WHEN contains(url, ':') THEN split_part(url, ':', 1) END AS prefix, regexp_replace(url, '^[^:]*:', '') AS local FROM pages""")
def curie_parse(spark, d):
    return load(spark, d, "pages").select("page_id", ids.curie_prefix(F.col("url")).alias("prefix"), ids.curie_local(F.col("url")).alias("local"))


@entry("SELECT l_orderkey, l_linenumber, l_partkey, 'OrderPartEdge:' || sha256(l_orderkey || '|' || l_partkey) AS key FROM lineitem")
def hash_id(spark, d):
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", ids.edge_key(F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"), kind="OrderPartEdge").alias("key"))


@entry(r"""SELECT part, raw, TRY_CAST(CASE WHEN lower(trim(raw)) NOT IN ('', 'na', 'n/a', 'nan', 'none', 'null', '-') THEN trim(raw) END AS DOUBLE) AS number FROM (SELECT p_partkey AS part, CASE p_partkey % 5 WHEN 0 THEN 'NA' WHEN 1 THEN ' ' WHEN 2 THEN ' ' || p_size WHEN 3 THEN p_brand ELSE p_size || '.5' END AS raw FROM part)""")
def safe_parse(spark, d):
    k = F.col("p_partkey") % 5
    raw = F.when(k == 0, "NA").when(k == 1, " ").when(k == 2, F.concat(F.lit(" "), F.col("p_size"))).when(k == 3, F.col("p_brand")).otherwise(F.concat(F.col("p_size"), F.lit(".5")))
    return load(spark, d, "part").select(F.col("p_partkey").alias("part"), raw.alias("raw"), text.safe_double(raw).alias("number"))


@entry("""SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) % 10 AS k, count(*)::BIGINT AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def json_props(spark, d):
    e = load(spark, d, "events").select("event_type", "value", F.from_json("props", "k long").getField("k").alias("k"))
    return e.groupBy("event_type", (F.col("k") % 10).alias("k")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@entry("""SELECT vec_id, 'd' || (i - 1) AS "column", embedding[i]::DOUBLE AS value FROM embeddings, range(1, 65) t(i)""")
def melt_matrix(spark, d):
    e = load(spark, d, "embeddings").select("vec_id", *[F.get("embedding", F.lit(k)).cast("double").alias(f"d{k}") for k in range(64)])
    return export.melt(e, ["vec_id"], [f"d{k}" for k in range(64)])


@entry(f"""SELECT vec_id, {", ".join(f"embedding[{k + 1}]::DOUBLE AS d{k}" for k in range(64))} FROM embeddings""")
def widen_matrix(spark, d):
    long = load(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("k", "v")).select("vec_id", F.concat(F.lit("d"), "k").alias("k"), F.col("v").cast("double").alias("v"))
    return export.widen(long, ["vec_id"], "k", "v", [f"d{k}" for k in range(64)])


def violation(condition: str, field: str, message: str, key: str, table: str, severity: str = "error") -> str:
    return f"SELECT '{severity}' AS severity, '{table}' AS entity, '{field}' AS field, {message} AS message, {key}::VARCHAR AS row FROM {{}} WHERE {condition}"


ORDERS = "(SELECT *, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS priority, CASE WHEN o_orderkey % 13 = 0 THEN ' ' ELSE o_orderstatus END AS status FROM orders)"


def flawed_orders(spark, d):
    return load(spark, d, "orders").withColumns({"priority": F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")), "status": F.when(F.col("o_orderkey") % 13 == 0, " ").otherwise(F.col("o_orderstatus"))})


@entry(violation("status IS NULL OR trim(status) = ''", "status", "'status is required'", "o_orderkey", "orders").format(ORDERS))
def validate_required(spark, d):
    return validate.required(flawed_orders(spark, d), "o_orderkey", "orders", "status")


@entry(violation("lower(o_orderstatus) IN ('f') AND priority IS NULL", "priority", "'priority is required by o_orderstatus'", "o_orderkey", "orders").format(ORDERS))
def validate_conditional(spark, d):
    return validate.conditional_required(flawed_orders(spark, d), "o_orderkey", "orders", "priority", "o_orderstatus", ["f"])


@entry(violation("priority IS NOT NULL AND priority NOT IN ('1-URGENT', '2-HIGH')", "priority", "'not allowed: ' || priority", "o_orderkey", "orders", "warning").format(ORDERS))
def validate_allowed(spark, d):
    return validate.allowed_values(flawed_orders(spark, d), "o_orderkey", "orders", "priority", ["1-URGENT", "2-HIGH"])


@entry(violation("(priority IS NULL) <> (trim(status) = '')", "priority,status", "'the group is only partly filled'", "o_orderkey", "orders").format(ORDERS))
def validate_group(spark, d):
    return validate.indexed_group(flawed_orders(spark, d), "o_orderkey", "orders", ["priority", "status"])


@entry(violation("a <> b", "a,b", "'lengths differ: ' || a || ',' || b", "l_orderkey", "orders").format("(SELECT l_orderkey, count(*) AS a, count(DISTINCT l_returnflag) AS b FROM lineitem GROUP BY 1)"))
def validate_parallel(spark, d):
    lists = load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("a"), F.collect_set("l_returnflag").alias("b"))
    return validate.parallel_lists(lists, "l_orderkey", "orders", ["a", "b"])


@entry(violation("o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)", "o_custkey", "'unknown: ' || o_custkey", "o_orderkey", "orders").format("orders"))
def validate_reference(spark, d):
    return validate.foreign_key(load(spark, d, "orders"), "o_orderkey", "orders", "o_custkey", load(spark, d, "customer").where("c_acctbal >= 0"), "c_custkey")


@entry(violation("event_type = 'error'", "m", "'kind is missing from m'", "event_id", "events").format("events"))
def validate_map_key(spark, d):
    e = load(spark, d, "events").withColumn("m", F.when(F.col("event_type") != "error", F.create_map(F.lit("kind"), F.col("event_type"))).otherwise(F.create_map(F.lit("other"), F.lit("x"))))
    return validate.required_map_key(e, "event_id", "events", "m", "kind")


@entry("""SELECT split_part(p_brand, '#', 1) AS prefix, count(DISTINCT p_brand)::BIGINT AS n FROM part GROUP BY 1 UNION ALL SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1), count(DISTINCT url)::BIGINT FROM pages GROUP BY 1""")
def prefix_counts(spark, d):
    p = load(spark, d, "part").select(F.split_part("p_brand", F.lit("#"), F.lit(1)).alias("prefix"), F.col("p_brand").alias("v"))
    u = load(spark, d, "pages").select(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("prefix"), F.col("url").alias("v"))
    one = lambda x: x.groupBy("prefix").agg(F.countDistinct("v").alias("n"))
    return one(p).union(one(u))


@entry("""SELECT c_custkey, count(DISTINCT o_orderstatus)::BIGINT AS kinds, count(*)::BIGINT AS orders, string_agg(o_orderpriority || ':' || o_orderkey, ';' ORDER BY o_orderpriority, o_orderkey) AS evidence FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > 300000 GROUP BY 1""")
def evidence_group(spark, d):
    both = load(spark, d, "customer").join(load(spark, d, "orders").where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"))
    evidence = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderpriority", "o_orderkey"))), lambda x: F.concat_ws(":", x["o_orderpriority"], x["o_orderkey"])), ";")
    return both.groupBy("c_custkey").agg(F.countDistinct("o_orderstatus").alias("kinds"), F.count(F.lit(1)).alias("orders"), evidence.alias("evidence"))


@entry("""SELECT vec_id AS parent_id, (i - 1)::INT AS position, embedding[i]::FLOAT AS value FROM embeddings, range(1, 65) t(i)""")
def flatten_nested(spark, d):
    return export.flatten(load(spark, d, "embeddings"), "VecRow", "vec_id")["vec_row__embedding"]


@entry("""WITH x AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) SELECT user_id, event_id, event_type, value FROM x WHERE r = 1 AND event_type <> 'error'""")
def incr_upsert(spark, d):
    from weftline.streaming.incremental import last_changes

    e = load(spark, d, "events").withColumn("batch", F.month("ts") % 3)
    state = None
    for b in range(3):
        new = last_changes(e.where(F.col("batch") == b), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value", "ts")
        state = new if state is None else last_changes(state.unionByName(new), "user_id", ["ts", "event_id"])
    return state.where("event_type <> 'error'").select("user_id", "event_id", "event_type", "value")


@entry("""SELECT time_bucket(INTERVAL '6 hours', ts) AS start, event_type, count(*)::BIGINT AS n FROM events GROUP BY 1, 2""")
def stream_tumbling(spark, d):
    from weftline.streaming.incremental import tumbling

    return tumbling(load(spark, d, "events"), "ts", "6 hours", "1 hour", "event_type")


@entry("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '2 hours' THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL '2 hours' AS "end", count(*)::BIGINT AS n FROM s GROUP BY user_id, sid""")
def stream_sessions(spark, d):
    from weftline.streaming.incremental import sessions

    return sessions(load(spark, d, "events"), "ts", "2 hours", "user_id")


@entry("""WITH b AS (SELECT ts, time_bucket(INTERVAL '6 hours', ts) AS s FROM events), w AS (SELECT s AS start FROM b UNION ALL SELECT time_bucket(INTERVAL '6 hours', ts + INTERVAL '3 hours') - INTERVAL '3 hours' FROM b) SELECT start, count(*)::BIGINT AS n FROM w GROUP BY 1""")
def stream_sliding(spark, d):
    from weftline.streaming.incremental import sliding

    return sliding(load(spark, d, "events"), "ts", "6 hours", "3 hours")
