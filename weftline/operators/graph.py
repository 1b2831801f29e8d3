"""Graph operators over edge tables: components, closure, hops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.core import join_by_shuffle, materialize


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())


def connected_components(spark: SparkSession, edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst), the component being its smallest node.

    Large-star and small-star rounds in turn: O(log n) of them for any shape of graph, each with shuffles by node only
    and never a path, a component or a neighbourhood in one place. Rounds are written out, so plans stay short and lost
    executors cost no more than the running round. Null ends are ignored.
    """
    loops = edges.where("src is not null and dst is not null").select("src", "dst")
    now = materialize(spark, loops.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "components")
    before = _digest(now)
    for _ in range(most_rounds):
        if not before[0]:
            break
        both = now.union(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.min("dst").alias("low")).select("src", F.least("src", "low").alias("low"))
        large = join_by_shuffle(both.where("dst > src"), least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).where("src <> dst").distinct()
        large = materialize(spark, large, "components")
        low = large.groupBy("src").agg(F.min("dst").alias("low"))
        moved = join_by_shuffle(large, low, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        now = materialize(spark, moved.union(low.select("src", F.col("low").alias("dst"))).distinct(), "components")
        after = _digest(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("dst").alias("node")).union(join_by_shuffle(loops.where("src = dst").select("src"), now, "src", "left_anti")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(roots.select("node", F.col("node").alias("component"))).distinct()


def transitive_closure(spark: SparkSession, edges: DataFrame, nodes: DataFrame | None = None, most_rounds: int = 64) -> DataFrame:
    """(ancestor, descendant) along (parent, child) edges, with each node its own; safe on cycles.

    Pairs double their reach each round, so a chain of n takes log n rounds; edges to ids that ``nodes`` (node) lacks are
    left out.
    """
    steps = edges.select("parent", "child").where("parent is not null and child is not null and parent <> child").distinct()
    every = nodes.select("node").distinct() if nodes is not None else steps.select(F.col("parent").alias("node")).union(steps.select("child")).distinct()
    if nodes is not None:
        steps = steps.join(every.withColumnRenamed("node", "parent"), "parent", "left_semi").join(every.withColumnRenamed("node", "child"), "child", "left_semi").select("parent", "child")
    reached = materialize(spark, every.select(F.col("node").alias("ancestor"), F.col("node").alias("descendant")).union(steps).distinct(), "closure")
    delta, step = materialize(spark, steps, "delta"), steps
    for _ in range(most_rounds):
        # of 2k steps are those of k and those of k, the second k being just k: only the newest pairs meet all
        on = step.select(F.col("parent").alias("_p"), F.col("child").alias("far"))
        further = reached.join(on, F.col("descendant") == F.col("_p")).select("ancestor", F.col("far").alias("descendant")).distinct()
        new = materialize(spark, further.join(reached, ["ancestor", "descendant"], "left_anti"), "delta")
        if new.isEmpty():
            return reached
        joined = materialize(spark, reached.union(new), "closure")
        doubled = delta.join(on, F.col("child") == F.col("_p")).select("parent", F.col("far").alias("child")).where("parent <> child").distinct()
        reached, delta = joined, materialize(spark, doubled, "delta")
        step = delta
    raise RuntimeError("closure did not settle")


def hops(edges: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """(node, depth): nodes within ``k`` steps along (src, dst) of ``seeds`` (node), each at its least depth. Every depth but the
    last is written, so that none is computed again for the next."""
    found = frontier = seeds.select("node").distinct().withColumn("depth", F.lit(0))
    for depth in range(1, k + 1):
        frontier = frontier.join(edges, frontier["node"] == edges["src"]).select(F.col("dst").alias("node")).distinct()
        frontier = frontier.join(found.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth))
        frontier = materialize(edges.sparkSession, frontier, "hops") if depth < k else frontier
        found = found.union(frontier)
    return found


def drop_dangling(edges: DataFrame, starts: DataFrame, ends: DataFrame) -> DataFrame:
    """Edges (src, dst) whose ends are both known nodes (node)."""
    return edges.join(starts.select(F.col("node").alias("src")), "src", "left_semi").join(ends.select(F.col("node").alias("dst")), "dst", "left_semi")


def leaves(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes (node) that are no edge's parent."""
    return nodes.join(edges.select(F.col("parent").alias("node")), "node", "left_anti")


def partition_changes(left: DataFrame, right: DataFrame) -> DataFrame:
    """(side, grp, change, score) of two groupings (item, grp) of items: new, removed, split, merged, reconfigured or same.

    Works on overlaps of groups, never on pairs of items.
    """
    l, r = left.select("item", F.col("grp").alias("lg")), right.select("item", F.col("grp").alias("rg"))
    over = l.join(r, "item", "full").groupBy("lg", "rg").agg(F.count(F.lit(1)).alias("n"))
    by_left = over.where("lg is not null").groupBy("lg").agg(F.count("rg").alias("n_right"), F.sum(F.when(F.col("rg").isNull(), F.col("n")).otherwise(0)).alias("lost"))
    by_right = over.where("rg is not null").groupBy("rg").agg(F.count("lg").alias("n_left"), F.sum(F.when(F.col("lg").isNull(), F.col("n")).otherwise(0)).alias("gained"))
    pairs = over.where("lg is not null and rg is not null").join(by_left, "lg").join(by_right, "rg")
    merged_from = pairs.groupBy("lg").agg(F.max("n_left").alias("most_left"), F.sum("gained").alias("gained"))
    full = by_left.join(merged_from, "lg", "left")
    many, shared = F.col("n_right") > 1, F.coalesce(F.col("most_left"), F.lit(0)) > 1
    change = F.when(F.col("n_right") == 0, "removed").when(many & shared, "reconfigured").when(many, "split").when(shared, "merged").when((F.col("lost") > 0) | (F.col("gained") > 0), "membership changed").otherwise("same")
    score = F.col("lost") + F.coalesce("gained", F.lit(0)) + F.greatest(F.col("n_right"), F.coalesce("most_left", F.lit(0)))
    olds = full.select(F.lit("left").alias("side"), F.col("lg").alias("grp"), change.alias("change"), score.alias("score"))
    news = by_right.where("n_left = 0").select(F.lit("right").alias("side"), F.col("rg").alias("grp"), F.lit("new").alias("change"), F.col("gained").alias("score"))
    return olds.union(news)
