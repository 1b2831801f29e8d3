"""Specificity, ranks, novelty, importance, shares, spreads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.rules import TIER_CODES


def tau(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, tau): sum(1 - v / max) / (n - 1); 0 for one value, or if the largest is 0."""
    agg = df.groupBy(key).agg(F.count(value).alias("n"), F.max(value).alias("m"), F.sum(value).alias("s"))
    return agg.select(key, F.when((F.col("n") <= 1) | (F.col("m") == 0), 0.0).otherwise((F.col("n") - F.col("s") / F.col("m")) / (F.col("n") - 1)).alias("tau"))


def normalised_rank(df: DataFrame, key: str, value: str, out: str = "rank") -> DataFrame:
    """Average rank / n within the key, spread over 0..1; all 0 if the largest value is 0; plain if all are tied."""
    own, ties = Window.partitionBy(key), Window.partitionBy(key, value)
    filled = F.count(value).over(own)
    rank = F.when(F.col(value).isNotNull(), (F.sum(F.when(F.col(value).isNotNull(), 1)).over(own.orderBy(F.asc_nulls_last(value)).rangeBetween(Window.unboundedPreceding, 0)) - (F.count(value).over(ties) - 1) / 2) / filled)
    df = df.withColumn("_r", rank)
    low, high = F.min("_r").over(own), F.max("_r").over(own)
    spread = F.when(F.max(value).over(own) == 0, F.when(F.col(value).isNotNull(), 0.0)).when(high == low, F.col("_r")).otherwise((F.col("_r") - low) / (high - low))
    return df.withColumn(out, spread).drop("_r")


def novelty(mentions: DataFrame, entity: str, paper: str) -> DataFrame:
    """(entity, novelty): 1 / sum over its distinct papers of 1 / (entities of the paper)."""
    pairs = mentions.select(entity, paper).distinct()
    share = pairs.groupBy(paper).agg((1 / F.count(F.lit(1))).alias("share"))
    return pairs.join(share, paper).groupBy(entity).agg((1 / F.sum("share")).alias("novelty"))


def importance(a: DataFrame, b: DataFrame, paper: str, left: str, right: str) -> DataFrame:
    """(left, right, importance): sum over shared papers of 1 / (rows of a there x rows of b there); repeats count.

    Rows are counted before the join, so a paper with many repeats is no larger than one with few.
    """
    na, nb = a.groupBy(paper, left).agg(F.count(F.lit(1)).alias("ca")), b.groupBy(paper, right).agg(F.count(F.lit(1)).alias("cb"))
    ta, tb = na.groupBy(paper).agg(F.sum("ca").alias("ta")), nb.groupBy(paper).agg(F.sum("cb").alias("tb"))
    weight = F.col("ca") * F.col("cb") / (F.col("ta") * F.col("tb"))
    return na.join(ta, paper).join(nb.join(tb, paper), paper).groupBy(left, right).agg(F.sum(weight).alias("importance")).where("importance > 0")


def shares(df: DataFrame, group: str, entity: str, year: Column) -> DataFrame:
    """(entity, year, score): the entity's part of each group's rows, added up by year; groups without one are left out."""
    counts = df.select(group, entity, year.alias("year")).where("year is not null").groupBy(group, "year", entity).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(group, "year").agg(F.sum("n").alias("t"))
    return counts.join(totals, [group, "year"]).groupBy(entity, "year").agg(F.sum(F.col("n") / F.col("t")).alias("score"))


def spread(df: DataFrame, key: str, value: str, limit: float = 0.10) -> DataFrame:
    """(key, low, middle, high, n, spread, flagged): spread = (high - low) / low."""
    agg = df.groupBy(key).agg(F.min(value).alias("low"), F.median(value).alias("middle"), F.max(value).alias("high"), F.count(value).alias("n"))
    ratio = F.when(F.col("low") > 0, (F.col("high") - F.col("low")) / F.col("low"))
    return agg.withColumn("spread", ratio).withColumn("flagged", F.coalesce(F.col("spread") > limit, F.lit(False)))


def jaccard_matrix(df: DataFrame, source: str, item: str) -> DataFrame:
    """(a, b, shared, jaccard) of all sources with a common item. Sources are few; items meet by an equi-join on distinct pairs."""
    pairs = df.select(F.col(source).alias("s"), F.col(item).alias("i")).distinct()
    sizes = pairs.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    held = pairs.groupBy("i").agg(F.array_sort(F.collect_set("s")).alias("by"))
    both = held.groupBy("by").agg(F.count(F.lit(1)).alias("n")).select(F.explode("by").alias("a"), "by", "n").select("a", F.explode("by").alias("b"), "n").groupBy("a", "b").agg(F.sum("n").alias("shared"))
    sa, sb = sizes.select(F.col("s").alias("a"), F.col("n").alias("na")), sizes.select(F.col("s").alias("b"), F.col("n").alias("nb"))
    return both.join(sa, "a").join(sb, "b").select("a", "b", "shared", F.round(F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared")), 4).alias("jaccard"))


def neighbours(df: DataFrame, node: str, key: str, k: int) -> DataFrame:
    """(node, other, shared, rank): the ``k`` nodes that share most distinct keys with each node."""
    pairs = df.select(F.col(node).alias("node"), F.col(key).alias("k")).distinct()
    met = pairs.join(pairs.select(F.col("node").alias("other"), "k"), "k").where("node <> other").groupBy("node", "other").agg(F.count(F.lit(1)).alias("shared"))
    return met.withColumn("rank", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("shared"), "other"))).where(F.col("rank") <= k)


def source_counts(df: DataFrame, field: str) -> DataFrame:
    """(kind, value, n): in how many rows each source stands (once a row), and how many rows have each list of sources, as
    it is, sorted; rows without any count nowhere."""
    marginal = df.select(F.explode(F.array_distinct(F.col(field))).alias("value")).where("value <> ''").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    joint = df.select(F.array_join(F.array_sort(field), "|").alias("value")).where("value <> ''").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return marginal.select(F.lit("marginal").alias("kind"), "value", "n").union(joint.select(F.lit("joint"), "value", "n"))


def closure_rollup(closure: DataFrame, links: DataFrame, nodes: DataFrame, target: str, tier: str) -> DataFrame:
    """(node, target_count, direct_target_count, max_tier) of ``nodes`` (node): distinct targets of it and its descendants,
    of itself alone, and its own targets' highest tier; ``links`` is (node, target, tier, direct)."""
    known = links.where(F.col(target).isNotNull())
    codes = F.coalesce(*[F.when(F.col(tier) == name, code) for name, code in TIER_CODES.items()], F.lit(1))
    own = links.where("direct").groupBy("node").agg(F.countDistinct(target).alias("direct_target_count"), F.max(codes).alias("_code"))
    below = closure.join(known.select(F.col("node").alias("descendant"), target).distinct(), "descendant").groupBy(F.col("ancestor").alias("node")).agg(F.countDistinct(target).alias("target_count"))
    name = F.coalesce(*[F.when(F.col("_code") == code, name) for name, code in TIER_CODES.items()])
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return nodes.join(below, "node", "left").join(own, "node", "left").select("node", zero("target_count"), zero("direct_target_count"), name.alias("max_tier"))


def collapse(df: DataFrame, column: str, separator: str = "|") -> DataFrame:
    """Rows that are the same but in one column become one, with its distinct values strung together in order."""
    others = [c for c in df.columns if c != column]
    return df.groupBy(*others).agg(F.array_join(F.array_sort(F.collect_set(column)), separator).alias(column))


def union_lists(df: DataFrame, key: str, separator: str = "|") -> DataFrame:
    """One row per key: each column's delimited values of all its rows, each once, in order; null if there are none."""
    items = lambda c: F.filter(F.transform(F.split(F.col(c), rf"\{separator}"), lambda x: F.trim(x)), lambda x: x != "")
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(items(c))))), separator)
    return df.groupBy(key).agg(*[F.nullif(joined(c), F.lit("")).alias(c) for c in df.columns if c != key])


def distributions(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, value, n) of several fields in one pass; missing and blank values are one."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.nullif(F.trim(F.col(f).cast("string")), F.lit("")).alias("value")) for f in fields])
    return df.select(F.inline(pairs)).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


def mapped_coverage(df: DataFrame, key: str, alternates: str, matches: DataFrame) -> DataFrame:
    """(total, mapped, percent): keys, each once, of which they or one of their delimited alternates (those of the key's
    first row) have a match (input)."""
    first = df.where(F.coalesce(F.trim(key), F.lit("")) != "").groupBy(key).agg(F.min(alternates).alias("_a"))
    every = F.array_distinct(F.array_prepend(F.filter(F.transform(F.split(F.coalesce("_a", F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != ""), F.col(key)))
    hits = first.select(key, F.explode(every).alias("input")).join(matches.select("input").distinct().withColumn("_hit", F.lit(1)), "input", "left").groupBy(key).agg(F.max("_hit").alias("_hit"))
    return hits.agg(F.count(F.lit(1)).alias("total"), F.count("_hit").alias("mapped")).withColumn("percent", F.when(F.col("total") > 0, 100 * F.col("mapped") / F.col("total")).otherwise(0.0))


def large_sources(df: DataFrame, source: str, item: str, least: int = 500, most: int = 10, fallback: int = 6) -> DataFrame:
    """(source) of the ``most`` largest with ``least`` items or more; if none has, of the ``fallback`` largest of all."""
    sizes = df.groupBy(F.col(source).alias("source")).agg(F.countDistinct(item).alias("n"))
    ranked = sizes.withColumn("r", F.row_number().over(Window.orderBy(F.desc("n"), "source"))).withColumn("top", F.max("n").over(Window.partitionBy()))
    return ranked.where(F.when(F.col("top") >= least, (F.col("n") >= least) & (F.col("r") <= most)).otherwise(F.col("r") <= fallback)).select("source")
