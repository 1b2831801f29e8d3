"""Filter, search, facet, combination, list and coverage queries over node tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_list(df: DataFrame, field: str) -> bool:
    return isinstance(df.schema[field].dataType, T.ArrayType)


def field_filter(df: DataFrame, field: str, values: list) -> Column:
    """The field, or an item of it, is one of the values; a None among them also takes missing and empty."""
    named, col = [v for v in values if v is not None], F.col(field)
    if is_list(df, field):
        held = F.coalesce(F.arrays_overlap(col, F.array(*map(F.lit, named))), F.lit(False)) if named else F.lit(False)
        missing = F.coalesce(F.size(col) <= 0, F.lit(True))
    else:
        held = F.coalesce(col.isin(*named), F.lit(False)) if named else F.lit(False)
        missing = col.isNull()
    return held | missing if None in values else held


def filters(df: DataFrame, wanted: dict[str, list], skip: str | None = None) -> Column:
    """All field filters together, but for the one on ``skip``."""
    return reduce(lambda a, b: a & b, [field_filter(df, f, v) for f, v in wanted.items() if f != skip and v], F.lit(True))


def search(df: DataFrame, fields: list[str], text: str | None) -> Column:
    """Some field, or an item of it, holds the text, in either case."""
    if not text:
        return F.lit(True)
    low = text.lower()
    one = lambda f: F.exists(F.col(f), lambda x: F.lower(x.cast("string")).contains(low)) if is_list(df, f) else F.lower(F.col(f).cast("string")).contains(low)
    return reduce(lambda a, b: a | b, [F.coalesce(one(f), F.lit(False)) for f in fields])


def facet(df: DataFrame, field: str, wanted: dict[str, list] | None = None, top: int = 20) -> DataFrame:
    """(value, n) of the ``top`` commonest values; list items count once per row; the field's own filter does not apply."""
    rows = df.where(filters(df, wanted or {}, skip=field))
    value = F.explode_outer(F.array_distinct(F.col(field))) if is_list(df, field) else F.col(field)
    counts = rows.select(value.alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc_nulls_last("value")).limit(top)


def upset(df: DataFrame, field: str, top: int | None = None) -> DataFrame:
    """(combination, n): how many rows hold exactly that set of items."""
    key = F.array_join(F.array_sort(F.array_distinct(F.coalesce(F.col(field), F.array().cast(df.schema[field].dataType))).cast("array<string>")), "|")
    counts = df.groupBy(key.alias("combination")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "combination").limit(top) if top else counts


def page(df: DataFrame, key: str, number: int, size: int) -> DataFrame:
    """One page in key order, with the total and the number, clamped to the pages there are."""
    total = df.count()
    last = max(1, -(-total // size))
    number = min(max(1, number), last)
    return df.orderBy(key).offset((number - 1) * size).limit(size).withColumns({"total": F.lit(total).cast("long"), "page": F.lit(number).cast("long")})


def coverage(df: DataFrame) -> DataFrame:
    """(field, filled, total, percent), missing and empty lists alike."""
    total = F.count(F.lit(1)).alias("_total")
    one = lambda f: F.count(F.when(F.size(F.col(f)) > 0, 1) if is_list(df, f) else F.col(f))
    wide = df.agg(total, *[one(f).alias(f) for f in df.columns])
    long = wide.select("_total", F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("filled")) for f in df.columns])))
    return long.select("field", "filled", F.col("_total").alias("total"), F.when(F.col("_total") > 0, F.round(100 * F.col("filled") / F.col("_total"), 2)).otherwise(0.0).alias("percent"))


def column_stats(df: DataFrame, fields: list[str]) -> DataFrame:
    """One row per numeric field, all in one pass."""
    parts = []
    for f in fields:
        v = F.col(f).cast("double")
        parts += [F.count(v).alias(f"{f}:n"), F.min(v).alias(f"{f}:low"), F.max(v).alias(f"{f}:high"), F.avg(v).alias(f"{f}:mean"), F.stddev_samp(v).alias(f"{f}:std"), F.countDistinct(v).alias(f"{f}:distinct")]
    wide, stats = df.agg(*parts), ("n", "low", "high", "mean", "std", "distinct")
    return wide.select(F.inline(F.array(*[F.struct(F.lit(f).alias("field"), *[F.col(f"`{f}:{s}`").alias(s) for s in stats]) for f in fields])))


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def linked(nodes: DataFrame, edges: DataFrame, key: str, start: str, end: str, others: DataFrame, other_key: str, node_filter: Column | None = None, edge_filter: Column | None = None) -> DataFrame:
    """Rows node - edge - other, with filters on either side pushed below the joins."""
    left = nodes.where(node_filter) if node_filter is not None else nodes
    middle = edges.where(edge_filter) if edge_filter is not None else edges
    return left.join(middle, left[key] == middle[start]).join(others, middle[end] == others[other_key])


def coerce(values: list[str]) -> list:
    """Filter values as they come from a form: true, false and null in any case stand for themselves."""
    known = {"true": True, "false": False, "null": None}
    return [known.get(v.lower(), v) if isinstance(v, str) else v for v in values]


def quality_range(value: Column, wanted: str) -> Column:
    """``low-high``: a number from low up to below high; else the very text. A range that is none takes every row."""
    if "-" not in wanted:
        return F.coalesce(F.trim(value) == wanted, F.lit(False))
    try:
        low, high = map(float, wanted.split("-", 1))
    except ValueError:
        return F.lit(True)
    number = F.trim(value).try_cast("double")
    return F.coalesce((number >= low) & (number < high), F.lit(False))


def concepts(df: DataFrame, sources: DataFrame | None = None, *, text: str = "", tier: str = "", quality: str = "", rare: str = "", source: str = "", kind: str = "", flagged: Column | None = None) -> DataFrame:
    """Concepts (id, name, tier, quality, is_rare, kind) for which all that is asked for holds; ``sources`` is (id, source)."""
    ok = [flagged] if flagged is not None else []
    if text:
        ok.append(F.lower("id").contains(text.lower()) | F.coalesce(F.lower("name").contains(text.lower()), F.lit(False)))
    if tier:
        ok.append(F.lower("tier") == tier.lower())
    if quality:
        ok.append(quality_range(F.col("quality"), quality))
    if rare in ("true", "false"):
        ok.append((F.lower(F.coalesce("is_rare", F.lit(""))) == "true") == F.lit(rare == "true"))
    if kind:
        ok.append(F.col("kind") == kind)
    out = df.where(reduce(lambda a, b: a & b, ok, F.lit(True)))
    return out.join(sources.where(F.col("source") == source).select("id"), "id", "left_semi") if source and sources is not None else out


def keyset_page(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """The next rows in key order after a key: the filter reaches the scan, whatever the page."""
    rows = df if after is None else df.where(F.col(key) > after)
    return rows.orderBy(key).limit(size)


def sorted_page(df: DataFrame, order: list[tuple[str, bool]], key: str, skip: int, size: int) -> DataFrame:
    """Rows by several columns (name, descending), the key last, from ``skip`` on."""
    by = [F.desc_nulls_last(c) if down else F.asc_nulls_first(c) for c, down in order]
    return df.orderBy(*by, key).offset(skip).limit(size)


def sample_rows(df: DataFrame, key: str, size: int = 500, seed: str = "sample") -> DataFrame:
    """``size`` rows by a hash of their key: the same on every run, and no sort of the whole table."""
    return df.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256), key).limit(size)
