"""Keyed record merge with provenance: scalars by policy, lists as ordered unions, maps key by key, and a change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP_FIRST, KEEP_LAST = "KeepFirst", "KeepLast"
SHOWN = 5  # additions to a list that the log shows


def _ordered(col: str, order: Column) -> Column:
    """The column's values with their order, oldest first, without missing ones."""
    by_order = lambda a, b: F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0)  # noqa: E731  maps have no order of their own
    return F.array_sort(F.collect_list(F.when(F.col(col).isNotNull(), F.struct(order.alias("o"), F.col(col).alias("v")))), by_order)


def merge_records(df: DataFrame, keys: list[str], order: list[str], policy: str = KEEP_FIRST, fixed: tuple[str, ...] = (), provenance: str | None = None) -> DataFrame:
    """One row per key of records that arrive in ``order``.

    Scalars: the first (or last) value that is not null. Lists: the union in order of arrival. Maps: entry by entry, by
    the same policy; a column of another kind raises. Columns in ``fixed`` keep what the first record has. With
    ``provenance``: ``creation`` (the first record's) and ``updates`` (column, old, new, provenance, policy of each scalar
    that came to differ; column, ``+``, additions, provenance, policy of each list that grew).
    """
    at = F.struct(*order)
    out = []
    for f in df.schema.fields:
        c = f.name
        if c in keys or c in order or c == provenance:
            continue
        if isinstance(f.dataType, T.StructType):
            raise TypeError(f"{c} is neither a scalar, a list nor a map")
        pick = F.min_by if policy == KEEP_FIRST or c in fixed else F.max_by
        if c in fixed:
            out.append(F.min_by(F.col(c), at).alias(c))
        elif isinstance(f.dataType, T.ArrayType):
            merged = F.array_distinct(F.flatten(F.transform(_ordered(c, at), lambda x: x["v"])))
            out.append(F.when(F.size(merged) > 0, merged).alias(c))
        elif isinstance(f.dataType, T.MapType):
            entries = F.flatten(F.transform(_ordered(c, at), lambda x: F.map_entries(x["v"])))
            entries = F.reverse(entries) if policy == KEEP_LAST else entries
            seen = F.array_distinct(F.transform(entries, lambda e: e["key"]))
            out.append(F.map_from_entries(F.transform(seen, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), 1))).alias(c))
        else:
            out.append(pick(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c))
    if provenance:
        out.append(F.min_by(F.col(provenance), at).alias("creation"))
    merged = df.groupBy(*keys).agg(*out)
    return merged.join(change_log(df, keys, order, policy, fixed, provenance).groupBy(*keys).agg(F.array_sort(F.collect_list("entry")).alias("updates")), keys, "left") if provenance else merged


def change_log(df: DataFrame, keys: list[str], order: list[str], policy: str, fixed: tuple[str, ...], provenance: str) -> DataFrame:
    """(keys, entry): each scalar that a later record brings and that differs from the value held by then."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    entries = []
    for f in df.schema.fields:
        c = f.name
        if c in keys or c in order or c in fixed or c == provenance or isinstance(f.dataType, T.MapType):
            continue
        if isinstance(f.dataType, T.ArrayType):
            entries.append(_additions(f, w, provenance, policy))
            continue
        held = (F.first if policy == KEEP_FIRST else F.last)(c, ignorenulls=True).over(w)
        nth = F.count(F.lit(1)).over(w)
        text = F.concat_ws("\t", F.lit(c), F.coalesce(held.cast("string"), F.lit("NULL")), F.col(c).cast("string"), F.col(provenance), F.lit(policy))
        entries.append(F.when((nth > 0) & F.col(c).isNotNull() & ~held.eqNullSafe(F.col(c)), text))
    logged = df.select(*keys, F.array_compact(F.array(*entries)).alias("entries"))
    return logged.select(*keys, F.explode("entries").alias("entry"))


def _additions(f: T.StructField, w, provenance: str, policy: str) -> Column:
    """What a later record adds to a list, if anything: the first ``SHOWN`` additions as JSON, and how many more there are."""
    c = F.col(f.name)
    before = F.flatten(F.collect_list(F.coalesce(c, F.array().cast(f.dataType))).over(w))
    new = F.array_except(F.array_distinct(c), F.coalesce(before, F.array().cast(f.dataType)))
    more = F.when(F.size(new) > SHOWN, F.concat(F.lit(" (+"), (F.size(new) - SHOWN).cast("string"), F.lit(" more)"))).otherwise("")
    text = F.concat_ws("\t", F.lit(f.name), F.lit("+"), F.concat(F.to_json(F.slice(new, 1, SHOWN)), more), F.col(provenance), F.lit(policy))
    return F.when((F.count(F.lit(1)).over(w) > 0) & (F.size(new) > 0), text)


def resolutions(df: DataFrame, keys: list[str], order: list[str], field: str) -> DataFrame:
    """(keys, resolved_ids): how each record's id came about, in order of arrival, each once."""
    return df.groupBy(*keys).agg(F.array_distinct(F.transform(_ordered(field, F.struct(*order)), lambda x: x["v"])).alias("resolved_ids"))


def append_lists(df: DataFrame, keys: list[str], order: list[str], policy: str = KEEP_FIRST) -> DataFrame:
    """The merge of a graph loader: scalars keep the first or the last value, lists are strung together with their repeats."""
    at, out = F.struct(*order), []
    for f in df.schema.fields:
        if f.name in keys or f.name in order:
            continue
        if isinstance(f.dataType, T.ArrayType):
            out.append(F.flatten(F.transform(_ordered(f.name, at), lambda x: x["v"])).alias(f.name))
        else:
            out.append((F.min_by if policy == KEEP_FIRST else F.max_by)(F.col(f.name), F.when(F.col(f.name).isNotNull(), at)).alias(f.name))
    return df.groupBy(*keys).agg(*out)


def overwrite(current: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``current`` after a source that is the only one for its rows: its last record replaces a row whole."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    last = new.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    return current.join(last.select(*keys), keys, "left_anti").unionByName(last.select(*current.columns))


def merge_objects(df: DataFrame, keys: list[str], order: list[str], provenance: str, policy: str = KEEP_FIRST, insert_only: bool = False) -> DataFrame:
    """Rows of a relational table: blank strings count as missing, and ``provenance`` becomes the row's history.

    Its first line is ``creation: `` and the first record's provenance; then a line for each value that was filled in, or,
    keeping the last, replaced. ``insert_only``: a table whose key the database gives takes every record as a new row.
    """
    if insert_only:
        return df.drop(*order)
    fields = [c for c in df.columns if c not in {*keys, *order, provenance}]
    blank = lambda c: F.when(F.trim(F.col(c).cast("string")) != "", F.col(c))
    w = Window.partitionBy(*keys).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_n", F.row_number().over(w))
    lines = []
    for c in fields:
        held = (F.first if policy == KEEP_FIRST else F.last)(blank(c), ignorenulls=True).over(before)
        raw = F.first(c).over(w.rowsBetween(Window.unboundedPreceding, 0))
        old = F.lit("NULL") if policy == KEEP_FIRST else F.coalesce(held.cast("string"), raw.cast("string"), F.lit("None"))
        changed = (F.col("_n") > 1) & blank(c).isNotNull() & (held.isNull() if policy == KEEP_FIRST else ~held.eqNullSafe(F.col(c)))
        lines.append(F.when(changed, F.concat_ws("\t", F.lit(c), old, F.col(c).cast("string"), F.col(provenance), F.lit(policy))))
    first = F.when(F.col("_n") == 1, F.concat(F.lit("creation: "), F.col(provenance)))
    rows = rows.withColumn("_lines", F.array_compact(F.array(first, *lines)))
    by_order = lambda a, b: a["n"] - b["n"]
    history = F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col("_n").alias("n"), F.col("_lines").alias("l"))), by_order), lambda x: x["l"])), "\n")
    pick = F.min_by if policy == KEEP_FIRST else F.max_by
    values = [F.coalesce(pick(F.col(c), F.when(blank(c).isNotNull(), F.col("_n"))), F.min_by(F.col(c), F.col("_n"))).alias(c) for c in fields]
    return rows.groupBy(*keys).agg(*values, history.alias(provenance))


def existing(current: DataFrame, wanted: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """The rows that a batch is about to change, with the fields it needs."""
    return current.join(wanted.select(key).distinct(), key, "left_semi").select(key, *[f for f in fields if f != key])


def keep_greatest(df: DataFrame, keys: list[str], score: str, *details: str) -> DataFrame:
    """Upsert that keeps the greatest score and what belongs to it."""
    return df.groupBy(*keys).agg(F.max(score).alias(score), *[F.max_by(d, F.struct(score, d)).alias(d) for d in details])


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], deleted: str | None = None) -> DataFrame:
    """``current`` after ``changes`` (whole rows; those with ``deleted`` true take the row away)."""
    kept = current.join(changes.select(*keys), keys, "left_anti")
    new = changes.where(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted) if deleted else changes
    return kept.unionByName(new.select(*current.columns))
