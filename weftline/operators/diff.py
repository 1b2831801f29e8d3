"""Version and entity diffs, change reasons, fingerprints, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.core import materialize
from weftline.functions.ids import minted_id


def entity_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, change, changed): added, removed or changed rows, with the fields that changed (nulls are equal)."""
    a = old.select(key, F.struct(*fields).alias("_a"))
    b = new.select(key, F.struct(*fields).alias("_b"))
    both = a.join(b, key, "full")
    differs = F.filter(F.array(*[F.when(~F.col(f"_a.{f}").eqNullSafe(F.col(f"_b.{f}")), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.size(differs) > 0, "changed")
    changed = F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), F.array_join(differs, ",")).otherwise("")
    return both.select(key, change.alias("change"), changed.alias("changed")).where("change is not null")


def removal_reason(merged_into: Column, absorbed: Column, obsolete: Column, dropped: Column, source_only: Column, lost_evidence: Column, evidence: Column) -> Column:
    """Why an entity is gone: the first reason that holds."""
    out = F.when(merged_into, "merged").when(absorbed, "absorbed as xref").when(obsolete, "all obsolete").when(dropped, "dropped by decision")
    return out.when(source_only, "source only").when(lost_evidence, "evidence lost").when(~evidence, "no evidence").otherwise("absent")


def fingerprint(df: DataFrame, *columns: str) -> DataFrame:
    """One row: the number of rows and an order-free digest of their content."""
    own = columns or tuple(df.columns)
    return df.agg(F.count(F.lit(1)).alias("n"), F.sha2(F.sum(F.xxhash64(*own).cast("decimal(38,0)")).cast("string"), 256).alias("digest"))


def version_key(version: Column) -> Column:
    """Sorts numeric dotted versions above ISO dates above other text, each in its own order."""
    numeric, iso = version.rlike(r"^v?\d+(\.\d+)*$"), version.rlike(r"^\d{4}-\d{2}-\d{2}$")
    padded = F.array_join(F.transform(F.split(F.regexp_replace(version, "^v", ""), r"\."), lambda p: F.lpad(p, 12, "0")), ".")
    return F.when(iso, F.concat(F.lit("1:"), version)).when(numeric, F.concat(F.lit("2:"), padded)).otherwise(F.concat(F.lit("0:"), version))


def latest(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The row of each key with the greatest version."""
    whole = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.max_by(whole, version_key(F.col(version))).alias("_r")).select("_r.*")


def allocate_ids(rows: DataFrame, known: DataFrame, key: str, prefix: str) -> DataFrame:
    """(key, id): the id that ``known`` (key, id) has for a natural key, whatever its case and blanks; else one minted from it."""
    norm = F.upper(F.trim(key))
    old = known.select(F.upper(F.trim(key)).alias("_k"), "id").groupBy("_k").agg(F.min("id").alias("_old"))
    return rows.select(key).distinct().withColumn("_k", norm).join(old, "_k", "left").select(key, F.coalesce("_old", minted_id(prefix, F.col(key))).alias("id"))


def flag_for_review(df: DataFrame, provenance: list[str]) -> DataFrame:
    """(rows, copies, flagged): each distinct row, how often it occurs, and whether it occurs more than once or some source
    of it disagrees."""
    wrong = F.exists(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in provenance]), lambda x: x == "error")
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies")).withColumn("flagged", (F.col("copies") > 1) | wrong)


def surrogates(spark: SparkSession, df: DataFrame, key: str, out: str = "surrogate") -> DataFrame:
    """(key, number) of the distinct keys, numbered from 1 in their order.

    Keys are sorted in ranges, side by side, and written with their place; how many each range holds (one number a
    partition) says where its numbers begin, so no task sees more than its range.
    """
    placed = materialize(spark, df.select(key).where(F.col(key).isNotNull()).distinct().sort(key).withColumn("_at", F.monotonically_increasing_id()), "surrogates")
    part, nth = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.withColumn("_part", part).join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part").select(key, (F.col("_before") + nth + 1).alias(out))
