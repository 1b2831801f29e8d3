"""Immutable dataset snapshots with manifests: written once, found by ``source:dataset:version``, checked by digest."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.diff import fingerprint, version_key

MANIFEST = "source string, dataset string, version string, rows long, digest string, columns string, inputs string"


def _folder(root: str, source: str, dataset: str, version: str) -> str:
    return f"{root.rstrip('/')}/data/source={source}/dataset={dataset}/version={version}"


def snapshot(spark: SparkSession, df: DataFrame, root: str, ref: str, inputs: tuple[str, ...] = ()) -> None:
    """Write a version and then its manifest row; a version that exists raises. ``inputs`` are the refs it was made from."""
    source, dataset, version = ref.split(":")
    path = _folder(root, source, dataset, version)
    df.write.mode("errorifexists").parquet(path)
    found = fingerprint(spark.read.parquet(path))
    row = found.select(F.lit(source).alias("source"), F.lit(dataset).alias("dataset"), F.lit(version).alias("version"), F.col("n").alias("rows"), "digest", F.lit(df.schema.simpleString()).alias("columns"), F.lit(",".join(sorted(inputs))).alias("inputs"))
    row.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/manifest")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/manifest")
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST)


def latest_versions(spark: SparkSession, root: str) -> DataFrame:
    """The manifest rows of each dataset's greatest version."""
    rows = manifest(spark, root)
    return rows.groupBy("source", "dataset").agg(F.max_by(F.struct(*rows.columns), version_key(F.col("version"))).alias("r")).select("r.*")


def open_ref(spark: SparkSession, root: str, ref: str) -> DataFrame:
    """The table of ``source:dataset:version`` or of ``source:dataset`` at its latest version."""
    source, dataset, *version = ref.split(":")
    if not version:
        row = latest_versions(spark, root).where((F.col("source") == source) & (F.col("dataset") == dataset)).first()
        if row is None:
            raise LookupError(f"no version of {ref}")
        version = [row["version"]]
    return spark.read.parquet(_folder(root, source, dataset, version[0]))


def verify(spark: SparkSession, root: str, ref: str) -> bool:
    """Whether the table still has the rows and the digest of its manifest."""
    source, dataset, version = ref.split(":")
    row = manifest(spark, root).where((F.col("source") == source) & (F.col("dataset") == dataset) & (F.col("version") == version)).first()
    now = fingerprint(open_ref(spark, root, ref)).first()
    return row is not None and (row["rows"], row["digest"]) == (now["n"], now["digest"])


def stale(spark: SparkSession, root: str) -> DataFrame:
    """(source, dataset, version, input): latest versions made from an input that has a later version by now."""
    last = latest_versions(spark, root)
    each = last.where("inputs <> ''").select("source", "dataset", "version", F.explode(F.split("inputs", ",")).alias("input"))
    now = last.select(F.concat_ws(":", "source", "dataset").alias("name"), F.col("version").alias("newest"))
    used = each.withColumn("name", F.substring_index("input", ":", 2)).withColumn("was", F.substring_index("input", ":", -1))
    return used.join(now, "name").where("was <> newest").select("source", "dataset", "version", "input")


def write_database(df: DataFrame, url: str, table: str, batch: int = 10_000, mode: str = "append", **options: str) -> None:
    """Rows into a table over JDBC, in batches by task."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), **options).mode(mode).save()
