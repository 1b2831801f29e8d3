"""Session settings, table loading and durable intermediate tables."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR: list[str] = []
_SCOPES: list[list[str]] = []


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table. The path goes to Spark's reader as it is, so any store that Spark knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a private one is made only for a local master that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _OWN_DIR:
        _OWN_DIR.append(tempfile.mkdtemp(prefix="weftline-"))
        atexit.register(shutil.rmtree, _OWN_DIR[0], True)
    return f"file://{_OWN_DIR[0]}"


def materialize(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage, survives lost executors and gives the planner exact sizes.
    """
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for made in _SCOPES:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def join_by_shuffle(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join of two tables that both grow with the input, by shuffle whatever their estimates.

    The planner takes a written table for as large as its compressed files. One of 10 MB can have ten times as much in rows, which it
    would gather in the driver and broadcast.
    """
    return left.join(right.hint("merge"), on, how)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in any store that Spark knows; none there is no fault."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def scratch(spark: SparkSession, keep: int = 1):
    """Within it, tables that are written to cut lineage are noted; at its end all but the last ``keep`` are deleted.

    For builders that write their result last: nothing that it was made from is read again.
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES.remove(made)
        for path in made[: len(made) - keep]:
            remove(spark, path)


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names that ``df`` does not have, so helper columns never clash with the caller's."""
    taken, out = {c.lower() for c in df.columns}, []
    for base in bases:
        name = base
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
