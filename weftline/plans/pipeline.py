"""Declarative builds: named steps in order, each written once, resumable by a fingerprint of what it depends on."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


@dataclass
class Step:
    """A table: its function of (spark, tables so far, params), the tables it reads, and its parameters."""

    name: str
    make: Callable[[SparkSession, dict[str, DataFrame], dict], DataFrame]
    needs: tuple[str, ...] = ()
    params: dict = field(default_factory=dict)


def stage_key(step: Step, keys: dict[str, str]) -> str:
    """Changes with the step's parameters and with everything before it."""
    text = json.dumps([step.name, step.params, [keys[n] for n in step.needs]], sort_keys=True, default=str)
    return f"{step.name}-{hashlib.sha1(text.encode()).hexdigest()[:16]}"


def build(spark: SparkSession, steps: list[Step], folder: str) -> tuple[dict[str, DataFrame], list[str]]:
    """The tables of all steps, and the names of those that had to be made. A step whose key is in ``folder`` is read back;
    Spark's own commit marks a folder as whole, so a broken run is made again."""
    tables: dict[str, DataFrame] = {}
    keys: dict[str, str] = {}
    made = []
    for step in steps:
        keys[step.name] = key = stage_key(step, keys)
        path = f"{folder.rstrip('/')}/{key}"
        try:
            tables[step.name] = spark.read.parquet(path)
        except AnalysisException:
            step.make(spark, {n: tables[n] for n in step.needs}, step.params).write.mode("overwrite").parquet(path)
            tables[step.name] = spark.read.parquet(path)
            made.append(step.name)
    return tables, made


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Tables as views for ad-hoc SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
