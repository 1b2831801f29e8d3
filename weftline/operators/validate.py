"""Validation rules: each gives a table of violations (severity, entity, field, message, row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _blank(df: DataFrame, field: str) -> Column:
    c = F.col(field)
    if isinstance(df.schema[field].dataType, T.ArrayType):
        return F.coalesce(F.size(c) <= 0, F.lit(True))
    return c.isNull() | (F.trim(c.cast("string")) == "")


def _report(df: DataFrame, key: str, wrong: Column, entity: str, field: str, message: Column | str, severity: str) -> DataFrame:
    text = F.lit(message) if isinstance(message, str) else message
    return df.where(wrong).select(F.lit(severity).alias("severity"), F.lit(entity).alias("entity"), F.lit(field).alias("field"), text.alias("message"), F.col(key).cast("string").alias("row"))


def required(df: DataFrame, key: str, entity: str, field: str, severity: str = "error") -> DataFrame:
    return _report(df, key, _blank(df, field), entity, field, f"{field} is required", severity)


def conditional_required(df: DataFrame, key: str, entity: str, field: str, when_field: str, when_values: list[str], severity: str = "error") -> DataFrame:
    """The field is required where another one has one of the values, in either case."""
    when = F.lower(F.col(when_field).cast("string")).isin(*[v.lower() for v in when_values])
    return _report(df, key, when & _blank(df, field), entity, field, f"{field} is required by {when_field}", severity)


def required_map_key(df: DataFrame, key: str, entity: str, field: str, name: str, severity: str = "error") -> DataFrame:
    value = F.try_element_at(F.col(field), F.lit(name))
    return _report(df, key, value.isNull() | (F.trim(value) == ""), entity, field, f"{name} is missing from {field}", severity)


def parallel_lists(df: DataFrame, key: str, entity: str, fields: list[str], severity: str = "error") -> DataFrame:
    """Lists of equal length; missing counts 0, a scalar 1."""
    n = lambda f: F.greatest(F.coalesce(F.size(f), F.lit(0)), F.lit(0)) if isinstance(df.schema[f].dataType, T.ArrayType) else F.col(f).isNotNull().cast("int")
    sizes = F.array(*map(n, fields))
    return _report(df, key, F.size(F.array_distinct(sizes)) > 1, entity, ",".join(fields), F.concat(F.lit("lengths differ: "), F.array_join(sizes.cast("array<string>"), ",")), severity)


def allowed_values(df: DataFrame, key: str, entity: str, field: str, allowed: list[str], severity: str = "warning") -> DataFrame:
    c = F.col(field)
    return _report(df, key, c.isNotNull() & ~c.isin(*allowed), entity, field, F.concat(F.lit("not allowed: "), c.cast("string")), severity)


def indexed_group(df: DataFrame, key: str, entity: str, fields: list[str], severity: str = "error") -> DataFrame:
    """Either all of the fields are filled or none."""
    filled = F.array(*[(~_blank(df, f)).cast("int") for f in fields])
    return _report(df, key, F.size(F.array_distinct(filled)) > 1, entity, ",".join(fields), "the group is only partly filled", severity)


def foreign_key(df: DataFrame, key: str, entity: str, field: str, target: DataFrame, target_key: str, severity: str = "error") -> DataFrame:
    lost = df.where(F.col(field).isNotNull()).join(target.select(F.col(target_key).alias("_t")), F.col(field) == F.col("_t"), "left_anti")
    return _report(lost, key, F.lit(True), entity, field, F.concat(F.lit("unknown: "), F.col(field).cast("string")), severity)


def conditional_required_map_key(df: DataFrame, key: str, entity: str, field: str, name: str, when_field: str, when_values: list[str], severity: str = "error") -> DataFrame:
    """The map has the key where another field has one of the values, in either case; NA and N/A are no value."""
    when = F.lower(F.col(when_field).cast("string")).isin(*[v.lower() for v in when_values])
    value = F.try_element_at(F.col(field), F.lit(name))
    return _report(df, key, when & (value.isNull() | F.trim(value).isin("", "NA", "N/A")), entity, field, f"{name} is required in {field} by {when_field}", severity)


def placed(report: DataFrame, sheet: str, column: str | None = None, source_file: str | None = None) -> DataFrame:
    """A report with where its rows come from."""
    text = lambda v: F.lit(v).cast("string")
    return report.select("severity", "entity", "field", "message", text(sheet).alias("sheet"), F.coalesce(text(column), F.col("field")).alias("column"), "row", text(source_file).alias("source_file"))


def sheets(columns: DataFrame, required_sheets: list[str], recognized: list[str], source_file: str) -> DataFrame:
    """Missing sheets (errors) and unknown ones (warnings) of a workbook's (sheet, column) table."""
    spark, have = columns.sparkSession, columns.select("sheet").distinct()
    wanted = spark.createDataFrame([(s,) for s in required_sheets], "sheet string")
    known = spark.createDataFrame([(s,) for s in recognized], "sheet string")
    one = lambda df, severity, text, sheet: df.select(F.lit(severity).alias("severity"), F.lit("parse").alias("entity"), F.col("sheet").alias("field"), F.concat(F.lit(text), "sheet").alias("message"), sheet.alias("sheet"), F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("row"), F.lit(source_file).alias("source_file"))
    missing = one(wanted.join(have, "sheet", "left_anti"), "error", "missing sheet: ", F.lit(None).cast("string"))
    return missing.union(one(have.join(known, "sheet", "left_anti"), "warning", "unknown sheet: ", F.col("sheet")))


def unknown_keys(keys: DataFrame, known: list[str], sheet: str, source_file: str) -> DataFrame:
    """Keys (key) of a map sheet that are not known; numbers in a key stand for any number."""
    low = F.regexp_replace(F.trim("key"), r"\d+", "{}")
    bad = keys.where((F.trim("key") != "") & ~F.trim("key").isin(*known) & ~low.isin(*known)).select(F.trim("key").alias("key")).distinct()
    return bad.select(F.lit("warning").alias("severity"), F.lit("parse").alias("entity"), F.col("key").alias("field"), F.concat(F.lit("unknown key: "), "key").alias("message"), F.lit(sheet).alias("sheet"), F.col("key").alias("column"), F.lit(None).cast("string").alias("row"), F.lit(source_file).alias("source_file"))


def mapped_columns(mapping: DataFrame, columns: DataFrame, map_sheet: str, data_sheet: str, source_file: str) -> DataFrame:
    """Columns that a map sheet (key, column) names and the data sheet (sheet, column) does not have."""
    named = mapping.where(~F.trim(F.coalesce("column", F.lit(""))).isin("", "NA", "N/A"))
    lost = named.join(columns.where(F.col("sheet") == data_sheet).select("column"), "column", "left_anti")
    return lost.select(F.lit("error").alias("severity"), F.lit("parse").alias("entity"), F.col("key").alias("field"), F.concat(F.lit(f"no such column in {data_sheet}: "), "column").alias("message"), F.lit(map_sheet).alias("sheet"), F.col("key").alias("column"), F.lit(None).cast("string").alias("row"), F.lit(source_file).alias("source_file"))
