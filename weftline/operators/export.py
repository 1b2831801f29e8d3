"""Relational, matrix and mapping exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.ids import curie_prefix


def snake(name: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() and k else c.lower() for k, c in enumerate(name))


def flatten(df: DataFrame, name: str, key: str) -> dict[str, DataFrame]:
    """Tables of a nested one: scalars; objects (one row each); lists (one row per item); maps (one row per entry).

    Lists within listed objects become grandchild tables; their parents then get an id of their own, made from where they
    stand (parent, position).
    """
    name, parent = snake(name), F.col(key).alias("parent_id")
    scalars, out = [], {}
    for f in df.schema.fields:
        kind, c, table = f.dataType, F.col(f.name), f"{name}__{snake(f.name)}"
        if isinstance(kind, T.StructType):
            out[table] = df.where(c.isNotNull()).select(parent, f"{f.name}.*")
        elif isinstance(kind, T.ArrayType):
            item = df.select(parent, F.posexplode(c).alias("position", "value"))
            if not isinstance(kind.elementType, T.StructType):
                out[table] = item
                continue
            nested = [x for x in kind.elementType.fields if isinstance(x.dataType, T.ArrayType)]
            plain = [F.col(f"value.{x.name}").alias(x.name) for x in kind.elementType.fields if x not in nested]
            own = F.sha1(F.concat_ws("|", "parent_id", F.col("position").cast("string")))
            out[table] = item.select("parent_id", "position", *([own.alias("id")] if nested else []), *plain)
            for x in nested:
                sub = item.select(own.alias("parent_id"), F.posexplode(F.col(f"value.{x.name}")).alias("position", "item"))
                out[f"{table}__{snake(x.name)}"] = sub.select("parent_id", "position", "item.*") if isinstance(x.dataType.elementType, T.StructType) else sub.withColumnRenamed("item", "value")
        elif isinstance(kind, T.MapType):
            out[table] = df.select(parent, F.explode(c).alias("key", "value"))
        else:
            scalars.append(f.name)
    return {name: df.select(*scalars)} | out


def edge_table(edges: DataFrame) -> DataFrame:
    """A link table: (from_id, to_id, scalars). A list of plain values becomes one column, named without its last ``s``, with a
    row for each value; lists of objects are left out."""
    out = edges.select(F.col("start_id").alias("from_id"), F.col("end_id").alias("to_id"), *[f.name for f in edges.schema.fields if f.name not in ("start_id", "end_id") and not isinstance(f.dataType, (T.StructType, T.MapType)) and not (isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType))])
    for f in out.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            out = out.withColumn(f.name, F.explode_outer(f.name)).withColumnRenamed(f.name, f.name.removesuffix("s"))
    return out


def plan_data_tables(edges: DataFrame, file_backed: DataFrame) -> DataFrame:
    """(parent, target, edge, role) of the edges (edge, source, target) that leave file-backed collections (collection).

    role: how many other collections point at the target decides: none, a row key (``analyte``); one, a column key
    (``sample``); more, a link table as any other (``edge``).
    """
    files = file_backed.select("collection").distinct()
    others = edges.join(files, F.col("source") == F.col("collection"), "left_anti").groupBy("target").agg(F.countDistinct("source").alias("n"))
    own = edges.join(files, F.col("source") == F.col("collection"), "left_semi").join(others, "target", "left")
    role = F.when(F.coalesce("n", F.lit(0)) == 0, "analyte").when(F.col("n") == 1, "sample").otherwise("edge")
    return own.select(F.col("source").alias("parent"), "target", "edge", role.alias("role"))


def melt(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Wide to long: (keys, column, value)."""
    return df.unpivot(keys, columns, "column", "value")


def widen(df: DataFrame, keys: list[str], column: str, value: str, columns: list[str]) -> DataFrame:
    """Long to wide; the columns are named, so no job has to find them."""
    return df.groupBy(*keys).pivot(column, columns).agg(F.first(value))


def literal(value: Column) -> Column:
    """A text as an N-Triples literal: backslashes, quotes and line ends escaped."""
    out = F.regexp_replace(value, r"\\", r"\\\\")
    for raw, shown in (('"', r"\\\""), ("\n", r"\\n"), ("\r", r"\\r"), ("\t", r"\\t")):
        out = F.regexp_replace(out, raw, shown)
    return F.concat(F.lit('"'), out, F.lit('"'))


def iri(base: str, local: Column) -> Column:
    """An IRI; characters that it may not hold are percent-encoded."""
    return F.concat(F.lit(f"<{base}"), F.replace(F.url_encode(local), F.lit("+"), F.lit("%20")), F.lit(">"))


def triples(df: DataFrame, subject: Column, base: str, fields: list[str], links: tuple[str, ...] = ()) -> DataFrame:
    """N-Triples lines of the fields that are filled; those in ``links`` hold ids, and become IRIs."""
    end = lambda f: iri(base, F.col(f).cast("string")) if f in links else literal(F.col(f).cast("string"))
    lines = [F.when(F.col(f).isNotNull(), F.concat(iri(base, subject), F.lit(f" <{base}{f}> "), end(f), F.lit(" ."))) for f in fields]
    return df.select(F.explode(F.array_compact(F.array(*lines))).alias("value"))


def edge_triples(edges: DataFrame, base: str, predicate: Column, overlay: dict[str, str] | None = None) -> DataFrame:
    """N-Triples lines of edges (start_id, end_id); predicates with a name in ``overlay`` say it by that one as well."""
    names = [F.concat(F.lit(f"<{base}"), predicate, F.lit(">"))] + [F.when(predicate == k, F.lit(f"<{v}>")) for k, v in (overlay or {}).items()]
    every = F.transform(F.array_compact(F.array(*names)), lambda p: F.concat(iri(base, F.col("start_id")), F.lit(" "), p, F.lit(" "), iri(base, F.col("end_id")), F.lit(" .")))
    return edges.select(F.explode(every).alias("value"))


def mappings(edges: DataFrame, subject: str, predicate: str, obj: str) -> DataFrame:
    """SSSOM rows: exact, broad, narrow or related matches of the edges' ends."""
    p = F.lower(F.col(predicate))
    kind = F.when(p.contains("exact") | p.contains("equivalent"), "skos:exactMatch").when(p.contains("broad"), "skos:broadMatch").when(p.contains("narrow"), "skos:narrowMatch").otherwise("skos:relatedMatch")
    return edges.select(F.col(subject).alias("subject_id"), kind.alias("predicate_id"), F.col(obj).alias("object_id"), curie_prefix(F.col(subject)).alias("subject_source"), curie_prefix(F.col(obj)).alias("object_source"), F.lit("semapv:DatabaseCrossReference").alias("mapping_justification"))


def label_index(tables: list[tuple[DataFrame, str, str]], longest: int = 255) -> DataFrame:
    """(kind, label) of all labels to complete from: distinct, cut to the index's width."""
    out = None
    for df, kind, column in tables:
        part = df.where(F.col(column).isNotNull()).select(F.lit(kind).alias("kind"), F.left(F.col(column), F.lit(longest)).alias("label")).distinct()
        out = part if out is None else out.union(part)
    return out


def write_delimited(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=header)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_clustered(df: DataFrame, path: str, by: list[str], files: int) -> None:
    """A table whose files cover ranges of its keys, sorted within: scans that filter on them skip the others' row groups."""
    df.repartitionByRange(files, *by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def in_batches(rows: list, write, size: int) -> int:
    """Hand rows to ``write`` in batches; one that fails is halved until it passes or a single row fails, which raises.
    The number of batches written."""
    done = 0
    for a in range(0, len(rows), size):
        waiting = [rows[a : a + size]]
        while waiting:
            batch = waiting.pop()
            try:
                write(batch)
                done += 1
            except Exception:
                if len(batch) == 1:
                    raise
                waiting += [batch[len(batch) // 2 :], batch[: len(batch) // 2]]
    return done
