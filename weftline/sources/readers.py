"""Readers of the source formats: each gives a DataFrame, and leaves splitting and pruning to Spark.

Formats whose records span lines are read with their own record separator, so files still split between tasks.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def delimited(spark: SparkSession, path: str, fields: list[str] | None = None, separator: str = "\t", comment: str | None = None, expected: list[str] | None = None, quote: str = "") -> DataFrame:
    """A delimited table of strings: with its own header, or with the given fields. A header other than ``expected`` raises."""
    reader = spark.read.option("sep", separator).option("quote", quote).option("header", fields is None)
    if comment:
        reader = reader.option("comment", comment)
    if fields:
        return reader.schema(T.StructType([T.StructField(f, T.StringType()) for f in fields])).csv(path)
    df = reader.csv(path)
    if expected is not None and df.columns != expected:
        raise ValueError(f"the header of {path} is {df.columns}, not {expected}")
    return df


def whitespace(spark: SparkSession, path: str, fields: list[str], header: bool = True) -> DataFrame:
    """Fields separated by any blanks; a first line that repeats the first field's name is a header."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(F.trim("value") != "").select(*[F.get(parts, F.lit(k)).alias(f) for k, f in enumerate(fields)])
    return rows.where(F.col(fields[0]) != fields[0]) if header else rows


def packed_tokens(spark: SparkSession, path: str, token: str = r"\d+") -> DataFrame:
    """(id, token) of lines ``id <tab> token token ...``; repeats stay."""
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).where(F.size(parts) == 2).select(F.get(parts, F.lit(0)).alias("id"), F.explode(F.regexp_extract_all(F.get(parts, F.lit(1)), F.lit(token), F.lit(0))).alias("token"))


def gct(spark: SparkSession, path: str) -> DataFrame:
    """(name, description, sample, value) of an expression matrix with two banner lines, in long form."""
    header = spark.read.text(path).where(F.col("value").startswith("Name\tDescription\t")).first()["value"].split("\t")
    parts = F.split("value", "\t")
    rows = spark.read.text(path).where(F.size(parts) == len(header)).where(~F.col("value").startswith("Name\tDescription\t"))
    cells = F.arrays_zip(F.array(*map(F.lit, header[2:])).alias("sample"), F.slice(parts, 3, len(header) - 2).alias("value"))
    long = rows.select(F.get(parts, F.lit(0)).alias("name"), F.get(parts, F.lit(1)).alias("description"), F.explode(cells).alias("c"))
    return long.select("name", "description", F.col("c.sample").alias("sample"), F.col("c.value").try_cast("double").alias("value"))


def gmt(spark: SparkSession, path: str) -> DataFrame:
    """(name, url, member) of gene sets."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).where(F.size(parts) > 2)
    return rows.select(F.get(parts, F.lit(0)).alias("name"), F.get(parts, F.lit(1)).alias("url"), F.explode(F.filter(F.slice(parts, F.lit(3), F.size(parts)), lambda x: x != "")).alias("member"))


def wikipathways(sets: DataFrame) -> DataFrame:
    """(pathway, id, member) of gene sets named ``title%source%WPn%Homo sapiens``, with numeric members only."""
    name = r"^(.*?)%.*?(WP\d+)%Homo sapiens"
    return sets.where(F.col("name").rlike(name) & F.col("member").rlike(r"^\d+$")).select(F.regexp_extract("name", name, 1).alias("pathway"), F.regexp_extract("name", name, 2).alias("id"), "member")


# fixed values: the columns of a gene annotation file
GAF = ["db", "object_id", "symbol", "qualifier", "term", "reference", "evidence", "with_from", "aspect", "name", "synonym", "type", "taxon", "date", "assigned_by", "extension", "product"]


def gaf(spark: SparkSession, path: str) -> DataFrame:
    return delimited(spark, path, GAF, comment="!")


def stanzas(spark: SparkSession, path: str, kind: str = "Term") -> DataFrame:
    """(id, tag, values) of an ontology's stanzas; a tag may repeat."""
    raw = spark.read.option("lineSep", "\n[").text(path).where(F.regexp_replace("value", r"^\[", "").startswith(f"{kind}]"))
    lines = F.filter(F.split("value", "\n"), lambda x: x.contains(": "))
    pairs = F.transform(lines, lambda x: F.struct(F.substring_index(x, ": ", 1).alias("tag"), F.regexp_replace(x, r"^[^:]*(?::(?! )[^:]*)*: ", "").alias("value")))
    rows = raw.select(pairs.alias("pairs")).withColumn("id", F.try_element_at(F.filter("pairs", lambda p: p["tag"] == "id"), F.lit(1))["value"])
    tags = F.array_distinct(F.transform("pairs", lambda p: p["tag"]))
    return rows.select("id", F.explode(tags).alias("tag"), "pairs").select("id", "tag", F.transform(F.filter("pairs", lambda p: p["tag"] == F.col("tag")), lambda p: p["value"]).alias("values"))


def ontology_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, label, deprecated) and is_a edges (child, parent) between nodes that stay: classes that are not deprecated."""
    schema = "graphs array<struct<nodes array<struct<id string, lbl string, type string, meta struct<deprecated boolean>>>, edges array<struct<sub string, pred string, obj string>>>>"
    doc = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("graphs").alias("g"))
    nodes = doc.select(F.inline("g.nodes")).where("type = 'CLASS' AND NOT coalesce(meta.deprecated, false)").select("id", F.col("lbl").alias("label"))
    edges = doc.select(F.inline("g.edges")).where("pred = 'is_a'").select(F.col("sub").alias("child"), F.col("obj").alias("parent"))
    keep = nodes.select("id")
    edges = edges.join(keep.withColumnRenamed("id", "child"), "child", "left_semi").join(keep.withColumnRenamed("id", "parent"), "parent", "left_semi")
    return nodes, edges.select("child", "parent")


def json_records(spark: SparkSession, path: str, schema: str | None = None, lines: bool = True) -> DataFrame:
    reader = spark.read.option("multiLine", not lines)
    return (reader.schema(schema) if schema else reader).json(path)


def xml_records(spark: SparkSession, path: str, tag: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", tag)
    return (reader.schema(schema) if schema else reader).load(path)


def sdf(spark: SparkSession, path: str) -> DataFrame:
    """(record, properties) of a structure file: the tagged values of each record as a map."""
    raw = spark.read.option("lineSep", "$$$$\n").text(path).where(F.trim("value") != "")
    pattern = r">\s*<([^>]+)>[^\n]*\n([^\n]*)"
    names, values = (F.regexp_extract_all("value", F.lit(pattern), F.lit(k)) for k in (1, 2))
    entries = F.arrays_zip(names.alias("k"), values.alias("v"))
    seen = F.array_distinct(names)
    pick = F.transform(seen, lambda n: F.struct(n, F.element_at(F.filter(entries, lambda e: e["k"] == n), 1)["v"]))
    return raw.select(F.trim(F.substring_index(F.ltrim("value"), "\n", 1)).alias("record"), F.map_from_entries(pick).alias("properties"))


def flat_records(spark: SparkSession, path: str, first: str = "ID") -> DataFrame:
    """(id, code, values) of records of two-letter lines that end in ``//``."""
    raw = spark.read.option("lineSep", "//\n").text(path).where(F.col("value").rlike(rf"(?m)^{first}   "))
    codes, values = (F.regexp_extract_all("value", F.lit(r"(?m)^([A-Z]{2})   (.*)$"), F.lit(k)) for k in (1, 2))
    entries = F.arrays_zip(codes.alias("k"), values.alias("v"))
    rows = raw.select(entries.alias("e"), F.trim(F.regexp_extract("value", rf"(?m)^{first}   (.*)$", 1)).alias("id"))
    return rows.select("id", F.explode(F.array_distinct(F.transform("e", lambda x: x["k"]))).alias("code"), "e").select("id", "code", F.transform(F.filter("e", lambda x: x["k"] == F.col("code")), lambda x: x["v"]).alias("values"))


def gff(spark: SparkSession, path: str) -> DataFrame:
    """Features with their attributes as a map."""
    fields = ["seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes"]
    df = delimited(spark, path, fields, comment="#")
    return df.withColumns({"attributes": F.str_to_map("attributes", F.lit(";"), F.lit("=")), "start": F.col("start").try_cast("long"), "end": F.col("end").try_cast("long")})


def triples(spark: SparkSession, path: str) -> DataFrame:
    """(s, p, o) of N-Triples lines."""
    pattern = r"^(\S+)\s+(\S+)\s+(.+?)\s*\.\s*$"
    rows = spark.read.text(path).where(F.col("value").rlike(pattern))
    clean = lambda k: F.regexp_replace(F.regexp_extract("value", pattern, k), r'^[<"]|[>"]$', "")
    return rows.select(clean(1).alias("s"), clean(2).alias("p"), clean(3).alias("o"))


def database(spark: SparkSession, url: str, table: str, partition: str | None = None, low: int = 0, high: int = 0, parts: int = 1, **options: str) -> DataFrame:
    """A table over JDBC, read in ranges of a numeric column."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition:
        reader = reader.options(partitionColumn=partition, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    return reader.load()


def workbook(spark: SparkSession, path: str, sheet: str, renames: dict[str, str] | None = None) -> DataFrame:
    """One sheet of a workbook, all strings. Workbooks are small files filled in by hand; pandas reads them where it can."""
    frame = pd.read_excel(path, sheet_name=sheet, dtype=str).rename(columns=renames or {})
    return spark.createDataFrame(frame.astype(object).where(frame.notna(), None), T.StructType([T.StructField(str(c), T.StringType()) for c in frame.columns]))


def kept_rows(df: DataFrame, condition: Column, most: int | None) -> DataFrame:
    """A development cap: it counts the rows that pass the filter."""
    kept = df.where(condition)
    return kept.limit(most) if most is not None else kept


def rdf_xml(spark: SparkSession, path: str, tag: str = "rdf:Description") -> DataFrame:
    """(s, p, o, is_iri) of RDF/XML node elements: attributes that point elsewhere are IRIs, element texts are literals."""
    raw = spark.read.option("lineSep", f"</{tag}>").text(path)
    subject = F.regexp_extract("value", rf'(?s)<{tag}[^>]*rdf:about="([^"]*)"', 1)
    body = F.regexp_replace("value", rf"(?s)^.*?<{tag}[^>]*>", "")
    links = r'<([A-Za-z_][\w.-]*:[\w.-]+)\s[^>]*rdf:resource="([^"]*)"'
    texts = r"(?s)<([A-Za-z_][\w.-]*:[\w.-]+)(?:\s[^>]*[^/])?>([^<]+)</"
    pairs = lambda p, iri: F.transform(F.arrays_zip(F.regexp_extract_all(body, F.lit(p), F.lit(1)).alias("p"), F.regexp_extract_all(body, F.lit(p), F.lit(2)).alias("o")), lambda x: F.struct(x["p"].alias("p"), plain_xml(x["o"]).alias("o"), F.lit(iri).alias("is_iri")))
    every = F.concat(pairs(links, True), F.filter(pairs(texts, False), lambda x: x["o"] != ""))
    return raw.select(subject.alias("s"), F.explode(every).alias("x")).where("s <> ''").select("s", "x.*")


def plain_xml(value: Column) -> Column:
    out = F.trim(value)
    for shown, raw in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(shown), F.lit(raw))
    return out


def soft(spark: SparkSession, path: str, kind: str = "SAMPLE") -> DataFrame:
    """(id, key, values) of the records of one kind of a SOFT family file: ``^SAMPLE = id`` and its ``!Sample_key = value`` lines."""
    raw = spark.read.option("lineSep", "\n^").text(path).select(F.regexp_replace("value", r"^\^", "").alias("value")).where(F.col("value").startswith(f"{kind} ="))
    lines = F.filter(F.split("value", r"\r?\n"), lambda x: x.startswith("!") & x.contains("="))
    cut = lambda x, k: F.trim(F.regexp_extract(x, r"^!([^=]*)=(.*)$", k))
    pairs = F.transform(lines, lambda x: F.struct(F.regexp_replace(cut(x, 1), rf"(?i)^{kind}_", "").alias("key"), cut(x, 2).alias("value")))
    rows = raw.select(F.trim(F.regexp_extract("value", r"^[^=]*=([^\r\n]*)", 1)).alias("id"), pairs.alias("pairs"))
    tags = rows.select("id", F.explode(F.array_distinct(F.transform("pairs", lambda p: p["key"]))).alias("key"), "pairs")
    return tags.select("id", "key", F.transform(F.filter("pairs", lambda p: p["key"] == F.col("key")), lambda p: p["value"]).alias("values"))


def isa_investigation(spark: SparkSession, path: str) -> DataFrame:
    """(field, position, value) of an investigation file: ``Field <tab> value <tab> value``. Its study and assay files are
    delimited tables."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).where(F.size(parts) > 1)
    items = rows.select(F.trim(F.get(parts, F.lit(0))).alias("field"), F.posexplode(F.slice(parts, F.lit(2), F.size(parts))).alias("position", "value"))
    return items.select("field", "position", F.regexp_replace(F.trim("value"), '^"|"$', "").alias("value")).where("value <> ''")


def paged(spark: SparkSession, fetch, pages: int, schema: str, tasks: int = 8) -> DataFrame:
    """The records of a paged service: ``fetch(page)`` gives a page's records as dicts; tasks fetch pages side by side."""
    names = [f.name for f in spark.createDataFrame([], schema).schema.fields]

    def run(batches):
        for frame in batches:
            for page in frame["id"].tolist():
                rows = fetch(page)
                if rows:
                    yield pd.DataFrame([{n: r.get(n) for n in names} for r in rows], columns=names)

    return spark.range(0, pages, 1, max(1, min(tasks, pages))).mapInPandas(run, schema)


def renamed(sheet: DataFrame, mapping: dict[str, str], aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """A sheet's columns under the names of a map sheet (name -> column); names that it does not map take the first of their
    aliases that the sheet has, and are null without one."""
    by_low = {c.lower(): c for c in sheet.columns}
    blank = lambda v: v is None or v.strip() in ("", "NA", "N/A")
    out = []
    for name, column in mapping.items():
        found = None if blank(column) else by_low.get(column.strip().lower())
        found = found or next((by_low[a.lower()] for a in (aliases or {}).get(name, []) if a.lower() in by_low), None)
        out.append((F.col(f"`{found}`") if found else F.lit(None).cast("string")).alias(name))
    return sheet.select(*out)


def named_sets(sets: DataFrame, excluded: tuple[str, ...] = (), prefixes: tuple[str, ...] = ()) -> DataFrame:
    """(id, source_id, name, source, url, member) of gene sets whose second field says ``name: ...; datasource: ...``."""
    said = lambda what: F.trim(F.regexp_extract("url", rf"{what}: ([^;]+)", 1))
    raw, clean = F.trim("name"), F.trim("name")
    for p in reversed(prefixes):
        clean = F.when(raw.startswith(p), F.substring(raw, len(p) + 1, 10_000)).otherwise(clean)
    out = sets.select(clean.alias("id"), F.substring_index(clean, ":", -1).alias("source_id"), said("name").alias("set_name"), said("datasource").alias("source"), F.when(raw.startswith("http"), raw).alias("url"), F.trim("member").alias("member"))
    return out.where((F.col("set_name") != "") & (F.col("source") != "") & ~F.col("source").isin(*excluded, "")).withColumnRenamed("set_name", "name")


def titled_sets(sets: DataFrame, prefix: str) -> DataFrame:
    """(name, id, member) of gene sets whose first field is a title and whose second is an id with a known prefix."""
    return sets.where(F.col("url").startswith(prefix)).select("name", F.col("url").alias("id"), F.trim("member").alias("member"))
