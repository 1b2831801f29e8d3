"""Identifier resolution: match tables, policies for no match and several matches, fan-out and union of aliases."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKIP, ALLOW, ERROR = "Skip", "Allow", "Error"
FIRST, ALL = "First", "All"


def best_matches(ids: DataFrame, matches: DataFrame) -> DataFrame:
    """Matches (input, match, priority) of ``ids`` (id) with the best priority, all ties."""
    rows = ids.select("id").distinct().join(matches, F.col("id") == F.col("input"))
    return rows.withColumn("_r", F.rank().over(Window.partitionBy("id").orderBy("priority"))).where("_r = 1").drop("_r", "input")


def resolve(nodes: DataFrame, matches: DataFrame, no_match: str = ALLOW, many: str = ALL) -> DataFrame:
    """``nodes`` (id, ...) under the ids that ``matches`` (input, match, priority) gives them.

    ``old_id`` is the id before; several matches make clones (or the first one stays); ``xref`` of every clone is the
    union of the old id and all its matches; unmatched nodes stay marked, go, or raise, by policy.
    """
    per = best_matches(nodes, matches).groupBy("id").agg(F.array_sort(F.collect_set("match")).alias("found"))
    rows = nodes.join(per, "id", "left" if no_match != SKIP else "inner")
    miss = F.col("found").isNull()
    if no_match == ERROR:
        rows = rows.withColumn("found", F.when(miss, F.raise_error(F.concat(F.lit("no match for "), F.col("id")))).otherwise(F.col("found")))
    if many == ERROR:
        rows = rows.withColumn("found", F.when(F.size("found") > 1, F.raise_error(F.concat(F.lit("several matches for "), F.col("id")))).otherwise(F.col("found")))
    found = F.coalesce(F.slice("found", 1, 1) if many == FIRST else F.col("found"), F.array("id"))
    rows = rows.withColumn("xref", F.array_sort(F.array_union(F.array("id"), F.coalesce("found", F.array().cast("array<string>"))))).withColumn("resolver_miss", miss)
    return rows.select(F.explode(found).alias("new_id"), *[F.col(c) for c in rows.columns if c != "found"]).withColumnRenamed("id", "old_id").withColumnRenamed("new_id", "id")


def resolve_edges(edges: DataFrame, starts: DataFrame, ends: DataFrame) -> DataFrame:
    """Edges (start_id, end_id, ...) between resolved ids: every match of one end with every match of the other.

    ``starts`` and ``ends`` are (input, match); edges with an unmatched end go.
    """
    s, e = starts.select(F.col("input").alias("start_id"), F.col("match").alias("_s")), ends.select(F.col("input").alias("end_id"), F.col("match").alias("_e"))
    rest = [c for c in edges.columns if c not in ("start_id", "end_id")]
    return edges.join(s, "start_id").join(e, "end_id").select(F.col("_s").alias("start_id"), F.col("_e").alias("end_id"), F.col("start_id").alias("old_start_id"), F.col("end_id").alias("old_end_id"), *rest)


def unambiguous(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with one value only."""
    return pairs.groupBy(key).agg(F.countDistinct(value).alias("_n"), F.min(value).alias(value)).where("_n = 1").drop("_n")


def cascade(left: DataFrame, right: DataFrame, keys: list[str], right_id: str, tag: str = "match_source", append: bool = False) -> DataFrame:
    """Match on the first key; what is left on the next; and so on. Unmatched rows of ``left`` stay, tagged ``none``; with
    ``append``, so do unmatched rows of ``right``, tagged ``right``."""
    out, rest = None, left
    for k in keys:
        lookup = unambiguous(right.where(F.col(k).isNotNull()).select(k, right_id), k, right_id)
        hit = rest.join(lookup, k).withColumn(tag, F.lit(k))
        rest = rest.join(lookup.select(k), k, "left_anti")
        out = hit if out is None else out.unionByName(hit)
    out = out.unionByName(rest.withColumn(right_id, F.lit(None).cast(right.schema[right_id].dataType)).withColumn(tag, F.lit("none")))
    if append:
        lost = right.select(right_id, *keys).distinct().join(out.select(F.col(right_id).alias("_hit")).where("_hit is not null").distinct(), F.col(right_id) == F.col("_hit"), "left_anti")
        out = out.unionByName(lost.withColumn(tag, F.lit("right")), allowMissingColumns=True)
    return out


def preferred_label(df: DataFrame, label: str, fallback: str, out: str = "preferred") -> DataFrame:
    """The label where it is filled and unique in the table, else the fallback."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    return df.join(counts, label, "left").withColumn(out, F.when((F.col("_n") == 1) & (F.trim(label) != ""), F.col(label)).otherwise(F.col(fallback))).drop("_n")


def match_any(inputs: DataFrame, documents: DataFrame, key: str, references: str) -> DataFrame:
    """(id, key) of ``inputs`` (id) that a document has as its own key or among its references: an equi-join on each."""
    every = documents.select(F.col(key), F.explode(F.array_distinct(F.array_append(F.coalesce(F.col(references), F.array().cast("array<string>")), F.col(key)))).alias("id"))
    return inputs.select("id").distinct().join(every, "id").select("id", key).distinct()


def alias_variants(alias: Column) -> Column:
    """The spellings under which a disease id is met: its prefix as it is, in upper and in lower case, in its usual form;
    numbers of the rare-disease registry with and without zeros in front."""
    prefix, local = F.trim(F.substring_index(alias, ":", 1)), F.trim(F.regexp_replace(alias, "^[^:]*:", ""))
    prefixes = F.array(prefix, F.upper(prefix), F.lower(prefix), F.when(F.lower(prefix) == "orphanet", "Orphanet"))
    plain = F.transform(F.array_compact(prefixes), lambda p: F.concat(p, F.lit(":"), local))
    number = local.try_cast("long")
    padded = F.array(*[F.concat(F.lit(f"{p}:"), n) for p in ("GARD", "gard") for n in (F.lpad(number.cast("string"), 7, "0"), number.cast("string"))])
    rare = (F.lower(prefix) == "gard") & local.rlike(r"^\d+$")
    every = F.concat(F.array(alias), plain, F.when(rare, padded).otherwise(F.array().cast("array<string>")))
    return F.when(alias.contains(":") & (prefix != "") & (local != ""), F.array_distinct(every)).otherwise(F.array(alias))


def disease_matches(rows: DataFrame, standard: str, normalised: str, references: list[str]) -> DataFrame:
    """(input, match, priority) of a table of diseases: own ids before normalised ones before cross references, in all
    spellings; lists are delimited by ``|``, ``;`` or ``,``."""
    items = lambda c: F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), r"[|;,]"), lambda x: F.trim(x)), lambda x: x != "")
    tagged = lambda aliases, priority: F.transform(F.flatten(F.transform(aliases, alias_variants)), lambda a: F.struct(a.alias("input"), F.lit(priority).alias("priority")))
    own = F.trim(standard)
    every = F.concat(tagged(F.array(own), 0), tagged(items(normalised), 1), tagged(F.flatten(F.array(*map(items, references))), 2))
    return rows.where(F.coalesce(own, F.lit("")) != "").select(own.alias("match"), F.inline(every)).select("input", "match", "priority").distinct()


def reference_map(terms: DataFrame, ontologies: list[str]) -> DataFrame:
    """(input, match) of the cross references of terms (id, xref array): trailing text cut off, prefixes in lower case,
    allowed ontologies only; a reference of several terms goes to the last of them, and terms stand for themselves."""
    raw = terms.select("id", F.explode("xref").alias("x")).select("id", F.substring_index(F.trim("x"), " ", 1).alias("x")).where(F.col("x").contains(":"))
    prefix, local = F.lower(F.substring_index("x", ":", 1)), F.regexp_replace("x", "^[^:]*:", "")
    allowed = raw.select("id", prefix.alias("p"), local.alias("l")).where(F.col("p").isin([o.lower() for o in ontologies]) & (F.col("l") != ""))
    own = terms.select(F.col("id").alias("input"), F.col("id").alias("match"))
    return allowed.groupBy(F.concat("p", F.lit(":"), "l").alias("input")).agg(F.max("id").alias("match")).unionByName(own).distinct()


def roll_up_aliases(proteins: DataFrame, transcripts: DataFrame, genes: DataFrame) -> DataFrame:
    """(input, match, kind): everything that names a protein, also through its transcripts and their genes, and its own genes.

    proteins: (id, canonical, aliases, transcripts, genes), canonical the id that stands for its isoforms (its own, or
    null to leave it out); transcripts: (id, aliases, genes); genes: (id, aliases). Aliases of transcripts and genes hold
    their own ids.
    """
    base = proteins.where("canonical is not null")
    exact = base.select(F.col("id").alias("input"), F.col("canonical").alias("match"), F.when(F.col("id") == F.col("canonical"), "exact").otherwise("isoform").alias("kind"))
    named = lambda df, kind: df.select(F.explode("aliases").alias("input"), F.col("match"), F.lit(kind).alias("kind"))
    own = named(base.withColumn("match", F.col("canonical")), "alias")
    by_alias = lambda df, *more: df.select(F.explode("aliases").alias("alias"), F.col("aliases"), *more)
    to_transcript = base.select(F.col("canonical").alias("match"), F.explode("transcripts").alias("alias")).distinct().join(by_alias(transcripts, "genes"), "alias")
    to_gene = base.select(F.col("canonical").alias("match"), F.explode("genes").alias("alias")).union(to_transcript.select("match", F.explode("genes").alias("alias"))).distinct()
    return exact.union(own).union(named(to_transcript, "transcript")).union(named(to_gene.join(by_alias(genes), "alias"), "gene")).distinct()


def allow_list(matches: DataFrame, allowed: DataFrame, column: str = "id") -> DataFrame:
    """Matches (input, match, ...) whose match is on the list."""
    return matches.join(allowed.select(F.col(column).alias("match")).distinct(), "match", "left_semi")


def retype(nodes: DataFrame, fields: list[str], kind: str, free: tuple[str, ...] = ("id", "xref", "provenance", "sources")) -> DataFrame:
    """``nodes`` with ``kind`` as their type and its ``fields`` only, where no other field is filled; else as they are.

    A field is filled if it is neither null, nor blank, nor an empty list.
    """

    def filled(f):
        c = F.col(f.name)
        return F.coalesce(F.size(c) > 0, F.lit(False)) if isinstance(f.dataType, T.ArrayType) else c.isNotNull() & (F.trim(c.cast("string")) != "")

    others = [f for f in nodes.schema.fields if f.name not in {*fields, *free, "type"}]
    ok = ~functools.reduce(lambda a, b: a | b, map(filled, others), F.lit(False))
    return nodes.withColumn("type", F.when(ok, F.lit(kind)).otherwise(F.col("type")))


# fixed values: edges from genes that become edges from proteins when their start resolves to one, by the type of their end
PROTEIN_EDGES = {
    ("GeneTissueExpressionEdge", "Tissue"): "ProteinTissueExpressionEdge",
    ("GeneDiseaseEdge", "Disease"): "ProteinDiseaseEdge",
    ("GenePathwayEdge", "Pathway"): "ProteinPathwayEdge",
    ("GeneOrthologGeneEdge", "OrthologGene"): "ProteinOrthologGeneEdge",
    ("GeneMousePhenotypeEdge", "MousePhenotype"): "ProteinMousePhenotypeEdge",
    ("GeneGwasTraitEdge", "GwasTrait"): "ProteinGwasTraitEdge",
}


def canonical_edge(kind: Column, start_type: Column, end_type: Column) -> Column:
    """An edge's class after its ends are resolved."""
    out = kind
    for (edge, end), name in PROTEIN_EDGES.items():
        out = F.when((kind == edge) & (start_type == "Protein") & (end_type == end), name).otherwise(out)
    return out


def reconcile_lists(main: DataFrame, orphans: DataFrame, key: str, listed: str, own: str, fold: list[str]) -> tuple[DataFrame, DataFrame]:
    """``main`` with what orphans bring to it, and the orphans left.

    An orphan whose ``own`` id stands in a row's delimited ``listed`` folds its ``fold`` columns into the first such row
    (by ``key``): filled values stay, missing ones are taken from the first orphan (by ``own``).
    """
    tokens = main.select(key, F.explode(F.transform(F.split(listed, r"\|"), lambda x: F.trim(x))).alias(own)).where(F.col(own) != "")
    home = tokens.groupBy(own).agg(F.min(key).alias(key))
    found = orphans.join(home, own)
    brought = found.groupBy(key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(own))).alias(f"_{c}") for c in fold])
    joined = main.join(brought, key, "left")
    return joined.select(*[F.coalesce(c, f"_{c}").alias(c) if c in fold else F.col(c) for c in main.columns]), orphans.join(home, own, "left_anti")


def fill_shared(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows without a value take the one that the others of their key share, marked ``filled``; others that differ raise."""
    known = df.where(F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    one = F.when(F.col("_low") == F.col("_high"), F.col("_low")).when(F.col("_low").isNotNull(), F.raise_error(F.concat(F.lit(f"{value} differs for "), F.col(key).cast("string"))))
    rows = df.join(known, key, "left").withColumn("_one", one)
    return rows.select(*[F.coalesce(value, "_one").alias(value) if c == value else F.col(c) for c in df.columns], (F.col(value).isNull() & F.col("_one").isNotNull()).alias("filled"))
