"""Groups of equivalent identifiers: which evidence keeps an edge alive, which structures join groups, and how groups look.

An edge is (start_id, end_id, details) with details as array<struct<source, source_field>>; a structure is (id, source,
smiles, formula, inchi, inchi_key, mass).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.operators.graph import connected_components

# fixed values: a residue in a formula, SMILES or InChI; the shapes of structure keys
RESIDUE = r"(?<![A-Za-z])R\d*(?![a-z])"
KEY_PREFIX = r"^([A-Z]{14})(?:-.*)?$"
KEY_DUPLEX = r"^([A-Z]{14}-[A-Z]{10})(?:-.*)?$"
MASS_CUTOFF = 500.0


def is_generic(smiles: Column, formula: Column, inchi: Column) -> Column:
    """Some description holds a wildcard or a residue; a star in an InChI counts atoms and says nothing."""
    one = lambda c, star: c.isNotNull() & ((c.contains("*") if star else F.lit(False)) | c.contains("[R") | c.contains("(R)") | c.rlike(RESIDUE))
    return F.coalesce(one(smiles, True), F.lit(False)) | F.coalesce(one(formula, True), F.lit(False)) | F.coalesce(one(inchi, False), F.lit(False))


def key_prefix(key: Column) -> Column:
    """The first block of a structure key: the skeleton, without stereo chemistry; null if the key has another shape."""
    found = F.regexp_extract(F.upper(F.trim(key)), KEY_PREFIX, 1)
    return F.when(found != "", found)


def key_duplex(key: Column) -> Column:
    """The first two blocks; null if the key has another shape."""
    found = F.regexp_extract(F.upper(F.trim(key)), KEY_DUPLEX, 1)
    return F.when(found != "", found)


@dataclass
class Rules:
    """What removes evidence and what joins groups. prefixes: source -> prefixes of ids that it is not believed about;
    fields: source -> fields of its that are not believed; merge: "prefix", "duplex" or "mass"."""

    generic_mismatch: bool = False
    denied: DataFrame | None = None
    prefixes: dict[str, list[str]] = field(default_factory=dict)
    fields: dict[str, list[str]] = field(default_factory=dict)
    merge: str | None = None
    cutoff: float = MASS_CUTOFF


def surviving_edges(edges: DataFrame, active: DataFrame, structures: DataFrame, rules: Rules) -> DataFrame:
    """Edges between ``active`` (id) ids with the details that the rules leave, and their sources; an edge that had
    details and loses all of them goes."""
    live = edges
    for end in ("start_id", "end_id"):
        live = live.join(active.select(F.col("id").alias(end)).distinct(), end, "left_semi")
    if rules.generic_mismatch:
        generic = structures.where(is_generic(F.col("smiles"), F.col("formula"), F.col("inchi"))).select("id").distinct()
        for end, flag in (("start_id", "_gs"), ("end_id", "_ge")):
            live = live.join(generic.select(F.col("id").alias(end), F.lit(True).alias(flag)), end, "left")
        live = live.where(F.coalesce("_gs", F.lit(False)) == F.coalesce("_ge", F.lit(False))).drop("_gs", "_ge")
    if rules.denied is not None:
        pairs = rules.denied.select(F.least("left", "right").alias("_l"), F.greatest("left", "right").alias("_r")).distinct()
        live = live.join(pairs, (F.least("start_id", "end_id") == F.col("_l")) & (F.greatest("start_id", "end_id") == F.col("_r")), "left_anti")
    gone = lambda d: F.lit(False)
    for source, prefixes in rules.prefixes.items():
        low = [p.lower() for p in prefixes]
        touched = F.lower(F.substring_index("start_id", ":", 1)).isin(low) | F.lower(F.substring_index("end_id", ":", 1)).isin(low)
        gone = lambda d, before=gone, s=source, t=touched: before(d) | (t & (F.lower(d["source"]) == s))
    for source, names in rules.fields.items():
        gone = lambda d, before=gone, s=source, n=names: before(d) | ((F.lower(d["source"]) == s) & d["source_field"].isin(n))
    kept = F.filter("details", lambda d: ~F.coalesce(gone(d), F.lit(False)))
    live = live.withColumn("_kept", kept).where((F.coalesce(F.size("details"), F.lit(0)) <= 0) | (F.size("_kept") > 0))
    named = F.array_sort(F.array_distinct(F.filter(F.transform("_kept", lambda d: F.trim(d["source"])), lambda s: s.isNotNull() & (s != ""))))
    return live.withColumns({"details": F.col("_kept"), "sources": named}).drop("_kept")


def structure_links(structures: DataFrame, active: DataFrame, rules: Rules) -> DataFrame:
    """(src, dst): each id to the least id that has the same structure key. By mass: the skeleton from the cut-off on, the
    duplex below it or without a mass (the least one known counts)."""
    live = structures.join(active.select("id").distinct(), "id", "left_semi")
    mass = live.groupBy("id").agg(F.min("mass").alias("_m"))
    prefix, duplex = key_prefix(F.col("inchi_key")), key_duplex(F.col("inchi_key"))
    if rules.merge == "mass":
        live = live.join(mass, "id")
        key = F.when(F.coalesce(F.col("_m") >= rules.cutoff, F.lit(False)), F.concat(F.lit("prefix:"), prefix)).otherwise(F.concat(F.lit("duplex:"), duplex))
    else:
        key = F.concat(F.lit(f"{rules.merge}:"), prefix if rules.merge == "prefix" else duplex)
    keyed = live.select("id", key.alias("key")).where("key is not null").distinct()
    return keyed.join(keyed.groupBy("key").agg(F.min("id").alias("dst")), "key").where("id <> dst").select(F.col("id").alias("src"), "dst").distinct()


def groups(spark: SparkSession, active: DataFrame, edges: DataFrame, structures: DataFrame, rules: Rules) -> DataFrame:
    """(id, component) of all active ids and all ends of surviving edges, joined by edges and, by rule, by structures."""
    every = active.select("id").union(edges.select("start_id")).union(edges.select("end_id")).distinct()
    links = edges.select(F.col("start_id").alias("src"), F.col("end_id").alias("dst"))
    if rules.merge:
        links = links.union(structure_links(structures, every, rules))
    return connected_components(spark, links.union(every.select(F.col("id").alias("src"), F.col("id").alias("dst")))).withColumnRenamed("node", "id")


def ranked(members: DataFrame) -> DataFrame:
    """(component, size, first, digest, rank) of groups of two or more: largest first, then by first member; the digest is
    SHA-1 over the sorted members. Components are named by one of their members, so sorting them needs no member lists."""
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("first"), F.sha1(F.array_join(F.array_sort(F.collect_list("id")), "|")).alias("digest")).where("size > 1")
    return sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("size"), "first")))


def denied_still_joined(members: DataFrame, denied: DataFrame) -> DataFrame:
    """(left, right, component) of denied pairs whose ends are in one group all the same."""
    a, b = members.select(F.col("id").alias("left"), "component"), members.select(F.col("id").alias("right"), "component")
    pairs = denied.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right")).distinct()
    return pairs.join(a, "left").join(b, ["right", "component"]).select("left", "right", "component")


def stage_summary(members: DataFrame, edges: DataFrame, largest: int = 10) -> DataFrame:
    """One row: active ids and edges, groups of two or more, singletons, all groups, and the largest sizes."""
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    top = sizes.where("n > 1").orderBy(F.desc("n")).limit(largest).agg(F.sort_array(F.collect_list("n"), asc=False).alias("largest"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("active_ids"), F.count_if(F.col("n") > 1).alias("non_singletons"), F.count_if(F.col("n") == 1).alias("singletons"), F.count(F.lit(1)).alias("cliques"))
    one = F.lit(1).alias("_one")
    return total.select("*", one).join(edges.agg(F.count(F.lit(1)).alias("active_edges")).select("*", one), "_one").join(top.select("*", one), "_one").drop("_one")


def mass_warnings(members: DataFrame, structures: DataFrame, limit: float = 0.10, most: int = 50) -> DataFrame:
    """(component, size, low, high, spread) of the groups whose masses lie further apart than ``limit``: widest first."""
    low = members.join(structures.where("mass is not null").select("id", "mass"), "id").groupBy("component").agg(F.min("mass").alias("low"), F.max("mass").alias("high"))
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    out = low.where("low > 0").withColumn("spread", (F.col("high") - F.col("low")) / F.col("low")).where(F.col("spread") > limit).join(sizes, "component")
    return out.select("component", "size", "low", "high", "spread").orderBy(F.desc("spread"), F.desc("size"), "component").limit(most)
