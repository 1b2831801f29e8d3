"""Names and provenance: the grammar of comparison columns, agreement of sources, scores of mappings, names of proteins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.text import dice, sequence_ratio

# fixed values: what the prefixes of comparison columns stand for; longer ones first
STATISTICS = {"ESadjPval": "adjusted_pvalue", "ESPval": "pvalue", "ES2": "effect_size_2", "ES": "effect_size"}
LEAST_RATIO, LEAST_DICE = 0.55, 0.60


def comparison(name: Column) -> Column:
    """struct<stat_type, group1, group2, comparison> of a column name such as ``ES_A_vs_B``."""
    kind, rest = F.lit(None).cast("string"), name
    for prefix, stat in reversed(STATISTICS.items()):
        kind = F.when(name.startswith(prefix), stat).otherwise(kind)
        rest = F.when(name.startswith(prefix), F.regexp_replace(F.substring(name, len(prefix) + 1, 10_000), "^_+", "")).otherwise(rest)
    rest = F.nullif(F.regexp_replace(rest, "_+", "_"), F.lit(""))
    parts = F.split(rest, "_[Vv][Ss]_", 2)
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    both = F.when(F.coalesce(first, F.lit("")).eqNullSafe("") | F.coalesce(second, F.lit("")).eqNullSafe(""), first).otherwise(F.concat(first, F.lit("_VS_"), second))
    return F.struct(kind.alias("stat_type"), first.alias("group1"), second.alias("group2"), both.alias("comparison"))


def _filled(values: dict[str, Column]) -> Column:
    return F.filter(F.array(*[F.struct(F.lit(s).alias("s"), F.trim(F.coalesce(c.cast("string"), F.lit(""))).alias("v")) for s, c in values.items()]), lambda x: x["v"] != "")


def provenance_equal(values: dict[str, Column]) -> Column:
    """The sources that have a value, if all have the same; ``error`` if not; null if none has one."""
    filled = _filled(values)
    return F.when(F.size(filled) == 0, None).when(F.size(F.array_distinct(F.transform(filled, lambda x: x["v"]))) == 1, F.array_join(F.transform(filled, lambda x: x["s"]), ", ")).otherwise("error")


def _ids(value: Column) -> Column:
    parts = F.filter(F.transform(F.split(value, r"\|"), lambda x: F.trim(x)), lambda p: (p != "") & (F.lower(p) != "nan"))
    return F.array_distinct(F.transform(parts, lambda p: F.regexp_replace(p, r"[-.]\d+$", "")))


def provenance_overlap(values: dict[str, Column]) -> Column:
    """The sorted sources that have ids, if any two share one (versions aside) or there is one source; else ``error``."""
    each = F.array(*[F.struct(F.lit(s).alias("s"), _ids(F.coalesce(c, F.lit(""))).alias("ids")) for s, c in sorted(values.items())])
    filled = F.filter(each, lambda x: F.size(x["ids"]) > 0)
    every = F.flatten(F.transform(filled, lambda x: x["ids"]))
    shared = F.size(F.array_distinct(every)) < F.size(every)
    return F.when(F.size(filled) == 0, None).when((F.size(filled) == 1) | shared, F.array_join(F.transform(filled, lambda x: x["s"]), ", ")).otherwise("error")


def provenance_score(provenance: Column, most: int) -> Column:
    """How many sources agree, ``most`` at most; none or ``error``: 0."""
    return F.when(provenance.isNull() | (provenance == "error"), 0).otherwise(F.least(F.size(F.split(provenance, ",")), F.lit(most)))


def filled_score(values: dict[str, Column]) -> Column:
    """How many sources have a value."""
    return F.size(_filled(values))


def combined_name(ensembl: Column, uniprot: Column, nodenorm: Column) -> Column:
    """struct<name, score, method> of three sources' names: the only one there is; the same one; the best by sequence; the
    best by words; or all of them."""
    own = [F.coalesce(c, F.lit("")) for c in (ensembl, uniprot, nodenorm)]
    filled = F.filter(F.array(*own), lambda x: x != "")
    tokens = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"\W+"), lambda x: x != ""))
    pairs = [("Ensembl-Uniprot", own[0], own[1]), ("Ensembl-NodeNorm", own[0], own[2]), ("Uniprot-NodeNorm", own[1], own[2])]
    struct = lambda name, score, method: F.struct(name.alias("name"), score.cast("double").alias("score"), method.alias("method"))

    def best(kind, score):
        each = [F.struct(F.when((a != "") & (b != ""), score(a, b)).otherwise(0.0).alias("score"), F.lit(-k).alias("k"), b.alias("name"), F.lit(f"{kind}-{m}").alias("method")) for k, (m, a, b) in enumerate(pairs)]
        return F.array_max(F.array(*each))

    fuzzy, words = best("Fuzzy", sequence_ratio), best("Token", lambda a, b: dice(tokens(a), tokens(b)))
    exact = F.coalesce(*[F.when((a != "") & (a == b), b) for _, a, b in pairs])
    out = F.when(F.size(filled) == 1, struct(F.get(filled, F.lit(0)), F.lit(0.0), F.lit("None"))).when(exact.isNotNull(), struct(exact, F.lit(1.0), F.lit("Exact")))
    out = out.when(fuzzy["score"] >= LEAST_RATIO, struct(fuzzy["name"], fuzzy["score"], fuzzy["method"])).when(words["score"] >= LEAST_DICE, struct(words["name"], words["score"], words["method"]))
    return out.otherwise(struct(F.array_join(filled, " | "), words["score"], F.lit("Token-Fallback")))
