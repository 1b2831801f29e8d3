"""Rule cascades: development tiers, category cut-offs, agreement of sources, mapping quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: cut-offs of an activity by family; other families have the last one
CUTOFFS = {"Kinase": 7.52288, "Ion Channel": 5.0, "GPCR": 7.0}
OTHER_CUTOFF = 6.0
TIER_CODES = {"Tclin": 4, "Tchem": 3, "Tbio": 2, "Tdark": 1}


def tier(drugs: Column, ligands: Column, terms: Column, papers: Column, notes: Column, antibodies: Column) -> Column:
    """Tclin with a drug, Tchem with a ligand, Tbio with a term; else Tdark with two dark points of three, else Tbio.

    Dark points: fewer than 5 papers, 3 notes or fewer, 50 antibodies or fewer; what is missing counts as dark.
    """
    zero = lambda c: F.coalesce(c, F.lit(0))
    dark = (zero(papers) < 5).cast("int") + (zero(notes) <= 3).cast("int") + (zero(antibodies) <= 50).cast("int")
    return F.when(zero(drugs) > 0, "Tclin").when(zero(ligands) > 0, "Tchem").when(zero(terms) > 0, "Tbio").when(dark >= 2, "Tdark").otherwise("Tbio")


def cutoff(family: Column) -> Column:
    out = F.lit(OTHER_CUTOFF)
    for name, value in CUTOFFS.items():
        out = F.when(family == name, value).otherwise(out)
    return out


def meets_cutoff(family: Column, values: Column) -> Column:
    """Some value reaches the family's cut-off; no values: false."""
    return F.coalesce(F.exists(values, lambda v: v >= cutoff(family)), F.lit(False))


def agreement(sets: list[Column], subset: bool = True) -> Column:
    """How sorted distinct lists of ids, one per source, agree: no_data, single, agree, subset, majority or conflict."""
    filled = F.filter(F.array(*sets), lambda s: s.isNotNull() & (F.size(s) > 0))
    n, union = F.size(filled), F.array_sort(F.array_distinct(F.flatten(filled)))
    largest = F.array_max(F.transform(filled, lambda s: F.size(s)))
    most = F.array_max(F.transform(filled, lambda s: F.size(F.filter(filled, lambda t: t == s))))
    out = F.when(n == 0, "no_data").when(n == 1, "single").when(F.size(F.array_distinct(filled)) == 1, "agree")
    out = out.when(F.size(union) == largest, "subset") if subset else out
    return out.when(most > n / 2, "majority").otherwise("conflict")


def quality(label: Column, n: Column) -> Column:
    return F.when(label == "no_data", 0).when(label == "conflict", -1).when(label == "single", 1).when(label.isin("majority", "subset"), 2).otherwise(F.least(n, F.lit(4)))


def cardinality(anchor: Column, others: Column) -> Column:
    a, b = F.coalesce(F.size(anchor), F.lit(0)), F.coalesce(F.size(others), F.lit(0))
    return F.when((a <= 0) | (b <= 0), "no_data").when((a == 1) & (b == 1), "1:1").when(a == 1, "1:n").when(b == 1, "n:1").otherwise("complex")


def resolver_score(lexical: Column, tier_score: Column, xref: Column, sources: Column, prior: Column, penalty: Column, key_field: Column) -> Column:
    """Weighted evidence of a candidate, between 0 and 1."""
    raw = 0.86 * lexical + 0.08 * F.greatest(tier_score, xref) + 0.04 * F.least(F.lit(1.0), 0.55 + 0.09 * sources) + 0.02 * prior - penalty + F.when((lexical >= 0.98) & key_field, 0.02).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))


def match_status(lexical: Column, score: Column) -> Column:
    return F.when((lexical >= 0.98) & (score >= 0.9), "exact").when(score >= 0.82, "probable").when(score >= 0.68, "possible").otherwise("weak")
