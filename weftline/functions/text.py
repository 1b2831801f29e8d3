"""Text helpers: normal forms, tokens, similarity, safe parsing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed value: tokens of an abstract
TOKEN = r"\b[A-Za-z]+[A-Za-z0-9\-\./\+]{1,}\b|\b[0-9]+[A-Za-z]+[0-9]+\b"
NOTHING = ("", "na", "n/a", "nan", "none", "null", "-")


def normalise(value: Column) -> Column:
    """Lower case, other characters than letters and digits as single blanks."""
    return F.trim(F.regexp_replace(F.lower(value), "[^a-z0-9]+", " "))


def slug(value: Column) -> Column:
    return F.regexp_replace(normalise(value), " ", "_")


def tokens(value: Column, pattern: str = TOKEN, longest: int = 128) -> Column:
    """The distinct lower-case tokens of a text."""
    return F.array_distinct(F.filter(F.transform(F.regexp_extract_all(value, F.lit(pattern), F.lit(0)), F.lower), lambda t: F.length(t) <= longest))


def split_list(value: Column, separator: str = r"\|") -> Column:
    """The non-blank, trimmed items of a delimited list; null if there is none."""
    items = F.filter(F.transform(F.split(value, separator), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(items) > 0, items)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def dice(a: Column, b: Column) -> Column:
    total = F.size(a) + F.size(b)
    return F.when(total > 0, 2 * F.size(F.array_intersect(a, b)) / total).otherwise(0.0)


def containment(a: Column, b: Column) -> Column:
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(0.0)


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity; Spark has no function for it."""
    from difflib import SequenceMatcher

    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def lexical_score(a: Column, b: Column) -> Column:
    """0 if empty, 1 if equal, else the best of ratio, 0.96 containment, 0.9 Jaccard and the substring score; 4 places."""
    x, y = normalise(a), normalise(b)
    tx, ty = F.array_distinct(F.split(x, " ")), F.array_distinct(F.split(y, " "))
    inside = F.when(x.contains(y) | y.contains(x), 0.82 + 0.12 * F.least(F.length(x), F.length(y)) / F.greatest(F.length(x), F.length(y))).otherwise(0.0)
    best = F.greatest(sequence_ratio(x, y), 0.96 * containment(tx, ty), 0.9 * jaccard(tx, ty), inside)
    return F.when(F.coalesce(x == "", F.lit(True)) | F.coalesce(y == "", F.lit(True)), 0.0).when(x == y, 1.0).otherwise(F.round(best, 4))


def present(value: Column) -> Column:
    """The trimmed value; null if it says that there is none."""
    trimmed = F.trim(value)
    return F.when(~F.lower(trimmed).isin(*NOTHING), trimmed)


def safe_double(value: Column) -> Column:
    return present(value).try_cast("double")


def safe_long(value: Column) -> Column:
    return present(value).try_cast("long")


def safe_bool(value: Column) -> Column:
    low = F.lower(present(value))
    return F.when(low.isin("true", "yes", "y", "1", "t"), True).when(low.isin("false", "no", "n", "0", "f"), False)


def any_date(value: Column, formats=("yyyy-MM-dd", "dd-MMM-yyyy", "MM/dd/yyyy", "yyyyMMdd")) -> Column:
    """The first format that fits."""
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(f)).cast("date") for f in formats])


def excel_date(value: Column) -> Column:
    """A day counted from 1899-12-30, as workbooks hold dates; null if it is no number."""
    return F.date_add(F.lit("1899-12-30").cast("date"), F.floor(value.try_cast("double")).cast("int"))


# fixed values: the months by their first three letters
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def publication_date(year: Column, month: Column, day: Column, free: Column) -> Column:
    """``yyyy``, ``yyyy-mm`` or ``yyyy-mm-dd`` of a publication's date; from free text its first year of four digits."""
    m = F.lower(F.left(F.trim(month), F.lit(3)))
    number = F.when(F.trim(month).rlike(r"^\d+$"), F.lpad(F.trim(month), 2, "0")).otherwise(F.coalesce(*[F.when(m == name, f"{k + 1:02}") for k, name in enumerate(MONTHS)]))
    d = F.when(F.trim(day).rlike(r"^\d+$"), F.lpad(F.trim(day), 2, "0"))
    whole = F.when(number.isNull(), F.trim(year)).when(d.isNull(), F.concat_ws("-", F.trim(year), number)).otherwise(F.concat_ws("-", F.trim(year), number, d))
    found = F.regexp_extract(F.trim(free), r"\b(\d{4})\b", 1)
    return F.when(F.trim(year).rlike(r"^\d+$"), whole).when(found != "", found)


def strip_html(value: Column) -> Column:
    return F.regexp_replace(value, "<[^>]+>", "")
