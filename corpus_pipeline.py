"""The corpus pipeline: language ID, near-duplicates, secrets, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. Stages
read nothing but their own input, and handle nulls, empty tables, repeated rows and further columns as the operators
they call state it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.core import fresh, join_by_shuffle, load, materialize, remove, scratch
from weftline.llm import language, mixing, packing, secrets, simhash

#: SQL has no softmax training, fingerprints or packing; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model does not reject. It learns from all labelled documents of its input."""
    (rejected,) = fresh(docs, "rejected")
    return language.identify(spark, docs, language.train(docs)).where(~F.col(rejected)).select(_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id (of rows alike in it, one).

    Near-duplicates have sets of five-word shingles with a similarity of 0.8 or more, or are linked over others that do.
    Components whose doc_ids are all null keep one row each as well. Rows are told apart by doc_id and a hash of the text.
    """
    marks = simhash.similar_components(spark, docs).where("doc_id <=> component_id").groupBy("component", "doc_id", "mark").agg(F.count(F.lit(1)).alias("_rows"))
    first = marks.groupBy("component").agg(F.min(F.struct("mark", F.col("doc_id").alias("_keep"), "_rows")).alias("_first"))
    firsts = materialize(spark, first.select("_first._keep", F.col("_first.mark").alias("_mark"), "_first._rows"), "firsts")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_keep")) & (F.xxhash64("text") == F.col("_mark"))
    kept = join_by_shuffle(docs, firsts.where("_rows = 1"), same, "left_semi")
    repeated = firsts.where("_rows > 1")
    if repeated.isEmpty():
        return kept
    # rows that share doc_id and text: one partial minimum each, so that no task gathers them
    rows = join_by_shuffle(docs, repeated, same, "left_semi").groupBy("doc_id", F.xxhash64("text")).agg(F.min_by(F.struct(*_columns(docs)), F.xxhash64("text")).alias("_row"))
    return kept.unionByName(rows.select("_row.*"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with a mark in place of each secret, and n_chars of the new text where it was that of the old one."""
    _, spans = fresh(docs, "base", "spans")
    found = secrets.scan_secrets(docs, secrets.train(secrets.labelled_samples(spark, docs)))
    clean = secrets.redact(F.col("text"), F.col(spans))
    columns = {"text": clean}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.size(spans) > 0, F.length(clean)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.withColumns(columns).select(_columns(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's repetition rate says."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their sequences and places."""
    return packing.pack_documents(spark, docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("source_mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage leaves behind is deleted when its result is written, and so is the result once the
    next one's is."""
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark) as made:
            docs = materialize(spark, stage(spark, docs, sf_dir), name)
            written = made[-1]
        if before:
            remove(spark, before)
        before = written
    return docs
