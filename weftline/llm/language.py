"""Language identification: averaged hashed subword embeddings under a linear softmax.

Subwords are the 1- to 4-byte pieces of lower-cased words with their blanks, hashed into buckets. A text is the mean of
its pieces' embeddings; embeddings and softmax are trained by stochastic gradient descent in numpy. A temperature fitted
on labelled rows kept out of training makes the top probability a score, and texts whose score stays below a threshold
fitted on the same rows are rejected.

The classifier is fitted on at most ``FIT_ROWS`` labelled rows (or one row of each language, if there are more of them),
dealt evenly over the languages and chosen by a hash of doc_id and text. What a row costs there is bounded by the number
of buckets, however long its text; one task fits, and the driver sees weights only.

Defined results: texts that are null or without a letter are ``und`` with score 0, and rejected; rows with a null lang
teach nothing; a null doc_id counts as the empty string in its fold; with no labelled row everything is ``und``;
repeated rows are predicted alike, and teach once; further
columns pass through, also under the names of the results, which then get a ``_`` before them; an empty table gives no
rows.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.core import fresh, load, materialize

BUCKETS = 4096
ORDERS = (1, 2, 3, 4)
DIM = 16
FIT_ROWS = 6000
TOGETHER = 256  # texts scored by one matrix product
EPOCHS, BATCH, RATE = 12, 64, 0.3
CALIBRATION = 5  # every fifth fitted row
MOST_ERROR = 0.01
LEAST_SCORE = 0.5
STRETCH = 1 << 20
BLANKED = bytes(32 if c < 128 and not chr(c).isalpha() else c for c in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def subword_counts(text: str) -> np.ndarray:
    """How often each bucket's subwords occur in the whole text."""
    raw = np.frombuffer(b" " + b" ".join(text.lower().encode().translate(BLANKED).split()) + b" ", "u1")
    out = np.zeros(BUCKETS, "f8")
    for a in range(0, len(raw), STRETCH):
        part = raw[a : a + STRETCH + max(ORDERS) - 1].astype("u4")
        n = min(STRETCH, len(raw) - a)
        key = np.zeros(len(part), "u4")
        for order in range(1, max(ORDERS) + 1):
            key = (key[: len(part) - order + 1] if order > 1 else key) * np.uint32(257) + part[order - 1 :] + np.uint32(order)
            if order in ORDERS:
                out += np.bincount((key[:n] * np.uint32(2654435769)) >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
    return out


@dataclass
class Model:
    langs: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = LEAST_SCORE

    def logits(self, means: np.ndarray) -> np.ndarray:
        return means @ self.embeddings @ self.weights + self.bias

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        return softmax(self.logits(means) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(means: np.ndarray, langs: list[str], seed: int = 7) -> Model:
    """Train on rows of bucket means and their languages; every fifth row calibrates instead, if there are enough."""
    names = sorted(set(langs))
    labels = np.array([names.index(x) for x in langs])
    rng = np.random.default_rng(seed)
    model = Model(names, rng.normal(0, 0.5, (BUCKETS, DIM)), rng.normal(0, 0.5, (DIM, len(names))), np.zeros(len(names)))
    held = np.arange(len(labels)) % CALIBRATION == 0 if len(labels) >= 10 * CALIBRATION else np.zeros(len(labels), bool)
    train = np.flatnonzero(~held)
    scale = np.full(BUCKETS, 1e-8)  # running squares of the embeddings' gradients, by bucket
    for epoch in range(EPOCHS):
        rng.shuffle(train)
        for a in range(0, len(train), BATCH):
            rows = train[a : a + BATCH]
            x, hidden = means[rows], means[rows] @ model.embeddings
            g = softmax(hidden @ model.weights + model.bias)
            g[np.arange(len(rows)), labels[rows]] -= 1
            g /= len(rows)
            back = x.T @ (g @ model.weights.T)
            rate = RATE * (1 - epoch / EPOCHS) + 0.01
            scale += (back**2).mean(axis=1)
            model.weights -= rate * hidden.T @ g
            model.bias -= rate * g.sum(axis=0)
            model.embeddings -= rate * back / np.sqrt(scale)[:, None]
    if held.any():
        calibrate(model, means[held], labels[held])
    return model


def calibrate(model: Model, means: np.ndarray, labels: np.ndarray) -> None:
    """The temperature of least log loss, then the lowest threshold at which accepted rows err in 1 % at most."""
    logits, at = model.logits(means), np.arange(len(labels))
    loss = lambda t: -np.log(softmax(logits / t)[at, labels] + 1e-12).mean()
    model.temperature = min(np.geomspace(0.05, 20, 60).tolist(), key=loss)
    p = softmax(logits / model.temperature)
    score, wrong = p.max(axis=1), p.argmax(axis=1) != labels
    order = np.argsort(-score)
    errors = np.cumsum(wrong[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(errors <= MOST_ERROR)
    lowest = score[order][good[-1]] if len(good) and good[-1] < len(order) - 1 else (0.0 if len(good) else 1.0)
    model.threshold = float(min(max(LEAST_SCORE, lowest), 0.99))


def fold(doc_id: Column, parts: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


SAMPLE = "lang string, draw long, at binary, mean binary"


def sample(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """SAMPLE: the subwords of at most about ``fit_rows`` labelled rows, as many of each language as of any other, if it has them.

    Rows are drawn by a hash of doc_id and text, so which ones teach does not depend on how the table is dealt out. No
    language is left out: with more languages than ``fit_rows``, each gives one row. Repeated rows count once.
    """
    labelled = docs.select("lang", "text", F.pmod(F.xxhash64(F.lit("fit"), F.col("doc_id").cast("string"), "text"), F.lit(1 << 40)).alias("draw")).where("lang is not null and text is not null")
    sizes = materialize(docs.sparkSession, labelled.groupBy(F.col("lang").alias("_lang")).agg(F.approx_count_distinct("draw").alias("n")), "languages")
    each = max(1, fit_rows // max(1, sizes.count()))
    below = (F.least(F.lit(1.0), F.lit(2.0 * each + 64) / F.col("n")) * F.lit(float(1 << 40))).cast("long")
    some = labelled.join(sizes, F.col("lang") == F.col("_lang")).where(F.col("draw") < below)  # twice what is wanted, so that texts without a letter leave enough

    def run(batches):
        for batch in (b.slice(a, TOGETHER) for b in batches for a in range(0, b.num_rows, TOGETHER)):
            rows = [(k, subword_counts(t.as_py())) for k, t in enumerate(batch["text"]) if has_letter(t.as_py())]
            at = pa.array([k for k, _ in rows], pa.int64())
            columns = [pa.array([np.flatnonzero(c).astype("<u2").tobytes() for _, c in rows], pa.binary()), pa.array([(c[c > 0] / c.sum()).astype("<f4").tobytes() for _, c in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch[c].take(at) for c in ("lang", "draw")] + columns, ["lang", "draw", "at", "mean"])

    counted = some.select("lang", "draw", "text").dropDuplicates(["lang", "draw"]).mapInArrow(run, SAMPLE)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "at", "mean"))
    return counted.withColumn("nth", nth).where(F.col("nth") <= each).select("lang", "draw", "at", "mean")


def fit_sample(rows: list[tuple[str, int, bytes, bytes]]) -> Model:
    """The model of rows of SAMPLE, in whatever order they come."""
    rows = sorted(rows)
    rows = [rows[k] for k in np.random.default_rng(11).permutation(len(rows))]
    means = np.zeros((len(rows), BUCKETS), "f4")
    for row, (_, _, at, mean) in zip(means, rows):
        row[np.frombuffer(at, "<u2")] = np.frombuffer(mean, "<f4")
    return fit(means, [r[0] for r in rows])


def train(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Model | None:
    """Fit on rows of ``docs`` (doc_id, text, lang); None if none of them has a language and a letter.

    One task fits: its input is bounded by ``fit_rows`` (or the number of languages), and only weights go to the driver.
    """

    def run(batches):
        rows = [row for batch in batches for row in zip(*(batch[c].to_pylist() for c in ("lang", "draw", "at", "mean")))]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_sample(rows))] if rows else [], pa.binary())], ["model"])

    fitted = sample(docs, fit_rows).coalesce(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(fitted[0]["model"]) if fitted else None


def predictions(model: Model | None, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, rejected) of every text; texts with letters are scored together."""
    names, scores, out = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    known = [k for k, t in enumerate(texts) if model is not None and has_letter(t)]
    for a in range(0, len(known), TOGETHER):
        some = known[a : a + TOGETHER]
        counts = np.stack([subword_counts(texts[k]) for k in some])
        p = model.probabilities(counts / counts.sum(axis=1, keepdims=True))
        for k, best in zip(some, p.argmax(axis=1).tolist()):
            names[k] = model.langs[best]
        scores[some] = p.max(axis=1)
        out[some] = scores[some] < model.threshold
    return names, scores, out


def identify(spark: SparkSession, docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred, score and rejected; predictions see the text only."""
    lang, score, rejected = fresh(docs, "lang_pred", "score", "rejected")
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in (batch.slice(a, TOGETHER) for a in range(0, batch.num_rows, TOGETHER)):
                names, scores, out = predictions(shared.value, part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(scores), pa.array(out)], [*part.schema.names, lang, score, rejected])

    schema = docs.select("*", F.lit("").alias(lang), F.lit(0.0).alias(score), F.lit(True).alias(rejected)).schema
    for f in schema.fields:
        f.nullable = True
    return docs.mapInArrow(run, schema)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    held = fold(F.col("doc_id"), 3) == 1
    model = train(docs.where(~held))
    return identify(spark, docs.select("doc_id", "text", held.alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score", "rejected")
