"""Approximate nearest neighbours by largest inner product: an inverted file with product-quantised residuals.

Coarse centroids and residual codebooks are fitted on at most ``FIT_ROWS`` distinct vectors, chosen by their hash; every
row is indexed. How many lists a query probes is measured on the same rows: as many as hold ``RECALL`` of the true
neighbours of some of them. Small lists share a block and large ones are cut into several of about ``BLOCK_ROWS`` rows,
so a list that holds a third of the table is many tasks. A query meets the blocks of the lists it probes; there an
asymmetric distance table scores all codes, and the best distinct vectors are reranked exactly on the originals, with
all their copies' ids in order. Equal vectors of a block count as one candidate, so copies neither crowd others out nor
fall out.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows whose vec_id
is null or no number; vectors of each length are searched among themselves, as others have no inner product with them.
Repeated ids are rows of their own as neighbours, but a row with the query's id is taken for the query itself, and never
its neighbour. Each query row gets its own ranks: where an id is repeated, its rows come once for each. Further columns
are not looked at, whatever their names; a table without usable rows gives no rows.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.core import load, materialize

FIT_ROWS = 20_000
MOST_LISTS = 1024
CODES = 256
PARTS = 16
BLOCK_ROWS = 4096
QUERY_ROWS = 16_384
RECALL = 0.98
PROBE_QUERIES = 200
RERANK = 12  # times the neighbours asked for, by block
TOP = 20


@dataclass
class Quantizer:
    centroids: np.ndarray  # lists x dim
    books: np.ndarray  # parts x codes x width
    dim: int
    probed: int = 1  # lists that a query meets

    @property
    def width(self) -> int:
        return self.books.shape[2]

    def padded(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, self.books.shape[0] * self.width - self.dim)))

    def assign(self, x: np.ndarray) -> np.ndarray:
        return nearest(x, self.centroids)

    def encode(self, x: np.ndarray, lists: np.ndarray) -> np.ndarray:
        r = self.padded(x - self.centroids[lists])
        return np.stack([nearest(r[:, k * self.width : (k + 1) * self.width], book) for k, book in enumerate(self.books)], axis=1).astype("u1")

    def tables(self, q: np.ndarray) -> np.ndarray:
        """queries x parts x codes: the inner products of the query's parts with the codebooks."""
        parts = self.padded(q).reshape(len(q), len(self.books), self.width)
        return np.einsum("qpw,pcw->qpc", parts, self.books)


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), "i4")
    for a in range(0, len(x), 8192):
        out[a : a + 8192] = (x[a : a + 8192] @ centers.T - (centers**2).sum(axis=1) / 2).argmax(axis=1)
    return out


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    distinct = np.unique(x, axis=0)
    centers = distinct[rng.permutation(len(distinct))[:k]].astype("f8")
    for _ in range(rounds):
        own = nearest(x, centers)
        n = np.bincount(own, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, own, x)
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
    return centers


def fit(sample: np.ndarray, top: int = TOP, seed: int = 3) -> Quantizer:
    rng, dim = np.random.default_rng(seed), sample.shape[1]
    centroids = kmeans(sample, min(MOST_LISTS, max(1, int(2 * len(sample) ** 0.5))), rng)
    lists = nearest(sample, centroids)
    parts = min(PARTS, dim)
    width = -(-dim // parts)
    r = np.pad(sample - centroids[lists], ((0, 0), (0, parts * width - dim)))
    books = [kmeans(r[:, k * width : (k + 1) * width], CODES, rng, 6) for k in range(parts)]
    books = np.stack([np.concatenate([b, np.repeat(b[:1], CODES - len(b), axis=0)]) for b in books])
    return Quantizer(centroids, books, dim, lists_to_probe(sample, centroids, lists, top, rng))


def lists_to_probe(sample: np.ndarray, centroids: np.ndarray, lists: np.ndarray, top: int, rng: np.random.Generator) -> int:
    """The fewest lists, nearest first, that hold RECALL of the true neighbours of some sampled rows."""
    reached = []
    for k in rng.permutation(len(sample))[:PROBE_QUERIES]:
        score = sample @ sample[k]
        score[k] = -np.inf
        place = np.empty(len(centroids), "i4")
        place[np.argsort(-(centroids @ sample[k]), kind="stable")] = np.arange(len(centroids))
        reached.append(place[lists[np.argsort(-score)[: min(top, len(sample) - 1)]]])
    reached = np.sort(np.concatenate(reached))
    return int(reached[min(len(reached) - 1, int(RECALL * len(reached)))]) + 1 if len(reached) else 1


def usable(vectors: DataFrame) -> DataFrame:
    """(id, v) of the rows that take part, v as doubles."""
    v = F.col("embedding").cast("array<double>")
    ok = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v")).where(ok & F.col("vec_id").isNotNull())


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dim)


def build_index(spark: SparkSession, rows: DataFrame, dim: int, fit_rows: int = FIT_ROWS) -> tuple[DataFrame, Quantizer, dict] | None:
    """(list, id, code, v, block) of every row, the quantizer, and each list's first block and number of blocks.

    The quantizer learns from the ``fit_rows`` distinct vectors that come first by a hash, however the rows are dealt out.
    """
    drawn = rows.withColumn("draw", F.pmod(F.xxhash64(F.lit("ann"), "v"), F.lit(1 << 40)))
    distinct = drawn.agg(F.approx_count_distinct("draw")).first()[0]
    if not distinct:
        return None
    below = int(min(1.0, 2 * fit_rows / distinct) * (1 << 40))
    sample = drawn.where(F.col("draw") < below).dropDuplicates(["draw"]).orderBy("draw").limit(fit_rows).select("v").toArrow()
    fitted = matrix(sample["v"].combine_chunks(), dim)
    quantizer = fit(fitted[np.lexsort(fitted.T)])
    shared = spark.sparkContext.broadcast(quantizer)

    def run(batches):
        q = shared.value
        for batch in batches:
            x = matrix(batch["v"], dim)
            lists = q.assign(x)
            codes = q.encode(x, lists)
            yield pa.RecordBatch.from_arrays([pa.array(lists), batch["id"], pa.array([c.tobytes() for c in codes], pa.binary()), batch["v"]], ["list", "id", "code", "v"])

    coded = materialize(spark, rows.mapInArrow(run, "list int, id long, code binary, v array<double>"), "index")
    sizes = coded.groupBy("list").count().orderBy("list").collect()  # one number for each of at most MOST_LISTS lists
    plan, at, room = {}, -1, 0
    for r in sizes:
        if r["count"] > BLOCK_ROWS:
            n = -(-r["count"] // BLOCK_ROWS)
            plan[r["list"]], at, room = (at + 1, n), at + n, 0
        else:
            if r["count"] > room:
                at, room = at + 1, BLOCK_ROWS
            plan[r["list"]], room = (at, 1), room - r["count"]
    by_list = lambda k: F.element_at(F.create_map(*[F.lit(x) for lst, v in plan.items() for x in (lst, v[k])]), F.col("list"))
    block = (by_list(0) + F.pmod(F.xxhash64("id", "v"), by_list(1))).cast("int")
    return coded.withColumn("block", block), quantizer, plan


def search(spark: SparkSession, vectors: DataFrame, is_query, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``top`` largest inner products found for the rows where ``is_query`` holds."""
    rows = usable(vectors)
    parts = [search_length(spark, rows.where(F.size("v") == r["n"]), r["n"], is_query, top) for r in rows.select(F.size("v").alias("n")).distinct().orderBy("n").collect()]
    found = functools.reduce(DataFrame.unionByName, [p for p in parts if p is not None]) if any(p is not None for p in parts) else None
    return found if found is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def search_length(spark: SparkSession, rows: DataFrame, dim: int, is_query, top: int) -> DataFrame | None:
    """The same among vectors of one length, as inner products need.

    Equal queries are one, and get their copies back at the end. A block's queries are dealt to as many tasks as hold
    QUERY_ROWS of them each, with the block's rows in every one, so that a block that all queries probe is many tasks.
    """
    asked = rows.where(is_query(F.col("id"))).groupBy("id", "v").agg(F.count(F.lit(1)).alias("times"))
    asked = materialize(spark, asked.select(F.monotonically_increasing_id().alias("query"), "id", "v", "times"), "queries")  # written, so that a number stays with its query
    n = asked.count()
    built = build_index(spark, rows, dim) if n else None
    if built is None:
        return None
    index, quantizer, plan = built
    shared = spark.sparkContext.broadcast((quantizer, plan))
    slices = -(-n // QUERY_ROWS)

    def route(batches):
        q, plan = shared.value
        known = np.array(sorted(plan))
        for batch in batches:
            x = matrix(batch["v"], dim)
            near = known[np.argsort(-(x @ q.centroids[known].T), axis=1, kind="stable")[:, : q.probed]]
            pairs = [(k, b) for k, row in enumerate(near.tolist()) for b in sorted({plan[lst][0] + j for lst in row for j in range(plan[lst][1])})]
            at = pa.array([k for k, _ in pairs], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([b for _, b in pairs], pa.int32()), *(batch[c].take(at) for c in ("query", "id", "v"))], ["block", "query", "query_id", "v"])

    def score(key, asked, held):
        return score_block(shared.value[0], asked, held, top)

    queries = asked.mapInArrow(route, "block int, query long, query_id long, v array<double>").withColumn("slice", F.pmod(F.xxhash64("query"), F.lit(slices)).cast("int"))
    held = index.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    found = queries.groupBy("block", "slice").cogroup(held.groupBy("block", "slice")).applyInPandas(score, "query long, vec_id long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    copies = asked.select("query", F.col("id").alias("query_id"), F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy"))
    return best.join(copies, "query").select("query_id", "rank", "vec_id", "score")


def score_block(q: Quantizer, queries: pd.DataFrame, rows: pd.DataFrame, top: int) -> pd.DataFrame:
    """The block's ``top`` for each of its queries: codes scored from tables, the best reranked on the original vectors."""
    out = {"query": [], "vec_id": [], "score": []}
    if len(queries) and len(rows):
        rows = rows.sort_values("id", kind="stable")
        vectors, ids = np.stack(rows["v"]), rows["id"].to_numpy()
        _, first, which = np.unique(vectors.view(f"V{vectors.shape[1] * 8}").reshape(-1), return_index=True, return_inverse=True)
        members = np.split(ids[np.argsort(which, kind="stable")], np.cumsum(np.bincount(which))[:-1])  # of each distinct vector, by id
        distinct, codes = vectors[first], np.stack([np.frombuffer(c, "u1") for c in rows["code"].to_numpy()[first]])
        centers = q.centroids[rows["list"].to_numpy()[first]].astype("f4")
        asked = np.stack(queries["v"])
        keep = min(len(distinct), RERANK * top)
        for a in range(0, len(asked), 256):
            part, numbers, qids = (x[a : a + 256] for x in (asked, queries["query"].to_numpy(), queries["query_id"].to_numpy()))
            tables = q.tables(part).astype("f4")
            rough = part.astype("f4") @ centers.T
            for p in range(codes.shape[1]):
                rough += tables[:, p].take(codes[:, p], axis=1)
            best = np.argpartition(rough, len(distinct) - keep, axis=1)[:, len(distinct) - keep :]
            exact = (distinct[best] * part[:, None]).sum(axis=2)
            order = np.argsort(-exact, axis=1, kind="stable")
            for number, qid, scores, places in zip(numbers.tolist(), qids.tolist(), np.take_along_axis(exact, order, 1).tolist(), np.take_along_axis(best, order, 1).tolist()):
                taken = []
                for score, place in zip(scores, places):
                    if len(taken) >= top and score < taken[-1][0]:
                        break
                    own = members[place]
                    taken += [(score, v) for v in (own if len(own) == 1 and own[0] != qid else own[own != qid][:top]).tolist()]
                taken = sorted(taken, key=lambda x: (-x[0], x[1]))[:top]
                out["query"] += [number] * len(taken)
                out["vec_id"] += [v for _, v in taken]
                out["score"] += [s for s, _ in taken]
    return pd.DataFrame(out).astype({"query": "int64", "vec_id": "int64", "score": "float64"})


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark, load(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)
