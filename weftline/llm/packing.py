"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

A packing instance is only its histogram of lengths (at most ``capacity`` numbers, however many pieces there are), so
the driver reduces and packs the histogram exactly and the pieces find their places by their rank within their length.

Defined results: a null or empty text is the end id alone; repeated rows are packed each for itself; a null doc_id is a
document like any other; further columns are not looked at, whatever their names; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.core import load, materialize

CAPACITY = 2048
END = 0
GROUP_ROWS = 100_000  # pieces of one length that a task ranks
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_ENCODERS: dict = {}


def encoder(ranks: str = "byte_bpe_50k.tiktoken", special: str = "<|endoftext|>"):
    """text -> uint32 ids of the byte-level BPE vocabulary; the special string is one id, as the JSON file's library has it.

    The ranks file holds the same vocabulary as ``byte_bpe_50k.json``; tests hold the ids of both libraries equal.
    """
    if ranks not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(ranks), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={special: len(table)})
        _ENCODERS[ranks] = lambda text: coder.encode_to_numpy(text, allowed_special={special}, disallowed_special=())
    return _ENCODERS[ranks]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, and the rest, if any, first."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, ranks: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """One row per piece of every document, with the CRC-32 of its ids as little-endian 32-bit numbers."""

    def run(batches):
        encode = encoder(ranks)
        for batch in batches:
            rows = [[], [], [], [], []]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = np.append(encode(text.as_py() or ""), end).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    for column, value in zip(rows, (doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes()))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


class Reduction:
    """What is left of an instance, and the bins already fixed: (how often, ((length, times), ...))."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {w: c for w, c in counts.items() if c}
        self.sizes = sorted(self.left)
        self.fixed: list[tuple[int, tuple[tuple[int, int], ...]]] = []

    def take(self, w: int, n: int) -> None:
        self.left[w] -= n
        if not self.left[w]:
            del self.left[w]
            self.sizes.pop(bisect_left(self.sizes, w))

    def largest_up_to(self, room: int) -> int | None:
        k = bisect_left(self.sizes, room + 1)
        return self.sizes[k - 1] if k else None

    def best_pair_sum(self, room: int) -> int:
        """The largest sum of two remaining items that fits ``room`` (0: none does)."""
        best, lo, hi = 0, 0, bisect_left(self.sizes, room + 1) - 1
        while lo <= hi:
            total = self.sizes[lo] + self.sizes[hi]
            if total > room or (lo == hi and self.left[self.sizes[lo]] < 2):
                hi -= 1
            else:
                best, lo = max(best, total), lo + 1
        return best

    def reduce(self) -> Reduction:
        """Fix bins of the largest item for as long as one set of at most two items dominates all its alternatives.

        A set dominates another with the same largest item if the other's further items can be split into groups that
        fit into the places of its own items. With j the largest item that fits beside i:
        nothing fits -> {i}; i + j fills the bin -> {i, j}; no three items fit -> {i, j}; no four items fit and the
        best two beside i sum to at most j -> {i, j}. Every fixed set is part of some optimal packing.
        """
        for i in sorted(self.left, reverse=True):
            while self.left.get(i):
                self.take(i, 1)  # the item itself is no candidate beside itself
                room, n = self.capacity - i, self.left.get(i, 0) + 1
                j = self.largest_up_to(room)
                if j is None:
                    if n > 1:
                        self.take(i, n - 1)
                    self.fixed.append((n, ((i, 1),)))
                    continue
                small = self.sizes[0]
                low = small * 2 if self.left[small] > 1 else small + (self.sizes[1] if len(self.sizes) > 1 else room + 1)
                third = self.sizes[1] if len(self.sizes) > 1 else room + 1
                low3 = small * 3 if self.left[small] > 2 else (small * 2 + third if self.left[small] > 1 else low + small)
                if i + j == self.capacity or low > room or (low3 > room and self.best_pair_sum(room) <= j):
                    if i == j:
                        m = n // 2
                        self.take(i, 2 * m - 1)
                        self.fixed.append((m, ((i, 2),)))
                    else:  # taking items away leaves fewer alternatives, so the reason holds until one of the two runs out
                        m = min(n, self.left[j])
                        if m > 1:
                            self.take(i, m - 1)
                        self.take(j, m)
                        self.fixed.append((m, ((i, 1), (j, 1))))
                    continue
                self.left[i] = self.left.get(i, 0) + 1  # put back; other items may still be fixed
                if self.left[i] == 1:
                    insort(self.sizes, i)
                break
        return self


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Best-fit decreasing over a histogram: equal bins are held together, so the work is by distinct length."""
    rooms: list[int] = []
    open_bins: dict[int, list[tuple[int, tuple]]] = defaultdict(list)

    def add(room: int, m: int, held: tuple) -> None:
        if room not in open_bins:
            insort(rooms, room)
        open_bins[room].append((m, held))

    for w in sorted(counts, reverse=True):
        c = counts[w]
        while c:
            k = bisect_left(rooms, w)
            if k == len(rooms):
                room, m, held = capacity, c, ()
            else:
                room = rooms[k]
                m, held = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(k)
            fit = min(room // w, c)  # the bin just filled stays the tightest that takes the next one
            used = min(m, c // fit)
            if m > used and held:
                add(room, m - used, held)
            add(room - fit * w, used, (*held, (w, fit)))
            c -= used * fit
    return [x for room in rooms for x in open_bins[room]]


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Bins as (how often, ((length, times), ...)): dominance reduction, then best fit on what is left."""
    if any(not 0 < w <= capacity for w in counts):
        raise ValueError("lengths must be from 1 to the capacity")
    reduced = Reduction(counts, capacity).reduce()
    return reduced.fixed + best_fit(reduced.left, capacity)


def slot_table(bins, capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """length -> (first rank, times, first sequence, first offset) of its runs of places, by rank."""
    runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    ranks: dict[int, int] = defaultdict(int)
    sequence = 0
    for m, held in bins:
        offset = 0
        for w, times in held:
            runs[w].append((ranks[w], times, sequence, offset))
            ranks[w] += m * times
            offset += w * times
        sequence += m
    return {w: tuple(np.array(x, "i8") for x in zip(*r)) for w, r in runs.items()}


def pack_pieces(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` (columns of PIECES, and row, a number that no other piece has and that stays) with sequence_id and offset.

    A piece that fills its sequence gets one of its own, numbered below zero by its row, and is counted nowhere. The
    others are counted by length, and within it by salts of about ``group_rows`` pieces, so that no task ranks more,
    however common a length is. To the driver go these counts (capacity numbers, and one for each ``group_rows`` pieces);
    back go the runs of places, of which each distinct bin has at most one per length it holds.
    """
    short = pieces.where(F.col("length") < capacity)
    counts = {r["length"]: r["count"] for r in short.groupBy("length").count().collect()}
    n_salts = np.ones(capacity + 1, "i8")
    for w, n in counts.items():
        n_salts[w] = -(-n // group_rows)
    by_length = F.split(F.lit(",".join(map(str, n_salts[1:].tolist()))), ",").cast("array<int>")
    salted = short.withColumn("salt", F.pmod(F.xxhash64("row"), F.element_at(by_length, F.col("length").cast("int"))).cast("int"))
    first = np.cumsum(n_salts) - n_salts  # where a length's salts stand in one list
    tally = np.zeros(int(n_salts.sum()), "i8")
    several = np.flatnonzero(n_salts > 1).tolist()
    for w, n in counts.items():
        tally[first[w]] = n
    if several:
        table = salted.where(F.col("length").isin(several)).groupBy("length", "salt").count().toArrow()
        for w in several:
            tally[first[w]] = 0
        tally[first[table["length"].to_numpy()] + table["salt"].to_numpy()] = table["count"].to_numpy()
    before = np.cumsum(tally) - tally
    before -= np.repeat(before[first], n_salts)
    shared = spark.sparkContext.broadcast((first, before, slot_table(pack_lengths(counts, capacity), capacity)))
    ranked = salted.withColumn("nth", F.row_number().over(Window.partitionBy("length", "salt").orderBy("row")).cast("long") - 1)

    def run(batches):
        first, before, slots = shared.value
        for batch in batches:
            length = batch["length"].to_numpy()
            rank = batch["nth"].to_numpy() + before[first[length] + batch["salt"].to_numpy()]
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for w in np.unique(length):
                at = np.flatnonzero(length == w)
                runs, times, base, start = slots[int(w)]
                run_no = np.searchsorted(runs, rank[at], side="right") - 1
                inside = rank[at] - runs[run_no]
                sequence[at] = base[run_no] + inside // times[run_no]
                offset[at] = start[run_no] + w * (inside % times[run_no])
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    placed = ranked.mapInArrow(run, f"{PIECES}, sequence_id long, offset long")
    full = pieces.where(F.col("length") == capacity).select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(full)


def pack_documents(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack ``docs``; the pieces are written once with their numbers, and read for the counts and for the places."""
    return pack_pieces(spark, materialize(spark, token_pieces(docs, capacity).withColumn("row", F.monotonically_increasing_id()), "pieces"), capacity)


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, load(spark, sf_dir, "documents"))
