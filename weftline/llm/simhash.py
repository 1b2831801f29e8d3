"""SimHash near-duplicates through segment popcounts.

A fingerprint's sixteen 4-bit segments are mapped to their bit counts. The Manhattan distance of two such vectors is a
lower bound of the Hamming distance of the fingerprints, so fingerprints at 2 or fewer differing bits have vectors at
distance 2 or less, and then share a grid cell at distance 1 or less from both. Members of a cell are verified exactly.
The members of cells of over ``CROWD`` (groups of near copies, or very many fingerprints) meet again in finer grids, by
the same bound: segments of 2 bits, then of single bits, where the bound is the distance itself, a cell holds at most 65
fingerprints, and one star links what is within 2 bits of its middle. Nothing is lost, and no members are paired with
each other beyond the crowd limit.

Near copies by similarity (``similar_components``) may be further apart than a fingerprint search can promise. There the grid's
links and fingerprints of sampled shingles only propose; the Jaccard similarity of the whole sets of shingles decides.

Defined results: a null, empty or blank text has fingerprint zero, linked like any other; repeated rows and exact copies
share a fingerprint and so a component; the component of rows whose doc_ids are all null is null; texts of any length
count whole; further columns are not looked at, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.core import join_by_shuffle, load, materialize
from weftline.operators.graph import connected_components

SHINGLE = 3
SEED = 42
MOST_BITS = 2
WIDTHS = (4, 2, 1)  # bits of the segments, coarse to fine
CROWD = 32
AT_ONCE = 1 << 15
NEAR_SHINGLE, NEAR = 5, 0.8  # words of a shingle, and least similarity, of near copies
BANDS, SAMPLED = 10, 3
REPRESENTATIVES = 4  # of a cell, against whom its members are held
ORDERS, ONES = 0x9E3779B97F4A7C15, (1 << 64) - 1


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """The XXH64 of every shingle of a text, repeats included."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    if not words:
        return np.zeros(0, "<u8")
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    ends, digest = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:], xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends.tolist())), "<u8", n)


def majority(h: np.ndarray) -> int:
    """64 bits, each set where over half the hashes have it set."""
    total = np.zeros(64, "i8")
    for k in range(0, len(h), AT_ONCE):
        total += np.unpackbits(h[k : k + AT_ONCE].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return int(np.packbits(2 * total > len(h), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, mark): fp holds the fingerprint's bits as a signed number, mark a hash of the text."""

    def run(batches):
        for batch in batches:
            made = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch["text"]), "u8", batch.num_rows).view("i8")
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(made), batch["mark"]], ["doc_id", "fp", "mark"])

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("mark")).mapInArrow(run, "doc_id long, fp long, mark long")


def segment_counts(fp: Column, width: int) -> Column:
    """The bit counts of the segments of ``width`` bits (4, 2 or 1), ``width`` bits each, in one number."""
    if width == 1:
        return fp
    mask = F.lit(sum(1 << k for k in range(0, 64, width)))
    each = [F.shiftrightunsigned(fp, k).bitwiseAND(mask) for k in range(width)]
    if width == 2:  # sums and carries apart, as a sum could overflow
        return each[0].bitwiseXOR(each[1]).bitwiseOR(F.shiftleft(each[0].bitwiseAND(each[1]), 1))
    return functools.reduce(lambda a, b: a + b, each)


def cells(fp: Column, width: int) -> Column:
    """The grid cells at Manhattan distance 1 or less: itself, and one count up or down."""
    at = segment_counts(fp, width)
    near = [at]
    for k in range(0, 64, width):
        count = F.shiftrightunsigned(at, k).bitwiseAND(F.lit((1 << width) - 1))
        for ok, other in ((count < width, count + 1), (count > 0, count - 1)):  # counts are exchanged bit by bit, as sums could overflow
            near.append(F.when(ok, at.bitwiseXOR(F.shiftleft(count.bitwiseXOR(other), k))))
    return F.filter(F.array(*near), lambda x: x.isNotNull())


def links(spark: SparkSession, points: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(src, dst): links that join all distinct fingerprints ``points`` (fp) within 2 bits, directly or over each other."""
    found = []
    for width in WIDTHS:
        # a task spreads AT_ONCE points at most; the planner takes the spread rows, up to 65 a point, for as few as the points
        dealt = points.repartition(1 + points.count() // AT_ONCE, "fp")
        spread = dealt.select("fp", F.explode(cells(F.col("fp"), width)).alias("cell"))
        shared = spread.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        members = materialize(spark, join_by_shuffle(spread, shared, "cell"), "members")
        few = members.where(F.col("n") <= crowd) if width > 1 else members
        if width > 1:
            a, b = few.select("cell", F.col("fp").alias("src")), few.select("cell", F.col("fp").alias("dst"))
            found.append(join_by_shuffle(a, b, "cell").where((F.col("src") < F.col("dst")) & (F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= MOST_BITS)).select("src", "dst").distinct())
            points = members.where(F.col("n") > crowd).select("fp").distinct()
            if points.isEmpty():
                break
        else:
            found.append(join_by_shuffle(few, few.groupBy("cell").agg(F.min("fp").alias("dst")), "cell").select(F.col("fp").alias("src"), "dst").where("src <> dst").distinct())
    return functools.reduce(DataFrame.unionByName, found)


def components(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, mark, component, component_id): one row per row of ``docs``; component and component_id are the
    smallest fingerprint and doc_id that links lead to.

    Copies meet as one fingerprint before anything is spread over cells, so groups of copies cost a partial minimum only.
    """
    marks = materialize(spark, fingerprints(docs, shingle), "fingerprints")
    points = materialize(spark, marks.groupBy("fp").agg(F.min("doc_id").alias("low")), "points")
    parts = materialize(spark, connected_components(spark, links(spark, points.select("fp"))), "parts")
    lows = join_by_shuffle(points, parts.withColumnRenamed("node", "fp"), "fp").groupBy("component").agg(F.min("low").alias("component_id"))
    merged = join_by_shuffle(parts, lows, "component").select(F.col("node").alias("fp"), "component", "component_id")
    ids = join_by_shuffle(points, merged, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"), F.coalesce("component_id", "low").alias("component_id"))
    return join_by_shuffle(marks, materialize(spark, ids, "classes"), "fp").select("doc_id", "fp", "mark", "component", "component_id")


# --- near copies by similarity


def sketch(text: str | None, shingle: int = NEAR_SHINGLE, bands: int = BANDS) -> tuple[int, int, int, list[int]]:
    """(hash of the set of shingles, fingerprint, distinct shingles, sampled fingerprints) of a text.

    A sampled fingerprint is that of the SAMPLED shingles that come first in an order of all shingles, another order for
    each: texts of similarity s have the same sample, and so the same fingerprint, with a chance of about s^SAMPLED.
    """
    h = shingle_hashes(text, shingle)
    own = np.unique(h)
    key = xxhash.xxh64_intdigest(own.tobytes(), SEED)
    if len(own) < SAMPLED:
        return key, majority(h), len(own), [key] * bands
    out = []
    for k in range(bands):
        mixed = (own ^ np.uint64(ORDERS * (2 * k + 1) & ONES)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        out.append(majority(own[np.argpartition(mixed, SAMPLED - 1)[:SAMPLED]]))
    return key, majority(h), len(own), out


def similarity(a: Column, b: Column) -> Column:
    """The Jaccard similarity of two sets."""
    shared = F.size(F.array_intersect(a, b))
    return shared / (F.size(a) + F.size(b) - shared)


def overlap(n: Column, m: Column, least: float) -> Column:
    """The fewest elements that sets of n and m with a similarity of ``least`` share."""
    return F.ceil((n + m) * F.lit(least / (1 + least)) - F.lit(1e-9))


def prefixes(sets: DataFrame, least: float) -> DataFrame:
    """(token, sizes, small, key, component, outside, n, at) of sets (key, component, outside, n, own, ranked), by which any two of
    different components with a similarity of ``least`` meet once at least, as the smaller and the larger one.

    A set's elements stand in one order for all sets, the ``own`` ones first that no other component has; those after them
    are ranked. Two sets that share ``overlap`` elements share one that stands early enough in both to leave so many. How
    early depends on both sizes: the larger one is spread over classes of smaller sizes, 2 % wide.
    """

    def run(batches):
        for batch in batches:
            rows = {k: [] for k in out}
            for r in batch.to_pylist():
                n, own, ranked = r["n"], r["own"], r["ranked"]
                sizes = np.arange(max(1, int(np.ceil(least * n - 1e-9))), n + 1)
                classes, first = np.unique(np.floor(np.log(sizes) * 50).astype("i8"), return_index=True)
                met = [(False, int(c), int(sizes[f])) for c, f in zip(classes, first)] + [(True, int(classes[-1]), n)]
                for small, c, m in met:
                    for at in range(own, min(own + len(ranked), n - int(np.ceil((n + m) * (least / (1 + least)) - 1e-9)) + 1)):
                        for k, v in zip(out, (ranked[at - own], c, small, r["key"], r["component"], r["outside"], n, at)):
                            rows[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows[k], t) for k, t in out.items()], list(out))

    out = {"token": pa.int64(), "sizes": pa.int64(), "small": pa.bool_(), "key": pa.int64(), "component": pa.int64(), "outside": pa.bool_(), "n": pa.int64(), "at": pa.int64()}
    return sets.mapInArrow(run, "token long, sizes long, small boolean, key long, component long, outside boolean, n long, at long")


def open_members(members: DataFrame, parts: DataFrame) -> DataFrame:
    """(key, component, n, outside): what is in a cell whose pairs were not all looked at and which ``parts`` (node, component) do
    not join; outside: not in the largest component of such a cell."""
    owned = join_by_shuffle(members, parts.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    held = owned.groupBy("cell", "component").agg(F.count(F.lit(1)).alias("_n"))
    open_cells = held.groupBy("cell").agg(F.count(F.lit(1)).alias("_parts"), F.sum("_n").alias("_all"), F.max_by("component", F.struct("_n", "component")).alias("_core"))
    open_cells = open_cells.where((F.col("_parts") > 1) & (F.col("_all") > REPRESENTATIVES + 1))
    return join_by_shuffle(owned, open_cells.select("cell", "_core"), "cell").where("n > 0").groupBy("key", "component", "n").agg(F.max(F.col("component") != F.col("_core")).alias("outside"))


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (src, dst) whose sets (key, shingles) have a similarity of ``least`` or more."""
    one, two = (sets.select(F.col("key").alias(c), F.col("shingles").alias(f"_{c}")) for c in ("src", "dst"))
    return join_by_shuffle(join_by_shuffle(pairs, one, "src"), two, "dst").where(similarity(F.col("_src"), F.col("_dst")) >= least).select("src", "dst")


def similar_links(spark: SparkSession, members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(src, dst): links that join all members (cell, key, n) of a cell whose sets (key, shingles) have a similarity of ``least`` or
    more, directly or over each other.

    First each member is held against its cell's representatives, those members that share most cells with others,
    REPRESENTATIVES at most; a cell of few members more than these has all its pairs looked at. That joins most of a group of
    any size for a few comparisons a member. Where a larger cell then is in several components, all pairs across these that
    can be like each other are found by prefixes of their sets (``prefixes``) and verified; none is left out. Pairs whose
    sizes forbid the similarity are not looked at.
    """
    sizes = members.groupBy("cell").agg(F.count(F.lit(1)).alias("_n"))
    near = join_by_shuffle(members, sizes, "cell").groupBy("key").agg(F.sum("_n").alias("near"))
    first = F.row_number().over(Window.partitionBy("cell").orderBy(F.desc("near"), "key"))
    chosen = join_by_shuffle(members, near, "key").withColumn("_r", first).where(F.col("_r") <= REPRESENTATIVES).select("cell", F.col("key").alias("other"), F.col("n").alias("m"))
    met = join_by_shuffle(members, chosen, "cell").where((F.col("key") != F.col("other")) & (F.least("n", "m") >= least * F.greatest("n", "m")))
    pairs = materialize(spark, met.select(F.least("key", "other").alias("src"), F.greatest("key", "other").alias("dst")).distinct(), "pairs")
    found = materialize(spark, verified(pairs, sets, least), "similar")

    rest = materialize(spark, open_members(members, connected_components(spark, found)), "open")
    if rest.isEmpty():
        return found
    tokens = materialize(spark, join_by_shuffle(rest, sets, "key").select("key", "component", F.explode("shingles").alias("token")), "tokens")
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("_n"), F.min("component").alias("_a"), F.max("component").alias("_b"))
    ranked = join_by_shuffle(tokens, counts.where("_a <> _b").select("token", "_n"), "token").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("_n", "token")))["token"].alias("ranked"))
    # only sets with elements enough that other components have can be like one of these
    able = join_by_shuffle(rest, ranked, "key").where(F.size("ranked") >= F.ceil(F.col("n") * F.lit(least) - F.lit(1e-9))).withColumn("own", F.col("n") - F.size("ranked"))
    early = materialize(spark, prefixes(able, least), "prefixes")
    a = early.where("small").select("token", "sizes", *[F.col(c).alias(f"a_{c}") for c in ("key", "component", "outside", "n", "at")])
    b = early.where("not small").select("token", "sizes", *[F.col(c).alias(f"b_{c}") for c in ("key", "component", "outside", "n", "at")])
    enough = overlap(F.col("a_n"), F.col("b_n"), least)
    fit = (F.col("a_component") != F.col("b_component")) & (F.col("a_n") <= F.col("b_n")) & (F.col("a_n") - F.col("a_at") >= enough) & (F.col("b_n") - F.col("b_at") >= enough)
    across = [join_by_shuffle(x, y, ["token", "sizes"]).where(fit) for x, y in ((a.where("a_outside"), b), (a.where("not a_outside"), b.where("b_outside")))]
    other = across[0].union(across[1]).select(F.least("a_key", "b_key").alias("src"), F.greatest("a_key", "b_key").alias("dst")).distinct()
    return found.union(verified(materialize(spark, other, "pairs"), sets, least))


def similar_components(spark: SparkSession, docs: DataFrame, shingle: int = NEAR_SHINGLE, least: float = NEAR, bands: int = BANDS) -> DataFrame:
    """(doc_id, mark, key, component, component_id): one row per row of ``docs``; documents of one component are linked by
    similarities of ``least`` or more of their sets of shingles.

    Texts with the same set are one from the start. Candidates are texts whose fingerprints the grid links, and texts that
    share a sampled fingerprint; ``similar_links`` joins what is alike in these groups, on the sets themselves, which are made
    again for candidates only.
    """

    def run(batches):
        for batch in batches:
            made = [sketch(t.as_py(), shingle, bands) for t in batch["text"]]
            signed = lambda v: np.array(v, "u8").view("i8")
            prints = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1, dtype="i4") * bands), pa.array(signed([x for m in made for x in m[3]])))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["mark"], pa.array(signed([m[0] for m in made])), pa.array(signed([m[1] for m in made])), pa.array([m[2] for m in made], pa.int64()), prints], ["doc_id", "mark", "key", "fp", "n", "prints"])

    def shingles(batches):
        for batch in batches:
            own = [np.unique(shingle_hashes(t.as_py(), shingle)) for t in batch["text"]]
            keys = np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in own], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([x.view("i8") for x in own], pa.list_(pa.int64()))], ["key", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("mark"))
    marks = materialize(spark, rows.mapInArrow(run, "doc_id long, mark long, key long, fp long, n long, prints array<long>"), "sketches")
    points = materialize(spark, marks.groupBy("key").agg(F.min("doc_id").alias("low"), F.min("mark").alias("mark"), *[F.any_value(c).alias(c) for c in ("fp", "n", "prints")]), "points")
    near = materialize(spark, connected_components(spark, links(spark, points.select("fp").distinct())).select(F.col("node").alias("fp"), F.col("component").alias("grid")), "near")
    every = F.concat(F.array(F.coalesce("grid", "fp")), "prints")
    cells = join_by_shuffle(points, near, "fp", "left").select("key", "n", F.posexplode(every).alias("band", "value")).select(F.xxhash64("band", "value").alias("cell"), "key", "n").distinct()
    shared = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("cell")
    members = materialize(spark, join_by_shuffle(cells, shared, "cell", "left_semi"), "members")
    wanted = join_by_shuffle(points, members.select("key").distinct(), "key", "left_semi").select("mark")
    texts = join_by_shuffle(rows.select("mark", "text"), wanted, "mark", "left_semi").dropDuplicates(["mark"])
    sets = materialize(spark, texts.select("text").mapInArrow(shingles, "key long, shingles array<long>"), "sets")
    parts = materialize(spark, connected_components(spark, similar_links(spark, members, sets, least)), "parts")
    lows = join_by_shuffle(points, parts.withColumnRenamed("node", "key"), "key").groupBy("component").agg(F.min("low").alias("component_id"))
    merged = join_by_shuffle(parts, lows, "component").select(F.col("node").alias("key"), "component", "component_id")
    ids = join_by_shuffle(points, merged, "key", "left").select("key", F.coalesce("component", "key").alias("component"), F.coalesce("component_id", "low").alias("component_id"))
    return join_by_shuffle(marks.select("doc_id", "mark", "key"), materialize(spark, ids, "classes"), "key").select("doc_id", "mark", "key", "component", "component_id")


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id): one row per row of ``docs``; component_id is the smallest doc_id that links lead to."""
    return components(spark, docs, shingle).select("doc_id", "fp", "component_id")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark, load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
