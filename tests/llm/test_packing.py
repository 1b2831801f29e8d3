import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weftline.llm.packing import CAPACITY, PIECES, Reduction, best_fit, encoder, op9_pack, pack_documents, pack_lengths, pack_pieces, token_pieces


def check_bins(counts, bins, capacity):
    got = defaultdict(int)
    for m, held in bins:
        assert m > 0 and sum(w * t for w, t in held) <= capacity
        for w, t in held:
            got[w] += m * t
    assert dict(got) == {w: c for w, c in counts.items() if c}


def fewest(items, capacity):
    """Exact bin packing of a few items by depth-first search."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for j in {b: j for j, b in enumerate(bins) if b + items[k] <= capacity}.values():
            bins[j] += items[k]
            go(k + 1, bins)
            bins[j] -= items[k]
        go(k + 1, [*bins, items[k]])

    go(0, [])
    return best[0]


def test_bins_hold_every_item():
    rng = random.Random(1)
    for capacity in (5, 40, CAPACITY):
        for _ in range(60):
            counts = defaultdict(int)
            for _ in range(rng.randint(0, 200)):
                counts[rng.randint(1, capacity)] += rng.choice((1, 1, 7))
            check_bins(counts, pack_lengths(dict(counts), capacity), capacity)


def test_reduction_keeps_an_optimum():
    rng = random.Random(2)
    for _ in range(300):
        items = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
        counts = {w: items.count(w) for w in items}
        r = Reduction(counts, 20).reduce()
        rest = [w for w, c in r.left.items() for _ in range(c)]
        assert sum(m for m, _ in r.fixed) + fewest(rest, 20) == fewest(items, 20)


def test_near_the_bound():
    rng = random.Random(3)
    counts = defaultdict(int)
    for _ in range(20000):
        counts[min(CAPACITY, int(rng.lognormvariate(6, 1)) + 1)] += 1
    bins = sum(m for m, _ in pack_lengths(dict(counts)))
    assert bins <= 1.01 * sum(w * c for w, c in counts.items()) / CAPACITY + 1
    assert best_fit({}, 10) == []


def test_ids_equal_the_other_library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["", "a  b\n\n c", "x<|endoftext|>y", "été — 日本 12345 don't", " " * 300 + "q", "\u0000 z" * 50, "aaaa" * 3000]:
        assert list(encoder()(text)) == t.encode(text, add_special_tokens=False).ids


def check_rows(rows, texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    spans, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        spans[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for held in spans.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= CAPACITY
    for doc_id, text in texts.items():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // CAPACITY)))
        assert all(r.length == CAPACITY for r in own[1:])
        at = 0
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_query_on_whole_table(spark):
    table = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    check_rows(op9_pack(spark, "/root/testdata/sf0.001").collect(), table)


def test_edges(spark):
    texts = {1: None, 2: "", 3: "word " * 9000, 4: "same", 5: "same"}
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in texts.items()], "doc_id long, text string, salt string, length int")
    check_rows(pack_documents(spark, df).collect(), texts)
    twice = pack_documents(spark, df.union(df)).collect()
    assert len(twice) == 2 * len(pack_documents(spark, df).collect())
    assert pack_documents(spark, df.limit(0)).collect() == []


def test_one_length_in_many_groups(spark):
    texts = {k: ("word " * 4 if k % 3 else "other words " * (k % 7) + "x " * 2047) for k in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    pieces = spark.createDataFrame(token_pieces(docs).withColumn("row", F.monotonically_increasing_id()).collect(), f"{PIECES}, row long")
    for group_rows in (7, 50, 10**6):
        rows = pack_pieces(spark, pieces, CAPACITY, group_rows).collect()
        check_rows(rows, texts)
        assert len({r.sequence_id for r in rows}) <= 1.01 * sum(r.length for r in rows) / CAPACITY + 1
