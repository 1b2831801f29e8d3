import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weftline.llm import tokencount
from weftline.llm.tokencount import CHUNK, Counter, compile_classes, compile_splitter, op4_tokens, run_splitter, token_counts

FILE = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(FILE))


def count(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def texts():
    rng = random.Random(1)
    out = ["", "it's 'll we're don'T x'rx 'r 'v'l 'lx '' ''s !'s a'", "12 ab3c", "Σίσυφος ΣΑΣ.", "<|endoftext|>x<|startoftext|>", "<|endoftext|", "日本語", "é İstanbul ǅ x\x85y\x1cz"]
    out += ["a" * 5000, "'re'", "don't" * 100, "½ ² Ⅷ ﬁne \u0000", "😀 ok 👍🏽", "'r", " \x1f a\x0bb", "ab" * 700, "!" * 300, "é café"]
    out += ["".join(rng.choice("ab'srtlvedm 1.!<|>é\n") for _ in range(rng.randint(0, 300))) for _ in range(200)]
    out += ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x250, 0xD700), rng.randrange(0xE000, 0x1FFFF), 32])) for _ in range(60)) for _ in range(200)]
    return out


def test_counts_equal_the_library(library, monkeypatch):
    own = Counter(public_tokenizers.path(FILE), compile_classes())
    want = [count(library, t) for t in texts()]
    assert own.count(texts()).tolist() == want
    assert own.count(texts()).tolist() == want  # by compiled arcs
    monkeypatch.setattr(tokencount, "MOST_ARCS", 50)
    monkeypatch.setattr(tokencount, "AT_ONCE", 100)
    assert own.count(texts()).tolist() == want


def test_chunks_do_not_matter():
    kinds = np.random.default_rng(1).integers(0, 9, 3000).astype("u1")
    kinds[-1] = 0
    to, says = compile_splitter()
    whole = run_splitter(kinds, to, says, 3000)
    for chunk in (1, 2, 7, CHUNK):
        assert (run_splitter(kinds, to, says, chunk) == whole).all()


def test_query_on_whole_table(spark, library):
    rows = {r.doc_id: r for r in op4_tokens(spark, "/root/testdata/sf0.001").collect()}
    for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        n = count(library, d.text)
        assert (rows[d.doc_id].n_bytes, rows[d.doc_id].n_tokens, rows[d.doc_id].over_limit) == (len(d.text.encode()), n, n > 2048)


def test_edges(spark, library):
    df = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "don't " * 300000, 1), (None, "x", 1), (None, "x", 1)], "doc_id long, text string, n_tokens int")
    assert [(r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts(spark, df).collect()] == [(1, 0, 0), (2, 0, 0), (3, 1800000, 600000), (None, 1, 1), (None, 1, 1)]
    assert token_counts(spark, df.limit(0)).collect() == []


def test_words_that_share_a_key(library):
    """Polynomial hashes modulo 2^64 cannot tell Thue-Morse words apart, whatever the base."""
    own = Counter(public_tokenizers.path(FILE), compile_classes())
    signs = [bin(k).count("1") % 2 for k in range(2048)]
    for a, b in ("ab", "th", "qx", "eo"):
        words = ["".join((a, b)[s] for s in signs[:1024]), "".join((b, a)[s] for s in signs[:1024]), "".join((a, b)[s] for s in signs), "".join((b, a)[s] for s in signs)]
        want = [count(library, w) for w in words]
        assert own.count(words).tolist() == want and own.count(words[::-1]).tolist() == want[::-1]
        assert own.count([" ".join(words)]).tolist() == [sum(want)]
