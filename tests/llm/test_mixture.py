import math
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from weftline.core import materialize
from weftline.llm import mixture
from weftline.llm.mixture import CHUNK, END, FLAG_GATES, INPUTS, LEVELS, LOGITS, RUN_GATES, Mixer, Model, counted, fold, offsets_of, op1_mixture, packed_logits, score_block, score_documents, seen_before, table_bits, trees_of, words_of

TEXTS = ["The cat sat on the mat, the cat.", "a b\tC\n d", "", None, "x" * 300, "é à la carte " * 40, "and the end", "a b c d and the cat sat on the mat, once more; the cat sat on"]


def model(texts, seed=1):
    counts = Counter(w for t in texts for w in [*words_of(t), END])
    pairs = np.zeros((256, 256), "i8")
    for w, n in counts.items():
        line = b" " + (w if w == END else w + b" ")
        for a, b in zip(line, line[1:]):
            pairs[a, b] += n
    trees, bits = trees_of(pairs), table_bits(len(counts))
    table, sums = np.full(int(offsets_of(bits)[-1]), mixture.UNSEEN, "u1"), defaultdict(lambda: [0, 0])
    for keys, (n, _) in counted(list(counts), np.array([[n, n] for n in counts.values()]), trees, bits):
        for k, x in zip(keys.tolist(), n.tolist()):
            sums[k >> 1][k & 1] += x
    for k, (z, o) in sums.items():
        table[k] = packed_logits(np.array([z]), np.array([o]))[0]
    spelling, flags, rng = Mixer.spelling(), Mixer.flags(), np.random.default_rng(seed)
    spelling.weights = rng.normal(0.3, 0.2, spelling.weights.shape)
    flags.weights = rng.normal(0.3, 0.2, flags.weights.shape)
    return Model(trees, bits, table, spelling, flags)


def known_of(texts, learn):
    """What others knows, from plain counters: (all, commonest, comes) of the two words before each word."""
    lines = [[*words_of(t), END] for t in texts]
    contexts = [[tuple(([None, None, *line])[k : k + 2]) for k in range(len(line))] for line in lines]
    total = defaultdict(Counter)
    for line, ctx, ok in zip(lines, contexts, learn):
        if ok:
            for w, c in zip(line, ctx):
                total[c][w] += 1
    best = {c: min((-n, int.from_bytes(xxhash.xxh3_128_digest(w)[:2], "big") >> 5) for w, n in ws.items()) for c, ws in total.items()}
    out = []
    for line, ctx, ok in zip(lines, contexts, learn):
        own, own_best, row = Counter(ctx if ok else []), Counter(), []
        lead = [c in best and int.from_bytes(xxhash.xxh3_128_digest(w)[:2], "big") >> 5 == best[c][1] for w, c in zip(line, ctx)]
        for c, x in zip(ctx, lead):
            own_best[c] += ok and x
        for c, x in zip(ctx, lead):
            all_, most = sum(total[c].values()) - own[c], (-best[c][0] if c in best else 0) - own_best[c]
            row.append(all_ << 16 | most << 1 | x if most > 0 else 0)
        out.append(row)
    return lines, out


def refine(m, kind, z, p):
    cell = kind * LEVELS + max(-(LEVELS // 2), min(LEVELS // 2, int(np.rint(np.float32(2 * z))))) + LEVELS // 2
    return cell, 0.5 * p + 0.5 * m.ones[cell] / m.n[cell]


def scalar_spelling(m, word):
    """One branch after another, with contexts built by hand."""

    def mix64(x):
        x = x * 0xD6E8FEB86659FD93 & mixture.MASK
        return (x ^ x >> 32) * 0xD6E8FEB86659FD93 & mixture.MASK

    total, offsets = 0.0, offsets_of(m.bits)
    spelled = word if word == END else word + b" "
    for j, symbol in enumerate(spelled):
        tail = lambda size: sum((c + 1) << 9 * i for i, c in enumerate(spelled[max(0, j - size) : j][::-1]))
        whole = sum((c + 1) * pow(0x2545F4914F6CDD1D, i, 1 << 64) for i, c in enumerate(spelled[:j]))
        contexts = [mix64(x & mixture.MASK) >> 32 for x in (tail(3) + (1 << 50), tail(5) + (2 << 50), whole + 3)]
        path = (spelled[j - 1] if j else 32) * 256 + symbol
        a = m.trees.first[path]
        for salt, way in zip(m.trees.salts[a : a + m.trees.length[path]].tolist(), m.trees.ways[a : a + m.trees.length[path]].tolist()):
            told = [int(m.table[int(offsets[t]) + ((c ^ salt) >> 32 - m.bits[t])]) for t, c in enumerate(contexts)]
            z = max(-16, min(16, sum(float(LOGITS[x]) * w for x, w in zip(told, m.spelling.weights[:, (told[2] & 3) * 4 + (told[1] & 3)]))))
            q = refine(m.spelling, 0, z, 1 / (1 + math.exp(-z)))[1]
            total += math.log(q if way else 1 - q)
    return total


def scalar_score(m, line, known):
    """One flag after another."""
    own = Mixer(m.flags.weights.astype("f4").astype("f8"), m.flags.ones.copy(), m.flags.n.copy())
    total, run, past, seen, waiting, ways = 0.0, 0, Counter(), defaultdict(lambda: [0, 0]), [], []

    def flag(inputs, gate, yes, no, key, kind, happened):
        nonlocal total
        x = [*inputs, math.log((seen[key][1] + 0.4) / (seen[key][0] + 0.4))]
        seen[key][happened] += 1
        z = max(-16, min(16, sum(a * b for a, b in zip(x, own.weights[:, gate]))))
        p = 1 / (1 + math.exp(-z))
        cell, q = refine(own, kind, z, p)
        whole = q * yes + (1 - q) * no
        total += math.log(whole)
        waiting.append((x, gate, q * yes / whole, p, cell))
        if len(waiting) == CHUNK:
            for x, gate, way, p, cell in waiting:
                own.weights[:, gate] += mixture.RATE * (way - p) * np.array(x)
                own.ones[cell] += way
                own.n[cell] += 1
            waiting.clear()

    for i, (word, k) in enumerate(zip(line, known)):
        all_, most, hit = k >> 16, k >> 1 & 0x7FFF, k & 1
        if k:
            step = [0, 1, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4, 4, 4, 4, 4, 5][min(run, 16)]
            flag([math.log((most + 0.4) / (all_ - most + 0.4)), 1, 0], (step * 4 + (all_ >= 2) + (all_ >= 3) + (all_ >= 6)) * 2 + (most == all_), hit, 1 - hit, ("run", step, most == all_), 0, hit)
        run = run + 1 if k and hit else 0
        if not (k and hit):
            spelling = scalar_spelling(m, word)
            total += spelling
            if i:
                copied = past[word] / i / math.exp(spelling)
                n, ones = len(ways), sum(ways)
                gate = RUN_GATES + min(15, int(math.log2(n + 1))) * 2 + (ways[-1] if ways else 0)
                flag([math.log((ones + 0.4) / (n - ones + 0.4)), 1, math.log((n - ones + 1) / (n + 1))], gate, copied, 1, ("copy", *ways[:-4:-1], *[0] * (3 - n)), 1, int(copied > 1))
                ways.append(int(copied > 1))
        past[word] += 1
    return total


def joint(lines, known):
    words = sorted({w for line in lines for w in line})
    seq = np.array([words.index(w) for line in lines for w in line])
    return words, seq, np.array([k for row in known for k in row]), np.cumsum([0, *map(len, lines)])


def test_scores_against_scalar_code(monkeypatch):
    texts = [*TEXTS, " ".join(f"{a} {b}" for a in "the cat sat on a mat and ran".split() for b in "x y z cat the w".split())]
    m = model(TEXTS[:6])
    lines, known = known_of(texts, [True] * 6 + [False] * 3)
    assert any(k & 1 for row in known for k in row)
    want = [scalar_score(m, line, row) for line, row in zip(lines, known)]
    assert score_block(*joint(lines, known), m) == pytest.approx(want, rel=1e-4)
    monkeypatch.setattr(mixture, "ENTRIES", 64)  # words and texts in other company
    assert score_block(*joint(lines, known), m) == pytest.approx(want, rel=1e-4)


def beginning(m, word):
    """The log probability of all words that begin so: their spelling without what ends it."""
    whole = m.trees.length[[(word[j - 1] if j else 32) * 256 + c for j, c in enumerate(word)]].sum() if word else 0
    s = mixture.letters([word])
    byte, salt, way = mixture.branches(m.trees, s.path)
    offsets, total = offsets_of(m.bits), 0.0
    told = [m.table[offsets[t] + mixture.slots(s.contexts[t], byte, salt, m.bits[t])] for t in range(3)]
    for e in range(int(whole)):
        z = max(-16, min(16, sum(float(LOGITS[told[t][e]]) * m.spelling.weights[t, (told[2][e] & 3) * 4 + (told[1][e] & 3)] for t in range(3))))
        q = refine(m.spelling, 0, z, 1 / (1 + math.exp(-z)))[1]
        total += math.log(q if way[e] else 1 - q)
    return total


def test_spellings_have_probabilities_that_sum_to_one():
    m = model(TEXTS)
    for begin in (b"", b"t", b"th"):
        assert sum(math.exp(beginning(m, begin + bytes([c])) - beginning(m, begin)) for c in range(256)) == pytest.approx(1, abs=1e-6)


def test_counts_before_against_a_loop():
    rng = np.random.default_rng(2)
    for size in (0, 1, 500, 4000):
        keys, way, seen = rng.integers(0, 40, size).astype("u8") << np.uint64(33), rng.integers(0, 2, size).astype("u1"), defaultdict(lambda: [0, 0])
        for k, w, a, b in zip(keys.tolist(), way.tolist(), *(x.tolist() for x in seen_before(keys, way))):
            assert seen[k] == [a, b]
            seen[k] = [a + 1, b + w]


def test_counting_against_a_loop():
    words, counts = [b"abc", b"abd", b"x", END, b"abcabcabc"], np.array([[5, 5], [2, 0], [1, 1], [7, 3], [1, 0]])
    m = model(TEXTS)
    want, got = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for w, ns in zip(words, counts.tolist()):
        s = mixture.letters([w])
        byte, salt, way = mixture.branches(m.trees, s.path)
        for t in range(3):
            for at, x in zip(mixture.slots(s.contexts[t], byte, salt, m.bits[t]).tolist(), way.tolist()):
                for c, n in enumerate(ns):
                    want[2 * (int(offsets_of(m.bits)[t]) + at) + x][c] += n if t == 2 else int(n > 0)
    for keys, sums in counted(words, counts, m.trees, m.bits):
        for k, row in zip(keys.tolist(), sums.T.tolist()):
            got[k] = [a + b for a, b in zip(got[k], row)]
    assert dict(got) == dict(want)


class Caught(Exception):
    """Stands for a table, and raises what is mapped over it."""

    def select(self, *_):
        return self

    def mapInArrow(self, f, _):
        raise Caught(f)


def test_counts_of_many_branches_are_exact_and_take_little_memory(monkeypatch):
    rng, m = np.random.default_rng(6), model(TEXTS)
    raw = rng.choice(np.frombuffer(b"etaoinshrdlu", "u1"), (180_000, 8)).tobytes()
    words = [END, *(raw[k : k + 8] for k in range(0, len(raw), 8))]
    train = np.concatenate([[3 << 40, 1 << 22, (1 << 18) - 1, 1 << 18], rng.integers(1, 300, len(words) - 4)])  # some need many bits
    counts = np.stack([train, train - train * rng.integers(0, 2, len(train))], axis=1)
    blocks = [(words[a : a + 30_000], counts[a : a + 30_000]) for a in range(0, len(words), 30_000)]
    monkeypatch.setattr(mixture, "spoken", lambda _, k: blocks[k])
    session = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda x: SimpleNamespace(value=x)))
    with pytest.raises(Caught) as caught:
        mixture.spelling_tables(session, Caught(), m.trees, m.bits)
    tracemalloc.start()
    try:
        batches = list(caught.value.args[0]([SimpleNamespace(num_rows=len(blocks))]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    got, want, taken = *np.zeros((2, 2, 2 * int(offsets_of(m.bits)[-1])), "i8"), 0
    for batch in batches:
        for part, row in zip(batch["part"].to_pylist(), batch["packed"]):
            step, n, less = mixture.unpacked(row.as_py(), 3)
            at = np.cumsum(step) + (part << mixture.PART + 1)
            assert (step[1:] > 0).all()
            got[0, at] += n
            got[1, at] += n - less
            taken += len(at)
    for own in blocks:
        for keys, sums in counted(*own, m.trees, m.bits):
            for out, n in zip(want, sums):
                np.add.at(out, keys.astype("i8"), n)
    assert (got == want).all() and taken > mixture.COUNTED // 4  # branches enough to fill what a task adds up at once
    assert peak < 220e6


def check_base(rows, table, held):
    counts, n = Counter(), 0
    for d, t in table:
        if not held(d):
            counts.update([*words_of(t), None])
    n, v = sum(counts.values()), len(counts)
    want = {}
    for d, t in table:
        tokens = [*words_of(t), None]
        want[d] = (held(d), len(tokens), sum(counts[w] > 0 for w in tokens), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens))
    assert len(rows) == len(table)
    for r in rows:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4], rel=1e-9) and r.score <= 0


def test_query_on_whole_table(spark):
    table = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rows = op1_mixture(spark, "/root/testdata/sf0.01").collect()
    check_base(rows, table, lambda d: zlib.crc32(str(d).encode()) % 7 == 2)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > 0.88 * sum(r.base_score for r in out)  # both are negative: better than the base by an eighth
    copies = Counter(t for _, t in table)
    bits = {r.doc_id: r.bits_per_byte for r in rows}
    once, twice = ([bits[d] for d, t in table if (copies[t] == 2) == x and copies[t] < 3] for x in (False, True))
    assert np.mean(np.array(twice) < np.quantile(once, 0.1)) > 0.6  # documents that occur twice stand apart


def test_continuations_against_counters(spark, monkeypatch):
    """Blocks and parts of any size give what plain counters give, also for words that share a polynomial hash."""
    signs = [bin(k).count("1") % 2 for k in range(1024)]
    clash = ["".join("ab"[s] for s in signs), "".join("ba"[s] for s in signs)]
    texts = [t or "" for t in TEXTS] + [" ".join(clash), clash[0], "a b c d", "a b c e", "a b c e a b c d"]
    table = list(enumerate(texts * 3))
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    learn = {d: d % 5 != 2 for d, _ in table}
    rows = df.select("doc_id", "text", (F.col("doc_id") % 5 == 2).alias("held"), F.lit(False).alias("tune"))
    lines, want = known_of([t for _, t in table], [learn[d] for d, _ in table])
    counts = Counter(w for (d, _), line in zip(table, lines) if learn[d] for w in line)
    for size, bits, key_bits in ((1 << 22, 0, 32), (200, 5, 50)):
        monkeypatch.setattr(mixture, "BLOCK_BYTES", size)
        spoken = Counter()
        for r in mixture.joined_blocks(materialize(spark, mixture.word_blocks(rows), "blocks"), bits, key_bits).collect():
            words, own, (seq,), (known,) = mixture.spelled_words(r.spelled), mixture.unpacked(r.counts, 2)[0].tolist(), mixture.unpacked(r.seq, 1), mixture.unpacked(r.known, 1)
            assert [n >> 1 for n in own] == [counts[w] for w in words]
            spoken.update(w for w, n in zip(words, own) if n & 1)
            for d, a, b in zip(r.doc_id, r["first"], r["first"][1:]):
                assert [words[k] for k in seq[a:b]] == lines[d] and known[a:b].tolist() == want[d]
        assert set(spoken) == {w for line in lines for w in line} and set(spoken.values()) == {1}
    got = score_documents(spark, df, F.col("doc_id") % 5 == 2).collect()
    check_base(got, table, lambda d: not learn[d])


def test_edges(spark):
    data = [(k, t, "s", 1.0) for k, t in enumerate(TEXTS)] + [(None, "the cat", "s", 1.0), (3, None, "s", 1.0)]
    df = spark.createDataFrame(data, "doc_id long, text string, key string, score double")
    rows = score_documents(spark, df, fold(F.col("doc_id"), 7) == 2).collect()
    assert len(rows) == len(data)
    twice = [r for r in rows if r.doc_id == 3]
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0].n_tokens == 1
    none = score_documents(spark, df, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in none)
    depth = trees_of(np.zeros((256, 256), "i8")).length[32 * 256 + 10]
    assert {r.doc_id: r.score for r in none}[2] == pytest.approx(-depth * math.log10(2), rel=1e-3)
    assert score_documents(spark, df.limit(0), F.lit(False)).collect() == []


def test_long_texts_are_coded_whole(spark, monkeypatch):
    """No border changes how a text is scored: alone or beside others, in one stretch or many."""
    text = " ".join(f"w{k * 7919 % 30011:x} and" for k in range(30_000))  # over 256 KiB
    table = [(1, text), (2, text + " more"), (7, "y" * 300_000), (8, "short one"), (12, text)]
    df = spark.createDataFrame(table, "doc_id long, text string")
    rows = {r.doc_id: r for r in score_documents(spark, df, F.col("doc_id") == 12).collect()}
    check_base(list(rows.values()), table, lambda d: d == 12)
    assert rows[12].bits_per_byte < 0.05  # it has two copies to be predicted by
    monkeypatch.setattr(mixture, "ENTRIES", 1 << 14)
    monkeypatch.setattr(mixture, "STRETCH", 1000)
    again = {r.doc_id: r for r in score_documents(spark, df, F.col("doc_id") == 12).collect()}
    assert all(again[d].score == pytest.approx(rows[d].score, rel=1e-4) for d in rows)


def test_tables_grow():
    assert table_bits(0) == mixture.LEAST_BITS
    assert table_bits(1 << 18)[2] == 22 and table_bits(1 << 20)[2] == 23 and table_bits(1 << 28)[2] == 27
    zeros, ones = np.array([0, 0, 5, 900]), np.array([0, 3, 0, 1])
    x = packed_logits(zeros, ones)
    assert np.abs(LOGITS[x] - np.clip(np.log((ones + 0.4) / (zeros + 0.4)), -mixture.CLIP, mixture.CLIP)).max() < 0.14 and (x & 3).tolist() == [0, 2, 2, 3]
    assert (INPUTS, FLAG_GATES) == Mixer.flags().weights.shape


def test_every_text_tunes_or_not_alike(spark, monkeypatch):
    held = []
    monkeypatch.setattr(mixture, "tuned", lambda s, j, m, f=mixture.tuned: held.append((sum(sum(r.tune) for r in j.select("tune").collect()), f(s, j, m))) or held[-1][1])
    table = [(None, f"text{k} of its own k{k * k} " * (1 + 4000 * (k % 40 == 0))) for k in range(400)]  # one doc_id, many texts, some long
    df = spark.createDataFrame(table, "doc_id long, text string")
    score_documents(spark, df, F.lit(False)).count()
    score_documents(spark, df.repartition(5), F.lit(False)).count()
    assert held[0][0] == held[1][0] and 10 < held[0][0] < 50
    for mixer, new in zip(held[0][1], (Mixer.spelling(), Mixer.flags())):
        assert not np.allclose(mixer.weights, new.weights) and not np.allclose(mixer.ones, new.ones)


def test_packed_numbers_come_back():
    rng = np.random.default_rng(4)
    keys = np.sort(rng.integers(0, 2**64, 1000, dtype="u8"))
    some = [mixture.rises(keys), rng.integers(0, 300, 1000), np.zeros(1000, "i8"), rng.integers(-5, 5, 1000)]
    back = mixture.unpacked(mixture.packed(*some), 4)
    assert all((a == b).all() for a, b in zip(some, back)) and (mixture.risen(back[0]) == keys).all()
    for n in (0, 1):
        assert [x.tolist() for x in mixture.unpacked(mixture.packed(np.full(n, -7), np.zeros(n, "i8")), 2)] == [[-7] * n, [0] * n]
    low = keys >> np.uint64(9) << np.uint64(9)
    assert (mixture.risen(mixture.rises(low, 9), 9) == low).all()
