import random
import re

import xxhash
from pyspark.sql import functions as F

from weftline.llm import simhash
from weftline.llm.simhash import WIDTHS, fingerprint, links, near_duplicates, op5_simhash, segment_counts, similar_components, similar_links


def brute_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(ids, fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for k in range(len(fps)):
        low[find(k)] = min(low.get(find(k), ids[k]), ids[k])
    return [low[find(k)] for k in range(len(fps))]


def test_fingerprint_against_brute_force():
    for t in [None, "", " \t", "One", "one TWO", "a b c", "É é\x0bx y z w " * 9, "a b c d " * 10000]:
        assert fingerprint(t) == brute_fp(t)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_against_brute_force(spark):
    rng = random.Random(5)
    points = set()
    for _ in range(30):
        base = rng.getrandbits(64)
        points.add(base)
        for _ in range(rng.choice((0, 3, 60))):
            points.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.choice((1, 2, 3)))))
    points = sorted(points | {0, 1, (1 << 64) - 1, 1 << 63})
    df = spark.createDataFrame([(signed(p),) for p in points], "fp long")
    for width in WIDTHS:
        counts = {r.fp: r.c for r in df.select("fp", segment_counts(F.col("fp"), width).alias("c")).collect()}
        assert all(counts[signed(p)] == signed(sum((p >> width * k & (1 << width) - 1).bit_count() << width * k for k in range(64 // width))) for p in points)
    want = brute_components(list(range(len(points))), points)
    for crowd in (2, 8, 32, 10**6):
        at = {signed(p): k for k, p in enumerate(points)}
        got = list(range(len(points)))

        def find(x):
            while got[x] != x:
                x = got[x]
            return x

        for r in links(spark, df, crowd).collect():
            a, b = at[r.src], at[r.dst]
            assert (points[a] ^ points[b]).bit_count() <= 2
            got[max(find(a), find(b))] = min(find(a), find(b))
        assert [find(k) for k in range(len(points))] == want


def test_spread_cells_are_never_broadcast(spark, monkeypatch):
    plans, write = [], simhash.materialize

    def noted(session, df, label):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return write(session, df, label)

    monkeypatch.setattr(simhash, "materialize", noted)
    rng = random.Random(3)
    base = rng.getrandbits(63)
    df = spark.createDataFrame([(base ^ 1 << k,) for k in range(60)], "fp long")
    assert links(spark, write(spark, df, "points")).count() >= 59
    spread = [p for label, p in plans if label == "members"]
    assert len(spread) > 1 and all("Broadcast" not in p and "Generate" in p for p in spread)


def test_query_on_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    ids, fps = [d.doc_id for d in table], [brute_fp(d.text) for d in table]
    want = dict(zip(ids, zip(fps, brute_components(ids, fps))))
    rows = op5_simhash(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(table)
    assert all((int(r.fingerprint, 16), r.component_id) == want[r.doc_id] and len(r.fingerprint) == 16 for r in rows)


def test_edges(spark):
    rows = [(3, None, 1), (2, "", 1), (5, "x y z w", 1), (5, "x y z w", 1), (None, "x y z w", 1), (None, "alone in here", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    got = sorted(((r.doc_id, r.component_id) for r in near_duplicates(spark, df).collect()), key=str)
    assert got == sorted([(3, 2), (2, 2), (5, 5), (5, 5), (None, 5), (None, None)], key=str)
    assert near_duplicates(spark, df.limit(0)).collect() == []


def brute_set(text, shingle=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))) if words else frozenset()


def brute_similar(texts, least=0.8):
    """The least number of a text that links of sets lead to, for each text."""
    sets, parent = [brute_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] == sets[b] or len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(k) for k in range(len(texts))]


def near_copies(rng):
    words = [f"word{k}" for k in range(400)]
    texts = []
    for _ in range(12):
        base = rng.choices(words, k=rng.choice((8, 60, 300)))
        texts.append(base)
        for _ in range(rng.choice((0, 2, 25))):
            copy = list(base)
            for _ in range(rng.choice((0, 1, 2, 6, 20)) * len(base) // 300 + rng.choice((0, 1))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
    return [" ".join(t) for t in texts] + ["", None, " \t", "one", "ONE", "one two", "a b c d e", "A b c d  e", "a b c d e f"]


def test_similar_components_against_brute_force(spark):
    texts = near_copies(random.Random(8))
    want = brute_similar(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in similar_components(spark, df).collect()}
    # nothing unlike is joined; of what is alike, texts at the edge of a large group may stay apart
    assert all(want[k] == want[got[k]] for k in range(len(texts))) and sum(got[k] != want[k] for k in range(len(texts))) <= 0.02 * len(texts)
    assert len(set(got.values())) < len(texts) - 20
    assert similar_components(spark, df.limit(0)).collect() == []
    twice = df.union(df).union(spark.createDataFrame([(None, "one"), (None, "nobody else")], df.schema))
    rows = similar_components(spark, twice).collect()
    assert len(rows) == 2 * len(texts) + 2 and {r.component_id for r in rows if r.doc_id is None} == {texts.index("one"), None}


def test_pairs_and_small_groups_are_all_found(spark):
    rng, texts = random.Random(11), []
    for k in range(40):
        base = [f"w{rng.randrange(5000)}" for _ in range(100)]
        for _ in range(rng.choice((2, 3, 4))):
            copy = list(base)
            copy[rng.randrange(100)] = "other"
            texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.component_id for r in sorted(similar_components(spark, df).collect(), key=lambda r: r.doc_id)] == brute_similar(texts)


def test_a_group_costs_a_few_comparisons_a_member(spark):
    sets = [(k, [*range(40), -k, -1000 - k]) for k in range(1, 400)] + [(0, [*range(40)])]
    members = spark.createDataFrame([(c, k, len(v)) for c in (1, 2, 3) for k, v in sets], "cell long, key long, n long")
    found = similar_links(spark, members, spark.createDataFrame(sets, "key long, shingles array<long>"), 0.8).collect()
    assert len(found) < 4 * len(sets) and {x for r in found for x in (r.src, r.dst)} == {k for k, _ in sets}


def test_large_groups_lose_no_link(spark):
    rng, sets, fresh = random.Random(21), [], iter(range(10**6, 10**9))
    bases = [list(range(1000 * k, 1000 * k + 60)) for k in range(3)]
    for base in bases:  # crowds about three middles, and pairs and chains that are like each other only
        for _ in range(40):
            kept = rng.sample(base, rng.choice((52, 54, 56, 58)))
            sets.append(kept + [next(fresh) for _ in range(60 - len(kept))])
        for _ in range(12):
            mate = rng.sample(base, 60 - rng.choice((9, 12, 20)))
            mate += [next(fresh) for _ in range(rng.choice((60, 57, 63)) - len(mate))]
            for _ in range(rng.choice((1, 2, 3))):
                sets.append(list(mate))
                mate = [x if rng.random() > 0.06 else next(fresh) for x in mate] + [next(fresh) for _ in range(rng.choice((0, 0, 4)))]
    sets = [(k, sorted(set(v))) for k, v in enumerate(sets)]
    cells = [(c, k, len(v)) for c in (1, 2) for k, v in sets]  # two cells that hold all
    parent = {k: k for k, _ in sets}

    def joined(links):
        parent.update({k: k for k in parent})
        for a, b in links:
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            parent[max(a, b)] = min(a, b)

        def top(k):
            return k if parent[k] == k else top(parent[k])

        return {k: top(k) for k in parent}

    like = [(a, b) for a, x in sets for b, y in sets if a < b and len(set(x) & set(y)) >= 0.8 * len(set(x) | set(y))]
    found = [(r.src, r.dst) for r in similar_links(spark, spark.createDataFrame(cells, "cell long, key long, n long"), spark.createDataFrame(sets, "key long, shingles array<long>"), 0.8).collect()]
    assert set(found) <= set(like) and joined(found) == joined(like)
