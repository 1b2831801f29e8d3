import numpy as np
from pyspark.sql import functions as F

from weftline.llm import neighbours
from weftline.llm.neighbours import op2_neighbours, search


def brute(rows, queries, top=20):
    out = {}
    for q, v in queries:
        scored = sorted(((-float((np.array(w) * np.array(v)).sum()), k) for k, w in rows if k != q))[:top]
        out[q] = [(k, -s) for s, k in scored]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


def test_recall_on_whole_table(spark):
    for sf in ("0.01", "0.1"):
        table = [(r.vec_id, np.array(r.embedding, "f8")) for r in spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet").collect()]
        want = brute(table, [x for x in table if x[0] % 20 == 0])
        got = by_query(op2_neighbours(spark, f"/root/testdata/sf{sf}").collect())
        assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
        exact = dict(table)
        assert all(abs(s - float((exact[k] * exact[q]).sum())) < 1e-12 for q, v in got.items() for k, s in v)
        assert np.mean([len({k for k, _ in got[q]} & {k for k, _ in want[q]}) / 20 for q in want]) >= 0.95


def test_copies_ties_and_unusable_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(2)
    rows = [(k, [1.0, 2.0, 3.0, 4.0]) for k in range(150)] + [(k, rng.normal(size=4).tolist()) for k in range(150, 260)]
    odd = [(None, [1.0] * 4), (400, None), (420, [0.0] * 4), (440, [1.0, None, 0.0, 0.0]), (460, [float("nan")] * 4), (480, [float("inf"), 0.0, 0.0, 0.0]), (500, [9.0] * 3), (520, [])]
    df = spark.createDataFrame([(k, v, 1) for k, v in rows + odd], "vec_id long, embedding array<double>, block int")
    got = by_query(search(spark, df, lambda i: i % 20 == 0).collect())
    want = brute(rows, [x for x in rows if x[0] % 20 == 0])
    assert {q: [k for k, _ in v] for q, v in got.items()} == {q: [k for k, _ in v] for q, v in want.items()}
    few = df.where(F.col("vec_id").isin(20, 21, 22))
    assert {q: len(v) for q, v in by_query(search(spark, few, lambda i: i % 20 == 0).collect()).items()} == {20: 2}
    assert search(spark, df.where("vec_id = 400"), lambda i: i % 20 == 0).collect() == []
    assert search(spark, df.limit(0), lambda i: i % 20 == 0).collect() == []
    alone = df.where("vec_id = 40")
    assert search(spark, alone, lambda i: i % 20 == 0).collect() == []


def test_repeated_ids(spark, monkeypatch):
    one = [1.0, 2.0, 3.0]
    copies = spark.createDataFrame([(20, one)] * 30 + [(k, one) for k in range(21, 40)], "vec_id long, embedding array<double>")
    rows = search(spark, copies, lambda i: i % 20 == 0).collect()
    assert len(rows) == 30 * 19
    assert all(sorted(r.vec_id for r in rows if r["rank"] == k) == [20 + k] * 30 for k in range(1, 20))
    rng = np.random.default_rng(3)
    others = [(k, rng.normal(size=3).tolist()) for k in range(1, 60) if k not in (20, 40)]
    twice = [(20, one), (20, [-1.0, 0.5, 0.0]), (40, one), (40, one)] + others + [(7, others[3][1]), (7, [9.0, 9.0, 9.0])]
    for size in (16_384, 1):  # all queries of a block in one task, and one in each
        monkeypatch.setattr(neighbours, "QUERY_ROWS", size)
        got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in search(spark, spark.createDataFrame(twice, copies.schema), lambda i: i % 20 == 0).collect())
        want = []
        for q, v in twice:
            if q % 20 == 0:
                best = sorted((-float(np.dot(w, v)), k) for k, w in twice if k != q)[:20]
                want += [(q, n + 1, k, round(-s, 9)) for n, (s, k) in enumerate(best)]
        assert got == sorted(want)


def test_lengths_are_searched_apart(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=3 + k % 2).tolist()) for k in range(15, 85)]
    got = by_query(search(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 5 == 0).collect())
    for q, found in got.items():
        want = brute([r for r in rows if len(r[1]) == 3 + q % 2], [(q, dict(rows)[q])])[q]
        assert [k for k, _ in found] == [k for k, _ in want]
    assert len(got) == 14
