import math
import zlib
from collections import Counter

import numpy as np

from weftline.llm import language
from weftline.llm.language import BUCKETS, has_letter, identify, op8_language, subword_counts, train


def test_counts_against_loops(monkeypatch):
    def brute(text):
        raw = b" " + b" ".join(text.lower().encode().translate(language.BLANKED).split()) + b" "
        out = Counter()
        for order in (1, 2, 3, 4):
            for a in range(len(raw) - order + 1):
                key = 0
                for k in range(order):
                    key = (key * 257 + raw[a + k] + k + 1) % (1 << 32)
                out[(key * 2654435769) % (1 << 32) >> 20] += 1
        return out

    for stretch in (1 << 20, 5):
        monkeypatch.setattr(language, "STRETCH", stretch)
        for text in ["a", "Hello, wörld 12 x", "é" * 40]:
            got = subword_counts(text)
            assert len(got) == BUCKETS and {k: v for k, v in enumerate(got) if v} == dict(brute(text))


def test_held_out_accuracy_and_folds(spark):
    table = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang").collect()}
    rows = op8_language(spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == len(table)
    hits = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        text = table[r.doc_id].text
        assert (r.lang_pred == "und") == (not has_letter(text))
        if r.held_out and r.lang_pred != "und":
            hits.append((r.lang_pred == table[r.doc_id].lang, r.rejected))
    assert np.mean([h for h, _ in hits]) > 0.97
    assert np.mean([x for _, x in hits]) < 0.02


def test_edges(spark):
    words = {"xx": "abra kadabra zim bim ", "yy": "lorom ipsim dolur et "}
    rows = [(k, words[lang] * (k % 7 + 1), lang, "s", 0.5) for k in range(120) for lang in (("xx", "yy")[k % 2],)]
    rows += [(200, None, "xx", "s", 0.5), (201, "", None, "s", 0.5), (202, "12 !?", "yy", "s", 0.5), (None, "abra zim", None, "s", 0.5), (203, "dolur et " * 200000, None, "s", 0.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")
    model = train(df)
    assert model.langs == ["xx", "yy"]
    out = identify(spark, df, model)
    assert out.columns == [*df.columns, "_lang_pred", "_score", "rejected"]
    got = {r.doc_id: r for r in out.collect()}
    assert [got[k]["_lang_pred"] for k in (200, 201, 202, None, 203)] == ["und", "und", "und", "xx", "yy"]
    assert [got[k]["rejected"] for k in (200, 201, 202, 203)] == [True, True, True, False]
    assert train(df.where("lang is null")) is None and train(df.limit(0)) is None
    assert {r["_lang_pred"] for r in identify(spark, df, None).collect()} == {"und"}
    assert identify(spark, df.limit(0), model).collect() == []


def brute_fit(rows, dim):
    """Training, calibration and threshold in plain loops, over rows (buckets -> mean, language) in their order."""
    names = sorted({lang for _, lang in rows})
    rng = np.random.default_rng(7)
    emb, w, b = rng.normal(0, 0.5, (BUCKETS, dim)).tolist(), rng.normal(0, 0.5, (dim, len(names))).tolist(), [0.0] * len(names)
    held = [k for k in range(len(rows)) if k % 5 == 0]
    train_rows = np.array([k for k in range(len(rows)) if k % 5])
    scale = [1e-8] * BUCKETS

    def logits(x, emb, w, b):
        hidden = [sum(v * emb[k][d] for k, v in x.items()) for d in range(dim)]
        return hidden, [sum(h * w[d][c] for d, h in enumerate(hidden)) + b[c] for c in range(len(names))]

    def soft(z):
        e = [math.exp(v - max(z)) for v in z]
        return [v / sum(e) for v in e]

    for epoch in range(language.EPOCHS):
        rng.shuffle(train_rows)
        for a in range(0, len(train_rows), language.BATCH):
            some = [rows[k] for k in train_rows[a : a + language.BATCH]]
            back, dw, db = {}, [[0.0] * len(names) for _ in range(dim)], [0.0] * len(names)
            for x, lang in some:
                hidden, z = logits(x, emb, w, b)
                g = [(p - (names[c] == lang)) / len(some) for c, p in enumerate(soft(z))]
                up = [sum(g[c] * w[d][c] for c in range(len(names))) for d in range(dim)]
                for k, v in x.items():
                    own = back.setdefault(k, [0.0] * dim)
                    for d in range(dim):
                        own[d] += v * up[d]
                for c, v in enumerate(g):
                    db[c] += v
                    for d in range(dim):
                        dw[d][c] += hidden[d] * v
            rate = language.RATE * (1 - epoch / language.EPOCHS) + 0.01
            for c in range(len(names)):
                b[c] -= rate * db[c]
                for d in range(dim):
                    w[d][c] -= rate * dw[d][c]
            for k, own in back.items():
                scale[k] += sum(v * v for v in own) / dim
                emb[k] = [e - rate * v / math.sqrt(scale[k]) for e, v in zip(emb[k], own)]
    found = [(logits(rows[k][0], emb, w, b)[1], names.index(rows[k][1])) for k in held]
    heat = min(np.geomspace(0.05, 20, 60).tolist(), key=lambda t: -sum(math.log(soft([v / t for v in z])[c] + 1e-12) for z, c in found))
    scored = sorted(((max(p := soft([v / heat for v in z])), p.index(max(p)) == c) for z, c in found), reverse=True)
    threshold = 1.0
    for n in range(1, len(scored) + 1):
        if sum(not right for _, right in scored[:n]) <= language.MOST_ERROR * n:
            threshold = scored[n - 1][0] if n < len(scored) else 0.0
    return lambda x: soft([v / heat for v in logits(x, emb, w, b)[1]]), names, min(max(language.LEAST_SCORE, threshold), 0.99)


def test_fit_and_prediction_against_loops(monkeypatch):
    monkeypatch.setattr(language, "DIM", 3)
    monkeypatch.setattr(language, "EPOCHS", 3)
    rng = np.random.default_rng(5)
    words = {"aa": "solu mira tena pol", "bb": "krat strun vlod gnesk", "cc": "ouie aeau yaoi"}
    texts = [(" ".join(rng.choice(words[lang].split(), 3)) + " shared", lang) for _ in range(30) for lang in words]
    texts += [("krat strun", "aa"), ("solu mira", "bb")]  # wrong labels, for the threshold
    made = []
    for t, lang in texts:
        c = subword_counts(t)
        made.append(({int(k): float(np.float32(c[k] / c.sum())) for k in np.flatnonzero(c)}, lang))
    means = np.zeros((len(made), BUCKETS), "f4")
    for row, (x, _) in zip(means, made):
        row[list(x)] = list(x.values())
    model = language.fit(means, [lang for _, lang in made])
    predict, names, threshold = brute_fit(made, 3)
    assert model.langs == names and abs(model.threshold - threshold) < 1e-4
    got_names, scores, rejected = language.predictions(model, [t for t, _ in texts])
    for (t, _), name, score, out in zip(texts, got_names, scores, rejected):
        c = subword_counts(t)
        p = predict({int(k): c[k] / c.sum() for k in np.flatnonzero(c)})
        assert abs(max(p) - score) < 1e-3 and names[p.index(max(p))] == name and (out == (score < model.threshold))


def test_every_language_teaches_and_draws_ignore_partitions(spark):
    rows = [(k % 50, f"zork{k % 700} blif{k % 700}x" if k < 1400 else "common words again and again", f"l{k % 700:03}" if k < 1400 else "big") for k in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    a, b = train(df, 200), train(df.repartition(7), 200)
    assert len(a.langs) == 701 and a.langs == b.langs and (a.embeddings == b.embeddings).all()  # more languages than 512, and than rows to fit
    counts = {r.lang: r["count"] for r in language.sample(df, 1500).groupBy("lang").count().collect()}
    assert len(counts) == 701 and counts.pop("big") == 2 and set(counts.values()) == {1}  # two rows of each are the same
    same = spark.createDataFrame([(None, "one text only here", "xx")] * 500 + [(None, f"other words nr {k}", "yy") for k in range(500)], df.schema)  # a null id, and copies
    assert {r.lang: r["count"] for r in language.sample(same, 100).groupBy("lang").count().collect()} == {"xx": 1, "yy": 50}
