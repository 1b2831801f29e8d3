import corpus_pipeline
from tests.llm.test_secrets import brute_all
from tests.llm.test_simhash import brute_similar
from weftline.llm import language, secrets, simhash
from weftline.operators import graph

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.columns == docs.columns
        rows, before = out.collect(), docs.collect()
        if name == "language_id":
            assert len(rows) >= 0.97 * sum(language.has_letter(d.text) for d in before) and {r.doc_id for r in rows} <= {d.doc_id for d in before}
        elif name == "near_duplicates":
            ordered = sorted(before, key=lambda d: d.doc_id)
            component = brute_similar([d.text for d in ordered])
            assert sorted(r.doc_id for r in rows) == sorted(ordered[k].doc_id for k in set(component))
        elif name == "secret_scans":
            table = secrets.train(secrets.labelled_samples(spark, docs))
            by = {r.doc_id: r for r in rows}
            assert len(by) == len(before)
            for d in before:
                spans, at, want = brute_all(d.text, table), 0, ""
                for a, _, b, _ in spans:
                    if a >= at:
                        want += d.text[at:a] + "[secret]"
                    at = max(at, b)
                want += d.text[at:]
                assert by[d.doc_id].text == want and by[d.doc_id].n_chars == (len(want) if spans else d.n_chars)
        elif name == "source_mixing":
            kept = {d.doc_id: d.text for d in before}
            assert all(r.text == kept[r.doc_id] for r in rows)
            assert max(sum(1 for x in rows if x.doc_id == r.doc_id) for r in rows[:20]) <= 2
        else:
            once, seen = [], set()
            for r in rows:
                if (r.doc_id, r.piece) not in seen:
                    seen.add((r.doc_id, r.piece))
                    once.append(r)
            pieces = {}
            for r in rows:
                pieces.setdefault((r.doc_id, r.piece), []).append(r.length)
            assert all(len(set(v)) == 1 for v in pieces.values())
            assert {d.doc_id for d in before} == {r.doc_id for r in rows}
        docs = spark.createDataFrame(rows, out.schema) if rows else out


def test_edges(spark):
    words = "the cat and the dog sat on a mat near some door with many other things "
    data = [(k, words * (k % 3 + 1) + f"nr {k} " * (k % 5), "en", None, 1) for k in range(60)]
    data += [(None, words, None, None, None), (None, None, None, None, None), (70, "", "en", "b", 0), (71, None, None, "b", None), (5, data[5][1], "en", None, 1)]
    docs = spark.createDataFrame([(*d, "x", "y") for d in data], COLUMNS + ", spans string, rejected string")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "nowhere")
        rows = out.collect()
        assert rows
        assert stage(spark, docs.limit(0), "nowhere").collect() == []
        docs = spark.createDataFrame(rows, out.schema)


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows  # which can be read, though what they were made from is deleted
    spans = {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in spans.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048


def test_one_row_of_each_component_stays(spark):
    a, b, c, d = ("one two three four", "quite another text here", "a third thing altogether now", "and the last of these texts")
    data = [(None, a), (None, b), (None, b), (7, c), (7, d), (8, c), (3, d), (9, "far from all of the others"), (9, a)]
    docs = spark.createDataFrame([(i, t, "en", None, 1) for i, t in data], COLUMNS)
    rows = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "nowhere").collect()]
    assert sorted(rows, key=str) == sorted([(9, a), (None, b), (7, c), (3, d), (9, data[7][1])], key=str)


def test_copies_of_one_document_under_another_id(spark):
    data = [(3, "a text of some words that is here"), (5, "a text of some words that is here"), (5, "and something else altogether in this one")]
    docs = spark.createDataFrame([(i, t, "en", None, 1) for i, t in data], COLUMNS)
    assert sorted((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "nowhere").collect()) == sorted([data[0], data[2]])


def test_near_duplicates_join_by_shuffle_only(spark, monkeypatch):
    plans, write = {}, simhash.materialize
    planned = lambda df: df._jdf.queryExecution().executedPlan().toString()

    def noted(session, df, label):
        plans.setdefault(label, []).append(planned(df))
        return write(session, df, label)

    for module in (simhash, graph, corpus_pipeline):
        monkeypatch.setattr(module, "materialize", noted)
    words = [f"word{k}" for k in range(60)]
    alike = [" ".join(["other" if at in (k, k // 2, 59 - k) else w for at, w in enumerate(words)]) for k in range(60)]
    data = [(k, t) for k, t in enumerate([*alike, *alike[:9], "a text of its own"])] + [(3, alike[3])]
    docs = spark.createDataFrame([(i, t, "en", None, 1) for i, t in data], COLUMNS)
    last = corpus_pipeline.drop_near_duplicates(spark, docs, "nowhere")
    assert {"members", "pairs", "components", "prefixes", "classes", "firsts"} <= set(plans)
    assert not [label for label, found in [*plans.items(), ("result", [planned(last)])] if "Broadcast" in "".join(found)]
    texts = [t for _, t in data]
    assert last.count() == len(set(brute_similar(texts)))
