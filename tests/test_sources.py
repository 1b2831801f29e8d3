import gzip

import pytest

from weftline.sources import readers


def test_delimited(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('x\ty\n1\t"q\n')
    assert readers.delimited(spark, str(tmp_path / "a.tsv"), expected=["x", "y"]).collect() == [("1", '"q')]
    with pytest.raises(ValueError):
        readers.delimited(spark, str(tmp_path / "a.tsv"), expected=["x", "z"])
    with gzip.open(tmp_path / "b.tsv.gz", "wt") as f:
        f.write("!c\n1\t2\n")
    assert readers.delimited(spark, str(tmp_path / "b.tsv.gz"), ["a", "b"], comment="!").collect() == [("1", "2")]


def test_whitespace_and_packed(spark, tmp_path):
    (tmp_path / "w").write_text("protein1 protein2 score\n a  b\t900\n\n")
    assert readers.whitespace(spark, str(tmp_path / "w"), ["protein1", "protein2", "score"]).collect() == [("a", "b", "900")]
    (tmp_path / "p").write_text("P1\t12 7 12\nP2\t\nbad\n")
    assert sorted(readers.packed_tokens(spark, str(tmp_path / "p")).collect()) == [("P1", "12"), ("P1", "12"), ("P1", "7")]


def test_matrix_and_sets(spark, tmp_path):
    (tmp_path / "m.gct").write_text("#1.2\n2\t2\nName\tDescription\tS1\tS2\ng1\td1\t1.5\tNA\n")
    assert sorted(readers.gct(spark, str(tmp_path / "m.gct")).collect()) == [("g1", "d1", "S1", 1.5), ("g1", "d1", "S2", None)]
    (tmp_path / "s.gmt").write_text("A path%WP%WP12%Homo sapiens\thttp://x\t10\tzz\t\nB%WP%WP1%Mus musculus\tu\t5\n")
    sets = readers.gmt(spark, str(tmp_path / "s.gmt"))
    assert sets.count() == 3
    assert readers.wikipathways(sets).collect() == [("A path", "WP12", "10")]


def test_ontologies(spark, tmp_path):
    (tmp_path / "o.obo").write_text('format: 1\n\n[Term]\nid: X:1\nname: one: two\nsynonym: "a"\nsynonym: "b"\n\n[Typedef]\nid: r\n\n[Term]\nid: X:2\nis_a: X:1\n')
    got = {(r.id, r.tag): r["values"] for r in readers.stanzas(spark, str(tmp_path / "o.obo")).collect()}
    assert got == {("X:1", "id"): ["X:1"], ("X:1", "name"): ["one: two"], ("X:1", "synonym"): ['"a"', '"b"'], ("X:2", "id"): ["X:2"], ("X:2", "is_a"): ["X:1"]}
    (tmp_path / "g.json").write_text('{"graphs":[{"nodes":[{"id":"a","lbl":"A","type":"CLASS"},{"id":"b","lbl":"B","type":"CLASS"},{"id":"c","type":"CLASS","meta":{"deprecated":true}}],"edges":[{"sub":"a","pred":"is_a","obj":"b"},{"sub":"a","pred":"is_a","obj":"c"},{"sub":"b","pred":"part","obj":"a"}]}]}')
    nodes, edges = readers.ontology_graph(spark, str(tmp_path / "g.json"))
    assert sorted(nodes.collect()) == [("a", "A"), ("b", "B")] and edges.collect() == [("a", "b")]


def test_records(spark, tmp_path):
    (tmp_path / "x.sdf").write_text("M1\nline\n> <ID>\n7\n\n> <NAME>\nn one\n\n$$$$\nM2\n> <ID>\n8\n\n$$$$\n")
    assert sorted((r.record, tuple(sorted(r.properties.items()))) for r in readers.sdf(spark, str(tmp_path / "x.sdf")).collect()) == [("M1", (("ID", "7"), ("NAME", "n one"))), ("M2", (("ID", "8"),))]
    (tmp_path / "e.dat").write_text("CC   head\n//\nID   1.1.1.1\nDE   alcohol.\nAN   x\nAN   y\n//\n")
    assert {(r.id, r.code): r["values"] for r in readers.flat_records(spark, str(tmp_path / "e.dat")).collect()} == {("1.1.1.1", "ID"): ["1.1.1.1"], ("1.1.1.1", "DE"): ["alcohol."], ("1.1.1.1", "AN"): ["x", "y"]}
    (tmp_path / "f.gff").write_text("#h\nc1\ts\tgene\t5\t9\t.\t+\t.\tID=g1;Name=n\n")
    (row,) = readers.gff(spark, str(tmp_path / "f.gff")).collect()
    assert (row.start, row.end, row.attributes) == (5, 9, {"ID": "g1", "Name": "n"})
    (tmp_path / "t.nt").write_text('<a> <b> <c> .\n<a> <d> "x y" .\n# no\n')
    assert sorted(readers.triples(spark, str(tmp_path / "t.nt")).collect()) == [("a", "b", "c"), ("a", "d", "x y")]
    (tmp_path / "r.xml").write_text("<all><r><id>1</id></r><r><id>2</id></r></all>")
    assert readers.xml_records(spark, str(tmp_path / "r.xml"), "r", "id string").count() == 2


def test_cap_counts_kept_rows(spark):
    from pyspark.sql import functions as F

    assert readers.kept_rows(spark.range(100), F.col("id") % 2 == 1, 5).where("id % 2 = 0").count() == 0
