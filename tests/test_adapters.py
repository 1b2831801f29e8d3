from pyspark.sql import functions as F

from weftline.plans import adapters


def test_interactions(spark):
    rows = spark.createDataFrame([("9606.P2", "9606.P1", "900"), ("9606.P1", "9606.P3", "399"), ("9606.P4", "9606.P4", "950"), ("9606.P3", "9606.P5", "400")], "protein1 string, protein2 string, combined_score string")
    assert sorted(adapters.interactions(rows).collect()) == [("ENSEMBL:P1", "ENSEMBL:P2", 900), ("ENSEMBL:P3", "ENSEMBL:P5", 400)]
    assert adapters.interactions(rows, most=2).count() == 2
    edges = spark.createDataFrame([("a", "b", 1, "STRING"), ("a", "b", 3, "BioPlex")], "start_id string, end_id string, score int, source string")
    assert sorted(adapters.interaction_rows(edges).collect()) == [("a", "b", 3, ["BioPlex", "StringDB"]), ("b", "a", 3, ["BioPlex", "StringDB"])]
    p = spark.createDataFrame([("Q-1", "A", "0.1", "0.2", "0.7")], "UniprotA string, UniprotB string, pW string, pNI string, pInt string")
    assert adapters.probability_interactions(p).collect() == [("UniProtKB:A", "UniProtKB:Q", [0.1], [0.2], [0.7])]


def test_expression(spark):
    cells = [("g.1", s, v) for s, v in (("S-1-a", 2.0), ("S-2-b", 4.0), ("S-3-c", 9.0), ("S-1-d", 10.0))]
    matrix = spark.createDataFrame(cells, "name string, sample string, value double")
    samples = spark.createDataFrame([("S-1-a", "Liver", None, "1"), ("S-2-b", "Liver", None, None), ("S-3-c", "Liver", None, "1"), ("S-1-d", None, "Brain", "0")], "SAMPID string, SMTSD string, SMTS string, SMATSSCR string")
    subjects = spark.createDataFrame([("S-1", "1", "0"), ("S-2", "2", None), ("S-3", "1", "4")], "SUBJID string, SEX string, DTHHRDY string")
    got = {r.tissue: r for r in adapters.expression_edges(matrix, samples, subjects).collect()}
    assert (got["Liver"].value, got["Liver"].male, got["Liver"].female, got["Liver"]["rank"]) == (3.0, 2.0, 4.0, 0.0)
    assert got["Brain"]["rank"] == 1.0 and abs(got["Brain"].tau - 0.7) < 1e-12
    rows = spark.createDataFrame([("g", "liver", "x", "High", "Approved"), ("g", "liver", "y", "Low", "Approved"), ("g", "brain", "z", "Low", "Uncertain")], "Gene string, Tissue string, `Cell type` string, Level string, Reliability string")
    tissues = spark.createDataFrame([("liver", "UBERON:1"), ("brain", "UBERON:2")], "name string, tissue_id string")
    (row,) = adapters.staining_edges(rows, tissues).collect()
    assert (row.gene_id, row.tissue_id, row.level, len(row.details)) == ("ENSEMBL:g", "UBERON:1", 3, 2)


def test_orthologs(spark):
    rows = spark.createDataFrame(
        [("mouse", "HGNC:1", "7", "E", "MGI:5", "8", "EM", "OMA, Inparanoid"), ("mouse", "-", "-", "-", "-", "-", "-", "OMA"), ("zebrafish", "HGNC:2", "1", "2", "ZFIN:1", "-", "-", "OMA"), ("rat", "-", "9", "-", "-", "-", "ER", "EggNOG")],
        "ortholog_species string, hgnc_id string, human_entrez_gene string, human_ensembl_gene string, ortholog_species_db_id string, ortholog_species_entrez_gene string, ortholog_species_ensembl_gene string, support string",
    )
    got = adapters.orthologs(rows, ["mouse", "rat"])
    assert sorted((r.human_id, r.ortholog_id, r.support) for r in got.collect()) == [("HGNC:1", "MGI:5", ["Inparanoid", "OMA"]), ("NCBIGene:9", "ENSEMBL:ER", ["EggNOG"])]
    assert adapters.well_supported(got).count() == 1


def test_flags_and_codes(spark):
    edges = spark.createDataFrame([("Kinase", [(7.5,), (7.6,)]), ("GPCR", [(6.9,)]), (None, [(6.0,)]), ("Kinase", None)], "family string, details array<struct<act_value double>>")
    assert [r.meets_cutoff for r in adapters.activity_flags(edges).collect()] == [True, False, True, False]
    codes = spark.createDataFrame([("1.2.3.4",), ("1.2.-.-",), ("3.-.-.-",)], "ec string")
    assert sorted(map(tuple, adapters.ec_parents(codes).collect())) == [("1.2.-.-", "1.-.-.-"), ("1.2.3.-", "1.2.-.-"), ("1.2.3.4", "1.2.3.-")]
    records = spark.createDataFrame([("HMDB:1", "CHEBI:5", "12"), ("HMDB:2", "", None)], "id string, chebi string, pubchem string")
    assert sorted(map(tuple, adapters.cross_references(records, "id", {"chebi": "CHEBI", "pubchem": "CID"}, "hmdb").collect())) == [("HMDB:1", "CHEBI:5", "hmdb", "chebi"), ("HMDB:1", "CID:12", "hmdb", "pubchem")]


def test_identifier_groups(spark):
    active = spark.createDataFrame([(x,) for x in "abcdefg"], "id string")
    edges = spark.createDataFrame([("a", "b"), ("c", "d"), ("e", "zz")], "start_id string, end_id string")
    support = spark.createDataFrame([("a", "main"), ("b", "other"), ("c", "main"), ("d", "main"), ("e", "minor"), ("f", "other")], "id string, source string")
    got = {r.id: r.component for r in adapters.identifier_groups(spark, active, edges, support, "main", ["minor"]).collect()}
    assert got == {"a": "a", "b": "a", "f": "f", "g": "g"}


def test_traits(spark):
    st = spark.createDataFrame([("E1", "T1", 0.5), ("E2", "T1", 0.1)], "ensemblId string, efoId string, score double")
    pr = spark.createDataFrame([("E1", "T1", "S2"), ("E1", "T1", "S1"), ("E1", "T1", "S1")], "ensemblId string, efoId string, study string")
    got = {r.ensemblId: r.provenance for r in adapters.trait_edges(st, pr).collect()}
    assert [p.study for p in got["E1"]] == ["S1", "S2"] and got["E2"] is None
    best = adapters.best_scores(st.withColumn("k", F.lit(1)), ["k"], "score")
    assert best.first().ensemblId == "E1"
