"""Source adapters: public files' rows to typed node and edge tables. Each is a filter and a projection over a reader's
table; ids are CURIEs, evidence is an array of structs on the edge, undirected pairs stand in canonical order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.ids import curie, ordered_pair, strip_version
from weftline.functions.text import safe_double
from weftline.operators import stats

# fixed values: ordinals of staining levels
LEVELS = {"Not detected": 0, "Low": 1, "Medium": 2, "High": 3}


def interactions(rows: DataFrame, cutoff: int = 400, most: int | None = None) -> DataFrame:
    """(start_id, end_id, score) of ``protein1 protein2 combined_score`` rows: no self pairs, at or above the cut-off;
    taxon prefixes go. A row cap counts the rows that stay."""
    a, b = (F.regexp_replace(c, r"^\d+\.", "") for c in ("protein1", "protein2"))
    start, end = ordered_pair(curie("ENSEMBL", a), curie("ENSEMBL", b))
    kept = rows.where((F.col("combined_score").cast("int") >= cutoff) & (a != b)).select(start.alias("start_id"), end.alias("end_id"), F.col("combined_score").cast("int").alias("score"))
    return kept.limit(most) if most is not None else kept


def probability_interactions(rows: DataFrame) -> DataFrame:
    """(start_id, end_id, p_wrong, p_none, p_int) of pairs with three probabilities, as lists by canonical pair."""
    start, end = ordered_pair(curie("UniProtKB", strip_version(F.col("UniprotA"))), curie("UniProtKB", strip_version(F.col("UniprotB"))))
    flat = rows.where("UniprotA <> UniprotB").select(start.alias("start_id"), end.alias("end_id"), *[safe_double(F.col(c)).alias(n) for c, n in (("pW", "p_wrong"), ("pNI", "p_none"), ("pInt", "p_int"))])
    return flat.groupBy("start_id", "end_id").agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in ("p_wrong", "p_none", "p_int")])


def interaction_rows(edges: DataFrame) -> DataFrame:
    """Both directions of each pair, with the greatest score and the sorted sources (STRING under its database's name)."""
    one = edges.groupBy("start_id", "end_id").agg(F.max("score").alias("score"), F.array_sort(F.collect_set(F.when(F.col("source") == "STRING", "StringDB").otherwise(F.col("source")))).alias("sources"))
    return one.union(one.select(F.col("end_id"), F.col("start_id"), "score", "sources"))


def expression_edges(matrix: DataFrame, samples: DataFrame, subjects: DataFrame) -> DataFrame:
    """(gene_id, tissue, value, male, female, rank, tau) from a long matrix (name, sample, value): medians by tissue.

    Samples count with a known sex, a death code of 2 or less (or none) and an autolysis score below 2 (or none).
    """
    subject = F.array_join(F.slice(F.split("SAMPID", "-"), 1, 2), "-")
    kept = samples.withColumn("SUBJID", subject).join(subjects.where("SEX IN ('1', '2')"), "SUBJID")
    kept = kept.where("coalesce(try_cast(DTHHRDY AS double), 0) <= 2 AND coalesce(try_cast(SMATSSCR AS double), 0) < 2")
    kept = kept.select(F.col("SAMPID").alias("sample"), "SEX", F.coalesce("SMTSD", "SMTS").alias("tissue"))
    cells = matrix.join(kept, "sample").withColumn("gene_id", curie("ENSEMBL", F.regexp_replace("name", r"\.\d+$", "")))
    only = lambda s: F.median(F.when(F.col("SEX") == s, F.col("value")))
    out = cells.groupBy("gene_id", "tissue").agg(F.median("value").alias("value"), only("1").alias("male"), only("2").alias("female"))
    return stats.normalised_rank(out, "gene_id", "value").join(stats.tau(out, "gene_id", "value"), "gene_id")


def staining_edges(rows: DataFrame, tissues: DataFrame) -> DataFrame:
    """(gene_id, tissue_id, level, rank, details): the greatest level of each gene and tissue, with its cell types.

    Rows marked Uncertain go; ``tissues`` (name, tissue_id) maps names.
    """
    level = F.coalesce(*[F.when(F.col("Level") == k, v) for k, v in LEVELS.items()])
    named = rows.where("Reliability <> 'Uncertain'").withColumn("level", level).where("level is not null").join(tissues, F.col("Tissue") == F.col("name"))
    edges = named.groupBy(curie("ENSEMBL", F.col("Gene")).alias("gene_id"), "tissue_id").agg(F.max("level").alias("level"), F.array_sort(F.collect_list(F.struct(F.col("Cell type").alias("cell_type"), F.col("Level").alias("label"), F.col("Reliability").alias("reliability")))).alias("details"))
    return stats.normalised_rank(edges, "gene_id", "level")


def orthologs(rows: DataFrame, species: list[str]) -> DataFrame:
    """(human_id, ortholog_id, species, support): preferred ids, rows without an identity dropped, support sorted."""
    known = lambda c: F.when(~F.col(c).isin("-", "") & F.col(c).isNotNull(), F.col(c))
    human = F.coalesce(known("hgnc_id"), curie("NCBIGene", known("human_entrez_gene")), curie("ENSEMBL", known("human_ensembl_gene")))
    own = F.when(known("ortholog_species_db_id").rlike("^(MGI|RGD):"), known("ortholog_species_db_id"))
    other = F.coalesce(own, curie("NCBIGene", known("ortholog_species_entrez_gene")), curie("ENSEMBL", known("ortholog_species_ensembl_gene")), known("ortholog_species_db_id"))
    out = rows.where(F.col("ortholog_species").isin(*species)).select(human.alias("human_id"), other.alias("ortholog_id"), F.col("ortholog_species").alias("species"), F.array_sort(F.array_distinct(F.filter(F.transform(F.split("support", ","), lambda x: F.trim(x)), lambda x: x != ""))).alias("support"))
    return out.where("human_id is not null and ortholog_id is not null")


def well_supported(edges: DataFrame) -> DataFrame:
    """Orthologs that two or more of three established methods name."""
    return edges.where(F.size(F.array_intersect("support", F.array(*map(F.lit, ("Inparanoid", "OMA", "EggNOG"))))) >= 2)


def text_mined(rows: DataFrame, least: float = 3.0) -> DataFrame:
    """(protein_id, disease_id, details) of text-mined pairs at or above a z-score."""
    z = F.col("zscore").try_cast("double")
    kept = rows.where(z >= least)
    return kept.groupBy(curie("ENSEMBL", F.col("protein")).alias("protein_id"), F.col("disease_id")).agg(F.array_sort(F.collect_list(F.struct(z.alias("zscore"), F.col("confidence").try_cast("double").alias("confidence"), "url"))).alias("details"))


def trait_edges(statistics: DataFrame, provenance: DataFrame, keys: tuple[str, str] = ("ensemblId", "efoId")) -> DataFrame:
    """Gene-trait rows with the list of studies behind each; rows without provenance have none."""
    studies = provenance.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct(*[c for c in provenance.columns if c not in keys]))).alias("provenance"))
    return statistics.join(studies, list(keys), "left")


def activity_flags(edges: DataFrame) -> DataFrame:
    """Ligand edges (family, details) with meets_cutoff, by the family's cut-off."""
    from weftline.operators.rules import meets_cutoff

    return edges.withColumn("meets_cutoff", meets_cutoff(F.col("family"), F.transform("details", lambda x: x["act_value"])))


def best_scores(edges: DataFrame, keys: list[str], score: str, k: int = 1) -> DataFrame:
    """The ``k`` best rows of each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(score), *[c for c in edges.columns if c not in keys and c != score and not c.endswith("details")])
    return edges.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def ec_parents(codes: DataFrame, column: str = "ec") -> DataFrame:
    """(child, parent) of enzyme codes: each code's next wider class, up to the main class."""
    parts = F.split(column, r"\.")
    filled = F.size(F.filter(parts, lambda p: p != "-"))
    wider = F.transform(F.sequence(F.lit(1), F.greatest(filled - 1, F.lit(1))), lambda n: F.array_join(F.concat(F.slice(parts, F.lit(1), n), F.array_repeat(F.lit("-"), 4 - n)), "."))
    chain = F.concat(F.when(filled > 1, wider).otherwise(F.array().cast("array<string>")), F.array(F.col(column)))
    links = F.transform(F.sequence(F.lit(1), F.greatest(F.size(chain) - 1, F.lit(1))), lambda n: F.struct(F.get(chain, n).alias("child"), F.get(chain, n - 1).alias("parent")))
    return codes.where(filled > 1).select(F.inline(links)).distinct()


def cross_references(records: DataFrame, key: str, fields: dict[str, str], source: str) -> DataFrame:
    """(start_id, end_id, source, field) equivalences of records with columns of foreign ids; no self links, each once."""
    each = F.array_compact(F.array(*[F.when(F.col(f).isNotNull() & (F.trim(f) != ""), F.struct(F.lit(f).alias("field"), F.concat(F.lit(f"{p}:"), F.regexp_replace(F.trim(f), f"^{p}:", "")).alias("end_id"))) for f, p in fields.items()]))
    out = records.select(F.col(key).alias("start_id"), F.inline(each)).select("start_id", "end_id", F.lit(source).alias("source"), "field")
    return out.where("start_id <> end_id").distinct()


def incident_type(start_type: Column, end_type: Column, kinds: dict[tuple[str, str], str], default: str) -> Column:
    """An edge's class by the types of its resolved ends."""
    out = F.lit(default)
    for (a, b), name in kinds.items():
        out = F.when((start_type == a) & (end_type == b), name).otherwise(out)
    return out


def identifier_groups(spark, active: DataFrame, edges: DataFrame, support: DataFrame, primary: str, minor: list[str]) -> DataFrame:
    """(id, component) over equivalences between active ids, without groups that only the primary or only minor sources support.

    ``active`` (id), ``edges`` (start_id, end_id), ``support`` (id, source). Supports meet as sets by component.
    """
    from weftline.operators.graph import connected_components

    live = edges.join(active.select(F.col("id").alias("start_id")), "start_id", "left_semi").join(active.select(F.col("id").alias("end_id")), "end_id", "left_semi")
    loops = active.select(F.col("id").alias("src"), F.col("id").alias("dst"))
    parts = connected_components(spark, live.select(F.col("start_id").alias("src"), F.col("end_id").alias("dst")).union(loops)).withColumnRenamed("node", "id")
    by = parts.join(support, "id", "left").groupBy("component").agg(F.array_sort(F.collect_set("source")).alias("sources"), F.count_distinct("id").alias("n"))
    only = lambda names: (F.size(F.array_except("sources", F.array(*map(F.lit, names)))) == 0) & (F.size("sources") > 0)
    gone = by.where(only([primary]) | only(minor)).select("component")
    return parts.join(gone, "component", "left_anti").select("id", "component")


# fixed values: evidence codes that stand for no data
NO_DATA = ("ND",)


def annotation_edges(rows: DataFrame) -> DataFrame:
    """(start_id, end_id, evidence) of gene annotation rows: proteins to terms, with the codes and who assigned them."""
    kept = rows.where(~F.col("evidence").isin(*NO_DATA) & F.col("term").contains(":"))
    pair = F.struct(F.col("evidence").alias("code"), "assigned_by")
    return kept.groupBy(curie("UniProtKB", F.col("object_id")).alias("start_id"), F.concat(F.lit("GO:"), F.regexp_replace("term", "^[^:]*:", "")).alias("end_id")).agg(F.array_sort(F.collect_set(pair)).alias("evidence"))


def curated_diseases(rows: DataFrame) -> DataFrame:
    """(start_id, end_id, name, details) of curated gene-disease rows that name a disease, its id and a gene."""
    filled = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    listed = lambda c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != "")
    kept = rows.where(filled("DiseaseID") & filled("DiseaseName") & filled("GeneID"))
    detail = F.struct(F.lit("CTD").alias("source"), listed("DirectEvidence").alias("evidence"), listed("PubMedIDs").alias("papers"))
    return kept.groupBy(curie("NCBIGene", F.trim("GeneID")).alias("start_id"), F.trim("DiseaseID").alias("end_id")).agg(F.min(F.trim("DiseaseName")).alias("name"), F.array_sort(F.collect_list(detail)).alias("details"))


def phenotype_edges(rows: DataFrame) -> DataFrame:
    """(start_id, end_id, n) of mouse genes and phenotypes, where a row has both."""
    known = lambda c: F.when(~F.trim(c).isin("", "-"), F.trim(c))
    both = rows.select(known("marker_accession_id").alias("start_id"), known("mp_term_id").alias("end_id")).where("start_id is not null and end_id is not null")
    return both.groupBy("start_id", "end_id").agg(F.count(F.lit(1)).alias("n"))


def implicated(rows: DataFrame) -> DataFrame:
    """Association rows but for those that say there is none."""
    return rows.where(F.coalesce(F.col("AssociationType"), F.lit("")) != "is_not_implicated_in")


def typed_terms(spark, terms: DataFrame, parents: DataFrame, role_root: str, chemical_root: str, role_targets: DataFrame, evidence: DataFrame) -> DataFrame:
    """(id, kind) of an ontology's terms: ``role`` for role targets and what is below the role root, ``chemical`` for what is
    below the chemical root or has evidence of its own, and for what is left over."""
    from weftline.operators.graph import transitive_closure

    below = transitive_closure(spark, parents, terms.select(F.col("id").alias("node")))
    under = lambda root: below.where(F.col("ancestor") == root).select(F.col("descendant").alias("id"))
    roles = role_targets.select("id").union(under(role_root)).distinct().withColumn("_role", F.lit(True))
    chemical = under(chemical_root).union(evidence.select("id")).distinct().withColumn("_chemical", F.lit(True))
    kind = F.when(F.col("_role"), "role").when(F.col("_chemical"), "chemical").otherwise("chemical")
    return terms.select("id").join(roles, "id", "left").join(chemical, "id", "left").select("id", kind.alias("kind"))


def endogenous(spark, terms: DataFrame, parents: DataFrame, root: str, exogenous: list[str], forbidden: list[str]) -> DataFrame:
    """(id) of terms (id, label, obsolete, drug) below the root that are neither obsolete, drugs, exogenous nor so labelled."""
    from weftline.operators.graph import transitive_closure

    below = transitive_closure(spark, parents, terms.select(F.col("id").alias("node")))
    under = lambda roots: below.where(F.col("ancestor").isin(*roots)).select(F.col("descendant").alias("id")).distinct()
    wrong = F.lit(False)
    for text in forbidden:
        wrong = wrong | F.lower(F.coalesce("label", F.lit(""))).contains(text.lower())
    kept = terms.where(~F.coalesce("obsolete", F.lit(False)) & ~F.coalesce("drug", F.lit(False)) & ~wrong)
    return kept.join(under([root]), "id", "left_semi").join(under(exogenous), "id", "left_anti").select("id")


def patent_families(mentions: DataFrame, patents: DataFrame, this_year: int) -> DataFrame:
    """(compound, year, families): distinct families by year of the patents (patent, year, family) that mention it; years from
    1950 on, real families only. Patents without a mention are left out before they are joined."""
    wanted = patents.where(F.col("year").between(1950, this_year) & (F.col("family") > 0)).join(mentions.select("patent"), "patent", "left_semi")
    return mentions.select("compound", "patent").distinct().join(wanted, "patent").groupBy("compound", "year").agg(F.countDistinct("family").alias("families"))


def grouped_notes(notes: DataFrame) -> DataFrame:
    """(gene_id, text, date, papers) of notes (gene_id, text, date, paper): one row a text, its last date, its papers in order."""
    return notes.where("text is not null").groupBy("gene_id", "text").agg(F.max("date").alias("date"), F.array_sort(F.collect_set("paper")).alias("papers"))


#: Source adapters by name: what reads each one's files, and the function that makes its table of the rows.
ADAPTERS = {
    "string_ppi": (("delimited",), interactions),
    "bioplex_ppi": (("delimited",), probability_interactions),
    "gtex_expression": (("gct", "delimited", "delimited"), expression_edges),
    "hpa_expression": (("delimited", "delimited"), staining_edges),
    "hcop_orthologs": (("delimited",), orthologs),
    "text_mining": (("delimited",), text_mined),
    "tiga_traits": (("delimited", "delimited"), trait_edges),
    "expasy_classes": (("flat_records",), ec_parents),
    "go_annotations": (("gaf",), annotation_edges),
    "ctd_diseases": (("delimited",), curated_diseases),
    "impc_phenotypes": (("delimited",), phenotype_edges),
    "alliance_diseases": (("delimited",), implicated),
    "patents": (("delimited", "delimited"), patent_families),
    "gene_notes": (("json_records",), grouped_notes),
}


def run_adapter(name: str, *tables: DataFrame, source: str, version: str | None = None, **options) -> DataFrame:
    """The table that an adapter makes, with where it comes from in ``provenance``."""
    _, make = ADAPTERS[name]
    return make(*tables, **options).withColumn("provenance", F.lit("\t".join([source, version or ""])))
