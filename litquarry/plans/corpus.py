"""From literature matches to labelled abstracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from litquarry.operators.filters import (
    ABSTRACT_CATEGORIES, CANCER_AREA, DISEASE_TYPE, GENE_TYPE, HUMAN_NAMES,
    disease_area_filter, is_species, literature_filter,
)
from litquarry.operators.joins import attach_abstracts, attach_dimension, combine_evidence, restrict_to, union_all
from litquarry.operators.rollups import distinct_organisms, joined_labels, rollup_labels
from litquarry.operators.sampling import MAX_PER_LABEL, SAMPLE_TARGET, SEED, cap_per_group, stratified_sample
from litquarry.session import materialize


def disease_evidence(
    matches: DataFrame, diseases: DataFrame, disease_type: str = DISEASE_TYPE, sep: str = ", "
) -> DataFrame:
    """Diseases of the area per pmid."""
    found = matches.filter(F.col("type") == disease_type).select("pmid", "keywordId")
    named = attach_dimension(found, diseases, "keywordId", "id", "name", "disease_name")
    return rollup_labels(named, "pmid", "disease_name", sep)


def gene_evidence(
    matches: DataFrame, symbols: DataFrame, keys: DataFrame, gene_type: str = GENE_TYPE, sep: str = ", "
) -> DataFrame:
    """Gene symbols per pmid, for the pmids in ``keys``.

    Distinct mentions go into the joins, so a pmid with very many matches is small by then.
    """
    found = matches.filter(F.col("type") == gene_type).select("pmid", "keywordId").distinct()
    named = attach_dimension(restrict_to(found, keys, "pmid"), symbols, "keywordId", "ENSG", "HUGO", "gene")
    return rollup_labels(named, "pmid", "gene", sep)


def organism_evidence(matches: DataFrame, keys: DataFrame) -> DataFrame:
    """Distinct organism lists of the pmids in ``keys``."""
    return restrict_to(distinct_organisms(matches), keys, "pmid")


def combined_evidence(
    matches: DataFrame,
    diseases: DataFrame,
    symbols: DataFrame,
    disease_type: str = DISEASE_TYPE,
    gene_type: str = GENE_TYPE,
) -> DataFrame:
    """pmid, gene, disease_name and each organism list: the roll-ups joined step by step.

    The filtered matches and the diseases are written once; the diseases' keys are unique already.
    """
    matches = materialize(matches.select("pmid", "type", "keywordId", "organisms"), "matches")
    by_disease = materialize(disease_evidence(matches, diseases, disease_type), "disease_evidence")
    keys = by_disease.select("pmid")
    genes = gene_evidence(matches, symbols, keys, gene_type)
    return combine_evidence(genes, by_disease, organism_evidence(matches, keys))


def labelled_pmids(
    matches: DataFrame,
    diseases: DataFrame,
    symbols: DataFrame,
    disease_type: str = DISEASE_TYPE,
    gene_type: str = GENE_TYPE,
    names: Sequence[str] = tuple(HUMAN_NAMES),
) -> DataFrame:
    """pmid, gene, disease_name of pmids with both labels and a species of interest.

    Equals ``species_filter(combined_evidence(...))`` from one scan of the matches and
    one shuffle on pmid: both dimensions are one lookup table, and the species is a
    flag per pmid instead of a joined list.
    """
    lookup = union_all(
        diseases.select(F.lit(disease_type).alias("_type"), F.col("id").alias("_id"), F.col("name").alias("_label")),
        symbols.select(F.lit(gene_type).alias("_type"), F.col("ENSG").alias("_id"), F.col("HUGO").alias("_label")),
    )
    facts = matches.filter(F.col("pmid").isNotNull()).select(
        "pmid", "type", "keywordId", is_species("organisms", names).alias("_species")
    )
    labelled = facts.join(
        lookup, (facts["type"] == lookup["_type"]) & (facts["keywordId"] == lookup["_id"]), "left"
    )
    label = lambda kind: F.when(F.col("type") == kind, F.col("_label"))
    return (
        labelled.filter(F.col("_label").isNotNull() | F.col("_species"))  # the others add nothing
        .groupBy("pmid")
        .agg(
            joined_labels(label(gene_type)).alias("gene"),
            joined_labels(label(disease_type)).alias("disease_name"),
            F.count(label(gene_type)).alias("_genes"),
            F.count(label(disease_type)).alias("_diseases"),
            F.bool_or("_species").alias("_species"),
        )
        .filter((F.col("_genes") > 0) & (F.col("_diseases") > 0) & F.col("_species"))
        .select("pmid", "gene", "disease_name")
    )


def sample_evidence(
    labelled: DataFrame, target: int = SAMPLE_TARGET, cap: int = MAX_PER_LABEL, seed: int = SEED
) -> DataFrame:
    """The capped, proportional sample of labelled pmids; the capped rows are written once."""
    capped = materialize(cap_per_group(labelled, "disease_name", cap, "pmid", seed), "capped")
    return stratified_sample(capped, "disease_name", target, "pmid", seed)


def build_corpus(
    matches: DataFrame,
    diseases: DataFrame,
    symbols: DataFrame,
    pubmed: DataFrame,
    target: int = SAMPLE_TARGET,
    cap: int = MAX_PER_LABEL,
    seed: int = SEED,
    section: str = "abstract",
    disease_type: str = DISEASE_TYPE,
    gene_type: str = GENE_TYPE,
    area: str = CANCER_AREA,
    exclude_names: Sequence[str] = tuple(ABSTRACT_CATEGORIES),
    species: Sequence[str] = tuple(HUMAN_NAMES),
    funnel: dict[str, Observation] | None = None,
) -> DataFrame:
    """Labelled abstracts from raw tables: filter, evidence, sample, title and abstract.

    The labelled pmids are written once, because sampling reads them several times,
    and so is the sample, whose size lets Spark look up its abstracts without moving all.
    Into a given ``funnel`` go the rows of each stage, counted as they pass; see ``funnel_table``.
    """
    def counted(df: DataFrame, stage: str) -> DataFrame:
        if funnel is None:
            return df
        funnel[stage] = Observation(stage)
        return df.observe(funnel[stage], F.count(F.lit(1)).alias("rows"))

    matches = counted(literature_filter(counted(matches, "matches"), section, (disease_type, gene_type)), "filtered")
    diseases = disease_area_filter(diseases, area, exclude_names=exclude_names)
    found = labelled_pmids(matches, diseases, symbols, disease_type, gene_type, species)
    labelled = materialize(counted(found, "labelled"), "labelled")
    sample = materialize(counted(sample_evidence(labelled, target, cap, seed), "sampled"), "sample")
    return attach_abstracts(sample, pubmed)


def funnel_table(spark: SparkSession, funnel: dict[str, Observation]) -> DataFrame:
    """Stage and rows of a corpus build that has run, one row for each of its few stages."""
    counts = [(stage, observed.get["rows"]) for stage, observed in funnel.items()]
    return spark.createDataFrame(counts, "stage string, rows bigint")
