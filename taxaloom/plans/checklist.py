"""Checklist to Darwin Core table, with its violations as data."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.functions import text
from taxaloom.operators import columns, joins, lineage, ordering, parents, quality, reconcile, treatment
from taxaloom.operators.synonyms import combine_accepted_and_aliases, explode_synonyms
from taxaloom.operators.windows import carry_forward
from taxaloom.session import stage
from taxaloom.sources.checklist import read_checklist

HTML_COLUMNS = ["scientificName", "namePublishedIn", "synonyms", "taxonRemarks"]


class Taxa(NamedTuple):
    """Taxon table, the staged tables it was made from, and what their row rules found as they were written."""

    taxa: DataFrame
    checklist: DataFrame
    ranked: DataFrame
    assigned: DataFrame
    lineages: DataFrame
    measured: list[quality.Measured]


class Treatment(NamedTuple):
    """Lines of a treatment, and what is missing in them."""

    lines: DataFrame
    violations: DataFrame


def prepare_checklist(raw: DataFrame, pos: str = "pos") -> DataFrame:
    """Raw rows in file order (``pos``) to accepted taxa with rank, code and key."""
    df = columns.drop_columns(raw, *vocab.DROPPED_COLUMNS)
    for name in ("number", "taxon", "name", "literature", "remarks", "synonyms"):
        if name not in df.columns:
            df = columns.assign_const(df, **{name: None})
    df = carry_forward(df.withColumn("taxon", text.decode_rank("taxon")), ["number"], pos)
    df = columns.normalise_text_columns(columns.rename_to_terms(df), HTML_COLUMNS)
    return df.withColumn("taxonID", text.content_key("scientificName", "namePublishedIn"))


def load_checklist(spark: SparkSession, path: str) -> DataFrame:
    return stage(prepare_checklist(read_checklist(spark, path)), "checklist")


def write_checklist(prepared: DataFrame) -> quality.Measured:
    """Stage a prepared checklist; its row rules are counted in the same pass."""
    return quality.write_measured(prepared, checklist_row_rules(), "checklist")


def checklist_row_rules() -> list[quality.RowRule]:
    return [quality.not_null("taxonRank", rule="rank_not_null"), quality.not_null("number")]


def excluded_synonyms(spark: SparkSession) -> DataFrame:
    """The fixed list of names whose synonym row is dropped."""
    return spark.createDataFrame(vocab.EXCLUDED_SYNONYMS, "scientificName string, taxonomicStatus string")


def checklist_to_taxa(checklist: DataFrame | quality.Measured, strict_markers: bool = False) -> Taxa:
    """Taxon table with parents, lineage and name usages from a prepared (staged) checklist.

    Each staged table is one the later steps read more than once.
    """
    measured = [checklist] if isinstance(checklist, quality.Measured) else []
    checklist = measured[0].rows if measured else checklist
    synonyms = explode_synonyms(checklist, strict_markers)
    flat = combine_accepted_and_aliases(checklist, synonyms)
    ranked = parents.rank_by_code(checklist)
    autonyms = stage(parents.synthesise_autonyms(ranked), "autonyms")
    checked = quality.write_measured(parents.assign_parents(ranked, autonyms), [parents.parent_missing()], "assigned")
    assigned = checked.rows
    everything = columns.union_by_name(flat, columns.select_terms(autonyms))
    taxa = stage(parents.with_parents(everything, parents.parent_edges(assigned)), "taxa")
    lineages = lineage.resolve_accepted(taxa)
    full = lineage.attach_lineage(taxa, resolved=lineages)
    full = reconcile.fill_name_usages(full, keys_from=taxa)
    full = columns.assign_const(full, modified=None)
    full = joins.exclude_pairs(
        full,
        excluded_synonyms(checklist.sparkSession),
        ["scientificName", "taxonomicStatus"],
        bounded=True,
    )
    final = quality.write_measured(full, taxa_row_rules(full.columns), "taxa")
    return Taxa(final.rows, checklist, ranked, assigned, lineages, [*measured, checked, final])


def taxa_row_rules(columns: list[str]) -> list[quality.RowRule]:
    """Rules on single rows of the finished table; they are counted while it is written."""
    return [
        quality.not_null("order"),
        *quality.table_row_rules(columns),
        quality.parentless_accepted(),
        *reconcile.name_rules(columns),
    ]


def taxa_violations(result: Taxa) -> DataFrame:
    """All rule violations of a finished table; ``quality.enforce`` turns them into an error.

    Row rules of the tables written on the way have been counted: only broken ones cost a scan.
    """
    taxa, checklist, _, assigned, lineages, measured = result
    listed = [] if any(m.rows is checklist for m in measured) else [quality.row_rules(checklist, checklist_row_rules())]
    return quality.check(
        [
            *listed,
            quality.rule_unique(checklist, "scientificName", "accepted_name_unique"),
            parents.ambiguous_violations(assigned),
            lineage.circle_violations(lineages),
            quality.rule_table(taxa, check_columns=False, row_rules_too=False),
            quality.rule_parentless_synonyms(taxa),
            *[m.violations() for m in measured],
        ]
    )


def remove_duplicates(taxa: DataFrame, listed: DataFrame) -> DataFrame:
    return joins.remove_listed(taxa, listed, "taxonID")


def reconcile_names(taxa: DataFrame, reference: DataFrame) -> DataFrame:
    """Final table: names and publications taken from the authority where the match is kept."""
    requests = reconcile.prepare_match_requests(taxa)
    results = stage(reconcile.match_reference(requests, reference), "matches")
    summary = stage(reconcile.summarise_matches(taxa, results), "summary")
    return ordering.sort_names(reconcile.apply_reference_names(taxa, summary), "scientificName", "taxonID")


def sorted_treatment(taxa: DataFrame, ranked: DataFrame, level: str = "species") -> Treatment:
    """The treatment down to ``level`` ("species" or "genus"): its lines, accepted rows without a line, and
    rows whose order has no place."""
    if level not in ("species", "genus"):
        raise ValueError("level must be 'species' or 'genus'")
    plain = columns.drop_columns(taxa, *vocab.LINEAGE_RANKS, pattern="ipni|modified")
    full = stage(lineage.attach_lineage(plain), "treatment")
    if level == "genus":
        full = stage(lineage.filter_to_level(full), "treatment")
    ordered = ordering.hierarchical_sort(full, ranked)
    lines = stage(treatment.treatment_lines(ordered), "lines")
    printed = lines.filter(F.col("kind") == "header")
    violations = quality.check(
        [treatment.unprinted_violations(printed, ordered), ordering.missing_order_violations(ordered)]
    )
    return Treatment(lines, violations)
