"""Packed synonyms to rows, and the accepted + synonym stack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.functions import names, text
from taxaloom.operators.columns import assign_const, filter_has_alias_text, select_terms, union_by_name
from taxaloom.operators.windows import status_by_multiplicity

SYNONYM_COLUMNS = [
    "taxonRank",
    "number",
    "acceptedNameUsageID",
    "scientificName",
    "namePublishedIn",
    "taxonID",
    "taxonomicStatus",
]


def split_synonyms(checklist: DataFrame) -> DataFrame:
    """One row per packed synonym: accepted id, name, publication, key.

    Copies can only come from one packed text (``taxonID`` is the key of the
    checklist), so they are dropped inside the row and nothing is shuffled.
    """

    def cited(piece: Column) -> Column:
        name, publication = text.split_first(piece, r"\[")
        return F.struct(
            text.squish(name).alias("scientificName"),
            text.strip_suffix(publication).alias("namePublishedIn"),
        )

    cited_names = F.array_distinct(F.transform(text.split_multivalue("synonyms"), cited))
    split = (
        filter_has_alias_text(checklist)
        .select("number", F.col("taxonID").alias("acceptedNameUsageID"), F.explode(cited_names).alias("_cited"))
        .select("number", "acceptedNameUsageID", "_cited.*")
    )
    key = text.content_key("acceptedNameUsageID", "scientificName", "namePublishedIn")
    return split.withColumn("taxonID", key)


def explode_synonyms(checklist: DataFrame, strict_markers: bool = False) -> DataFrame:
    """Synonym rows with key, status by how often the name is listed, and guessed rank."""
    rows = status_by_multiplicity(split_synonyms(checklist), ["scientificName"], salt_by=["taxonID"])
    ranked = names.rank_from_name(rows, "scientificName", strict=strict_markers)
    return ranked.select(*SYNONYM_COLUMNS)


def combine_accepted_and_aliases(checklist: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Accepted rows (status set) and synonym rows, restricted to known terms."""
    accepted = assign_const(checklist.drop("synonyms"), taxonomicStatus="accepted")
    return select_terms(union_by_name(select_terms(accepted), select_terms(synonyms)))
