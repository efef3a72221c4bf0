"""Sorted taxonomic treatment as lines of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.functions import names
from taxaloom.operators.joins import lookup_join, one_per_key
from taxaloom.operators.ordering import NULL_TEXT

# Marks of the treatment text.
DASH = " \\-\\- "
BULLET = "* "
HARD_LINE = "  "

# Offset of a line from the sort order of its taxon, in tenths.
OFFSETS = {"spacer": -5, "header": 0, "remarks": 1, "synonym": 2}


def cited_name() -> Column:
    """Name and publication; a missing part prints as ``NA``."""
    name, publication = (F.coalesce(c, F.lit(NULL_TEXT)) for c in ("scientificName", "namePublishedIn"))
    return F.concat(name, F.lit(DASH), publication)


def hard_line(c: Column) -> Column:
    return F.concat(c, F.lit(HARD_LINE))


def heading(c: Column, level: int) -> Column:
    return F.concat(F.lit("#" * level + " "), c)


def header_line() -> Column:
    """Heading by rank, list item below genus, null for other ranks."""
    rank, cited = F.col("taxonRank"), cited_name()
    line = F.when(rank.isin(*vocab.BULLET_RANKS), F.concat(F.lit(BULLET), hard_line(cited)))
    for name, level in vocab.HEADING_LEVELS.items():
        line = line.when(rank == name, heading(cited, level))
    return line


def treatment_lines(sorted_taxa: DataFrame) -> DataFrame:
    """(taxonID, sort_order, part_order, kind, line) for every line of the treatment.

    ``sorted_taxa`` comes from ``hierarchical_sort``. Synonyms stay one row per
    line, in their own sort order, so no taxon's lines are gathered in one task.
    """
    taxa = sorted_taxa.withColumn("scientificName", names.italicise_name("scientificName", "taxonRank"))

    def lines(df: DataFrame, kind: str, line: Column, part: Column = F.lit(0).cast("long")) -> DataFrame:
        return df.select(
            "taxonID",
            ((F.col("sort_order") * 10 + OFFSETS[kind]) / 10).cast("double").alias("sort_order"),
            part.alias("part_order"),
            F.lit(kind).alias("kind"),
            line.alias("line"),
        )

    accepted = taxa.filter(F.col("taxonomicStatus") == "accepted")
    headers = lines(accepted, "header", header_line()).filter(F.col("line").isNotNull())
    spacers = lines(accepted, "spacer", F.lit(""))
    remarks = lines(
        accepted.filter(F.col("taxonRemarks").isNotNull()), "remarks", hard_line(F.col("taxonRemarks"))
    )
    aliases = taxa.filter(F.col("taxonomicStatus") == "synonym").select(
        F.col("acceptedNameUsageID").alias("taxonID"),
        F.col("sort_order").alias("_part"),
        hard_line(F.concat(F.lit("= "), cited_name())).alias("_line"),
    )
    places = one_per_key(taxa.select(F.col("taxonID").alias("_id"), "sort_order"), "_id")
    placed = lookup_join(aliases, places, [("taxonID", "_id")])
    synonyms = lines(placed, "synonym", F.col("_line"), F.col("_part"))
    return headers.unionByName(spacers).unionByName(remarks).unionByName(synonyms)


def report_sort(lines: DataFrame) -> DataFrame:
    return lines.orderBy(
        F.col("sort_order").asc_nulls_last(), F.col("part_order").asc_nulls_last(), "kind", "taxonID", "line"
    )


def unprinted_violations(lines: DataFrame, taxa: DataFrame) -> DataFrame:
    """Accepted rows without a line."""
    from taxaloom.operators.quality import rule_membership

    accepted = taxa.filter(F.col("taxonomicStatus") == "accepted").select(
        "taxonID", F.col("taxonID").alias("_accepted")
    )
    return rule_membership(accepted, "_accepted", lines, "taxonID", rule="accepted_printed")
