"""Parents from position codes, name parts and interval bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.functions import names, text
from taxaloom.operators.columns import drop_unmatched, filter_rank, union_by_name
from taxaloom.operators.joins import Keys, anti_join, interval_join, key_pairs, lookup_join
from taxaloom.operators.quality import RowRule, predicate, row_rules, rule_predicate
from taxaloom.operators.windows import fixed_width_interval, next_start_interval, unique_only_lookup

# Width of the band of minor numbers a taxon of that rank covers.
BAND_WIDTHS = {"family": 999.0, "subfamily": 999.0, "tribe": 99.0, "genus": 999.0}


def rank_by_code(checklist: DataFrame) -> DataFrame:
    """Accepted rows with the numbers decoded from their position code."""
    major, minor = text.code_parts("number")
    return checklist.select(
        "taxonID",
        "number",
        "scientificName",
        "taxonRank",
        "namePublishedIn",
        major.alias("major_num"),
        minor.alias("minor_num"),
        F.lit("accepted").alias("taxonomicStatus"),
    )


def range_parent(
    children: DataFrame, bands: DataFrame, point: str, id_col: str, start: str = "start", end: str = "end"
) -> DataFrame:
    """Closed range match, no equality key."""
    return interval_join(children, bands, point, id_col, start, end, closed=True)


def banded_parent(
    children: DataFrame,
    bands: DataFrame,
    on: Keys,
    point: str,
    id_col: str,
    start: str = "start",
    end: str = "end",
    widths: Sequence[float] | None = None,
) -> DataFrame:
    """Equality on ``on`` and ``start <= point < end``."""
    return interval_join(children, bands, point, id_col, start, end, on=on, widths=widths)


def equi_parent(children: DataFrame, parents: DataFrame, on: Keys, id_col: str = "taxonID") -> DataFrame:
    """Equality only; ``parents`` holds the keys and the parent columns."""
    return lookup_join(children, parents, on, salt_by=[id_col])


def cascade_parent(
    children: DataFrame,
    levels: Sequence[DataFrame],
    on: Keys,
    point: str,
    id_col: str,
    parent: str,
    widths: Sequence[float] | None = None,
) -> DataFrame:
    """Parent from the first level that has one, most specific level first: one row per child.

    Each level holds the keys, ``start``, ``end`` and ``parent``. The bands of all levels are tagged and
    matched in one join. ``n_matches`` counts the bands of the deciding level that hold the child; of
    several the smallest parent is taken, and the parent rules report them.
    """
    keys = [r for _, r in key_pairs(on)]
    tagged = union_by_name(
        *[
            bands.select(*keys, "start", "end", F.col(parent).alias("_found"), F.lit(i).alias("_tier"))
            for i, bands in enumerate(levels)
        ]
    )
    asked = children.select(*dict.fromkeys([id_col, point, *[l for l, _ in key_pairs(on)]])).distinct()
    matched = interval_join(asked, tagged, point, id_col, on=on, how="inner", widths=widths)
    best = (
        matched.groupBy(F.col(id_col).alias("_child"), "_tier")
        .agg(F.min("_found").alias("_found"), F.count(F.lit(1)).alias("n_matches"))
        .groupBy("_child")
        .agg(F.min(F.struct("_tier", "_found", "n_matches")).alias("_best"))
        .select("_child", F.col("_best._found").alias(parent), F.col("_best.n_matches").alias("n_matches"))
    )
    return lookup_join(children, best, [(id_col, "_child")], skewed=False)


def synthesise_parents(
    children: DataFrame, parents: DataFrame, on: Keys, key: Column, made: dict[str, Column], wanted: Column
) -> DataFrame:
    """One new parent row per key of the children that have no parent and meet ``wanted``."""
    orphans = anti_join(children, parents, on).filter(wanted)
    return orphans.select(key.alias("taxonID"), *[c.alias(n) for n, c in made.items()]).distinct()


def unique_species(ranked: DataFrame) -> DataFrame:
    """Accepted species by (genus, epithet); names with homonyms are left out."""
    species = filter_rank(ranked, "species").select(
        text.first_token("scientificName").alias("genericName"),
        text.epithet_token("scientificName").alias("specificEpithet"),
        "taxonID",
    )
    return unique_only_lookup(species, ["genericName", "specificEpithet"])


def synthesise_autonyms(ranked: DataFrame) -> DataFrame:
    """Species rows for infraspecific taxa that repeat a species epithet without a species row."""
    lower = filter_rank(ranked, *vocab.INFRASPECIFIC_RANKS).withColumns(
        {
            "genericName": text.first_token("scientificName"),
            "specificEpithet": text.epithet_token("scientificName"),
            "_canonical": names.canonical_name("scientificName"),
            "_author": names.authorship("scientificName"),
        }
    )
    genus, species, infra = text.split_fixed("_canonical", 3)
    name = text.full_name(genus, species, F.col("_author"))
    made = {
        "number": F.col("number"),
        "minor_num": F.col("minor_num"),
        "major_num": F.col("major_num"),
        "scientificName": name,
        "namePublishedIn": F.col("namePublishedIn"),
        "taxonRank": F.lit("species"),
        "taxonomicStatus": F.lit("accepted"),
        "taxonRemarks": F.lit("autonym"),
    }
    return synthesise_parents(
        lower,
        unique_species(ranked),
        ["genericName", "specificEpithet"],
        text.content_key(name, "namePublishedIn"),
        made,
        species == infra,
    )


def _parents(ranked: DataFrame, rank: str, *extra: str) -> DataFrame:
    return filter_rank(ranked, rank).select(F.col("taxonID").alias("parentNameUsageID"), *extra)


def _single(parents: DataFrame, *keys: str) -> DataFrame:
    """One ``_parent`` (smallest id, number of candidates) per key.

    Parents that share a key are merged before any join, so a name or code that
    is listed very often never multiplies its children.
    """
    merged = F.struct(F.min("parentNameUsageID").alias("id"), F.count(F.lit(1)).alias("n"))
    return parents.groupBy(*keys).agg(merged.alias("_parent"))


def _bands(ranked: DataFrame, rank: str) -> DataFrame:
    rows = _single(_parents(ranked, rank, "major_num", F.col("minor_num").alias("start")), "major_num", "start")
    return fixed_width_interval(rows, "start", BAND_WIDTHS[rank])


def order_bands(ranked: DataFrame) -> DataFrame:
    """Orders with the range of major numbers they cover, up to the next order."""
    orders = _single(_parents(ranked, "order", F.col("major_num").alias("start")), "start")
    # codes have three digits before the point, so they all fall into one bucket of positions
    return next_start_interval(orders.filter("start IS NOT NULL"), "start", "start", dense=True)


def assign_parents(ranked: DataFrame, autonyms: DataFrame) -> DataFrame:
    """(taxonID, taxonRank, scientificName, parentNameUsageID, n_parents) of every accepted row.

    A row without a parent keeps a null, and ``n_parents`` above one, or a row in
    several bands, means that the choice is open: the parent rules report both.
    """
    families = range_parent(
        filter_rank(ranked, "family"), order_bands(ranked), "major_num", "taxonID"
    )
    subfamilies = equi_parent(
        filter_rank(ranked, "subfamily"),
        _single(_parents(ranked, "family", "major_num"), "major_num"),
        ["major_num"],
    )
    tribes = banded_parent(
        filter_rank(ranked, "tribe"), _bands(ranked, "subfamily"), ["major_num"], "minor_num", "taxonID",
        widths=list(BAND_WIDTHS.values()),
    )
    genera = cascade_parent(
        filter_rank(ranked, "genus"),
        [_bands(ranked, rank) for rank in ("tribe", "subfamily", "family")],
        ["major_num"],
        "minor_num",
        "taxonID",
        "_parent",
        list(BAND_WIDTHS.values()),
    ).withColumn("_parent", F.struct(F.col("_parent.id").alias("id"), F.greatest("_parent.n", "n_matches").alias("n")))
    all_species = union_by_name(filter_rank(ranked, "species"), autonyms)
    species = equi_parent(all_species, _single(_parents(ranked, "genus", "number"), "number"), ["number"])
    epithets = {
        "genericName": text.first_token("scientificName"),
        "specificEpithet": text.epithet_token("scientificName"),
    }
    by_epithet = _single(
        all_species.select(
            F.col("taxonID").alias("parentNameUsageID"), *[c.alias(name) for name, c in epithets.items()]
        ),
        *epithets,
    )
    lower = filter_rank(ranked, *vocab.INFRASPECIFIC_RANKS).withColumns(epithets)
    infraspecific = equi_parent(lower, by_epithet, list(epithets))
    none = F.lit(None).cast("struct<id: string, n: bigint>")
    orders = filter_rank(ranked, "order").withColumn("_parent", none)
    wanted = ["taxonID", "taxonRank", "scientificName", "_parent"]
    parts = [orders, families, subfamilies, tribes, genera, species, infraspecific]
    return union_by_name(*[part.select(*wanted) for part in parts]).select(
        "taxonID",
        "taxonRank",
        "scientificName",
        F.col("_parent.id").alias("parentNameUsageID"),
        F.col("_parent.n").alias("n_parents"),
    )


def parent_edges(assigned: DataFrame) -> DataFrame:
    """One (taxonID, parentNameUsageID) edge per child; the smallest id when several fit."""
    known = drop_unmatched(assigned, "parentNameUsageID")
    return known.groupBy("taxonID").agg(F.min("parentNameUsageID").alias("parentNameUsageID"))


def parent_missing() -> RowRule:
    """Rows without a parent; orders may have none."""
    bad = F.col("parentNameUsageID").isNull() & (F.col("taxonRank") != "order")
    return predicate(bad, "parent_missing", detail=F.col("scientificName"))


def ambiguous_violations(assigned: DataFrame) -> DataFrame:
    """Rows with more than one parent."""
    choices = assigned.groupBy("taxonID").agg(F.sum("n_parents").alias("n_parents"))
    return rule_predicate(choices, F.col("n_parents") > 1, "ambiguous_parent", detail=F.col("n_parents"))


def parent_violations(assigned: DataFrame) -> DataFrame:
    """Rows without a parent (orders may have none) and rows with more than one."""
    return row_rules(assigned, [parent_missing()]).unionByName(ambiguous_violations(assigned))


def with_parents(taxa: DataFrame, edges: DataFrame) -> DataFrame:
    """Parent id on every row; a synonym takes the parent of its accepted record."""
    own = edges.select(F.col("taxonID").alias("_id"), F.col("parentNameUsageID").alias("_own"))
    accepted = edges.select(F.col("taxonID").alias("_id"), F.col("parentNameUsageID").alias("_accepted"))
    base = taxa.drop("parentNameUsageID")
    joined = lookup_join(base, own, [("taxonID", "_id")], skewed=False)
    joined = lookup_join(joined, accepted, [("acceptedNameUsageID", "_id")], salt_by=["taxonID"])
    return joined.withColumn("parentNameUsageID", F.coalesce("_own", "_accepted")).drop("_own", "_accepted")
