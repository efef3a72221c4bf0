"""Parent pointers to rank columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.functions.text import first_token, not_in
from taxaloom.operators.joins import lookup_join, one_per_key, semi_join
from taxaloom.session import stage_counted


def pivot_wider_rank(
    df: DataFrame, id_col: str, rank: str, value: str, ranks: Sequence[str] = vocab.LINEAGE_RANKS
) -> DataFrame:
    """(id, rank, value) rows to one column per rank; rows without rank add none."""
    return df.groupBy(id_col).pivot(rank, list(ranks)).agg(F.max(value))


def pivot_longer_rank(
    df: DataFrame, id_col: str, ranks: Sequence[str] = vocab.LINEAGE_RANKS, rank: str = "rank", value: str = "taxon"
) -> DataFrame:
    """Rank columns to (id, rank, value) rows."""
    return df.select(id_col, *ranks).unpivot([id_col], list(ranks), rank, value)


def _merged(near: str, far: str, ranks: Sequence[str]) -> Column:
    return F.struct(*[F.coalesce(F.col(near)[r], F.col(far)[r]).alias(r) for r in ranks])


def resolve_nodes(
    nodes: DataFrame, id_col: str, parent: str, rank: str, name: str, ranks: Sequence[str]
) -> DataFrame:
    """(_id, _lineage, _top) of the nodes that have children, written once.

    Pointer doubling: each round joins the table with itself and doubles the number of levels known.
    Rounds go on until no pointer is open, however deep the tree is. After ``log2`` of the number of inner
    nodes, plus one, only circles can be open: they keep their ``_top`` (see ``circle_violations``).
    """
    parents = nodes.select(F.col(parent).alias("_parent")).filter("_parent IS NOT NULL")
    inner = semi_join(nodes, parents, [(id_col, "_parent")], skewed=False)
    own = F.struct(*[F.when(F.col(rank) == r, F.col(name)).alias(r) for r in ranks])
    pointers = inner.select(F.col(id_col).alias("_id"), own.alias("_lineage"), F.col(parent).alias("_top"))
    sizes = {"rows": F.count(F.lit(1)), "open": F.count("_top")}  # known as soon as a round is written
    known, found = stage_counted(one_per_key(pointers, "_id"), sizes, "lineage")
    rounds = 0
    while True:
        if not found["open"] or rounds > math.ceil(math.log2(max(2, found["rows"]))):
            return known
        rounds += 1
        above = known.select(
            F.col("_id").alias("_above"), F.col("_lineage").alias("_far"), F.col("_top").alias("_next")
        )
        joined = lookup_join(known, above, [("_top", "_above")], salt_by=["_id"], keys_from=known)
        known, found = stage_counted(
            joined.select(
                "_id",
                _merged("_lineage", "_far", ranks).alias("_lineage"),
                # an unknown parent id ends the chain
                F.col("_next").alias("_top"),
            ),
            sizes,
            "lineage",
        )


def ancestor_columns(
    df: DataFrame,
    id_col: str = "taxonID",
    parent: str = "parentNameUsageID",
    rank: str = "taxonRank",
    name: str = "scientificName",
    ranks: Sequence[str] = vocab.LINEAGE_RANKS,
    strip_author: bool = False,
    resolved: DataFrame | None = None,
) -> DataFrame:
    """``df`` with one column per rank, filled from the chain of parents and the row itself.

    ``resolved``: result of ``resolve_nodes`` over the same nodes, if it is known already.
    """
    if resolved is None:
        resolved = resolve_nodes(df.select(id_col, parent, rank, name), id_col, parent, rank, name, ranks)
    up = resolved.select(F.col("_id").alias("_up"), F.col("_lineage").alias("_far"))
    joined = lookup_join(df.drop(*ranks), up, [(parent, "_up")], salt_by=[id_col])
    value = first_token if strip_author else F.col
    own = {r: F.when(F.col(rank) == r, F.col(name)) for r in ranks}
    wide = joined.withColumns({r: F.coalesce(own[r], F.col("_far")[r]) for r in ranks}).drop("_far")
    return wide.withColumns({r: value(r) for r in ranks}) if strip_author else wide


def accepted_nodes(df: DataFrame) -> DataFrame:
    """Narrow rows of the accepted taxa."""
    return df.filter(F.col("taxonomicStatus").eqNullSafe("accepted")).select(
        "taxonID", "parentNameUsageID", "taxonRank", "scientificName"
    )


def resolve_accepted(df: DataFrame, ranks: Sequence[str] = vocab.LINEAGE_RANKS) -> DataFrame:
    """``resolve_nodes`` over the accepted taxa of a taxon table."""
    return resolve_nodes(
        accepted_nodes(df), "taxonID", "parentNameUsageID", "taxonRank", "scientificName", ranks
    )


def lineage_by_id(
    df: DataFrame, ranks: Sequence[str] = vocab.LINEAGE_RANKS, resolved: DataFrame | None = None
) -> DataFrame:
    """(taxonID, rank columns) of the accepted rows, one per id."""
    full = ancestor_columns(accepted_nodes(df), ranks=ranks, strip_author=True, resolved=resolved)
    return one_per_key(full.select("taxonID", *ranks), "taxonID")


def attach_lineage(
    df: DataFrame, ranks: Sequence[str] = vocab.LINEAGE_RANKS, resolved: DataFrame | None = None
) -> DataFrame:
    """``df`` with genus, tribe, subfamily, family and order on every row.

    Lineages are resolved once over narrow accepted rows; an accepted row then looks up its own id and
    a synonym its accepted id, in one join over the whole rows.
    """
    lineages = lineage_by_id(df, ranks, resolved).withColumnRenamed("taxonID", "_id")
    is_accepted = F.col("taxonomicStatus").eqNullSafe("accepted")
    rows = df.select(*[c for c in df.columns if c not in ranks])
    keyed = rows.withColumn("_of", F.when(is_accepted, F.col("taxonID")).otherwise(F.col("acceptedNameUsageID")))
    return lookup_join(keyed, lineages, [("_of", "_id")], salt_by=["taxonID"]).drop("_of")


def rank_chain_join(top: DataFrame, lowers: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Rows of the lowest table with the columns of all tables above.

    ``lowers``: (table, its parent key, key of the table above), highest first.
    Built from the top, so the large low tables are joined once each.
    """
    resolved = top
    for table, parent_key, upper_key in lowers:
        resolved = lookup_join(table, resolved, [(parent_key, upper_key)])
    return resolved


def filter_to_level(df: DataFrame, dropped_ranks: Sequence[str] = vocab.BELOW_GENUS_RANKS) -> DataFrame:
    """Rows above a level; a row whose accepted record is gone goes too. Rows without rank stay."""
    kept = df.filter(not_in("taxonRank", list(dropped_ranks)))
    ids = kept.select(F.col("taxonID").alias("_id"))
    free = kept.filter(F.col("acceptedNameUsageID").isNull())
    bound = semi_join(
        kept.filter(F.col("acceptedNameUsageID").isNotNull()),
        ids,
        [("acceptedNameUsageID", "_id")],
        salt_by=["taxonID"],
    )
    return free.unionByName(bound)


def circle_violations(resolved: DataFrame) -> DataFrame:
    """Inner nodes whose chain of parents never ends: they are on a circle, or below one."""
    from taxaloom.operators.quality import rule_predicate

    return rule_predicate(resolved, F.col("_top").isNotNull(), "lineage_circle", "_id", F.col("_top"))
