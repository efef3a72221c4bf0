"""Sort orders of the final table and of the treatment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.functions import text
from taxaloom.operators.columns import filter_rank
from taxaloom.operators.joins import lookup_join, one_per_key
from taxaloom.operators.windows import number_rows

NULL_TEXT = "NA"


def sort_names(df: DataFrame, *columns: str) -> DataFrame:
    """Byte order, nulls last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def interleave_order(
    name: str = "scientificName", accepted: str = "acceptedNameUsage", id_col: str = "taxonID"
) -> list[Column]:
    """Sort columns that put each accepted name before its synonyms."""
    return [
        F.coalesce(accepted, name).asc_nulls_last(),
        F.col(accepted).isNotNull(),
        F.col(name).asc_nulls_last(),
        F.col(id_col).asc_nulls_last(),
    ]


def interleave_aliases(df: DataFrame, number: str | None = None, **columns: str) -> DataFrame:
    """Each accepted name followed by its synonyms; numbered when ``number`` is given."""
    order = interleave_order(**columns)
    return number_rows(df, order, number) if number else df.orderBy(*order)


def order_ranks(ranked: DataFrame) -> DataFrame:
    """(order, order_rank): place of each order, zero-padded to two digits."""
    return filter_rank(ranked, "order").select(
        text.first_token("scientificName").alias("order"),
        text.pad_left(F.col("major_num").cast("long").cast("string"), 2).alias("order_rank"),
    )


def higher_tax_key() -> Column:
    """Text key: order, family, subfamily, tribe, genus, each with a 0/1 flag "is that rank"."""
    parts = []
    for rank in reversed(vocab.LINEAGE_RANKS):
        value = F.col("order_rank") if rank == "order" else F.col(rank)
        flag = F.when(F.col("taxonRank") == rank, "0").when(F.col("taxonRank").isNotNull(), "1")
        parts += [value, flag]
    return F.concat_ws(" | ", *[F.coalesce(p, F.lit(NULL_TEXT)) for p in parts])


def hierarchical_sort(taxa: DataFrame, ranked: DataFrame) -> DataFrame:
    """``taxa`` with ``order_rank``, ``higher_tax`` and ``sort_order`` 1..n down the hierarchy."""
    ranks = one_per_key(order_ranks(ranked), "order")
    joined = lookup_join(taxa, ranks, "order", salt_by=["taxonID"])
    keyed = joined.withColumn("higher_tax", higher_tax_key())
    return number_rows(keyed, [F.col("higher_tax"), *interleave_order()], "sort_order")


def missing_order_violations(sorted_taxa: DataFrame) -> DataFrame:
    from taxaloom.operators.quality import rule_not_null

    return rule_not_null(sorted_taxa, "order_rank")
