"""Counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.functions import names, text


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, value: str | Column, *keys: str, name: str = "total") -> DataFrame:
    """Sum per group; nulls count as 0, also when a group has nothing else."""
    value = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys).agg(F.sum(F.coalesce(value, F.lit(0))).alias(name))


def count_and_sum_by(df: DataFrame, value: Column, *keys: str, count: str = "n", name: str = "total") -> DataFrame:
    """Rows and sum per group in one aggregate; nulls count as 0."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count), F.sum(F.coalesce(value, F.lit(0))).alias(name))


def rank_order(rank: Column | str, ranks: Sequence[str]) -> Column:
    """Place of a rank in an ordered list."""
    rank = F.col(rank) if isinstance(rank, str) else rank
    return F.array_position(F.array(*[F.lit(r) for r in ranks]), rank)


def count_ranked(
    df: DataFrame, rank: str, n_aliases: Column, ranks: Sequence[str] = vocab.COUNTED_RANKS
) -> DataFrame:
    """Rows and aliases per rank in one aggregate, in rank order."""
    counted = df.filter(F.col(rank).isin(*ranks)).groupBy(rank).agg(
        F.count(F.lit(1)).alias("wf_accepted"),
        F.sum(F.coalesce(n_aliases, F.lit(0))).cast("long").alias("wf_synonym"),
    )
    return counted.orderBy(rank_order(rank, ranks))


def count_taxa_by_rank(checklist: DataFrame) -> DataFrame:
    """Accepted taxa and synonyms per rank; hybrids left out, hybrid genera set apart."""
    ranked = checklist.withColumn("taxonRank", names.counted_rank("scientificName", "taxonRank"))
    return count_ranked(ranked, "taxonRank", text.count_matches("synonyms", "="))
