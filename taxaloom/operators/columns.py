"""Projections and filters on whole tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.functions import text


def snake_case(name: str) -> str:
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.replace("%", "_percent_").replace("#", "_number_"))
    return re.sub(r"[^0-9a-z]+", "_", name.lower()).strip("_") or "x"


def clean_names(df: DataFrame) -> DataFrame:
    """Snake-case headers; a repeated header gets ``_2``, ``_3`` and so on."""
    names, seen = [], {}
    for name in map(snake_case, df.columns):
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return df.toDF(*names)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any value; one aggregate pass, one row to the driver."""
    filled = df.agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if filled[c]])


def drop_columns(df: DataFrame, *names: str, pattern: str | None = None) -> DataFrame:
    """Drop columns by name and, if given, by pattern; absent names are ignored."""
    if pattern:
        names = (*names, *[c for c in df.columns if re.search(pattern, c)])
    return df.drop(*names)


def rename_to_terms(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    return df.withColumnsRenamed(names or vocab.TERM_NAMES)


def select_terms(df: DataFrame, terms: Sequence[str] = vocab.TERMS) -> DataFrame:
    """Known columns only, in vocabulary order."""
    return df.select(*[c for c in terms if c in df.columns])


def apply_across(df: DataFrame, fn: Callable[[str], Column], names: Sequence[str]) -> DataFrame:
    """Same expression over many columns."""
    return df.withColumns({c: fn(c) for c in names if c in df.columns})


def filter_status(df: DataFrame, *statuses: str, column: str = "taxonomicStatus") -> DataFrame:
    return df.filter(F.col(column).isin(*statuses))


def filter_rank(df: DataFrame, *ranks: str, column: str = "taxonRank") -> DataFrame:
    return df.filter(F.col(column).isin(*ranks))


def filter_has_alias_text(df: DataFrame, column: str = "synonyms") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def drop_unmatched(df: DataFrame, column: str) -> DataFrame:
    """Rows whose looked-up value is there."""
    return df.filter(F.col(column).isNotNull())


def exclude_incertae(
    df: DataFrame, column: str = "scientificName", phrase: str = "incertae sedis"
) -> DataFrame:
    return df.filter(~F.col(column).contains(phrase))


def eligible_for_match(df: DataFrame, column: str = "taxonRank") -> DataFrame:
    """Ranks the authority knows, and rows without a rank."""
    rank = F.col(column)
    return df.filter(rank.isin(*vocab.AUTHORITY_GROUPS) | rank.isNull())


def null_parent_for_aliases(df: DataFrame, status: str = "taxonomicStatus") -> DataFrame:
    """Parent name and id of every kind of synonym set to null."""
    alias = F.col(status).contains("synonym")
    return apply_across(
        df,
        lambda c: F.when(alias, F.lit(None)).otherwise(F.col(c)),
        ["parentNameUsage", "parentNameUsageID"],
    )


def coalesce_columns(df: DataFrame, target: str, *sources: str) -> DataFrame:
    """First non-null of ``sources`` into ``target``; the other sources go."""
    merged = df.withColumn(target, F.coalesce(*[F.col(c) for c in sources]))
    return merged.drop(*[c for c in sources if c != target])


def assign_const(df: DataFrame, **values) -> DataFrame:
    """Constant columns; ``None`` becomes a text null."""
    return df.withColumns(
        {c: F.lit(None).cast("string") if v is None else F.lit(v) for c, v in values.items()}
    )


def fill_self_rank(
    df: DataFrame, column: str, rank: str = "taxonRank", name: str = "scientificName"
) -> DataFrame:
    """Own name into the column of the own rank."""
    return df.withColumn(column, F.when(F.col(rank) == column, F.col(name)).otherwise(F.col(column)))


def union_by_name(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Stack frames; a column that one of them lacks is null there."""
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def normalise_text_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return apply_across(df, text.unescape_html, names)
