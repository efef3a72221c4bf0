"""Rules that report violations as rows (rule, key, detail) instead of stopping."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.functions.text import not_in
from taxaloom.session import stage, stage_counted


class RuleViolation(Exception):
    """Raised by ``enforce`` when a rule is broken."""


def _violations(df: DataFrame, rule: str, key: Column, detail: Column) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail")
    )


def _joined(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns])


RowRule = tuple[str, Column, Column, Column]


def row_rules(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Violations of several (rule, bad, key, detail) in one pass over the rows."""
    found = [
        F.when(
            bad,
            F.struct(
                F.lit(rule).alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail")
            ),
        )
        for rule, bad, key, detail in rules
    ]
    broken = F.filter(F.array(*found), lambda v: v.isNotNull())
    return df.select(F.explode(broken).alias("_v")).select("_v.*")


def no_violations(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "rule string, key string, detail string")


class Measured(NamedTuple):
    """A written table, row rules, and how many rows break each of them, counted while it was written."""

    rows: DataFrame
    rules: list[RowRule]
    broken: list[int]

    def violations(self) -> DataFrame:
        """Rows that break a rule; the table is read only if there are any, and for the broken rules only."""
        found = [rule for rule, n in zip(self.rules, self.broken, strict=True) if n]
        return row_rules(self.rows, found) if found else no_violations(self.rows)

    def counts(self) -> DataFrame:
        """As ``count_violations``, without reading the table."""
        total: dict[str, int] = {}
        for (rule, *_), n in zip(self.rules, self.broken, strict=True):
            total[rule] = total.get(rule, 0) + n
        rows = [(rule, n) for rule, n in total.items() if n]
        return self.rows.sparkSession.createDataFrame(rows, "rule string, n_violations long")


def write_measured(df: DataFrame, rules: Sequence[RowRule], tag: str = "measured") -> Measured:
    """Stage a table and count what breaks its row rules in the same pass."""
    rows, found = stage_counted(df, {f"rule_{i}": F.count_if(bad) for i, (_, bad, _, _) in enumerate(rules)}, tag)
    return Measured(rows, list(rules), list(found.values()))


def write_measured_keys(df: DataFrame, keys: Sequence[str], rule: str = "right_key_repeats", tag: str = "keys") -> Measured:
    """Stage the smallest row per key and count the keys that repeat (``rule_cardinality``) in the same pass.

    A join reads the written rows without ``_times``; keys that are null in part match nothing and are left out.
    """
    known = reduce(lambda d, k: d.filter(F.col(k).isNotNull()), keys, df)
    rest = [c for c in df.columns if c not in keys]
    smallest = [F.min(F.struct(*rest)).alias("_row")] if rest else []
    merged = known.groupBy(*keys).agg(*smallest, F.count(F.lit(1)).alias("_times"))
    merged = merged.select(*keys, *(["_row.*"] if rest else []), "_times")
    return write_measured(merged, [(rule, F.col("_times") > 1, _joined(keys), F.col("_times"))], tag)


def not_null(column: str, key: str = "taxonID", rule: str | None = None) -> RowRule:
    return rule or f"{column}_not_null", F.col(column).isNull(), F.col(key), F.lit(f"{column} is null")


def in_values(column: str, values: Sequence[str], key: str = "taxonID", rule: str | None = None) -> RowRule:
    bad = F.col(column).isNotNull() & not_in(column, list(values))
    return rule or f"{column}_in_values", bad, F.col(key), F.col(column)


def predicate(bad: Column, rule: str, key: str = "taxonID", detail: Column | None = None) -> RowRule:
    return rule, bad, F.col(key), detail if detail is not None else F.lit(rule)


def rule_not_null(df: DataFrame, column: str, key: str = "taxonID", rule: str | None = None) -> DataFrame:
    return row_rules(df, [not_null(column, key, rule)])


def _repeats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_times")).filter(F.col("_times") > 1)


def rule_unique_rows(df: DataFrame, columns: Sequence[str], rule: str | None = None) -> DataFrame:
    """Combination of columns unique; null counts as a value."""
    name = rule or f"{'_'.join(columns)}_unique"
    return _violations(_repeats(df, columns), name, _joined(columns), F.col("_times"))


class UniqueRule(NamedTuple):
    """Columns whose values must not repeat together; rows with a null among them count only if ``nulls``."""

    rule: str
    columns: Sequence[str]
    nulls: bool = True


#: fingerprints that repeat are sent to all tasks if they are so many at most
BROADCAST_MARKS = 1_000_000


def rules_unique(
    df: DataFrame, rules: Sequence[UniqueRule], fingerprint: Callable[..., Column] = F.xxhash64, most: int = BROADCAST_MARKS
) -> DataFrame:
    """Several uniqueness rules: one shuffle of (rule number, fingerprint), nine bytes each, finds what may repeat.

    Only then, and only for those rows, values are compared, so fingerprints that clash report nothing false. A value
    that very many rows share is summed up in each task before it is sent.
    """
    if not rules:
        return no_violations(df)

    def entry(number: int, rule: UniqueRule, *more: Column) -> Column:
        found = F.struct(F.lit(number).cast("byte").alias("no"), fingerprint(*rule.columns).alias("mark"), *more)
        if rule.nulls:
            return found
        return F.when(reduce(and_, [F.col(c).isNotNull() for c in rule.columns]), found)

    def entries(*more: Callable[[UniqueRule], Column]) -> DataFrame:
        each = F.array(*[entry(i, rule, *[m(rule) for m in more]) for i, rule in enumerate(rules)])
        return df.select(F.explode(F.filter(each, lambda e: e.isNotNull())).alias("e")).select("e.*")

    marks = stage(entries().groupBy("no", "mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "marks")
    n = marks.count()
    if not n:
        return no_violations(df)
    values = entries(lambda rule: F.array(*[F.col(c).cast("string") for c in rule.columns]).alias("values"))
    on = ["no", "mark"]
    if n <= most:
        asked = values.join(F.broadcast(marks.select(on)), on, "left_semi")
    else:  # a mark with a thousandth of all rows goes to all tasks, of which there are a thousand at most
        hot = F.col("n") * 1_000 >= marks.agg(F.sum("n")).first()[0]
        heavy = values.join(F.broadcast(marks.filter(hot).select(on)), on, "left_semi")
        asked = heavy.unionByName(values.join(marks.filter(~hot).select(on), on, "left_semi"))
    repeats = asked.groupBy("no", "values").agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1")
    name = F.element_at(F.array(*[F.lit(r.rule) for r in rules]), F.col("no").cast("int") + 1)
    key = F.concat_ws("|", F.transform("values", lambda v: F.coalesce(v, F.lit("NULL"))))
    return repeats.select(name.alias("rule"), key.alias("key"), F.col("_times").cast("string").alias("detail"))


def rule_unique(df: DataFrame, column: str, rule: str | None = None) -> DataFrame:
    return rule_unique_rows(df, [column], rule)


def rule_unique_allow_null(df: DataFrame, column: str, rule: str | None = None) -> DataFrame:
    return rule_unique_rows(df.filter(F.col(column).isNotNull()), [column], rule)


def rule_key(df: DataFrame, column: str = "taxonID") -> DataFrame:
    """Id present and unique."""
    missing = rule_not_null(df, column, column)
    return missing.unionByName(rule_unique_allow_null(df, column))


def rule_cardinality(df: DataFrame, keys: Sequence[str], rule: str = "right_key_repeats") -> DataFrame:
    """Keys that would multiply rows in a join."""
    known = reduce(lambda d, k: d.filter(F.col(k).isNotNull()), keys, df)
    return rule_unique_rows(known, keys, rule)


def rule_in_values(
    df: DataFrame, column: str, values: Sequence[str], key: str = "taxonID", rule: str | None = None
) -> DataFrame:
    return row_rules(df, [in_values(column, values, key, rule)])


def rule_membership(
    df: DataFrame,
    column: str,
    target: DataFrame,
    target_column: str,
    key: str = "taxonID",
    rule: str | None = None,
) -> DataFrame:
    """Every non-null value must be in the target column."""
    from taxaloom.operators.joins import anti_join

    asked = df.filter(F.col(column).isNotNull()).select(key, F.col(column).alias("_ref"))
    bad = anti_join(asked, target.select(F.col(target_column).alias("_id")), [("_ref", "_id")])
    return _violations(bad, rule or f"{column}_resolves", F.col(key), F.col("_ref"))


def rule_predicate(df: DataFrame, bad: Column, rule: str, key: str = "taxonID", detail: Column | None = None) -> DataFrame:
    """Rows for which ``bad`` holds."""
    return row_rules(df, [predicate(bad, rule, key, detail)])


def rule_columns(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Column names outside the vocabulary (known from the schema, no scan)."""
    extra = [c for c in df.columns if c not in allowed]
    spark = df.sparkSession
    rows = [("column_names", c, "unknown column") for c in extra]
    return spark.createDataFrame(rows, "rule string, key string, detail string")


def table_row_rules(columns: Sequence[str], statuses: Sequence[str] = vocab.STATUSES) -> list[RowRule]:
    """The row rules of ``rule_table`` that apply to these columns."""
    rules = [not_null("taxonID", "taxonID")]
    if "taxonomicStatus" in columns:
        rules.append(in_values("taxonomicStatus", statuses))
    references = [c for c in ("acceptedNameUsageID", "parentNameUsageID") if c in columns]
    return rules + [predicate(F.col(c) == F.col("taxonID"), f"{c}_not_self") for c in references]


def rule_table(
    df: DataFrame,
    check_names: bool = False,
    check_columns: bool = True,
    statuses: Sequence[str] = vocab.STATUSES,
    extra: Sequence[str] = vocab.EXTRA_COLUMNS,
    row_rules_too: bool = True,
) -> DataFrame:
    """Taxon table check: id, status vocabulary, references that resolve, column names.

    Rules on single rows share one pass; without ``row_rules_too`` they have been counted by ``write_measured``.
    """
    found = [rule_unique_allow_null(df, "taxonID")]
    references = [c for c in ("acceptedNameUsageID", "parentNameUsageID") if c in df.columns]
    if row_rules_too:
        found.append(row_rules(df, table_row_rules(df.columns, statuses)))
    if references:
        found.append(rule_references(df, references))
    if check_names:
        found.append(rule_unique(df, "scientificName"))
    if check_columns:
        found.append(rule_columns(df, [*vocab.TERMS, *extra]))
    return check(found)


def rule_references(df: DataFrame, columns: Sequence[str], key: str = "taxonID") -> DataFrame:
    """Every non-null value of each column must be an id of the table: one pass and one join for all."""
    asked = df.select(
        F.col(key),
        F.explode(
            F.filter(
                F.array(*[F.struct(F.lit(f"{c}_resolves").alias("rule"), F.col(c).alias("_ref")) for c in columns]),
                lambda v: v["_ref"].isNotNull(),
            )
        ).alias("_v"),
    ).select(key, "_v.*")
    from taxaloom.operators.joins import anti_join

    bad = anti_join(asked, df.select(F.col(key).alias("_id")), [("_ref", "_id")])
    return bad.select("rule", F.col(key).cast("string").alias("key"), F.col("_ref").cast("string").alias("detail"))


def parentless_accepted() -> RowRule:
    """Accepted rows without parent are orders."""
    bad = F.col("parentNameUsageID").isNull() & (F.col("taxonomicStatus") == "accepted") & ~F.col("taxonRank").eqNullSafe("order")
    return predicate(bad, "parentless_accepted_is_order", detail=F.col("taxonRank"))


def rule_parentless(df: DataFrame) -> DataFrame:
    """Accepted rows without parent are orders; such synonyms belong to orders."""
    return row_rules(df, [parentless_accepted()]).unionByName(rule_parentless_synonyms(df))


def rule_parentless_synonyms(df: DataFrame) -> DataFrame:
    """Synonyms without parent belong to orders."""
    orphan = F.col("parentNameUsageID").isNull()
    from taxaloom.operators.joins import lookup_join, one_per_key

    alias = df.filter(orphan & (F.col("taxonomicStatus") == "synonym")).select("taxonID", "acceptedNameUsageID")
    ranks = df.select(F.col("taxonID").alias("_id"), F.col("taxonRank").alias("_rank"))
    joined = lookup_join(alias, one_per_key(ranks, "_id"), [("acceptedNameUsageID", "_id")])
    return rule_predicate(
        joined, ~F.col("_rank").eqNullSafe("order"), "parentless_synonym_of_order", detail=F.col("_rank")
    )


def check(violations: Sequence[DataFrame]) -> DataFrame:
    """All violations in one table."""
    return reduce(DataFrame.unionByName, violations)


def count_violations(violations: DataFrame) -> DataFrame:
    return violations.groupBy("rule").agg(F.count(F.lit(1)).alias("n_violations"))


def enforce(violations: DataFrame) -> None:
    """Raise with counts per rule when there is any violation; one row per rule is read."""
    broken = count_violations(violations).orderBy("rule").collect()
    if broken:
        raise RuleViolation(", ".join(f"{r['rule']}: {r['n_violations']}" for r in broken))
