"""Order- and group-based operators without single-task windows over the data.

Positions are cut into buckets of a fixed number of rows. Windows run inside a
bucket; what crosses a bucket edge is carried through one row per bucket, and
that small table is cut the same way once more. The last, unpartitioned window
sees one row per ``bucket_rows ** 2`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaloom.operators.joins import lookup_join
from taxaloom.session import stage

BUCKET_ROWS = 10_000


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str = "row_no") -> DataFrame:
    """1..n in the order given, over all tasks; written once, so numbers are stable.

    The order must be total (end it with an id). Rows are range-sorted and
    written; a row's number is the rows in earlier files plus its place in its file.
    """
    staged = stage(df.orderBy(*order), "numbered").select(
        "*",
        F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long").alias("_file"),
        F.col("_metadata.row_index").alias("_index"),
    )
    sizes = staged.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per written file, so both the window and the broadcast are bounded by the task count
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    numbered = staged.join(F.broadcast(offsets), "_file")
    return numbered.withColumn(name, F.col("_before") + F.col("_index") + 1).drop("_file", "_index", "_before")


def _bucketed(df: DataFrame, pos: str, keys: Sequence[str], bucket_rows: int) -> DataFrame:
    """Adds the key as one never-null struct and the bucket; both compare with plain equality.

    Windows and joins on them share one partitioning, so rows are shuffled once.
    """
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)
    return df.withColumns({"_key": key, "_b1": F.floor(F.col(pos) / bucket_rows)})


def carry_forward(
    df: DataFrame,
    values: Sequence[str],
    pos: str,
    keys: Sequence[str] = (),
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Fill nulls of ``values`` with the last value before, by ``pos`` within ``keys``.

    ``pos`` is a unique whole number (see ``number_rows``), so a bucket holds at
    most ``bucket_rows`` rows whatever the size of a key.
    """
    rows = _bucketed(df, pos, keys, bucket_rows)

    def last_known(v: str, order: str) -> Column:
        return F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.col(order)))

    def before(partition: list[str], order: str):
        return Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    small = (
        rows.groupBy("_key", "_b1")
        .agg(*[last_known(v, pos).alias(v) for v in values])
        .withColumn("_b2", F.floor(F.col("_b1") / bucket_rows))
    )
    large = small.groupBy("_key", "_b2").agg(*[last_known(v, "_b1").alias(v) for v in values])
    far = large.select(
        "_key", "_b2", *[F.last(v, True).over(before(["_key"], "_b2")).alias(f"_far_{v}") for v in values]
    )
    near = small.withColumns({v: F.last(v, True).over(before(["_key", "_b2"], "_b1")) for v in values})
    carried = near.join(far, ["_key", "_b2"], "left").select(
        "_key", "_b1", *[F.coalesce(v, f"_far_{v}").alias(f"_in_{v}") for v in values]
    )
    here = Window.partitionBy("_key", "_b1").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.withColumns({v: F.last(v, True).over(here) for v in values})
    joined = filled.join(carried, ["_key", "_b1"], "left")
    return joined.withColumns({v: F.coalesce(v, f"_in_{v}") for v in values}).select(*df.columns)


def next_value(
    df: DataFrame,
    value: str,
    pos: str,
    name: str,
    keys: Sequence[str] = (),
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``value`` of the next row by ``pos`` within ``keys``; null on the last row."""
    rows = _bucketed(df, pos, keys, bucket_rows).withColumn("_v", F.struct(F.col(value).alias("v")))
    small = (
        rows.groupBy("_key", "_b1")
        .agg(F.min_by("_v", pos).alias("_first"))
        .withColumn("_b2", F.floor(F.col("_b1") / bucket_rows))
    )
    large = small.groupBy("_key", "_b2").agg(F.min_by("_first", "_b1").alias("_first"))
    far = large.select(
        "_key", "_b2", F.lead("_first").over(Window.partitionBy("_key").orderBy("_b2")).alias("_far")
    )
    near = small.withColumn("_near", F.lead("_first").over(Window.partitionBy("_key", "_b2").orderBy("_b1")))
    carried = near.join(far, ["_key", "_b2"], "left").select(
        "_key", "_b1", F.coalesce("_near", "_far").alias("_out")
    )
    here = Window.partitionBy("_key", "_b1").orderBy(pos)
    joined = rows.withColumn("_next", F.lead("_v").over(here)).join(carried, ["_key", "_b1"], "left")
    return joined.withColumn(name, F.coalesce("_next", "_out")["v"]).select(*df.columns, name)


def next_start_interval(
    df: DataFrame,
    start: str,
    pos: str,
    keys: Sequence[str] = (),
    end: str = "end",
    bucket_rows: int = BUCKET_ROWS,
    dense: bool = False,
) -> DataFrame:
    """``end`` = next start - 1; the last interval is open (+Infinity).

    ``pos`` orders the rows of a key and is unique there. Positions of any type are numbered first, so
    buckets fill evenly; ``dense=True`` says that they are whole numbers with few gaps already.
    """
    if not dense:
        numbered = number_rows(df, [*keys, pos], "_pos")
        return next_start_interval(numbered, start, "_pos", keys, end, bucket_rows, dense=True).drop("_pos")
    following = next_value(df, start, pos, "_next_start", keys, bucket_rows)
    return following.withColumn(
        end, F.coalesce(F.col("_next_start").cast("double") - 1, F.lit(float("inf")))
    ).drop("_next_start")


def fixed_width_interval(df: DataFrame, start: str, width: float, end: str = "end") -> DataFrame:
    return df.withColumn(end, F.col(start) + F.lit(width))


def add_count(
    df: DataFrame, keys: Sequence[str], name: str = "n", salt_by: Sequence[str] | None = None
) -> DataFrame:
    """Group size on every row; null keys form one group.

    ``df`` is evaluated once and written; counts come from partial aggregates over the written rows and
    are joined back, so no task holds a group.
    """
    rows = stage(df, "counted")
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return lookup_join(rows, counts, list(keys), "left", null_safe=True, salt_by=salt_by, keys_from=rows)


def status_by_multiplicity(
    df: DataFrame, keys: Sequence[str], name: str = "taxonomicStatus", salt_by: Sequence[str] | None = None
) -> DataFrame:
    """"synonym" for a name listed once, "ambiguous synonym" for one listed more often."""
    counted = add_count(df, keys, "_times", salt_by)
    status = F.when(F.col("_times") == 1, "synonym").otherwise("ambiguous synonym")
    return counted.withColumn(name, status).drop("_times")


def unique_only_lookup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs exactly once; one partial aggregate, no window."""
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_times"), *[F.min(c).alias(c) for c in rest]
    )
    return grouped.filter(F.col("_times") == 1).select(*df.columns)


def first_hit(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key by ``order``; a minimum, so partly aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)
