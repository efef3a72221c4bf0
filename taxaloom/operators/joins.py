"""Joins that stay balanced when one key holds a large share of the rows.

``lookup_join`` is the one equi join of the package. Where the caller names a
stored table that holds the left keys (``keys_from``), keys with more than 1/128
of its rows are found in one narrow pass over it, and only those are salted, so
the right side is copied for at most a few hundred keys. Elsewhere adaptive skew
handling splits large partitions: the left side is never evaluated just to look
for hot keys. No side is broadcast by hint unless its size has a fixed bound;
Spark still broadcasts sides that its own statistics show to be small.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 128
SKETCH_GROUPS = 512
# a table below this size has no key that a task could not hold; it is not searched for hot ones
SMALL_BYTES = 64 << 20

Keys = Sequence["str | tuple[str, str]"]


def key_pairs(on: Keys | str) -> list[tuple[str, str]]:
    on = [on] if isinstance(on, str) else on
    return [(k, k) if isinstance(k, str) else tuple(k) for k in on]


def _salts(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _key_hashes(left: DataFrame, target: DataFrame, pairs: list[tuple[str, str]]) -> tuple[str, str]:
    """SQL hash of the key on either side; keys that are equal have equal hashes.

    Numbers of different types, and doubles with their two zeros, go through double.
    """
    left_types, right_types = dict(left.dtypes), dict(target.dtypes)

    def same(name: str, own: str, other: str) -> str:
        if own == other and own not in ("double", "float"):
            return _quoted(name)
        if "string" in (own, other):
            raise TypeError(f"join key {name}: {own} against {other}")
        return f"CAST({_quoted(name)} AS DOUBLE) + 0D"

    left_keys = [same(l, left_types[l], right_types[r]) for l, r in pairs]
    right_keys = [same(r, right_types[r], left_types[l]) for l, r in pairs]
    return f"xxhash64({', '.join(left_keys)})", f"xxhash64({', '.join(right_keys)})"


def hot_hashes(df: DataFrame, hashed: str) -> list[int]:
    """Hashes of all keys with more than 1/128 of the rows: one pass, at most a few hundred values.

    Sketches are merged in up to 512 groups of tasks, so no task sees them all. A
    group keeps its 256 most frequent keys, so what is lost of a key is below
    1/256 of the rows, and the cut is made at that share.
    """
    groups = (
        df.select(F.expr(hashed).alias("_hash"))
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group"))
        .agg(
            F.expr(f"approx_top_k(_hash, {2 * HOT_KEYS}, {8 * HOT_KEYS})").alias("_top"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )
    # the entry without item carries the row count of the group
    entries = groups.select(
        F.explode(F.expr("concat(_top, array(named_struct('item', CAST(NULL AS BIGINT), 'count', _rows)))")).alias("_e")
    )
    sums = entries.groupBy("_e.item").agg(F.sum("_e.count").alias("n"))
    largest = sums.orderBy(F.col("n").desc()).limit(2 * HOT_KEYS + 1).collect()
    total = next((r["n"] for r in largest if r["item"] is None), 0)
    return sorted(r["item"] for r in largest if r["item"] is not None and r["n"] * 2 * HOT_KEYS >= total)


def _estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a frame's size; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Keys | str,
    how: str = "left",
    *,
    residual: Column | None = None,
    null_safe: bool = False,
    skewed: bool = True,
    keys_from: DataFrame | None = None,
    salt_by: Sequence[str] | None = None,
    bounded: bool = False,
    exploded: bool = False,
) -> DataFrame:
    """Equi join of a possibly skewed ``left`` with ``right``.

    ``on``: names, or (left name, right name) pairs; right keys are dropped.
    ``residual``: further condition on columns of both sides.
    ``keys_from``: stored frame with the same left keys, to look for hot ones.
    ``skewed=False``: the key is unique on the left, so there is nothing to salt.
    ``salt_by``: left columns that tell rows of one key apart (default: all).
    ``bounded=True``: the size of ``right`` has a fixed bound; it is broadcast.
    ``exploded=True``: a side makes many rows of each stored one, which Spark's estimate doesn't see; neither is broadcast.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    pairs = key_pairs(on)
    renamed = {r: f"_right_{i}" for i, (_, r) in enumerate(pairs)}
    target = right.select(
        *[F.col(r).alias(n) for r, n in renamed.items()],
        *[F.col(c) for c in right.columns if c not in renamed],
    )
    if how in ("left_semi", "left_anti") and residual is None:
        target = target.select(*renamed.values()).distinct()

    def equal(l: str, r: str) -> Column:
        a, b = F.col(l), F.col(renamed[r])
        return a.eqNullSafe(b) if null_safe else a == b

    condition = reduce(and_, [equal(l, r) for l, r in pairs])
    if residual is not None:
        condition = condition & residual
    if bounded:
        return left.join(F.broadcast(target), condition, how).drop(*renamed.values())
    if exploded:
        target = target.hint("merge")
    left_hash, right_hash = _key_hashes(left, target, [(l, renamed[r]) for l, r in pairs])
    searched = skewed and keys_from is not None and _estimated_bytes(keys_from) >= SMALL_BYTES
    hot = hot_hashes(keys_from, left_hash) if searched else []
    if not hot:
        return left.join(target, condition, how).drop(*renamed.values())
    salts = _salts(left)
    listed = ", ".join(f"{h}L" for h in hot)
    row_hash = f"xxhash64({', '.join(map(_quoted, salt_by or left.columns))})"
    salt = f"CASE WHEN {left_hash} IN ({listed}) THEN CAST(pmod({row_hash}, {salts}) AS INT) ELSE 0 END"
    copies = f"CASE WHEN {right_hash} IN ({listed}) THEN sequence(0, {salts - 1}) ELSE array(0) END"
    joined = left.select("*", F.expr(salt).alias("_salt")).join(
        target.select("*", F.expr(f"explode({copies})").alias("_right_salt")),
        condition & (F.col("_salt") == F.col("_right_salt")),
        how,
    )
    return joined.drop("_salt", "_right_salt", *renamed.values())


def anti_join(left: DataFrame, right: DataFrame, on: Keys | str, **options) -> DataFrame:
    """Rows of ``left`` without a match; rows with a null key stay."""
    return lookup_join(left, right, on, "left_anti", **options)


def semi_join(left: DataFrame, right: DataFrame, on: Keys | str, **options) -> DataFrame:
    return lookup_join(left, right, on, "left_semi", **options)


def inner_join(left: DataFrame, right: DataFrame, on: Keys | str, **options) -> DataFrame:
    return lookup_join(left, right, on, "inner", **options)


def one_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """Smallest row per key, so that a join on the key cannot multiply rows.

    The join needs the same shuffle, and copies are merged before it.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, "_row.*")


def many_to_one(left: DataFrame, right: DataFrame, on: Keys | str, **options) -> tuple[DataFrame, DataFrame]:
    """(left join, violations): the right key must not repeat.

    A repeated right key is matched once, with its smallest row, and reported,
    so the join never multiplies rows.
    """
    from taxaloom.operators.quality import rule_cardinality

    keys = [r for _, r in key_pairs(on)]
    joined = lookup_join(left, one_per_key(right, *keys), on, **options)
    return joined, rule_cardinality(right, keys, "right_key_repeats")


def one_to_one(left: DataFrame, right: DataFrame, on: Keys | str, **options) -> tuple[DataFrame, DataFrame]:
    """As ``many_to_one``, and the left key must not repeat either."""
    from taxaloom.operators.quality import rule_cardinality

    joined, violations = many_to_one(left, right, on, **options)
    left_keys = [l for l, _ in key_pairs(on)]
    return joined, violations.unionByName(rule_cardinality(left, left_keys, "left_key_repeats"))


def remove_listed(
    df: DataFrame, listed: DataFrame, on: Keys | str, mark: str = "comments_mh", phrase: str = "delete"
) -> DataFrame:
    """Drop rows on a curated list whose comment holds ``phrase``."""
    return anti_join(df, listed.filter(F.col(mark).contains(phrase)), on)


def exclude_pairs(df: DataFrame, pairs: DataFrame, on: Keys | str, **options) -> DataFrame:
    """Drop rows whose value pair is on the exclusion table."""
    return anti_join(df, pairs, on, **options)


def lookup_fill(
    df: DataFrame,
    fill_to: str,
    fill_from: str,
    match_to: str,
    match_from: str,
    overwrite: bool = False,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Fill ``fill_to`` with ``fill_from`` of the row whose ``match_to`` equals ``match_from``.

    Only nulls are filled unless ``overwrite``. ``match_to`` is an id; if it repeats, the smallest value counts.
    """
    source = one_per_key(df.select(F.col(match_to).alias("_id"), F.col(fill_from).alias("_found")), "_id")
    wanted = df if fill_to in df.columns else df.withColumn(fill_to, F.lit(None).cast("string"))
    joined = lookup_join(wanted, source, [(match_from, "_id")], salt_by=[match_to], keys_from=keys_from)
    order = ("_found", fill_to) if overwrite else (fill_to, "_found")
    return joined.withColumn(fill_to, F.coalesce(*order)).drop("_found").select(*wanted.columns)


def parent_for_alias(
    df: DataFrame,
    id_col: str = "taxonID",
    accepted_col: str = "acceptedNameUsageID",
    parent_col: str = "parentNameUsageID",
) -> DataFrame:
    """An alias without a parent takes the parent of its accepted record."""
    return lookup_fill(df, parent_col, parent_col, id_col, accepted_col)


# --- interval joins -------------------------------------------------------

# band sizes are powers of two; bands of 2^62 and more, and open ones, share one cell per key
_OPEN_LEVEL = 9_999
_LARGEST_LEVEL, _SMALLEST_LEVEL = 62, -1_022
#: bands that are broadcast at most
FEW_BANDS = 5_000


def _level(start: Column, end: Column) -> Column:
    """Power of two that a band fits in, but not below what a double tells apart at its place."""
    place = F.greatest(F.abs(start), F.abs(end))
    finest = F.when(place > 0, F.floor(F.log2(place)) - 51).otherwise(_SMALLEST_LEVEL)
    width = end - start
    exact = F.when(width > 0, F.ceil(F.log2(width))).otherwise(_SMALLEST_LEVEL)
    level = F.greatest(exact, finest, F.lit(_SMALLEST_LEVEL)).cast("int")
    return F.when(width >= float(2**_LARGEST_LEVEL), F.lit(_OPEN_LEVEL)).otherwise(level)


def _cell(value: Column, level: Column) -> Column:
    cell = F.floor(value / F.pow(F.lit(2.0), level)).cast("long")
    return F.when(level == _OPEN_LEVEL, F.lit(0).cast("long")).otherwise(cell)


def interval_join(
    points: DataFrame,
    bands: DataFrame,
    point: str,
    id_col: str,
    start: str = "start",
    end: str = "end",
    on: Keys = (),
    closed: bool = False,
    how: str = "left",
    widths: Sequence[float] | None = None,
) -> DataFrame:
    """Bands that hold ``point``: ``start <= point < end`` (``<=`` when ``closed``).

    A band is filed in the at most three cells of its own size that it touches, whatever that size is, and a
    point looks into one cell per band size in use, so the join is an equi join on (keys, size, cell) and
    never compares all pairs of a key. The sizes in use are read first, unless the caller states the ``widths`` of
    the bands (others match too, from more cells). Matching runs over (id, point, keys)
    only, each different one once, and is joined back, so rows that repeat an id keep their own matches.
    Cells with very many points are left to adaptive skew handling, which copies no bands. Only bands that were counted
    and are at most ``FEW_BANDS`` are broadcast.
    """
    low, high, at = F.col(start).cast("double"), F.col(end).cast("double"), F.col(point).cast("double")
    pairs = key_pairs(on)
    sound = bands.filter(low.isNotNull() & (high >= low))
    stated = sorted({max(_SMALLEST_LEVEL, math.ceil(math.log2(w))) for w in widths or () if w > 0})
    level = _level(low, high)
    if stated:
        level = F.lit(stated[-1])
        for size in reversed(stated[:-1]):
            level = F.when(high - low <= float(2**size), F.lit(size)).otherwise(level)
    filed = sound.withColumn("_level", level).withColumn(
        "_cell", F.explode(F.sequence(_cell(low, F.col("_level")), _cell(high, F.col("_level"))))
    )
    in_use = {} if stated else dict(sound.groupBy(level.alias("level")).agg(F.count(F.lit(1))).collect())
    levels = stated or sorted(in_use)
    few = not stated and sum(in_use.values()) <= FEW_BANDS
    inside = (low <= at) & ((at <= high) if closed else (at < high))
    needed = list(dict.fromkeys([id_col, point, *[l for l, _ in pairs]]))
    band_columns = [c for c in bands.columns if c not in {r for _, r in pairs}]
    asked = points.select(*needed).filter(at.isNotNull() & ~F.isnan(at)).distinct()
    probes = asked.withColumn("_level", F.explode(F.array(*[F.lit(n) for n in levels or [0]]))).withColumn(
        "_cell", _cell(at, F.col("_level"))
    )
    keys = [*pairs, ("_level", "_level"), ("_cell", "_cell")]
    matched = lookup_join(probes, filed, keys, "inner", residual=inside, bounded=few, exploded=True).select(
        *[F.col(c).alias(f"_point_{i}") for i, c in enumerate(needed)], *band_columns
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_point_{i}")) for i, c in enumerate(needed)])
    return points.join(matched, same, how).drop(*[f"_point_{i}" for i in range(len(needed))])
