"""Points and the bands that tile a line, met in one sorted stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaloom.operators.joins import Keys, key_pairs, one_per_key
from taxaloom.session import stage

#: order at one place: a band begins before the points that stand there
_BAND, _POINT = 0, 1


def last_start_join(points: DataFrame, bands: DataFrame, point: str, start: str = "start", on: Keys = ()) -> DataFrame:
    """Left join of every point with the band of its key that started last, at the point or before.

    A band goes on until the next one of its key starts. Points and bands are range-sorted together, so a point is moved
    once, is never copied, and a key of any size is spread over ranges; the last band of each range is carried into
    the ranges behind it. Bands that share key and start count as one, with the smallest other columns. Points
    without place, and null keys, match nothing. Columns of ``bands`` but for its keys are added.
    """
    spark = points.sparkSession
    pairs = key_pairs(on)
    added = [c for c in bands.columns if c not in {r for _, r in pairs}]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = lambda names: F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(names)])) if names else F.lit("")
    known = lambda names: F.coalesce(*[F.when(F.col(c).isNull(), F.lit(False)) for c in names], F.lit(True))
    left, right = [l for l, _ in pairs], [r for _, r in pairs]
    at, begin = F.col(point).cast("double"), F.col(start).cast("double")

    starts = one_per_key(bands.where(known(right) & begin.isNotNull() & ~F.isnan(begin)), *right, start)
    band = F.struct(*[F.col(c) for c in added])
    asked = known(left) & at.isNotNull() & ~F.isnan(at)
    row = F.struct(*[F.col(c) for c in points.columns])
    # points that match nothing come with a key of their own, spread by a hash
    alone = F.concat(F.lit("null "), F.xxhash64(*points.columns).cast("string"))
    stream = starts.select(key(right).alias("key"), begin.alias("at"), F.lit(_BAND).alias("kind"), band.alias("band"))
    stream = stream.withColumn("row", F.lit(None).cast(points.select(row.alias("row")).schema["row"].dataType)).unionByName(
        points.select(
            F.when(asked, key(left)).otherwise(alone).alias("key"),
            F.when(asked, at).otherwise(F.lit(0.0)).alias("at"),
            F.lit(_POINT).alias("kind"),
            F.lit(None).cast(stream.schema["band"].dataType).alias("band"),
            row.alias("row"),
        )
    )
    # a hash spreads points that share place and key over ranges too
    placed = stream.repartitionByRange(ranges, "key", "at", "kind", F.xxhash64("row")).sortWithinPartitions("key", "at", "kind")
    placed = placed.withColumn("part", F.spark_partition_id())
    out_schema = placed.select("part", "key", "kind", "row", "band", F.lit(True).alias("open")).schema
    swept = stage(placed.mapInArrow(_sweep, out_schema), "swept")

    # one row per range, with the last band in it
    ends = swept.where(F.col("kind") == _BAND).select("part", F.struct("key", "band").alias("last"))
    parts = swept.select("part").distinct().join(ends, "part", "left")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("part", F.last("last", ignorenulls=True).over(before).alias("carried"))
    found = swept.where(F.col("kind") == _POINT).join(F.broadcast(carried), "part", "left")  # a row per range
    match = F.when(F.col("open") & (F.col("carried.key") == F.col("key")), F.col("carried.band")).otherwise(F.col("band"))
    return found.select("row.*", match.alias("band")).select(*points.columns, *[F.col(f"band.{c}").alias(c) for c in added])


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Points of a range with the last band before them; ``open`` where none has come yet. At the end the last band."""
    names = ["part", "key", "kind", "row", "band", "open"]
    held: pa.RecordBatch | None = None  # the last band so far
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch.select(["part", "key", "kind", "row", "band"])
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        is_band = batch["kind"].to_numpy() == _BAND
        at = np.where(is_band, np.arange(batch.num_rows), -1)
        last = np.maximum.accumulate(at)
        if last[-1] >= 0:
            held = batch.slice(int(last[-1]), 1)
        points = np.flatnonzero(~is_band)
        if not len(points):
            continue
        of = last[points]
        keys = batch["key"]
        mine = keys.take(pa.array(points))
        there = keys.take(pa.array(of, mask=of < 0))
        same = pc.fill_null(pc.equal(mine, there), False).to_numpy(zero_copy_only=False)
        rows = batch.take(pa.array(points))
        bands = batch["band"].take(pa.array(of, mask=~same))
        # a band of another key came before: then none of this key is in the ranges ahead
        columns = [rows["part"], rows["key"], rows["kind"], rows["row"], bands, pa.array(of < 0)]
        yield pa.RecordBatch.from_arrays(columns, names=names)
    if held is not None:
        yield pa.RecordBatch.from_arrays([*(held[c] for c in names[:-1]), pa.array([False])], names=names)
