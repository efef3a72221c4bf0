"""Contiguous shards of nearly equal bytes from global prefix sums.

Rows are sorted by id into range partitions; per-partition totals give every partition its global
offset, a running sum inside the partition gives every row its global byte interval, and equal cut
points over the total decide the shard. Only (id, size, checksum) rows move, never texts.

Defined results: a null text has no bytes and counts with the fixed row overhead; null ids come first;
rows that agree in id, size and checksum are interchangeable; an empty table gives an empty result;
other columns of the input are not read and may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaloom.session import stage

#: bytes that every row costs besides its text
ROW_BYTES = 8


def sized_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_bytes: int = ROW_BYTES) -> DataFrame:
    """(id, size, text_crc32) per row; the crc is unsigned, over UTF-8 bytes."""
    return docs.select(
        F.col(id_col),
        (F.coalesce(F.octet_length(text_col).cast("long"), F.lit(0)) + row_bytes).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
    )


def global_prefix(rows: DataFrame, order: list[str], size_col: str = "size") -> DataFrame:
    """Add ``_before`` (sizes of all rows ahead) and ``_index`` (count of rows ahead) in global order.

    The rows are range-partitioned and written once, so that every later pass sees the same
    partitions; a window runs over one range partition only. Range partitions that share their first
    sort key's value are split by the other keys of ``order``.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(
        rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()),
        "prefix",
    )
    totals = placed.groupBy("_part").agg(F.sum(size_col).alias("_bytes"), F.count("*").alias("_rows"))
    # one row per partition: the cumulative sum over partitions needs no more than that
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(ahead), F.lit(0)).alias("_part_before"),
        F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_part_index"),
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    return (
        placed.withColumn("_in", F.sum(size_col).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_row", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_part")  # at most spark.sql.shuffle.partitions rows
        .withColumn("_before", F.col("_part_before") + F.col("_in") - F.col(size_col))
        .withColumn("_index", F.col("_part_index") + F.col("_row") - 1)
        .drop("_part", "_in", "_row", "_part_before", "_part_index")
    )


def shard_by_bytes(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard): contiguous shards of near-equal bytes.

    A row goes to the shard in whose byte interval its middle lies, so a shard misses its target by
    less than one row at either end. Slots count the rows of a shard from 0 without gaps.
    """
    order = [id_col, "size", "text_crc32"]
    numbered = stage(global_prefix(sized_rows(docs, id_col, text_col), order), "numbered")
    total = numbered.agg(F.sum("size")).first()[0]
    if total is None:  # no rows
        total = 1
    cut = numbered.withColumn("shard", F.expr(f"cast(({shards} * (2 * _before + size)) div {2 * total} as int)"))
    firsts = cut.groupBy("shard").agg(F.min("_index").alias("_first"))  # one row per shard
    return cut.join(F.broadcast(firsts), "shard").select(
        id_col,
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_index") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the documents into ``path/shard=N`` folders, each in slot order.

    Ids must be unique here, since rows find their shard by id.
    """
    placed = shard_by_bytes(docs, shards, id_col, text_col).select(id_col, "shard", "slot")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        docs.join(placed, id_col)
        .repartitionByRange(max(parts, shards), "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
