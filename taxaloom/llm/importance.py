"""Quality selection by importance resampling over hashed n-grams.

Two bag-of-n-gram models (words and adjacent word pairs, hashed into ``BUCKETS`` buckets) are counted, one over
the target rows and one over all rows. A text's log weight is the sum of its n-grams' log probability
ratios; Gumbel noise from a hash of the id is added, and the rows with the largest keys are taken. That is a draw
without replacement in proportion to the weights. The noise depends on id and seed only, so a lost task repeats it.

Ranks come from a range partition with prefix sums, so that no task sees more than its share of rows.

Defined results: texts that are null or without words have log weight 0; buckets without target n-grams are smoothed;
without target rows all weights are 0 and the draw is uniform; equal keys go by id; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.llm.arrow import Work, add_columns, utf8
from taxaloom.llm.minhash import word_hashes
from taxaloom.llm.sharding import global_prefix

BUCKETS = 10_000
#: share of rows that is drawn
SHARE = 0.8
SMOOTHING = 1.0


def buckets(text: bytes | None) -> np.ndarray:
    """Bucket of every word and of every pair of adjacent words."""
    hashes = word_hashes(text.lower().split() if text else [])
    pairs = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:] * np.uint64(0xD6E8FEB86659FD93)
    return (np.concatenate((hashes, pairs ^ (pairs >> np.uint64(29)))) % np.uint64(BUCKETS)).astype(np.int64)


def ngram_counts(docs: DataFrame, text_col: str, target: str) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over all rows and over the rows that ``target`` marks, summed per task first."""

    def run(batches):
        total, wanted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text, mark in zip(utf8(batch, "text"), batch["target"].to_pylist(), strict=True):
                counts = np.bincount(buckets(text), minlength=BUCKETS)
                total += counts
                if mark:
                    wanted += counts
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BUCKETS)), pa.array(total), pa.array(wanted)], names=["bucket", "n", "target"]
        )

    rows = docs.select(F.col(text_col).alias("text"), F.col(target).alias("target"))
    sums = rows.mapInArrow(run, "bucket long, n long, target long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("target").alias("target"))
    total, wanted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for r in sums.collect():  # BUCKETS rows
        total[r.bucket], wanted[r.bucket] = r.n, r.target
    return total, wanted


def log_ratios(total: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Log of target over raw probability per bucket; 0 without target n-grams."""
    if not wanted.sum():
        return np.zeros(BUCKETS)
    p, q = (x + SMOOTHING for x in (wanted, total))
    return np.log(p / p.sum()) - np.log(q / q.sum())


def resample(
    docs: DataFrame, target: str, share: float = SHARE, seed: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_grams, log_weight, gumbel_key, selected) per row; ``target`` is a boolean column of ``docs``."""
    ratios = log_ratios(*ngram_counts(docs, text_col, target))
    shipped = docs.sparkSession.sparkContext.broadcast(ratios)  # BUCKETS doubles

    def make() -> Work:
        def work(batch: pa.RecordBatch) -> list:
            found = [buckets(t) for t in utf8(batch, "text")]
            return [[len(f) for f in found], [float(shipped.value[f].sum()) for f in found]]

        return work

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    weighted = add_columns(rows, "text", "n_grams long, log_weight double", make).drop("text")
    unit = (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    keyed = weighted.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(unit))).withColumn("one", F.lit(1))
    ranked = global_prefix(keyed.withColumn("order", -F.col("gumbel_key")), ["order", "id"], "one")
    most = int(share * docs.count())
    return ranked.select(
        F.col("id").alias(id_col), "n_grams", "log_weight", "gumbel_key", (F.col("_index") < most).alias("selected")
    )
