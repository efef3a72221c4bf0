"""Near-duplicate embeddings through a pivot-permutation index.

Every vector is described by its nearest reference points (pivots; ``prefix_length`` of them). Two vectors are
compared if their prefixes share ``SHARED`` pivots: the inverted lists are kept per set of that many
pivots, so that a list already holds the vectors with the wanted shared count. Each list is verified
with cosines in double precision, in blocks of ``BLOCK`` vectors; a pair that meets in several lists
counts in the list of its smallest shared pivots only. Lists of any length are verified whole; rows, not
pairs, leave a block: the links of each vector and the smallest id of its component in the block.

The index is fitted on a bounded sample (the pivots: 14 per cube root of the number of vectors, at most
``MOST_PIVOTS``), so list lengths stay alike as tables grow. Prefixes grow with every doubling of the pivots, since
a fixed one describes an ever smaller part of them. Recall of single pairs at cosine exactly 0.90 in a model of this
rule (random vectors of 64 dimensions): 0.98 with 202 pivots, 0.94 with 512, 0.97 with 1,400 and 0.97 with 4,096.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing,
and are their own component; vectors of different lengths never link; equal vectors are one class and
link with each other; repeated rows of an id and vector count once; a null id links with nothing;
other columns are not read.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.llm.arrow import whole_cells
from taxaloom.llm.components import components
from taxaloom.session import stage

COSINE = 0.9
#: pivots of a vector's prefix for up to ``PREFIX_PIVOTS`` pivots (one more for each doubling), and those to share
PREFIX, PREFIX_PIVOTS, SHARED = 8, 512, 3
PIVOTS_PER_ROOT, MOST_PIVOTS = 14, 4_096
#: vectors of a list that are compared at once
BLOCK = 512


def prefix_length(pivots: int) -> int:
    """Pivots that describe a vector, of so many."""
    return min(pivots, PREFIX + max(0, ceil(log2(pivots / PREFIX_PIVOTS))))


def unit(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision and without overflow."""
    values = values.astype(np.float64)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def _by_length(column: pa.Array) -> dict[int, np.ndarray]:
    """Row numbers per vector length."""
    lengths = np.array(pc.list_value_length(column).to_pylist(), np.int64)
    return {int(n): np.flatnonzero(lengths == n) for n in np.unique(lengths)}


def _matrix(column: pa.Array, rows: np.ndarray, length: int) -> np.ndarray:
    return column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _index(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Add ``prefix`` (ascending numbers of the nearest pivots) and ``keys`` (its subsets, as numbers)."""
    shipped = classes.sparkSession.sparkContext.broadcast(pivots)  # at most MOST_PIVOTS vectors

    def run(batches):
        known = shipped.value
        for batch in batches:
            column = batch["embedding"]
            prefixes, keys = [None] * batch.num_rows, [None] * batch.num_rows
            for length, rows in _by_length(column).items():
                points = known.get(length)
                if points is None:  # no pivot of this length: one list for all
                    points = np.ones((1, length)) / np.sqrt(length)
                near = unit(_matrix(column, rows, length)) @ points.T
                k = prefix_length(near.shape[1])
                first = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < near.shape[1] else np.tile(np.arange(k), (len(rows), 1))
                first = np.sort(first, axis=1)
                subsets = np.array(list(combinations(range(k), min(SHARED, k))))
                coded = np.full((len(rows), len(subsets)), length, np.int64)
                for place in range(SHARED):  # shorter subsets end with 0
                    own = first[:, subsets[:, place]] + 1 if place < subsets.shape[1] else 0
                    coded = coded * (MOST_PIVOTS + 1) + own
                for i, row in enumerate(rows.tolist()):
                    prefixes[row], keys[row] = first[i].tolist(), coded[i].tolist()
            yield pa.RecordBatch.from_arrays(
                [batch["rep"], batch["weight"], column, pa.array(prefixes, pa.list_(pa.int32())), pa.array(keys, pa.list_(pa.int64()))],
                names=["rep", "weight", "embedding", "prefix", "keys"],
            )

    kind = classes.schema["embedding"].dataType.simpleString()
    schema = f"rep long, weight long, embedding {kind}, prefix array<int>, keys array<long>"
    return classes.select("rep", "weight", "embedding").mapInArrow(run, schema)


def _subset(key: int) -> list[int]:
    """The pivots of a list, ascending."""
    out = []
    for _ in range(SHARED):
        key, digit = divmod(key, MOST_PIVOTS + 1)
        out.append(digit - 1)
    return [p for p in reversed(out) if p >= 0]


def _verified(pivots_of_list: list[int], units: np.ndarray, prefixes: list, rep: np.ndarray, weight: np.ndarray, left: np.ndarray, cosine: float):
    """(row, links, smallest id of its component) of the vectors of one block pair that have links.

    ``left`` marks the rows of the first block; all rows if the block is compared with itself.
    """
    a = np.flatnonzero(left)
    b = a if len(a) == len(left) else np.flatnonzero(~left)
    linked = units[a] @ units[b].T >= cosine
    if b is a:
        np.fill_diagonal(linked, False)
    if not linked.any():
        return
    last = pivots_of_list[-1] if pivots_of_list else -1
    lower = [[p for p in prefix if p < last and p not in pivots_of_list] for prefix in prefixes]
    if any(lower):  # a pair that shares a lower pivot too belongs to another list
        seen = {p: i for i, p in enumerate(sorted({p for ps in lower for p in ps}))}
        marks = np.zeros((len(lower), len(seen)), np.float32)
        for i, ps in enumerate(lower):
            marks[i, [seen[p] for p in ps]] = 1
        linked &= marks[a] @ marks[b].T == 0
    links = np.zeros(len(rep), np.int64)
    links[a] += linked @ weight[b]
    if b is not a:
        links[b] += linked.T @ weight[a]
    root = rep.copy()
    while True:
        best = np.where(linked, root[b][None, :], np.iinfo(np.int64).max).min(1)
        new = root.copy()
        new[a] = np.minimum(new[a], best)
        back = np.where(linked, new[a][:, None], np.iinfo(np.int64).max).min(0)
        new[b] = np.minimum(new[b], back)
        if (new == root).all():
            break
        root = new
    for i in np.flatnonzero(links):
        yield int(i), int(links[i]), int(root[i])


def _verify(cells: DataFrame, cosine: float) -> DataFrame:
    """Links per vector and cell. Rows come sorted, so a cell is a run of rows."""

    def run(batches):
        for whole, cells_ in whole_cells(batches, ["key", "i", "j"]):
            key, i, j, rep, weight, own = (whole[c].to_numpy() for c in ("key", "i", "j", "rep", "weight", "own"))
            prefixes = whole["prefix"].to_pylist()
            column = whole["embedding"].combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            units: list = [None] * len(key)
            for length, at in _by_length(column).items():
                for row, values in zip(at.tolist(), unit(_matrix(column, at, length)), strict=True):
                    units[row] = values
            out: tuple[list, list, list] = ([], [], [])
            for s, e in cells_:
                left = own[s:e] == i[s]
                if e - s < 2 or (i[s] != j[s] and (left.all() or not left.any())):
                    continue
                found = _verified(_subset(int(key[s])), np.stack(units[s:e]), prefixes[s:e], rep[s:e], weight[s:e], left, cosine)
                for row, links, root in found:
                    out[0].append(rep[s + row])
                    out[1].append(links)
                    out[2].append(root)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["rep", "links", "root"])

    return cells.mapInArrow(run, "rep long, links long, root long")


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    block: int = BLOCK,
    n_pivots: int | None = None,
) -> DataFrame:
    """(id, n_links, component_id, kept) per row. ``n_pivots``: in place of the number that follows from the table."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    sound = F.coalesce(
        F.col("id").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0), F.lit(False)
    )
    rows = rows.withColumn("embedding", F.when(sound, F.col("embedding")))
    distinct = rows.where("embedding is not null").distinct()
    classes = distinct.groupBy("embedding").agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
    classes = stage(classes, "classes")
    n = classes.count()
    wanted = min(MOST_PIVOTS, n_pivots or int(PIVOTS_PER_ROOT * n ** (1 / 3)) + 1)
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(wanted).select("embedding").collect()
    pivots: dict[int, np.ndarray] = {}
    for r in sample:
        pivots.setdefault(len(r.embedding), []).append(r.embedding)
    pivots = {length: unit(np.array(points, np.float64)) for length, points in pivots.items()}

    indexed = stage(_index(classes, pivots), "indexed")
    keys = indexed.select("rep", F.explode("keys").alias("key"))
    lists = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    meet = keys.join(lists, "key").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    other = meet.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = other.select(
        "rep", "key", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    ).join(indexed.select("rep", "weight", "embedding", "prefix"), "rep")
    cells = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    found = stage(_verify(cells.select("key", "i", "j", "own", "rep", "weight", "embedding", "prefix"), cosine), "links")

    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    per_class = stage(
        classes.join(links, "rep", "left")
        .join(roots, "rep", "left")
        .select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id"),
        ),
        "per_class",
    )
    out = rows.join(per_class, "embedding", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))).withColumnRenamed("id", id_col)
