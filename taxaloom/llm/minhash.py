"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian pruning, exact verification.

1. Every text becomes the set of its 64-bit shingle hashes; texts with equal sets (by a 128-bit digest)
   are one class, and only the class's smallest id goes on.
2. Signatures are cut into bands; representatives that agree on a band share a bucket.
3. First every representative is compared with the smallest one of all its buckets, which leaves most
   buckets with one component. In the others, members outside the largest component are compared with all members
   of other components, in blocks of at most ``BLOCK`` texts. Pairs never leave a block, only links between
   components do. So no bucket is paired with itself, and no link between components is lost.
4. A pair is pruned when, after a batch of signature rows, the posterior probability (uniform prior) that the
   similarity reaches the threshold falls below ``MISS``. Survivors are verified on their full sets.

A pair at exactly 0.85 shares no band with probability 1.2e-5 and is pruned with about 4e-6. Bands are added for
lower thresholds (``bands_for``): a pair at exactly 0.80 shares none of 37 bands with probability 1.3e-5.

Defined results: texts that are null, empty or without words have no shingles and link with nothing; a
text of fewer words than a shingle has is one shingle; rows that repeat an id are one document (linked);
rows with a null id link with nothing and are kept; other columns are not read.
"""

from __future__ import annotations

import hashlib
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.llm.arrow import Work, add_columns, give_back, own_cache, utf8, whole_cells
from taxaloom.llm.components import checked, components
from taxaloom.session import stage

SHINGLE = 5
#: links need percent * union <= 100 * intersection; this is the percent of the query
PERCENT = 85
BANDS, BAND_ROWS = 24, 6
#: chance that a pair at the threshold shares no band; bands are added until it is met
BAND_MISS = 1.5e-5
MOST_BANDS = 400
HASHES = BANDS * BAND_ROWS
#: signature rows compared between two looks at the posterior
BATCH = 36
#: chance, per look, to lose a pair at the threshold
MISS = 1e-6
#: texts, and shingles of all texts, in one block of a bucket
BLOCK, BLOCK_SHINGLES = 512, 1_000_000
#: pairs of a block from which on shared shingles are counted by a matrix product
PAIRS = 400
#: words whose hash a Python worker remembers
CACHE_WORDS = 200_000

_random = np.random.RandomState(20_011)
_mult = _random.randint(0, 1 << 62, HASHES, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_plus = _random.randint(0, 1 << 62, HASHES, np.int64).astype(np.uint64)
_place = _random.randint(0, 1 << 62, 64, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_more = (MOST_BANDS - BANDS) * BAND_ROWS  # hash functions of added bands
_mult = np.concatenate((_mult, _random.randint(0, 1 << 62, _more, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)))
_plus = np.concatenate((_plus, _random.randint(0, 1 << 62, _more, np.int64).astype(np.uint64)))


def bands_for(percent: int) -> int:
    """Bands with which a pair at the threshold shares none with probability ``BAND_MISS`` at most."""
    bands = max(BANDS, ceil(log(BAND_MISS) / log(1 - (percent / 100) ** BAND_ROWS))) if percent < 100 else BANDS
    if bands > MOST_BANDS:
        raise ValueError(f"a similarity of {percent} % needs {bands} bands, more than {MOST_BANDS}")
    return bands


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_WORDS = _WordHashes()


def own_words() -> None:
    own_cache("words", _WORDS.clear)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a UTF-8 text."""
    words = text.lower().split() if text else []  # bytes: A-Z only; split at space and \\t..\\r only
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    size_ = min(size, len(words))
    n = len(words) - size_ + 1
    total = np.full(n, size_, np.uint64) * _place[63]
    for k in range(size_):
        total += hashes[k : k + n] * _place[k]
    return np.unique(_mixed(total))


def signature(hashes: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """The smallest value of the set under each hash function."""
    size = bands * BAND_ROWS
    best = np.full(size, np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(hashes), 1024):
        values = (_mult[:size, None] * hashes[None, k : k + 1024] + _plus[:size, None]) >> np.uint64(32)
        np.minimum(best, values.min(1).astype(np.uint32), out=best)
    return best


def band_keys(sig: np.ndarray) -> list[int]:
    rows = sig.reshape(-1, BAND_ROWS).astype(np.uint64)
    keys = (rows * _place[:BAND_ROWS]).sum(1, dtype=np.uint64) + np.arange(1, len(rows) + 1, dtype=np.uint64) * _place[62]
    return _mixed(keys).view(np.int64).tolist()


def sets_of(docs: DataFrame, id_col: str, text_col: str, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, digest, sig, bands) per row; digest, sig and bands are null without shingles.

    ``sig`` keeps the lower half of each signature value: unequal values agree there with probability
    2^-16, which can only let a pair survive. It has the rows of ``BANDS`` bands; only bands are added.
    """
    n_bands = bands_for(percent)

    def make() -> Work:
        own_words()

        def work(batch: pa.RecordBatch) -> list:
            counts, digests, sigs, bands = [], [], [], []
            for text in utf8(batch, "text"):
                hashes = shingles(text)
                counts.append(len(hashes))
                if not len(hashes):
                    digests.append(None)
                    sigs.append(None)
                    bands.append(None)
                    continue
                sig = signature(hashes, n_bands)
                digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                sigs.append(sig[:HASHES].astype(np.uint16).tobytes())
                bands.append(band_keys(sig))
            return [counts, digests, sigs, bands]

        return work

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return add_columns(rows, "text", "n_shingles long, digest binary, sig binary, bands array<long>", make).drop("text")


def fewest_matches(percent: int = PERCENT, miss: float = MISS) -> list[tuple[int, int]]:
    """(rows compared, fewest matches to go on): with a uniform prior, the posterior probability of a similarity
    of t or more after m of n matches is the binomial probability of at most m in n + 1 at t."""
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def prune(pairs: DataFrame, sigs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) that no look at their signatures rules out. ``sigs``: (id, sig)."""
    looks = fewest_matches(percent)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch[c].to_pylist()), np.uint16).reshape(-1, HASHES) for c in ("sig_a", "sig_b")
            )
            alive, matches, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), 0
            for n, fewest in looks:
                matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(1)
                alive, done = alive[matches[alive] >= fewest], n
            yield batch.select(["a", "b"]).take(pa.array(alive))
        give_back()

    wide = pairs.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a").join(
        sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b"
    )
    return wide.select("a", "b", "sig_a", "sig_b").mapInArrow(run, pairs.select("a", "b").schema).distinct()


def verify(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) whose full shingle sets are similar enough. ``texts``: (id, text)."""

    def run(batches):
        own_words()
        last: tuple = (None, None)
        for batch in batches:
            kept = []
            columns = [batch[c].to_pylist() if c == "b" else utf8(batch, c) for c in ("b", "text_a", "text_b")]
            for i, (b, text_a, text_b) in enumerate(zip(*columns, strict=True)):
                if last[0] != (b, text_b):  # rows come sorted by b
                    last = ((b, text_b), shingles(text_b))
                own, other = shingles(text_a), last[1]
                shared = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * shared >= percent * (len(own) + len(other) - shared):
                    kept.append(i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))
        give_back()

    wide = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"
    )
    return wide.select("a", "b", "text_a", "text_b").mapInArrow(run, pairs.select("a", "b").schema)


def _links(pairs: DataFrame, sigs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    survivors = stage(prune(pairs, sigs, percent), "survivors")
    ids = survivors.select(F.col("a").alias("id")).union(survivors.select(F.col("b").alias("id"))).distinct()
    needed = texts.join(checked(stage(ids, "needed")), "id", "left_semi")
    return stage(verify(survivors, needed, percent), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row; ``kept`` marks the smallest id of each component."""
    sets = stage(sets_of(docs, id_col, text_col, percent), "sets")
    linkable = sets.where("id is not null and digest is not null")
    classes = stage(linkable.groupBy("digest").agg(F.min("id").alias("rep")), "classes")
    # buckets of representatives; those with one member are dropped
    reps = linkable.join(classes, "digest").where("id = rep").dropDuplicates(["digest"])
    reps = stage(reps.select("id", F.col("n_shingles").alias("n"), "sig", "bands"), "reps")
    banded = reps.select("id", "n", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("id").alias("centre"), F.max("id").alias("last")).where("centre < last")
    members = stage(banded.join(shared, "bucket").select("bucket", "id", "n", "centre"), "members")
    candidates = stage(members.select("id").distinct(), "candidates")
    small = checked(candidates)
    sigs = stage(reps.join(small, "id", "left_semi").select("id", "sig"), "sigs")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = stage(rows.join(small, "id", "left_semi"), "texts")

    # each with the smallest member of all its buckets
    first = members.groupBy(F.col("id").alias("a")).agg(F.min("centre").alias("b")).where("b < a")
    found = _links(stage(first, "pairs"), sigs, texts, percent)
    # an id with several texts links their classes
    own = linkable.select("id", "digest").join(classes, "digest")
    several = own.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a < last")
    same = own.join(several.select("id", "a"), "id").select("a", F.col("rep").alias("b"))
    labels = components(found.unionByName(same))

    # buckets that hold several components
    now = stage(
        members.join(labels.select(F.col("node").alias("id"), "root"), "id", "left").select(
            "bucket", "id", "n", F.coalesce("root", "id").alias("comp")
        ),
        "open",
    )
    sizes = now.groupBy("bucket", "comp").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
    mixed = sizes.groupBy("bucket").agg(
        F.count("*").alias("parts"), F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.max(F.struct("rows", "n", "comp")).alias("top")
    )
    blocks = lambda rows, n: F.greatest(F.ceil(rows / BLOCK), F.ceil(n / BLOCK_SHINGLES), F.lit(1)).cast("int")
    mixed = mixed.where("parts > 1").select(
        "bucket",
        F.col("top.comp").alias("largest"),
        blocks(F.col("rows") - F.col("top.rows"), F.col("n") - F.col("top.n")).alias("others"),
        blocks(F.col("top.rows"), F.col("top.n")).alias("major"),
    )
    open_ = now.join(mixed, "bucket")
    # blocks 0 .. others - 1 hold members outside the largest component, the next ones its members
    outside = F.col("comp") != F.col("largest")
    block = F.when(outside, F.pmod(F.xxhash64("id"), F.col("others"))).otherwise(
        F.col("others") + F.pmod(F.xxhash64("id"), F.col("major"))
    )
    partners = F.sequence(F.lit(0), F.when(outside, F.col("others") + F.col("major") - 1).otherwise(F.col("others") - 1))
    cells = open_.withColumn("block", block.cast("int")).withColumn("other", F.explode(partners))
    cells = stage(
        cells.select("bucket", "id", "comp", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")),
        "cells",
    )
    if not cells.isEmpty():
        linked = stage(_cell_links(cells, sigs, texts, percent), "links")
        if not linked.isEmpty():
            known = labels.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
            labels = components(known.unionByName(linked))
    return _result(sets, classes, labels).withColumnRenamed("id", id_col)


def _cell_links(cells: DataFrame, sigs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between components that members of a cell's two blocks have."""
    looks = fewest_matches(percent)

    def run(batches):
        own_words()
        for whole, ranges in whole_cells(batches, ["bucket", "i", "j"]):
            i, j, block, comp, ids = (whole[c].to_numpy() for c in ("i", "j", "block", "comp", "id"))
            sig = np.frombuffer(b"".join(whole["sig"].to_pylist()), np.uint16).reshape(-1, HASHES)
            found: dict = {}  # shingles of the texts that a survivor needs
            raw = whole["text"].cast(pa.binary())

            def of(row: int, found=found, raw=raw) -> np.ndarray:
                if row not in found:
                    found[row] = shingles(raw[row].as_py())
                return found[row]

            out: tuple[list, list] = ([], [])
            for s, e in ranges:
                found.clear()
                left = np.flatnonzero(block[s:e] == i[s]) + s
                right = left if i[s] == j[s] else np.flatnonzero(block[s:e] == j[s]) + s
                for a, b in _verified_pairs(left, right, comp, ids, sig, of, looks, percent):
                    out[0].append(int(comp[a]))
                    out[1].append(int(comp[b]))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])

    wide = cells.join(sigs, "id").join(texts, "id").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    columns = ["bucket", "i", "j", "block", "comp", "id", "sig", "text"]
    return wide.select(*columns).mapInArrow(run, "a long, b long").distinct()


def _verified_pairs(left, right, comp, ids, sig, of, looks, percent):
    """Pairs of rows of different components that are similar enough: the first of every pair of components
    that is not connected by earlier ones of this cell."""
    if not len(left) or not len(right):
        return
    alive = comp[left][:, None] != comp[right][None, :]
    if right is left:
        alive &= ids[left][:, None] < ids[right][None, :]
    p, q = np.nonzero(alive)
    x, y = left[p], right[q]
    matches, done = np.zeros(len(x), np.int64), 0
    for n, fewest in looks:
        for k in range(0, len(x), 100_000):  # so many pairs at once
            part = slice(k, k + 100_000)
            matches[part] += (sig[x[part], done:n] == sig[y[part], done:n]).sum(1)
        keep = matches >= fewest
        x, y, matches, done = x[keep], y[keep], matches[keep], n
    if not len(x):
        return
    order = np.argsort(-matches, kind="stable")  # likely links first, so that later pairs are connected already
    x, y = x[order], y[order]
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.get(c, c) != c:
            c = root[c]
        return c

    shared = _shared_counts(x, y, of) if len(x) > PAIRS else None
    for k, (a, b) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
        ca, cb = find(int(comp[a])), find(int(comp[b]))
        if ca == cb:
            continue
        common = len(np.intersect1d(of(a), of(b), assume_unique=True)) if shared is None else int(shared[k])
        if 100 * common >= percent * (len(of(a)) + len(of(b)) - common):
            root[max(ca, cb)] = min(ca, cb)
            yield a, b


def _shared_counts(x: np.ndarray, y: np.ndarray, of) -> np.ndarray:
    """Number of shared shingles of each pair of rows, from products of incidence matrices of columns in turn."""
    rows = np.unique(np.concatenate((x, y)))
    at = {int(r): k for k, r in enumerate(rows)}
    sets = [of(int(r)) for r in rows]
    owner = np.repeat(np.arange(len(rows)), [len(s) for s in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = times > 1  # a shingle of one text is shared by none
    number = np.cumsum(several) - 1
    kept = several[column]
    owner, column = owner[kept], number[column[kept]]
    product = np.zeros((len(rows), len(rows)), np.float32)
    for start in range(0, int(several.sum()), 8_192):
        part = (column >= start) & (column < start + 8_192)
        marks = np.zeros((len(rows), 8_192), np.float32)
        marks[owner[part], column[part] - start] = 1
        product += marks @ marks.T
    return product[[at[int(r)] for r in x], [at[int(r)] for r in y]]


def _result(sets: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Ids get the component of their class's representative."""
    rows = sets.select("id", "n_shingles", "digest").join(classes, "digest", "left")
    rep = F.when(F.col("id").isNotNull(), F.coalesce("rep", "id"))
    found = rows.select("id", "n_shingles", rep.alias("rep")).join(
        labels.select(F.col("node").alias("rep"), "root"), "rep", "left"
    )
    found = found.select("id", "n_shingles", F.coalesce("root", "rep").alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents without near-duplicates: of each component the row of the smallest id stays, and of rows
    that repeat an id the one with the smallest text."""
    columns = docs.columns
    found = stage(near_duplicates(docs, id_col, text_col, percent), "found")
    gone = stage(found.where("not kept").select(id_col).distinct(), "gone")
    left = docs.join(checked(gone), id_col, "left_anti")
    several = found.where(F.col("kept") & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1")
    several = stage(several.select(id_col), "several")
    if several.isEmpty():
        return left.select(columns)
    small = checked(several)
    rows = left.join(small, id_col, "left_semi").select(columns)
    one = rows.groupBy(id_col).agg(F.min_by(F.struct(*columns), text_col).alias("row")).select("row.*")
    return left.join(small, id_col, "left_anti").select(columns).unionByName(one)
