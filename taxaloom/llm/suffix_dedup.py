"""Repeated passages by a depth-limited radix sort of suffixes.

Suffixes are compared through their first ``WINDOW`` bytes only. Passes refine groups of suffixes by one digit at a time and
drop every suffix that is alone in its group; what is equal after the last digit are exactly the repeated windows.

1. First digit: the gram of ``GRAM`` bytes with the smallest hash in the window. Neighbouring suffixes share it, so they
   travel as one run (start, count, digest of the text), and equal windows always have it in common. Runs whose gram
   occurs once are dropped, and equal runs (by gram and digest, 128 bits) fall together.
2. Where different runs remain, they are sent with their text to their gram's group, and their suffixes are sorted by
   the bytes of the window, eight at a time.
3. Groups of more than ``MOST_RUNS`` runs are not gathered: their suffixes are told apart by the digest of the whole
   window (128 bits), of which a task sends each one once. Grams that are frequent in many slices are known from a first
   count and take this way at once; the list has at most ``HOT_GRAMS`` entries by arithmetic.

Of each group all suffixes but the first (smallest id, then start) are marks; a document loses the bytes they cover.
Tasks send a gram or a digest once per slice of ``SLICE_BYTES``, so a passage that a third of all documents
share costs a group no more than a row a slice.

Defined results: null and empty texts, and texts shorter than a window, lose nothing; ids and texts together name a
document: repeated rows of both have the same result, documents with one id and different texts come in the order of
their texts' hashes, null ids come first (as the smallest long) in the same way; very long texts are hashed in chunks; an
empty table gives an empty result; other columns pass through, but for those with the names of added ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.llm.arrow import field, give_back
from taxaloom.llm.components import checked
from taxaloom.session import stage

WINDOW, GRAM = 100, 32
#: bytes of text in which a task merges equal grams, runs and digests before it sends them, and those hashed at once
SLICE_BYTES, CHUNK = 16 << 20, 1 << 18
#: windows of a run, and runs of a gram's group, that stay together
RUN, MOST_RUNS = 256, 1_000
#: occurrences in a slice from which a gram is counted ahead; hot are those with a share of 1 / HOT_GRAMS of all runs,
#: if these are more than MOST_RUNS
SEEN, HOT_GRAMS = 8, 1 << 16
#: windows that one radix sort holds
SORTED = 1 << 20

_LOW = np.uint64((1 << 20) - 1)  # place in a chunk, kept beside the upper bits of a hash
#: a run on its way: its document, ``at`` (start, and in the lower bits windows - 1, and the flags below), its digest
_PLACE = np.dtype([("d", "<i8"), ("tie", "<i8"), ("at", "<i8"), ("digest", "<i8")])
#: the group is large; the gram occurs twice in the run; an earlier run is equal
_LARGE, _TWICE, _EQUAL = 1, 2, 4


def _at(start: np.ndarray, windows: np.ndarray, flags: np.ndarray) -> np.ndarray:
    return start << 11 | (windows - 1) << 3 | flags


def _multipliers(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Random values of the bytes, and odd factors of the doublings (fixed by the seed, alike in all tasks)."""
    values = np.random.Generator(np.random.PCG64(seed)).integers(0, (1 << 64) - 1, 256 + 16, np.uint64)
    return values[:256], values[256:] | np.uint64(1)


_HASHES = {seed: _multipliers(seed) for seed in (1, 2, 3)}


def rolling(raw: np.ndarray, size: int, seed: int) -> np.ndarray:
    """64-bit hash of the ``size`` bytes from each position on, by doubling."""
    values, factors = _HASHES[seed]
    have, length, out, done = values[raw], 1, None, 0
    step = 0
    while True:
        if size & length:
            if out is None:
                out, done = have, length
            else:  # what is longer goes before
                n = len(raw) - done - length + 1
                out, done = _joined(have[:n], out[length : length + n], factors[8 + step]), done + length
        length *= 2
        if length > size:
            return out
        n = len(raw) - length + 1
        have, step = _joined(have[:n], have[length // 2 : length // 2 + n], factors[step]), step + 1


def _joined(first: np.ndarray, second: np.ndarray, factor: np.uint64) -> np.ndarray:
    out = first * factor
    out ^= out >> np.uint64(31)
    out += second
    out *= factor
    out ^= out >> np.uint64(29)
    return out


def _sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    have = 1
    n = len(values) - size + 1
    while have * 2 <= size:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[:n], values[size - have : size - have + n])


def runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram, start, windows, whether the gram occurs in it twice) of the runs of suffixes in texts laid end to end."""
    whole = np.ones(len(raw), bool)  # windows that end in the text they begin in
    for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        whole[max(s, e - WINDOW + 1) : e] = False
    out: list[list[np.ndarray]] = [[], [], [], []]
    for first in range(0, len(raw) - WINDOW + 1, CHUNK):
        part = raw[first : first + CHUNK + WINDOW - 1]
        hashes = rolling(part, GRAM, 1)
        upper, place = hashes & ~_LOW, np.arange(len(hashes), dtype=np.uint64)
        span = WINDOW - GRAM + 1
        at = _sliding_minimum(upper | place, span) & _LOW
        last = _LOW - (_sliding_minimum(upper | (_LOW - place), span) & _LOW)
        twice = at != last
        gram = hashes[at]
        ok = whole[first : first + len(at)]
        new = ok.copy()
        new[1:] &= ~ok[:-1] | (gram[1:] != gram[:-1])
        starts = np.flatnonzero(new)
        if not len(starts):
            continue
        stops = np.append(np.flatnonzero(new | ~ok), len(at))
        lengths = stops[np.searchsorted(stops, starts, "right")] - starts
        twice = np.logical_or.reduceat(twice, starts) | (at[starts] != at[starts + lengths - 1])
        pieces = -(-lengths // RUN)
        inside = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(starts, pieces) + inside * RUN
        out[0].append(np.repeat(gram[starts], pieces))
        out[1].append(begin + first)
        out[2].append(np.minimum(RUN, np.repeat(starts + lengths, pieces) - begin))
        out[3].append(np.repeat(twice, pieces))
    if not out[0]:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    gram, start, count, twice = (np.concatenate(x) for x in out)
    return gram, start, count, twice


class Slice:
    """Texts of some documents laid end to end, by (d, tie), each document once."""

    def __init__(self, rows: list[tuple]):
        rows = sorted({(r[0], r[1]): r for r in rows}.values(), key=lambda r: r[:2])
        self.rows = rows
        self.d = np.array([r[0] for r in rows], np.int64)
        self.tie = np.array([r[1] for r in rows], np.int64)
        self.offsets = np.zeros(len(rows) + 1, np.int64)
        np.cumsum([len(r[2]) for r in rows], out=self.offsets[1:])
        self.buffer = b"".join(r[2] for r in rows)
        self.raw = np.frombuffer(self.buffer, np.uint8)

    def row_of(self, start: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, start, "right") - 1


def packed(text: bytes) -> bytes:
    return pa.compress(text, codec="zstd", asbytes=True)


def unpacked(text: bytes, size: int) -> bytes:
    return pa.decompress(text, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def pack_texts(df: DataFrame, text_col: str) -> DataFrame:
    """Texts as compressed bytes with their ``size``, so that a shuffle moves half as much."""
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType

    fields = [StructField(f.name, BinaryType()) if f.name == text_col else f for f in df.schema.fields]

    def run(batches):
        for batch in batches:
            texts = field(batch, text_col).cast(pa.binary()).to_pylist()
            sizes = pa.array([None if t is None else len(t) for t in texts], pa.int64())
            columns = list(batch.columns)
            columns[batch.schema.get_field_index(text_col)] = pa.array([t and packed(t) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, sizes], names=[*batch.schema.names, "size"])

    return df.mapInArrow(run, StructType([*fields, StructField("size", LongType())]))


def slices(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[Slice]:
    """Slices of the rows (d, tie, text, further columns), of about ``SLICE_BYTES``."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        texts = field(batch, "text").cast(pa.binary()).to_pylist()
        if "size" in batch.schema.names:
            texts = [unpacked(t, n) for t, n in zip(texts, field(batch, "size").to_pylist(), strict=True)]
        rest = [field(batch, c).to_pylist() for c in ("d", "tie")]
        more = [field(batch, c) for c in columns]
        for i, text in enumerate(texts):
            held.append((rest[0][i], rest[1][i], text, *(c[i].values for c in more)))
            size += len(text)
            if size >= SLICE_BYTES:
                yield Slice(held)
                held, size = [], 0
    if held:
        yield Slice(held)


def documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Add ``d`` (the id) and ``tie`` (orders different texts of one id) to the rows."""
    # only ids with several texts need the hash, and 0 costs nothing in a shuffle
    keyed = docs.withColumn("d", F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))))
    hashed = keyed.select("d", F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("h"))
    several = hashed.groupBy("d").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low <> high")
    several = stage(several.select("d", F.lit(True).alias("several")), "several")
    tie = F.when(F.col("several"), F.xxhash64(F.coalesce(text_col, F.lit("")))).otherwise(F.lit(0))
    return keyed.join(checked(several), "d", "left").withColumn("tie", tie.cast("long")).drop("several")


def _hot_grams(texts: DataFrame, seen: int, most_runs: int) -> np.ndarray:
    """Grams with a share of 1 / HOT_GRAMS of all runs or more, among those seen so often in a slice; ascending."""

    def run(batches):
        for part in slices(batches):
            gram = runs(part.raw, part.offsets)[0]
            values, counts = np.unique(gram, return_counts=True)
            often = counts >= seen
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*values[often].view(np.int64).tolist(), None], pa.int64()),
                    pa.array([*counts[often].tolist(), len(gram)], pa.int64()),
                ],
                names=["gram", "n"],
            )
        give_back()

    counts = stage(texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    total = counts.where("gram is null").agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("gram").isNotNull() & (F.col("n") > most_runs) & (F.col("n") * HOT_GRAMS >= total))
    hot = hot.select("gram").collect()
    return np.sort(np.array([r.gram for r in hot], np.int64).view(np.uint64))  # HOT_GRAMS at most


def _among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)
    return ascending[at] == values


def _packed(places: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Groups of places as binary values."""
    offsets = (np.append(cuts, len(places)) * _PLACE.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(places.tobytes())])


def _first_digit(texts: DataFrame, hot: np.ndarray) -> DataFrame:
    """(key, places): the runs of each gram, a row per slice and gram. Runs of hot grams need no group: they come
    by document, with a key that spreads documents."""
    shipped = texts.sparkSession.sparkContext.broadcast(hot)  # HOT_GRAMS values at most

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for part in slices(batches):
            gram, start, count, twice = runs(part.raw, part.offsets)
            row = part.row_of(start)
            large = _among(gram, shipped.value)
            places = np.empty(len(gram), _PLACE)
            places["d"], places["tie"] = part.d[row], part.tie[row]
            places["at"] = _at(start - part.offsets[row], count, _TWICE * twice.astype(np.int64) + _LARGE * large)
            ends = (start + count + WINDOW - 1).tolist()
            buffer = part.buffer
            found = [digest(buffer[s:e]) for s, e in zip(start.tolist(), ends, strict=True)]
            places["digest"] = np.array(found, np.uint64).view(np.int64)
            key = np.where(large, part.d[row].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15), gram).view(np.int64)
            order = np.lexsort((key, large))
            key, large, places = key[order], large[order], places[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (large[1:] != large[:-1])
            cuts = np.flatnonzero(new)
            for s in range(0, len(cuts), 50_000):
                own = cuts[s : s + 50_000]
                end = cuts[s + 50_000] if s + 50_000 < len(cuts) else len(places)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[own]), _packed(places[own[0] : end], own - own[0])], names=["key", "places"]
                )
        give_back()

    return texts.mapInArrow(run, "key long, places binary")


class _Groups:
    """Rows (key, places) of a batch: the places end to end, and where each row's begin."""

    def __init__(self, keys: np.ndarray, sizes: np.ndarray, places: np.ndarray):
        self.keys, self.sizes, self.places = keys, sizes, places

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> "_Groups":
        column = batch["places"]
        sizes = pc.binary_length(column).to_numpy() // _PLACE.itemsize
        return cls(batch["key"].to_numpy(), sizes, np.frombuffer(b"".join(column.to_pylist()), _PLACE))

    def split(self) -> tuple[np.ndarray, "_Groups"]:
        """Places of hot grams, and the other rows."""
        hot = np.repeat(self.places["at"][np.cumsum(self.sizes) - self.sizes] & _LARGE == _LARGE, self.sizes)
        rows = self.places["at"][np.cumsum(self.sizes) - self.sizes] & _LARGE == 0
        return self.places[hot], _Groups(self.keys[rows], self.sizes[rows], self.places[~hot])

    def part(self, s: int, e: int) -> "_Groups":
        ends = np.append(0, np.cumsum(self.sizes))
        return _Groups(self.keys[s:e], self.sizes[s:e], self.places[ends[s] : ends[e]])

    def joined(self, other: "_Groups") -> "_Groups":
        return _Groups(*(np.concatenate(x) for x in zip(self.columns(), other.columns(), strict=True)))

    def columns(self) -> tuple[np.ndarray, ...]:
        return self.keys, self.sizes, self.places

    def occurrences(self) -> int:
        """Occurrences of the gram in runs of one group: two where one run has it twice."""
        return len(self.places) + int((self.places["at"] & _TWICE != 0).sum())


def _found(places: np.ndarray, at: np.ndarray, gram: np.ndarray) -> pa.RecordBatch:
    columns = [places["d"].copy(), places["tie"].copy(), at, gram]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["d", "tie", "at", "gram"])


def _large(places: np.ndarray) -> pa.RecordBatch:
    return _found(places, places["at"] | _LARGE, np.zeros(len(places), np.int64))


def _repeated_grams(grams: DataFrame, most_runs: int) -> DataFrame:
    """(d, tie, at, gram) of runs whose gram occurs again: those that equal an earlier run, and those of groups in which
    different runs, or a run with the gram twice, remain. Large groups are not looked into."""

    def closed(groups: _Groups) -> Iterator[pa.RecordBatch]:
        """Rows of whole groups."""
        if not len(groups.keys):
            return
        new = np.append(True, groups.keys[1:] != groups.keys[:-1])
        cell = np.repeat(np.cumsum(new) - 1, groups.sizes)
        places = groups.places
        total = np.bincount(cell, 1 + (places["at"] >> 1 & 1))
        wide = (total > most_runs)[cell]
        if wide.any():
            yield _large(places[wide])
        near = np.flatnonzero((total >= 2)[cell] & ~wide)
        places, cell, key = places[near], cell[near], np.repeat(groups.keys, groups.sizes)[near]
        if not len(near):
            return
        order = np.lexsort((places["at"], places["tie"], places["d"], places["digest"], cell))
        places, cell, key = places[order], cell[order], key[order]
        first = np.ones(len(cell), bool)
        first[1:] = (cell[1:] != cell[:-1]) | (places["digest"][1:] != places["digest"][:-1])
        of = np.flatnonzero(first)[np.cumsum(first) - 1]
        equal = ~first & ((places["d"] != places["d"][of]) | (places["tie"] != places["tie"][of]) | (places["at"] != places["at"][of]))
        different = np.bincount(cell, first)[cell] > 1
        open_ = first & (different | (places["at"] & _TWICE != 0))
        kept = equal | open_
        yield _found(places[kept], places["at"][kept] | _EQUAL * equal[kept], np.where(open_, key, 0)[kept])

    def run(batches):
        held: _Groups | None = None  # the open group, while it is small
        large = False  # the open group is not small
        open_key = None
        for batch in batches:
            hot, rows = _Groups.of(batch).split()
            if len(hot):
                yield _large(hot)
            if not len(rows.keys):
                continue
            if rows.keys[0] != open_key and held is not None:
                yield from closed(held)
                held = None
            same = int(np.searchsorted(rows.keys, open_key, "right")) if rows.keys[0] == open_key else 0
            if same:
                begun = rows.part(0, same)
                held = begun if held is None else held.joined(begun)
                if large or held.occurrences() > most_runs:
                    large = True
                    yield _large(held.places)
                    held = None
                if same == len(rows.keys):
                    continue
                if held is not None:
                    yield from closed(held)
            last = int(np.searchsorted(rows.keys, rows.keys[-1], "left"))
            yield from closed(rows.part(same, last))
            held, open_key, large = rows.part(max(same, last), len(rows.keys)), rows.keys[-1], False
        if held is not None:
            yield from closed(held)
        give_back()

    sent = grams.repartition("key").sortWithinPartitions("key")
    return sent.mapInArrow(run, "d long, tie long, at long, gram long")


_SENT = "key long, digest long, run binary, d long, tie long, start long, n long, twice boolean"


def _adjacent(d: np.ndarray, tie: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Marks of which those that follow each other are one."""
    order = np.lexsort((start, tie, d))
    d, tie, start, n = d[order], tie[order], start[order], n[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] != start[:-1] + n[:-1])
    cuts = np.flatnonzero(new)
    return d[cuts], tie[cuts], start[cuts], np.add.reduceat(n, cuts) if len(cuts) else n


def _marks(d: np.ndarray, tie: np.ndarray, start: np.ndarray, n: np.ndarray) -> list:
    """Columns of marks as rows of ``_SENT``, spread over all tasks."""
    d, tie, start, n = _adjacent(d, tie, start, n)
    none = pa.nulls(len(d), pa.int64())
    key = (d.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
    return [pa.array(key), none, pa.nulls(len(d), pa.binary()), *map(pa.array, (d, tie, start, n)), pa.nulls(len(d), pa.bool_())]


def _later_digits(texts: DataFrame, places: DataFrame) -> DataFrame:
    """Rows of ``_SENT``: runs with their text, digests of the windows of large groups, and marks of what repeats an
    equal run or something in the slice itself (without text or digest)."""
    names = [c.split()[0] for c in _SENT.split(", ")]

    def run(batches):
        for part in slices(batches, "places"):
            row = np.repeat(np.arange(len(part.rows)), [len(r[3]) for r in part.rows])
            found = pa.concat_arrays([r[3] for r in part.rows])
            at, gram = found.field("at").to_numpy(), found.field("gram").to_numpy()
            order = np.lexsort((at, row))
            row, at, gram = row[order], at[order], gram[order]
            once = np.append(True, (row[1:] != row[:-1]) | (at[1:] != at[:-1]))  # repeated rows of a document name a place again
            row, at, gram = row[once], at[once], gram[once]
            start, n = at >> 11, (at >> 3 & 0xFF) + 1
            twice, large, equal = (at & flag != 0 for flag in (_TWICE, _LARGE, _EQUAL))
            marked = [(row[equal], start[equal], n[equal])]

            small = np.flatnonzero(~large & ~equal)
            if len(small):
                begin = part.offsets[row[small]] + start[small]
                buffer = part.buffer
                texts_ = pa.array([buffer[b:e] for b, e in zip(begin.tolist(), (begin + n[small] + WINDOW - 1).tolist(), strict=True)], pa.binary())
                code = texts_.dictionary_encode().indices.to_numpy()
                first = np.unique(code, return_index=True)[1]  # equal texts have equal grams
                again = np.ones(len(small), bool)
                again[first] = False
                marked.append((row[small[again]], start[small[again]], n[small[again]]))
                for s in range(0, len(first), 20_000):
                    own = first[s : s + 20_000]
                    x = small[own]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(gram[x]), pa.nulls(len(x), pa.int64()), texts_.take(pa.array(own)), pa.array(part.d[row[x]]), pa.array(part.tie[row[x]]), pa.array(start[x]), pa.array(n[x]), pa.array(twice[x])],
                        names=names,
                    )
            wide = np.flatnonzero(large)
            if len(wide):
                inside = np.arange(n[wide].sum()) - np.repeat(np.cumsum(n[wide]) - n[wide], n[wide])
                rows_, begin = np.repeat(row[wide], n[wide]), np.repeat(start[wide], n[wide]) + inside
                one, two = _digests(part, part.offsets[rows_] + begin)
                order = np.lexsort((two, one))
                new = np.ones(len(order), bool)
                new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
                first, again = order[new], order[~new]  # the sort is stable: the first is the smallest
                marked.append((rows_[again], begin[again], np.ones(len(again), np.int64)))
                for s in range(0, len(first), 100_000):
                    x = first[s : s + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(one[x]), pa.array(two[x]), pa.nulls(len(x), pa.binary()), pa.array(part.d[rows_[x]]), pa.array(part.tie[rows_[x]]), pa.array(begin[x]), pa.array(np.ones(len(x), np.int64)), pa.nulls(len(x), pa.bool_())],
                        names=names,
                    )
            r, b, k = (np.concatenate(x) for x in zip(*marked, strict=True))
            yield pa.RecordBatch.from_arrays(_marks(part.d[r], part.tie[r], b, k), names=names)
        give_back()

    joined = pack_texts(texts, "text").join(places, ["d", "tie"])
    return joined.mapInArrow(run, _SENT)


def _digests(part: Slice, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the windows that begin there, as two columns; hashed chunk by chunk."""
    one, two = np.empty(len(begin), np.int64), np.empty(len(begin), np.int64)
    order = np.argsort(begin, kind="stable")
    sorted_ = begin[order]
    for first in range(0, len(part.raw), CHUNK):
        s, e = np.searchsorted(sorted_, [first, first + CHUNK])
        if s < e:
            raw = part.raw[first : first + CHUNK + WINDOW - 1]
            for seed, out in ((2, one), (3, two)):
                out[order[s:e]] = rolling(raw, WINDOW, seed)[sorted_[s:e] - first].view(np.int64)
    return one, two


def radix_marks(cell: np.ndarray, texts: pa.Array, order: np.ndarray, n: np.ndarray, twice: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window, windows) of the suffixes of runs that repeat earlier ones of their cell.

    Rows come by cell and then by place; ``order`` numbers the places, equal ones alike.
    """
    rows = np.arange(len(cell))
    code = texts.dictionary_encode().indices.to_numpy()
    by = np.lexsort((rows, code, cell))
    new = np.ones(len(by), bool)
    new[1:] = (cell[by][1:] != cell[by][:-1]) | (code[by][1:] != code[by][:-1])
    of = by[np.flatnonzero(new)[np.cumsum(new) - 1]]  # the first row with the text, per row
    again = by[~new & (order[by] != order[of])]
    out = [(again, np.zeros(len(again), np.int64), n[again])]
    first = np.sort(by[new])
    alone = np.ones(len(first), bool)
    same = cell[first][1:] == cell[first][:-1]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    first = first[~alone | twice[first]]
    # whole cells with up to SORTED windows at a time
    while len(first):
        held = min(len(first) - 1, int(np.searchsorted(np.cumsum(n[first]), SORTED)))
        held = int(np.searchsorted(cell[first], cell[first[held]], "right"))
        out.append(_sorted_windows(cell, texts, order, n, first[:held]))
        first = first[held:]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _sorted_windows(cell, texts, order, n, rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of some rows, sorted by eight bytes at a time; groups of one are dropped after each pass."""
    own = texts.take(pa.array(rows))
    buffer = b"".join(own.to_pylist()) + bytes(8)
    digits = np.ndarray((len(buffer) - 7,), ">u8", buffer, strides=(1,))
    begin = np.cumsum(pc.binary_length(own).to_numpy()) - pc.binary_length(own).to_numpy()
    inside = np.arange(n[rows].sum()) - np.repeat(np.cumsum(n[rows]) - n[rows], n[rows])
    row, window = np.repeat(rows, n[rows]), inside
    at = np.repeat(begin, n[rows]) + inside
    group = cell[row]
    for depth in [*range(0, WINDOW - 8, 8), WINDOW - 8]:
        digit = digits[at + depth].astype(np.uint64)
        by = np.lexsort((digit, group))
        row, window, at, group, digit = row[by], window[by], at[by], group[by], digit[by]
        new = np.ones(len(by), bool)
        new[1:] = (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])
        alone = new & np.append(new[1:], True)
        number = np.cumsum(new)
        row, window, at, group = row[~alone], window[~alone], at[~alone], number[~alone]
        if not len(row):
            break
    new = np.ones(len(row), bool)
    new[1:] = group[1:] != group[:-1]
    of = np.flatnonzero(new)[np.cumsum(new) - 1] if len(row) else row
    again = ~new & ((order[row] != order[row[of]]) | (window != window[of]))
    return row[again], window[again], np.ones(int(again.sum()), np.int64)


def _compared(sent: DataFrame) -> DataFrame:
    """(d, tie, start, n) of all marks."""

    def of_runs(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        key, d, tie, start, n = (rows[c].to_numpy() for c in ("key", "d", "tie", "start", "n"))
        cell = np.cumsum(np.append(True, key[1:] != key[:-1]))
        moved = np.ones(len(key), bool)
        moved[1:] = (d[1:] != d[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] != start[:-1]) | (cell[1:] != cell[:-1])
        row, window, count = radix_marks(cell, rows["run"], np.cumsum(moved), n, rows["twice"].to_numpy(zero_copy_only=False))
        yield marks_of(d[row], tie[row], start[row] + window, count)

    def marks_of(*columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in _adjacent(*columns)], names=["d", "tie", "start", "n"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        before = None  # first row (key, digest, d, tie, start) of the digest that the last batch ended with
        for batch in batches:
            is_run, is_digest = batch["run"].is_valid(), batch["digest"].is_valid()
            rest = batch.filter(pc.invert(pc.or_(is_run, is_digest)))
            if rest.num_rows:
                yield rest.select(["d", "tie", "start", "n"])
            wide = batch.filter(is_digest)
            if wide.num_rows:
                key, digest, d, tie, start = (wide[c].to_numpy() for c in ("key", "digest", "d", "tie", "start"))
                if before is not None:
                    key, digest, d, tie, start = (np.append(np.int64(b), c) for b, c in zip(before, (key, digest, d, tie, start), strict=True))
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])
                of = np.flatnonzero(new)[np.cumsum(new) - 1]
                again = ~new & ((d != d[of]) | (tie != tie[of]) | (start != start[of]))
                yield marks_of(d[again], tie[again], start[again], np.ones(int(again.sum()), np.int64))
                before = tuple(int(c[of[-1]]) for c in (key, digest, d, tie, start))
            small = batch.filter(is_run)
            if small.num_rows:
                key = small["key"].to_numpy()
                last = int(np.searchsorted(key, key[-1], "left"))
                if held and int(held[0]["key"][0].as_py()) != key[-1] or last:
                    whole = pa.Table.from_batches([*held, small.slice(0, last)]).combine_chunks()
                    for x in whole.to_batches():
                        yield from of_runs(x)
                    held = []
                held.append(small.slice(last))
        if held:
            for x in pa.Table.from_batches(held).combine_chunks().to_batches():
                yield from of_runs(x)
        held.clear()
        give_back()

    placed = sent.repartition("key").sortWithinPartitions("key", "digest", "d", "tie", "start")
    return placed.mapInArrow(run, "d long, tie long, start long, n long")


def _cut(rows: DataFrame, text_col: str) -> DataFrame:
    """Texts unpacked, with ``removed`` (array of byte ranges) and ``kept`` (the other bytes)."""
    from pyspark.sql.types import StringType, StructField, StructType

    added = StructType.fromDDL("removed array<struct<start: long, end: long>>, kept binary")
    own = [StructField(text_col, StringType()) if f.name == text_col else f for f in rows.schema.fields if f.name not in ("marks", "size")]
    schema = StructType(own + added.fields)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(added)
        for batch in batches:
            spans, kept, texts = [], [], []
            for text, size, marks in zip(field(batch, text_col).to_pylist(), field(batch, "size").to_pylist(), field(batch, "marks"), strict=True):
                texts.append(None if size is None else unpacked(text, size))
                text, own = texts[-1] or b"", []
                if marks.is_valid and len(marks):
                    starts, counts = (marks.values.field(k).to_numpy() for k in ("start", "n"))
                    by = np.argsort(starts, kind="stable")
                    starts = starts[by]
                    ends = np.maximum.accumulate(starts + counts[by] + WINDOW - 1)
                    gaps = np.flatnonzero(starts[1:] > ends[:-1])
                    own = list(zip(starts[np.append(0, gaps + 1)].tolist(), ends[np.append(gaps, len(ends) - 1)].tolist(), strict=True))
                cuts = [0, *(x for span in own for x in span), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)))
                spans.append([{"start": a, "end": b} for a, b in own])
            whole = {name: field(batch, name) for name in batch.schema.names if name not in ("marks", "size")}
            whole[text_col] = pa.array(texts, pa.binary()).cast(pa.string())
            whole["removed"], whole["kept"] = (pa.array(x, kinds.field(k).type) for x, k in ((spans, "removed"), (kept, "kept")))
            yield pa.RecordBatch.from_arrays(list(whole.values()), names=list(whole))

    return rows.mapInArrow(run, schema)


def repeated_windows(keyed: DataFrame, text_col: str = "text", most_runs: int = MOST_RUNS, seen: int = SEEN) -> DataFrame:
    """(d, tie, start, n): runs of n window starts whose windows occur earlier."""
    texts = keyed.where(F.octet_length(text_col) >= WINDOW).select("d", "tie", F.col(text_col).alias("text"))
    grams = _first_digit(texts, _hot_grams(texts, seen, most_runs))
    places = _repeated_grams(grams, most_runs).groupBy("d", "tie").agg(F.collect_list(F.struct("at", "gram")).alias("places"))
    return _compared(_later_digits(texts, places))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_runs: int = MOST_RUNS, seen: int = SEEN
) -> DataFrame:
    """The rows with ``removed`` (byte ranges of repeated passages) and ``kept`` (the bytes that are left, as binary
    since a passage may end inside a character)."""
    taken = {"d", "tie", "removed", "kept", "marks", "several", "size"} - {id_col, text_col}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in taken])
    keyed = documents(docs, id_col, text_col)
    marks = repeated_windows(keyed, text_col, most_runs, seen).groupBy("d", "tie").agg(F.collect_list(F.struct("start", "n")).alias("marks"))
    return _cut(pack_texts(keyed, text_col).join(marks, ["d", "tie"], "left").drop("d", "tie"), text_col)
