"""Phrase collocations from streams of counts in prefix and suffix order.

Counting: one pass over the texts per phrase length. A task splits slices of text of one language into words, counts
the phrases of each slice by sorting, and Spark adds the slices' counts up. A phrase is sent only if its first and its last
words without one are frequent, as a bitmap of ``FILTER_BITS`` says, which has all frequent phrases one word shorter
and by chance others; so what is sent is close to what counts, and the counts are exact. The bitmap has a fixed size.

Estimation: all frequent phrases of all lengths form a stream in prefix order (word by word, shorter first) and one
in suffix order (words reversed). In prefix order the first parts of a phrase are the open entries above it, so one
lockstep pass with a stack of ``LONGEST`` entries gives the counts of the first parts of every cut, and to each entry
its most frequent extension to the right; suffix order gives the last parts and the extensions to the left. Streams are
cut into ranges of equal size, whatever words they start with; the open entries at a cut are handed to the next
range (four rows a range at most). The two streams' results meet in one merge join.

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows count again; pieces
longer than ``SLICE_BYTES`` are taken whole; ids and other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaloom.llm.arrow import field, give_back, utf8
from taxaloom.session import stage

LONGEST, LEAST, TOP = 5, 100, 2_000
#: language of rows without one
UNKNOWN = "und"
#: bytes of text that are counted at once
SLICE_BYTES = 8 << 20
#: size of the bitmap that is sent to every task; more frequent phrases make it pass more others, and lose none
FILTER_BITS = 27
#: 0 in words, 1 between words, 2 between pieces (fixed values of the contract)
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """(language, texts with line breaks between them), of about ``SLICE_BYTES``; long texts are cut between pieces."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for lang, text in zip(field(batch, "lang").to_pylist(), utf8(batch, "text"), strict=True):
        while text:
            cut = len(text)
            if cut > SLICE_BYTES:
                cut = 1 + max(text.rfind(c, 0, SLICE_BYTES) for c in (b".", b",", b"\n", b";", b":", b"!", b"?"))
                cut = cut or len(text)
            held.setdefault(lang, []).append(text[:cut])
            sizes[lang] = sizes.get(lang, 0) + cut
            text = text[cut:]
            if sizes[lang] >= SLICE_BYTES:
                sizes[lang] = 0
                yield lang, b"\n".join(held.pop(lang))
    for lang, parts in held.items():
        yield lang, b"\n".join(parts)


def words(texts: bytes) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(word number and piece number of every occurrence, the different words)."""
    raw = np.frombuffer(texts.translate(_LOWER), np.uint8)
    kind = _CLASS[raw]
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = kind == 0
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    pieces = np.searchsorted(np.flatnonzero(kind == 2), starts)
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    column = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw[kind == 0]))]
    ).dictionary_encode()
    return column.indices.to_numpy().astype(np.int64), pieces, column.dictionary


def _word_hashes(lang: str, different: pa.Array) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    return np.array([xxhash.xxh3_64_intdigest(w, seed) for w in different.to_pylist()], np.uint64)


def _phrase_hashes(of_words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the phrase of ``length`` words from each occurrence on."""
    out = of_words[: len(of_words) - length + 1].copy()
    for k in range(1, length):
        out *= _STEP
        out += of_words[k : len(of_words) - length + 1 + k]
        out ^= out >> np.uint64(29)
    return out * _STEP


def _marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - FILTER_BITS)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _grouped(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(first row, number of rows) of each different row of the columns."""
    packed = [columns[k] << 32 | columns[k + 1] if k + 1 < len(columns) else columns[k] for k in range(0, len(columns), 2)]
    order = np.argsort(packed[0], kind="stable") if len(packed) == 1 else np.lexsort(packed[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for values in packed:
        values = values[order]
        new[1:] |= values[1:] != values[:-1]
    firsts = np.flatnonzero(new)
    return order[firsts], np.diff(np.append(firsts, len(order)))


def _counts(lang: str, texts: bytes, length: int, bits: np.ndarray | None) -> tuple[pa.Array, np.ndarray]:
    """Phrases of one length in a slice, and their counts. Those of length 1 have the empty phrase too: all words."""
    ids, pieces, different = words(texts)
    if length == 1:
        every = np.append(np.bincount(ids, minlength=len(different)), len(ids))
        return pa.concat_arrays([different, pa.array([b""], pa.binary())]), every
    if len(ids) < length:
        return pa.array([], pa.binary()), np.zeros(0, np.int64)
    shorter = _marked(bits, _phrase_hashes(_word_hashes(lang, different)[ids], length - 1))
    at = np.flatnonzero(shorter[:-1] & shorter[1:] & (pieces[: len(ids) - length + 1] == pieces[length - 1 :]))
    firsts, counts = _grouped([ids[at + k] for k in range(length)])
    parts = [different.take(pa.array(ids[at[firsts] + k])) for k in range(length)]
    return pc.binary_join_element_wise(*parts, b" "), counts


def _counted(docs: DataFrame, length: int, bits: np.ndarray | None) -> DataFrame:
    """(lang, phrase, f) of the phrases of one length that may be frequent."""
    shipped = docs.sparkSession.sparkContext.broadcast(bits)  # 2^FILTER_BITS bits

    def run(batches):
        for batch in batches:
            for lang, texts in _slices(batch):
                phrases, counts = _counts(lang, texts, length, shipped.value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counts), pa.string()), phrases.cast(pa.string()), pa.array(counts, pa.int64())],
                    names=["lang", "phrase", "f"],
                )
        give_back()

    return docs.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _bitmap(frequent: DataFrame, length: int) -> np.ndarray:
    """Bitmap of the hashes of frequent phrases; built by tasks, its words of 64 bits are what reaches the driver."""

    def run(batches):
        for batch in batches:
            slots, ones = [], []
            for lang, phrase in zip(batch["lang"].to_pylist(), batch["phrase"].to_pylist(), strict=True):
                parts = pa.array([w.encode() for w in phrase.split(" ")], pa.binary())
                at = int(_phrase_hashes(_word_hashes(lang, parts), length)[0]) >> (64 - FILTER_BITS)
                slots.append(at >> 6)
                ones.append((1 << (at & 63)) - (1 << 64 if at & 63 == 63 else 0))
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(ones, pa.int64())], names=["slot", "ones"])

    set_ = frequent.select("lang", "phrase").mapInArrow(run, "slot long, ones long")
    found = set_.groupBy("slot").agg(F.expr("bit_or(ones)").alias("ones")).toArrow()  # 2^(FILTER_BITS - 6) rows at most
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[found["slot"].to_numpy()] = found["ones"].to_numpy().astype(np.int64).view(np.uint64)
    return bits


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, n) with all words counted, and (lang, phrase, f) of all phrases up to ``longest`` words with f >= least."""
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text").where("text <> ''")
    one = stage(_counted(rows, 1, None).where((F.col("f") >= least) | (F.col("phrase") == "")), "words")
    levels = [one.where("phrase <> ''")]
    for length in range(2, longest + 1):
        bits = _bitmap(levels[-1], length - 1)
        levels.append(stage(_counted(rows, length, bits).where(F.col("f") >= least), f"phrases{length}"))
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    return one.where("phrase = ''").select("lang", F.col("f").alias("n")), every


def _lockstep(counts: DataFrame, longest: int) -> DataFrame:
    """(lang, key, parts, ext) of a stream (lang, key, f): ``parts`` are the counts of the key's first 1, 2, ... words,
    itself included, ``ext`` the largest count of an entry that is one word longer."""
    spark = counts.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = counts.repartitionByRange(ranges, "lang", "key").withColumn("part", F.spark_partition_id())
    placed = stage(placed, "stream")
    heads = placed.groupBy("part").agg(F.min(F.struct("lang", "key")).alias("head"))
    above = heads.select("part", "head.lang", F.explode(F.sequence(F.lit(1), F.lit(longest - 1))).alias("k"), "head.key")
    above = above.where(F.col("k") < F.size("key")).select("part", "lang", F.slice("key", 1, F.col("k")).alias("key"))
    handed: dict[int, list] = {}
    for r in above.join(placed.drop("part"), ["lang", "key"]).collect():  # longest - 1 rows a range at most
        handed.setdefault(r.part, []).append((r.lang, list(r.key), r.f))

    def run(batches):
        part, stack = None, []  # open entries: [lang, key, counts of its first parts, largest extension, own row]
        out: list[list] = []

        def close(depth: int) -> None:
            while len(stack) > depth:
                lang, key, parts, ext, own = stack.pop()
                out.append([lang, key, parts if own else None, ext])

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = [pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64()]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["lang", "key", "parts", "ext"]
            )

        def enter(lang: str, key: list[str], f: int, own: bool) -> None:
            while stack and (stack[-1][0] != lang or len(stack[-1][1]) >= len(key) or key[: len(stack[-1][1])] != stack[-1][1]):
                close(len(stack) - 1)
            if stack:
                stack[-1][3] = max(stack[-1][3], f) if own else stack[-1][3]
            stack.append([lang, key, (stack[-1][2] if stack else []) + [f], 0, own])

        for batch in batches:
            for p, lang, key, f in zip(*(batch[c].to_pylist() for c in ("part", "lang", "key", "f")), strict=True):
                if p != part:
                    close(0)
                    part = p
                    for entry in sorted(handed.get(p, []), key=lambda e: len(e[1])):
                        enter(*entry, False)
                enter(lang, key, f, True)
            yield batch_of()
        close(0)
        yield batch_of()

    whole = placed.repartition(ranges, "part").sortWithinPartitions("part", "lang", "key")
    passed = whole.mapInArrow(run, "lang string, key array<string>, parts array<long>, ext long")
    # an entry that is open over cuts has a row per range
    return passed.groupBy("lang", "key").agg(F.max("parts").alias("parts"), F.max("ext").alias("ext"))


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    totals, counts = frequent_phrases(docs, longest, least)
    in_order = counts.select("lang", F.split("phrase", " ").alias("key"), "f")
    first = _lockstep(in_order, longest)
    last = _lockstep(in_order.withColumn("key", F.reverse("key")), longest)
    last = last.select("lang", F.reverse("key").alias("key"), F.col("parts").alias("lasts"), F.col("ext").alias("left_ext"))
    both = first.where(F.size("key") > 1).hint("merge").join(last, ["lang", "key"])
    whole = both.select(
        "lang", F.array_join("key", " ").alias("phrase"), F.size("key").alias("size"), "parts", "lasts",
        F.element_at("parts", -1).alias("a"), F.greatest("ext", "left_ext").alias("ext"),
    ).where("ext < a")
    # numerators reach 10^30 at 10^13 words, so decimals; div rounds down
    cut = """array_min(transform(sequence(1, size - 1), k -> struct(
        cast((cast(1000 as decimal(4,0)) * cast(a as decimal(15,0)) * cast(n as decimal(18,0)))
            div (cast(parts[k - 1] as decimal(18,0)) * cast(lasts[size - k - 1] as decimal(18,0))) as long) as score,
        k, parts[k - 1] as l, lasts[size - k - 1] as r)))"""
    scored = whole.join(totals, "lang").withColumn("cut", F.expr(cut)).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")  # limited before the shuffle
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
