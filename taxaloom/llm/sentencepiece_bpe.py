"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The vocabulary is read from the model file; encoding is done here with an agenda of adjacent symbol
pairs ordered by piece score. No piece holds a word mark after another character, so merges never
cross the start of a run of word marks: a text is the concatenation of its chunks (marks, then
the characters up to the next mark), and a Python worker encodes each different chunk once while it
remembers it. Short chunks of a batch share one array agenda: each round pops the best-scored pair of every chunk.
Long ones have a heap. Every newly met chunk is checked against the sentencepiece library, a batch at a time,
before its ids are used; the library gets ``TOGETHER`` chunks as one text.

Defined results: null and empty texts have no ids and decode to the empty text; white space is kept
as it is; characters outside the vocabulary become byte ids; rows are independent, so repeated rows
repeat their result; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from taxaloom.llm.arrow import Work, add_columns, own_cache, texts

#: SentencePiece's visible stand-in for a space (fixed value)
MARK = "▁"
#: different chunks of one of the two generations that a Python worker remembers: a chunk that is met again moves from
#: the old generation to the young one, and a full young one takes the place of the old one
CACHE_CHUNKS = 100_000
#: chunks that the library checks as one text
TOGETHER = 64
#: bytes of text that are encoded at once for digests, so that array agendas have rows enough; where ids and texts are
#: returned, slices have the usual size
SLICE_BYTES = 4 << 20
#: chunks of up to so many characters share an array agenda
SHORT = 48
#: chunks in one array agenda
ROWS = 20_000
#: rank of pairs that don't merge
NO_RANK = np.iinfo(np.int32).max
CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Vocabulary:
    """Pieces, scores and byte ids of a BPE model file."""

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        if model.trainer_spec.model_type != 2:
            raise ValueError("not a BPE model")
        norm = model.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models with identity normalisation and escaped white space are read")
        if model.trainer_spec.treat_whitespace_as_suffix or not model.trainer_spec.byte_fallback:
            raise ValueError("only models with prefix marks and byte fallback are read")
        if not norm.add_dummy_prefix:
            raise ValueError("only models that put a mark before a text are read")
        self.pieces = [p.piece for p in model.pieces]
        self.shown = [p.replace(MARK, " ") for p in self.pieces]
        normal = [(i, p.piece, p.score) for i, p in enumerate(model.pieces) if p.type == 1]
        if any(MARK in piece.lstrip(MARK) for _, piece, _ in normal):
            raise ValueError("a piece crosses word marks; chunks would not be independent")
        self.ids = {piece: i for i, piece, _ in normal}
        self.scores = {piece: score for _, piece, score in normal}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.byte_ids = frozenset(self.byte_of)
        if any(c not in self.ids for piece in self.ids for c in piece):
            raise ValueError("a piece has a character that is no piece")
        # every way to make a piece of two, in a table with two places for each pair
        order = {x: r for r, x in enumerate(sorted(set(self.scores.values()), reverse=True))}
        pairs = [
            (self.ids[piece[:k]], self.ids[piece[k:]], order[score], self.ids[piece])
            for piece, score in self.scores.items()
            for k in range(1, len(piece))
            if piece[:k] in self.ids and piece[k:] in self.ids
        ]
        self.char_ids = {c: i for c, i in self.ids.items() if len(c) == 1}
        self._place(np.array(pairs, np.int64).reshape(-1, 4))

    def _place(self, pairs: np.ndarray) -> None:
        """Put pairs into the table; a pair thrown out of one place goes to its other one."""
        n = len(self.pieces)
        keys = pairs[:, 0] * n + pairs[:, 1]
        self.bits = max(10, int(keys.size * 4).bit_length())
        first, second = (h.tolist() for h in self._places(keys))
        table = [-1] * (1 << self.bits)
        for k in range(len(keys)):
            row, spot = k, first[k]
            for _ in range(500):
                row, table[spot] = table[spot], row
                if row < 0:
                    break
                spot = second[row] if spot == first[row] else first[row]
            else:
                raise RuntimeError("no room for the pairs")
        filled = np.array(table)
        self.keys = np.where(filled < 0, -2, keys[filled])
        self.ranks = np.where(filled < 0, NO_RANK, pairs[filled, 2]).astype(np.int32)
        self.made = pairs[filled, 3].astype(np.int32)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        plain, shift = keys.astype(np.uint64), np.uint64(64 - self.bits)
        return (
            (plain * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64),
            (plain * np.uint64(0xC2B2AE3D27D4EB4F) >> shift).astype(np.int64),
        )

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the piece that each pair makes; ids below 0 (no piece) never merge."""
        keys = left.astype(np.int64) * len(self.pieces) + right
        keys[(left < 0) | (right < 0)] = -1
        first, second = self._places(keys)
        at = np.where(self.keys[first] == keys, first, second)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_RANK), self.made[at]

    def encode_short(self, chunks: list[str]) -> list[list[int]]:
        """Ids of many short chunks. Row i holds the symbols of chunk i; each round pops the best pair of
        every row that has one (the leftmost of equals), and looks its two new neighbours up."""
        n, width = len(chunks), max(map(len, chunks))
        ids, outside = self.char_ids, {}  # outside: characters without a piece get ids below -1
        flat = [ids[c] if c in ids else outside.setdefault(c, -2 - len(outside)) for c in "".join(chunks)]
        lengths = np.fromiter(map(len, chunks), np.int64, n)
        # a row has its symbols, then an end; a merged right symbol leaves -1, and links skip it
        wide = width + 1
        symbols = np.full((n, wide), -1, np.int32)
        symbols[np.arange(wide) < lengths[:, None]] = flat
        ranks, made = self._look_up(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
        ranks = ranks.reshape(n, width)
        symbols, made, base = symbols.ravel(), np.append(made.reshape(n, width), np.zeros((n, 1), np.int32), 1).ravel(), np.arange(n) * wide
        after = np.tile(np.arange(1, wide + 1), n) + np.repeat(base, wide)
        before = after - 2
        rank_at = ranks.ravel()
        while True:
            best = ranks.argmin(1)
            rows = np.flatnonzero(rank_at[np.arange(n) * width + best] != NO_RANK)
            if not len(rows):
                break
            best = best[rows]
            at = base[rows] + best
            gone = after[at]
            symbols[at] = made[at]
            symbols[gone] = -1
            behind = after[gone]  # at most the end of the row, since a pair has two symbols
            after[at], before[behind] = behind, at
            rank_at[rows * width + (gone - base[rows]).clip(max=width - 1)] = NO_RANK
            rank_at[rows * width + best], made[at] = self._look_up(symbols[at], symbols[behind])
            inner = best > 0
            rows, at = rows[inner], at[inner]
            ahead = before[at]
            rank_at[rows * width + (ahead - base[rows])], made[ahead] = self._look_up(symbols[ahead], symbols[at])
        kept = symbols != -1
        counts = kept.reshape(n, wide).sum(1).tolist()
        flat = symbols[kept].tolist()
        names = {i: [self.bytes[b] for b in c.encode()] for c, i in outside.items()}
        out, start = [], 0
        for count in counts:
            line = flat[start : start + count]
            if outside and min(line) < 0:
                line = [x for i in line for x in (names[i] if i < 0 else (i,))]
            out.append(line)
            start += count
        return out

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        """Ids of every chunk; short ones are sorted by length and go through array agendas."""
        out: list[list[int]] = [[]] * len(chunks)
        short = sorted((i for i, c in enumerate(chunks) if len(c) <= SHORT), key=lambda i: len(chunks[i]))
        for k in range(0, len(short), ROWS):
            part = short[k : k + ROWS]
            for i, ids in zip(part, self.encode_short([chunks[i] for i in part]), strict=True):
                out[i] = ids
        for i, chunk in enumerate(chunks):
            if len(chunk) > SHORT:
                out[i] = self.encode_chunk(chunk)
        return out

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of one chunk: merge the best-scored adjacent pair, leftmost first, until none is left."""
        scores = self.scores
        symbols: list[str | None] = list(chunk)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, int, str]] = []

        def propose(left: int, right: int) -> None:
            piece = symbols[left] + symbols[right]
            if piece in scores:
                heapq.heappush(agenda, (-scores[piece], left, right, piece))

        for i in range(n - 1):
            propose(i, i + 1)
        while agenda:
            _, left, right, piece = heapq.heappop(agenda)
            if symbols[left] is None or symbols[right] is None or after[left] != right:
                continue  # one of the two was merged meanwhile
            if len(symbols[left]) + len(symbols[right]) != len(piece):
                continue  # one of the two has grown
            symbols[left], symbols[right] = piece, None
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
                propose(left, after[right])
            if before[left] >= 0:
                propose(before[left], left)
        ids: list[int] = []
        for symbol in symbols:
            if symbol is None:
                continue
            if symbol in self.ids:
                ids.append(self.ids[symbol])
            else:
                ids.extend(self.bytes[b] for b in symbol.encode())
        return ids

    def decode_chunk(self, ids: list[int]) -> str:
        """Text of the ids of one chunk, word marks as spaces, byte ids read as UTF-8."""
        if self.byte_ids.isdisjoint(ids):
            return "".join([self.shown[i] for i in ids])
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.pieces[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")

    @staticmethod
    def chunks(text: str | None) -> list[str]:
        """The chunks of a text, each without the mark that it starts with."""
        if not text:
            return []
        if "  " not in text and MARK not in text and text[0] != " ":
            return text.split(" ")
        return [c[1:] for c in CHUNK.findall(MARK + text.replace(" ", MARK))]


class Coder:
    """Chunk cache over a vocabulary, each new chunk checked against the library."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.vocabulary = Vocabulary(model_file)
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.names = [str(i) for i in range(len(self.vocabulary.pieces))]
        # ids of chunks, joined by commas: the young generation has all chunks of the rows at hand
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}
        self.odd: dict[str, str] = {}  # decoded text of chunks that don't decode to themselves

    def check(self, new: list[str], ids: list[list[int]], texts: list[str]) -> None:
        """Hold ids and decoded texts of chunks against the library's (it adds the first mark itself)."""
        # chunks that end in marks can't be followed by others, and the library gives no ids for an empty text
        joint = [i for i, c in enumerate(new) if c and c[-1] != MARK]
        groups = [joint[k : k + TOGETHER] for k in range(0, len(joint), TOGETHER)]
        groups += [[i] for i, c in enumerate(new) if c and c[-1] == MARK]
        asked = [" ".join([new[i] for i in g]) for g in groups]
        found = self.library.encode(asked, num_threads=1)
        back = self.library.decode(found, num_threads=1)
        for group, text, want, decoded in zip(groups, asked, found, back, strict=True):
            if list(chain.from_iterable([ids[i] for i in group])) != want or "".join([texts[i] for i in group])[1:] != decoded:
                raise AssertionError(f"ids of a chunk in {text!r} differ from the library's")
            if decoded != text.replace(MARK, " "):
                self.odd.update((new[i], texts[i]) for i in group if texts[i][1:] != new[i].replace(MARK, " "))

    def learn(self, new: list[str]) -> None:
        """Encode chunks in one batch, and check them."""
        ids = self.vocabulary.encode_chunks([MARK + c for c in new])
        self.check(new, ids, [self.vocabulary.decode_chunk(x) for x in ids])
        names = self.names
        self.young.update(zip(new, [",".join([names[i] for i in x]) for x in ids], strict=True))

    def remember(self, used: set[str]) -> None:
        """Have all these chunks in the young generation."""
        if len(self.young) > CACHE_CHUNKS:
            self.old, self.young = self.young, {}
            self.odd = {c: t for c, t in self.odd.items() if c in self.old}
        old = self.old
        missing = used.difference(self.young)
        known = [c for c in missing if c in old]
        self.young.update((c, old[c]) for c in known)
        if len(known) < len(missing):
            self.learn(list(missing.difference(known)))

    def code(self, rows: list[str | None]) -> list[tuple[str, str]]:
        """Per text the ids joined by commas, and the text decoded from them."""
        split = [self.vocabulary.chunks(t) for t in rows]
        self.remember(set().union(*split))
        ids, odd = self.young.__getitem__, self.odd
        out = []
        for chunks in split:
            if odd and not odd.keys().isdisjoint(chunks):
                text = "".join(odd.get(c, " " + c.replace(MARK, " ")) for c in chunks)[1:]
            else:
                text = " ".join(chunks).replace(MARK, " ")
            out.append((",".join(map(ids, chunks)), text))
        return out


_CODERS: dict[str, Coder] = {}


def coder(model_file: str) -> Coder:
    """The coder of this Python worker, which later tasks find with its chunks."""
    path = model_file if os.path.exists(model_file) else SparkFiles.get(os.path.basename(model_file))
    own_cache("sentencepiece", _CODERS.clear)
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def encode_decode(df: DataFrame, model_file: str, text_col: str = "text") -> DataFrame:
    """Add ``ids`` (array<int>), ``n_tokens`` and ``decoded`` to every row."""

    def make() -> Work:
        own = coder(model_file)

        def work(batch) -> list:
            out = own.code(texts(batch, text_col))
            counts = [a.count(",") + 1 if a else 0 for a, _ in out]
            flat = np.fromstring(",".join([a for a, _ in out if a]), np.int32, sep=",") if any(counts) else np.zeros(0, np.int32)
            ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), pa.array(flat))
            return [ids, counts, [b for _, b in out]]

        return work

    return add_columns(df, text_col, "ids array<int>, n_tokens long, decoded string", make)


def digests(df: DataFrame, model_file: str, text_col: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas) and ``decoded_sha256``."""

    def make() -> Work:
        own = coder(model_file)

        def work(batch) -> list:
            out = own.code(texts(batch, text_col))
            return [
                [a.count(",") + 1 if a else 0 for a, _ in out],
                [hashlib.sha256(a.encode()).hexdigest() for a, _ in out],
                [hashlib.sha256(b.encode()).hexdigest() for _, b in out],
            ]

        return work

    return add_columns(df, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", make, SLICE_BYTES)
