"""Benchmark decontamination with a generalised suffix automaton over item words.

The automaton holds every run of words that occurs in an item. A document's words are streamed through
it, which gives the longest run that ends at each word; a run of ``window`` words or more marks its
last ``window`` words as hit, and so does a whole item of fewer words. Each state knows the next shorter state that
ends a window or an item, so neither the length of items nor their repetitions cost more than their words.

Documents never move: the automaton is shipped to them, and a Python worker builds it once. Its size is checked: a
benchmark of more than ``GROUP_WORDS`` words is cut into groups of items by a hash of the id. Then the documents are
written once, each group is a pass of its own that gives hits only, and these are joined back.

Words are runs of ASCII letters (lower-cased), ASCII digits and characters beyond ASCII.

Defined results: null and empty texts have no words and are clean; an item without words has no
window; a null item id marks words but is not listed; items that repeat an id are one id; an empty
benchmark leaves every document clean; rows are independent; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.llm.arrow import Work, add_columns, own_cache, utf8
from taxaloom.session import stage

#: consecutive item words that count as contamination
WINDOW = 13
#: words of items in one automaton
GROUP_WORDS = 200_000
#: word bytes lower-cased, all other ASCII as spaces
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class ItemAutomaton:
    """Suffix automaton of all items, with the items of each window and of each short item."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, tokens in items:
            if tokens:
                coded.append((name, [self.ids.setdefault(w, len(self.ids)) for w in tokens]))
        for _, tokens in coded:
            last = 0
            for t in tokens:
                last = self._extend(last, t)
        #: per state that holds a window or short item: length of it, ids of its items
        self.marks: dict[int, dict[int, set[str | None]]] = {}
        for name, tokens in coded:
            for end, state in enumerate(self._states(tokens), 1):
                if end >= window or end == len(tokens):
                    self.marks.setdefault(state, {}).setdefault(min(window, end), set()).add(name)
        self.shortest = min((n for m in self.marks.values() for n in m), default=0)
        self._found: dict[int, tuple[tuple[int, frozenset], ...]] = {0: (), -1: ()}
        #: per state the longest shorter one that has marks
        self.shorter = [0] * len(self.link)
        for at in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            link = self.link[at]
            self.shorter[at] = link if link in self.marks else self.shorter[link] if link > 0 else 0

    def _extend(self, last: int, token: int) -> int:
        """State of the text so far with one more token."""
        known = self.next[last].get(token)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, token, known)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and token not in self.next[at]:
            self.next[at][token] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            to = self.next[at][token]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self._clone(at, token, to)
        return new

    def _state(self, length: int, next_: dict[int, int]) -> int:
        self.next.append(next_)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, at: int, token: int, to: int) -> int:
        """Split off the strings of ``to`` that are no longer than those of ``at`` with the token."""
        new = self._state(self.length[at] + 1, dict(self.next[to]))
        self.link[new], self.link[to] = self.link[to], new
        while at >= 0 and self.next[at].get(token) == to:
            self.next[at][token] = new
            at = self.link[at]
        return new

    def _states(self, tokens: list[int]):
        """The states of the last ``window`` words at most, after each word of an item."""
        state = 0
        for t in tokens:
            state = self.next[state][t]
            while self.length[self.link[state]] >= self.window:
                state = self.link[state]
            yield state

    def found(self, state: int) -> tuple[tuple[int, frozenset], ...]:
        """(length, items) of the windows and short items that end where ``state`` ends."""
        if state not in self._found:
            out, at = [], state
            while at > 0:  # marked states have different lengths up to ``window``, so these are few
                out += [(n, frozenset(names)) for n, names in self.marks.get(at, {}).items()]
                at = self.shorter[at]
            self._found[state] = tuple(out)
        return self._found[state]

    def scan(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Merged [start, end) spans of hit words, and the items with an occurring window."""
        spans: list[tuple[int, int]] = []
        items: set[str | None] = set()
        if not self.shortest or len(tokens) < self.shortest:
            return spans, items
        ids = np.fromiter((self.ids.get(w, -1) for w in tokens), np.int64, len(tokens))
        # only runs of item words that are long enough for some window
        edges = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        for start, end in edges.reshape(-1, 2).tolist():
            if end - start < self.shortest:
                continue
            state = length = 0
            for i, t in enumerate(ids[start:end].tolist(), start):
                while state and t not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
                if t in self.next[state]:
                    state, length = self.next[state][t], length + 1
                if length < self.shortest:
                    continue
                for n, names in self.found(state):
                    if n <= length:
                        items |= names
                        if spans and i + 1 - n <= spans[-1][1]:
                            spans[-1] = (min(spans[-1][0], i + 1 - n), i + 1)
                        else:
                            spans.append((i + 1 - n, i + 1))
        return _merged(spans), items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


_AUTOMATA: dict[str, ItemAutomaton] = {}


def _automaton(name: str, shipped: Broadcast, window: int) -> ItemAutomaton:
    """The automaton of a group, which later tasks of this Python worker find again; the one before is forgotten."""
    own_cache("decontamination", _AUTOMATA.clear)
    if name not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[name] = ItemAutomaton(shipped.value, window)
    return _AUTOMATA[name]


def _groups(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items with their words, in groups of about ``most`` words; one group is on the driver at a time."""
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    total = items.agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), "[^0-9A-Za-z\\x80-\\x{10FFFF}]+")))).first()[0] or 0
    n = total // most + 1
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        yield [(r.id, words(r.text.encode()) if r.text else []) for r in part.toLocalIterator()]


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    group_words: int = GROUP_WORDS,
) -> DataFrame:
    """Add ``n_words``, ``hit_spans`` (merged word spans, end exclusive) and ``hit_items`` (sorted ids)."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_words", "hit_spans", "hit_items", "row_")])
    groups = _groups(benchmark, item_id, item_text, group_words)
    first, second = next(groups), next(groups, None)
    if second is None:
        return _pass(docs, text_col, first, window)
    numbered = stage(docs.withColumn("row_", F.monotonically_increasing_id()), "documents")
    n_words = stage(_pass(numbered, text_col, [], window).select("row_", "n_words"), "words")
    hits = None
    for items in chain([first, second], groups):
        found = _pass(numbered, text_col, items, window).where(F.size("hit_spans") > 0)
        found = stage(found.select("row_", "hit_spans", "hit_items"), "hits")
        hits = found if hits is None else hits.unionByName(found)
    lists = hits.groupBy("row_").agg(
        F.flatten(F.collect_list("hit_spans")).alias("hit_spans"), F.flatten(F.collect_list("hit_items")).alias("hit_items")
    )
    merged = n_words.join(lists, "row_", "left").mapInArrow(_merge_lists, f"row_ long, {ADDED}")
    return numbered.join(merged, "row_").drop("row_")


ADDED = "n_words long, hit_spans array<struct<start: int, end: int>>, hit_items array<string>"


def _merge_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of several passes as one list, items sorted."""
    for batch in batches:
        spans = [_merged([(s["start"], s["end"]) for s in x or []]) for x in batch["hit_spans"].to_pylist()]
        named = [sorted(set(x or [])) for x in batch["hit_items"].to_pylist()]
        lists = pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], batch["hit_spans"].type)
        columns = [batch["row_"], batch["n_words"], lists, pa.array(named, batch["hit_items"].type)]
        yield pa.RecordBatch.from_arrays(columns, names=["row_", "n_words", "hit_spans", "hit_items"])


def _pass(docs: DataFrame, text_col: str, items: list, window: int) -> DataFrame:
    """One pass of the documents over the automaton of some items."""
    shipped = docs.sparkSession.sparkContext.broadcast(items)  # the words of a group
    name = uuid4().hex

    def make() -> Work:
        automaton = _automaton(name, shipped, window)

        def work(batch: pa.RecordBatch) -> list:
            counts, all_spans, all_items = [], [], []
            for text in utf8(batch, text_col):
                tokens = words(text)
                spans, found = automaton.scan(tokens)
                counts.append(len(tokens))
                all_spans.append([{"start": a, "end": b} for a, b in spans])
                all_items.append(sorted(x for x in found if x is not None))
            return [counts, all_spans, all_items]

        return work

    return add_columns(docs, text_col, ADDED, make)


def n_hit() -> Column:
    """Hit words of a scanned row."""
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


def contaminated(share: int = 20) -> Column:
    """Whether a scanned row has hits that make up at least one ``share``-th of its words."""
    return (n_hit() > 0) & (F.lit(share) * n_hit() >= F.col("n_words"))


def cut_spans(scanned: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace the text of scanned rows by the text without its hit words and what stands between them."""

    def make() -> Work:
        def work(batch: pa.RecordBatch) -> list:
            out = []
            for text, spans in zip(utf8(batch, text_col), batch["hit_spans"].to_pylist(), strict=True):
                if not spans:
                    out.append(text)
                    continue
                places = [m.span() for m in WORD.finditer(text)]
                kept, at = [], 0
                for s in spans:
                    kept.append(text[at : places[s["start"]][0]])
                    at = places[s["end"] - 1][1]
                out.append(b"".join(kept) + text[at:])
            return [[None if t is None else t.decode() for t in out]]

        return work

    return add_columns(scanned, text_col, "cleaned_ string", make).drop(text_col).withColumnRenamed("cleaned_", text_col)
