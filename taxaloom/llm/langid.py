"""Language identification by cross-parsing entropy.

Per language, a suffix automaton of labelled text recognises every string that occurs in it. A text is
parsed greedily against each automaton: a phrase is the longest match from where the last one ended (an
unseen character is a phrase of its own). The language that needs fewest phrases per character wins.

Texts are read as runs of lower-cased letters with one space between them; all other characters only
separate. Numpy parses the texts of a slice side by side, from their beginnings on; where fewer than ``LANES`` go
on, each of these is parsed to its end alone. The labelled sample is bounded by ``SAMPLE_CHARS`` per language and taken
in the order of a hash of the id; every text is one parse, however long. More than ``MOST_LANGUAGES`` labels are refused,
since each has an automaton in every task.

Defined results: ``und`` with score 0 if a text is null or has no letters; ties go to the first language in
alphabetical order; without any labelled row every text is ``und``; rows are independent; other columns pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaloom.llm.arrow import Work, add_columns, own_cache, texts
from taxaloom.session import stage

UNKNOWN = "und"
#: different labels that are learned
MOST_LANGUAGES = 500
#: characters of labelled text per language
SAMPLE_CHARS = 60_000
#: labelled documents looked at per language, and characters taken of one at most, from a place given by the hash of its id
SAMPLE_ROWS, ROW_CHARS = 400, 1_500
#: texts that are parsed side by side as long as they are so many; the longest of a batch are parsed one by one to their end
LANES = 64
#: letters of a language that a full row of its table has; transitions on others are kept as sorted pairs
LETTERS = 60


def _is_letter() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Parser:
    """Dense automata of all languages and the parse over batches of texts."""

    def __init__(self, samples: dict[str, str]):
        self.letter = _is_letter()
        plain = {lang: self.spaced(text) for lang, text in sorted(samples.items())}
        plain = {lang: codes for lang, codes in plain.items() if len(codes) > 2}
        self.languages = list(plain)
        self.points = np.unique(np.concatenate([np.empty(0, np.uint32), *plain.values()]))
        self.classes = np.zeros(0x110000, np.int32)  # 0: unseen
        self.classes[self.points] = np.arange(1, len(self.points) + 1)
        self.tables = [self._table(self.classes[codes]) for codes in plain.values()]
        self.rare: dict[int, dict[int, int]] = {}

    def spaced(self, text: str) -> np.ndarray:
        """Code points of a text in lower case, each run of other characters as one space, one at both ends."""
        points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
        letter = self.letter[points]
        kept = letter | np.concatenate(([True], letter[:-1]))  # a separator after a letter, or at the start
        return np.where(letter, points, 32)[kept].astype(np.uint32)

    def _table(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Suffix automaton of one language: (column by class, next state by (state, column), and the rare letters'
        transitions: state * classes + class, ascending, and next state). The ``LETTERS`` most frequent letters have
        columns; column 0 leads nowhere. State 1 is the root; state 0 is no state, so a parse that stands on it
        starts a phrase."""
        seen, counts = np.unique(classes, return_counts=True)
        common = seen[np.argsort(-counts, kind="stable")][:LETTERS]
        column = np.zeros(len(self.points) + 1, np.uint8)
        column[common] = np.arange(1, len(common) + 1)
        codes = classes.tolist()
        link, length, rows = [0, 0], [0, 0], [None, {}]
        last = 1
        for c in codes:
            new = len(rows)
            rows.append({})
            link.append(1)
            length.append(length[last] + 1)
            at = last
            while at and c not in rows[at]:
                rows[at][c] = new
                at = link[at]
            if at:
                to = rows[at][c]
                if length[to] == length[at] + 1:
                    link[new] = to
                else:
                    copy = len(rows)
                    rows.append(dict(rows[to]))
                    link.append(link[to])
                    length.append(length[at] + 1)
                    while at and rows[at].get(c) == to:
                        rows[at][c] = copy
                        at = link[at]
                    link[to] = link[new] = copy
            last = new
        table, rare = np.zeros((len(rows), len(common) + 1), np.int32), []
        places = column.tolist()
        for state, row in enumerate(rows):
            for c, to in (row or {}).items():
                if places[c]:
                    table[state, places[c]] = to
                else:
                    rare.append((state * len(places) + c, to))
        rare.sort()
        keys, states = (np.array([x[k] for x in rare], np.int64) for k in (0, 1))
        return column, table, keys, states

    def phrases(self, texts_: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(letters and spaces parsed per text, phrases per text and language)"""
        coded = [self.spaced(t) if t else np.empty(0, np.uint32) for t in texts_]
        sizes = np.array([len(c) if len(c) > 2 else 0 for c in coded], np.int64)  # two spaces: no letter
        counts = np.zeros((len(coded), len(self.tables)), np.int64)
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] > 0]
        if not len(order) or not self.tables:
            return sizes, counts
        flat = self.classes[np.concatenate([coded[i] for i in order])]
        lengths = sizes[order]
        begin = np.cumsum(lengths) - lengths
        # texts that reach a step, while they are enough for steps over all of them
        together = int(lengths[LANES - 1]) if len(lengths) >= LANES else 0
        active = np.searchsorted(-lengths, -np.arange(together), side="left")
        for k, table in enumerate(self.tables):
            state, found = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
            self._side_by_side(table, flat, begin, active, state, found)
            for lane in range(int(np.searchsorted(-lengths, -together, side="left"))):
                rest = flat[begin[lane] + together : begin[lane] + lengths[lane]]
                found[lane] += self._one(table, rest, int(state[lane]))
            counts[order, k] = found
        return sizes, counts

    def _side_by_side(self, table, flat, begin, active, state, found) -> None:
        """Parse the first characters of all texts, one of each per step."""
        column, rows, keys, states = table
        size, width, cells = len(self.points) + 1, rows.shape[1], rows.ravel()
        root = rows[1][column]  # by class
        first = (keys >= size) & (keys < 2 * size)
        root[keys[first] - size] = states[first]
        rare = np.zeros(size, bool)
        rare[keys % size] = True
        for step, n in enumerate(active):
            c = flat[begin[:n] + step]
            to = cells[state[:n] * width + column[c]]
            if len(keys) and len(lanes := np.flatnonzero(rare[c])):
                wanted = state[lanes] * size + c[lanes]
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                to[lanes] = np.where(keys[at] == wanted, states[at], 0)
            new = to == 0
            found[:n] += new
            state[:n] = np.where(new, root[c], to)

    def _one(self, table, classes: np.ndarray, state: int) -> int:
        """Phrases that begin in the rest of a text."""
        column, rows, keys, states = table
        size, width, cells = len(self.points) + 1, rows.shape[1], memoryview(rows.ravel())
        rare = self._rare(table)
        found = 0
        for c, place in zip(classes.tolist(), column[classes].tolist(), strict=True):
            to = cells[state * width + place] if place else rare.get(state * size + c, 0) if rare else 0
            if not to:
                found += 1
                to = cells[width + place] if place else rare.get(size + c, 0) if rare else 0
            state = to
        return found

    def _rare(self, table) -> dict[int, int]:
        """Transitions on rare letters, by state * classes + class."""
        if id(table) not in self.rare:
            self.rare[id(table)] = dict(zip(table[2].tolist(), table[3].tolist(), strict=True))
        return self.rare[id(table)]

    def predict(self, texts_: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, score (how far the winner is ahead, 0 to 1) and phrases per character."""
        sizes, counts = self.phrases(texts_)
        langs, scores, rates = [], [], []
        for size, row in zip(sizes.tolist(), counts, strict=True):
            if not size or not self.languages:
                langs.append(UNKNOWN)
                scores.append(0.0)
                rates.append(0.0)
                continue
            best = int(row.argmin())
            others = np.delete(row, best)
            ahead = 1.0 if not len(others) else 1.0 - row[best] / others.min()
            langs.append(self.languages[best])
            scores.append(float(ahead))
            rates.append(row[best] / size)
        return langs, scores, rates


_PARSERS: dict[int, Parser] = {}


def _parser(samples: dict[str, str]) -> Parser:
    """The parser of this Python worker, built once for the samples it was last given."""
    own_cache("langid", _PARSERS.clear)
    key = hash(tuple(sorted(samples.items())))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = Parser(samples)
    return _PARSERS[key]


def in_fold(id_col: str = "doc_id", folds: int = 3, held_out: int = 1) -> Column:
    """Whether a row is held out, by the crc32 of its id as text; a null id is never held out."""
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    return F.coalesce(fold == held_out, F.lit(False))


def labelled_sample(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", chars: int = SAMPLE_CHARS
) -> dict[str, str]:
    """Up to ``chars`` characters of text per language, from rows in the order of a hash of the id.

    Only ids are ranked; texts are fetched for the rows that were chosen. All of these give alike, as far as they reach.
    """
    ids = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~in_fold(id_col)).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h")
    )
    # per language a threshold that leaves about twice the rows wanted: no ranking over a whole language
    share = ids.groupBy("lang").agg(F.count("*").alias("n")).withColumn(
        "most", F.least(F.lit(1.0), F.lit(2.0 * SAMPLE_ROWS) / F.col("n"))
    )
    unit = (F.pmod(F.col("h"), F.lit(1 << 20)) / float(1 << 20)).alias("unit")
    shares = stage(share, "shares")
    if (n := shares.count()) > MOST_LANGUAGES:
        raise ValueError(f"{n} different languages in {lang_col!r}, more than {MOST_LANGUAGES}")
    near = ids.join(F.broadcast(shares), "lang").where(unit < F.col("most"))
    first = Window.partitionBy("lang").orderBy("h", "id")
    chosen = near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= SAMPLE_ROWS)
    places = F.greatest(F.length(text_col) - ROW_CHARS + 1, F.lit(1))  # where a part may start
    start = F.pmod(F.xxhash64(F.lit("start"), F.col(id_col)), places).cast("int") + 1
    part = F.substring(F.col(text_col), start, F.lit(ROW_CHARS))
    rows = (
        docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
        .select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), part.alias("text"))
        .join(F.broadcast(chosen.select("id", "lang", "place")), ["id", "lang"])  # SAMPLE_ROWS per language
        .select("lang", "place", "text")
        .distinct()
        .collect()
    )
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.place, r.text)):
        out.setdefault(r.lang, []).append(r.text)
    return {lang: _shared(parts, chars) for lang, parts in out.items()}


def _shared(parts: list[str], chars: int) -> str:
    """The start of every part, of such a length that all together have so many characters, or all of them."""
    low, high = 0, ROW_CHARS
    while low < high:
        share = (low + high + 1) // 2
        low, high = (share, high) if sum(min(len(p), share) + 1 for p in parts) <= chars + 1 else (low, share - 1)
    return " ".join(p[: max(low, 1)] for p in parts)[:chars]


def has_languages(samples: dict[str, str]) -> bool:
    """Whether any language can be told with these samples."""
    return any(c.isalpha() for text in samples.values() for c in text)


def identify(docs: DataFrame, samples: dict[str, str], text_col: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``phrase_rate`` (phrases per character) to every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(samples)  # SAMPLE_CHARS per language

    def make() -> Work:
        parser = _parser(shipped.value)

        def work(batch: pa.RecordBatch) -> list:
            return list(parser.predict(texts(batch, text_col)))

        return work

    added = "lang_pred string, score double, phrase_rate double"
    return add_columns(docs, text_col, added, make, slice_bytes=4 << 20)  # many texts side by side
