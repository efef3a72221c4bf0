"""Personal data by candidate generation and gradient boosting, in built-in column functions only.

1. Base patterns per kind with validators (parts of an address, Luhn sum, number of digits); what they find
   is always redacted.
2. Generators with higher recall run over the text with the base spans blanked out, so they also
   see what a greedy base pattern swallowed. Their spans may overlap.
3. Boosted trees score each candidate from format and context features. They are fitted on the candidates of
   all documents, labelled by the validators, with reformatted copies of the good
   ones (formats that no base pattern reads) and corrupted ones (formats near misses have). Candidates that agree in
   kind, label and features are one row with their number as weight.
4. Per kind, the threshold is the lowest score from which on ``PRECISION`` of the held-back candidates are
   good. Candidates above it are redacted; of overlapping ones the best scored.

The fitted trees are written out as one column expression, so that scoring stays in the row's projection:
no row leaves its task, and there is no shuffle. Positions are code points, ends exclusive; prefix sums over
the matches of a text are taken in blocks, so that a text with very many matches stays linear.

Defined results: a null text counts as empty and has no spans; rows are independent, so repeated rows
repeat their result; without good and bad candidates in the texts only base spans are found; an empty
table gives an empty result; columns of the input whose names this module adds are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.session import stage

KINDS = ["email", "ip", "card", "phone"]
TREES, DEPTH, STEP = 12, 4, 0.3
#: share of good candidates that a threshold has to reach on the held-back ones
PRECISION = 0.95
#: characters of context before a candidate
CONTEXT = 32
#: matches in a block of prefix sums
BLOCK = 64

_LOCAL = "[A-Za-z0-9._%+-]"
#: a cheap test whether a kind can occur, and the pattern. \G lets a match start where the last one ended, as a
#: search without the look-behind would; possessive loops neither recurse nor try again
BASE = {
    "email": ("@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9](?:[ -]?[0-9]){11}", r"[0-9](?:[ -]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]"),
}
_AT, _DOT = r" ?[(\[{] ?(?:at|AT) ?[)\]}] ?", r" ?[(\[{] ?(?:dot|DOT) ?[)\]}] ?"
#: generators per kind: cheap test and pattern
GENERATORS = [
    ("email", r"[(\[{] ?(?:at|AT) ?[)\]}]", rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}(?:(?:{_DOT}|\.)[A-Za-z0-9-]{{2,63}}){{1,6}}"),
    ("email", r" dot ", rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+ at [A-Za-z0-9-]{{1,63}}(?: dot [A-Za-z0-9-]{{2,63}}){{1,6}}"),
    ("ip", r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:", r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
    ("ip", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])"),
    ("card", r"[0-9]{13}", r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    ("card", r"[0-9]{4}[ ._/-]{1,3}[0-9]{4}", r"(?<![0-9])[0-9]{4}(?:[ ._/-]{1,3}[0-9]{4}){2}[ ._/-]{1,3}[0-9]{1,7}(?![0-9])"),
    ("phone", r"\+[0-9]", r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])"),
    ("phone", r"[0-9]{3}[ .-]?[0-9]{4}", r"(?<![0-9+.-])(?:00[1-9][0-9]{0,2}[ .-]?)?(?:\([0-9]{3,4}\)|[0-9]{3,4})[ .-]{1,2}[0-9]{3}[ .-]?[0-9]{4}(?![0-9.-])"),
]
#: words before a candidate that speak for its kind
CUES = {
    "email": "mail|contact|write|schreib|correo|courriel",
    "ip": "ip|addr|host|server|adresse",
    "card": "card|visa|credit|master|karte|carte|tarjeta",
    "phone": "phone|tel|call|fax|mobile|anruf",
}

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(number)

    def value(i: Column) -> Column:
        digit = F.substring(number, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when((n - i) % 2 == 1, twice).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + value(i))
    return F.when(n > 0, total % 10 == 0).otherwise(False)


def valid(kind: str, match: Column) -> Column:
    """Whether a match of a kind passes its validator."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    number = digits(match)
    if kind == "phone":
        return F.length(number).between(9, 15)
    return F.when(F.length(match) > 64, False).otherwise(F.length(number).between(12, 19) & luhn(number))


def _matches(text: Column, test: str, pattern: str) -> tuple[Column, Column]:
    """(what stands between the matches, the matches) of a pattern; no matches if the test fails."""
    may = text.contains(test) if test in ("@", " dot ") else text.rlike(test)
    none = F.array().cast("array<string>")
    return F.when(may, F.split(text, pattern, -1)).otherwise(none), F.when(may, F.regexp_extract_all(text, F.lit(pattern), 0)).otherwise(none)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once. A column expression that a lambda mentions is evaluated for
    every element; a lambda's variable is not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _prefix(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For every element of an int array, all elements before it merged (0 for none), in blocks of ``BLOCK``."""
    fold = lambda xs: F.aggregate(xs, F.lit(0), merge)

    def blocked(v: Column, tops: Column) -> Column:
        return F.transform(
            v,
            lambda _, i: merge(
                fold(F.slice(tops, F.lit(1), F.floor(i / BLOCK).cast("int"))),
                fold(F.slice(v, (i - i % BLOCK + 1).cast("int"), (i % BLOCK).cast("int"))),
            ),
        )

    blocks = lambda v: F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
    tops = lambda v: F.transform(blocks(v), lambda b: fold(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))
    found = let(values, lambda v: let(tops(v), lambda t: blocked(v, t)))
    return F.when(F.size(values) > 0, found).otherwise(F.array().cast("array<int>"))


def _starts(between: Column, matches: Column) -> Column:
    """Start of every match: prefix sums of the lengths."""
    gaps = F.transform(F.slice(between, F.lit(1), F.size(matches)), lambda b: F.length(b))
    steps = F.zip_with(matches, gaps, lambda m, g: F.length(m) + g)
    return F.zip_with(_prefix(steps, lambda x, y: x + y), gaps, lambda start, g: start + g)


def _spans(kind: str, matches: Column, starts: Column) -> Column:
    """array<struct<start, kind, end, match>>"""
    k = KINDS.index(kind)
    return F.zip_with(
        matches,
        starts,
        lambda m, at: F.struct(at.alias("start"), F.lit(k).alias("kind"), (at + F.length(m)).alias("end"), m.alias("match")),
    )


def _valid_only(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda s: valid(kind, s["match"]))


def base_spans(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``base``: array<struct<start, kind, end, match>> of valid base matches, by start, then kind.

    Also ``blanked``: the text with every valid base match as so many U+0001.
    """
    df = df.drop("base", "blanked").withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    for kind, (test, pattern) in BASE.items():
        between, matches = _matches(F.col("_text"), test, pattern)
        df = df.withColumns({f"_b_{kind}": between, f"_m_{kind}": matches})
        df = df.withColumn(f"_s_{kind}", _starts(F.col(f"_b_{kind}"), F.col(f"_m_{kind}")))
        spans = _spans(kind, F.col(f"_m_{kind}"), F.col(f"_s_{kind}"))
        df = df.withColumn(f"_base_{kind}", _valid_only(kind, spans))
    df = df.withColumn("base", F.array_sort(F.concat(*(F.col(f"_base_{kind}") for kind in KINDS))))
    # blank out in the text itself, one kind after the other: a pattern's spans don't overlap, and spans
    # that another kind has blanked in part keep their length
    df = df.withColumn("blanked", _blank(F.col("_text"), F.col("base")))
    return df.drop("_text", *(f"_{x}_{kind}" for x in ("b", "m", "s", "base") for kind in KINDS))


def _ends_before(spans: Column) -> Column:
    """Per span (sorted by start) the end of all spans before it."""
    return _prefix(F.transform(spans, lambda s: s["end"]), lambda x, y: F.greatest(x, y))


def replaced(text: Column, spans: Column, write) -> Column:
    """The text with each span, or run of overlapping spans, rewritten: ``write(span, from)`` gives what stands
    for a span's part from position ``from`` on (where the spans before it end)."""
    parts = F.zip_with(
        spans,
        _ends_before(spans),
        lambda s, end: F.concat(
            F.substring(text, end + 1, F.greatest(s["start"] - end, F.lit(0))), write(s, F.greatest(end, s["start"]))
        ),
    )
    end = F.aggregate(spans, F.lit(0), lambda a, s: F.greatest(a, s["end"]))
    whole = F.concat(F.array_join(parts, ""), F.substring(text, end + 1, F.length(text)))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def _blank(text: Column, spans: Column) -> Column:
    return replaced(text, spans, lambda s, start: F.repeat(F.lit("\x01"), F.greatest(s["end"] - start, F.lit(0))))


def candidates(df: DataFrame) -> DataFrame:
    """Add ``candidates``: array<struct<start, kind, end, match, source, before, after>> of all generators
    over ``blanked``."""
    found = []
    for g, (kind, test, pattern) in enumerate(GENERATORS):
        between, matches = _matches(F.col("blanked"), test, pattern)
        df = df.withColumns({f"_b_{g}": between, f"_m_{g}": matches})
        df = df.withColumn(f"_s_{g}", _starts(F.col(f"_b_{g}"), F.col(f"_m_{g}")))
        spans = _spans(kind, F.col(f"_m_{g}"), F.col(f"_s_{g}"))
        found.append(_with_context(spans, g))
    df = df.withColumn("candidates", F.concat(*found))
    return df.drop(*(f"_{x}_{g}" for x in ("b", "m", "s") for g in range(len(GENERATORS))))


def _with_context(spans: Column, source: int, text: str = "blanked") -> Column:
    start = lambda s: F.greatest(s["start"] - CONTEXT, F.lit(0))
    return F.transform(
        spans,
        lambda s: F.struct(
            *(s[x].alias(x) for x in ("start", "kind", "end", "match")),
            F.lit(source).alias("source"),
            F.lower(F.substring(F.col(text), start(s) + 1, s["start"] - start(s))).alias("before"),
            F.substring(F.col(text), s["end"] + 1, F.lit(8)).alias("after"),
        ),
    )


def features(c: Column) -> dict[str, Column]:
    """Format and context features of a candidate."""
    match, number = c["match"], digits(c["match"])
    yes = lambda x: F.when(x, 1.0).otherwise(0.0)
    count = lambda pattern: (F.length(match) - F.length(F.regexp_replace(match, pattern, ""))).cast("double")
    cue = F.lit(False)
    for k, kind in enumerate(KINDS):
        cue = cue | ((c["kind"] == k) & c["before"].rlike(CUES[kind]))
    return {
        **{f"is_{kind}": yes(c["kind"] == k) for k, kind in enumerate(KINDS)},
        "length": F.length(match).cast("double"),
        "digits": F.length(number).cast("double"),
        "letters": count("[A-Za-z]"),
        "spaces": count(" "),
        "dots": count("\\."),
        "dashes": count("-"),
        "slashes": count("[/_]"),
        "parentheses": count("[()]"),
        "plus": yes(match.startswith("+")),
        "at": yes(match.rlike("@| at |[(\\[{] ?(?:at|AT)")),
        "luhn": yes((F.length(number) <= 24) & luhn(F.substring(number, 1, 24))),
        "small_parts": yes(match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
        "cue": yes(cue),
        "word_before": yes(c["before"].rlike("[a-z0-9]$")),
        "digit_before": yes(c["before"].rlike("[0-9][ .,-]?$")),
        "word_after": yes(c["after"].rlike("^[A-Za-z0-9]")),
        "digit_after": yes(c["after"].rlike("^[ .,-]?[0-9]")),
        "private_near": yes(c["before"].contains("\x01") | c["after"].contains("\x01")),
    }


def training_rows(docs: DataFrame) -> DataFrame:
    """(kind, label, features) of all candidates, and of altered copies of the good ones.

    Here the generators see the text as it is, since base spans are the good examples.
    """
    raw = docs.withColumn("blanked", F.col("_whole_text"))
    spans = [_with_context(F.col("base"), -1)]
    rows = candidates(raw).select(F.explode(F.concat(F.col("candidates"), *spans)).alias("c"), "half")
    good = F.lit(False)
    for k, kind in enumerate(KINDS):
        shape = F.col("c.match").rlike("@|[(\\[{]| dot ") if kind == "email" else valid(kind, F.col("c.match"))
        bare = ~F.col("c.match").startswith("+")
        # a number without a country code is good only next to a cue
        shape = shape & (~bare | F.col("c.before").rlike(CUES["phone"])) if kind == "phone" else shape
        good = good | ((F.col("c.kind") == k) & shape)
    # written once: the texts are not searched again for each of the copies
    real = stage(rows.withColumn("label", F.when(good, 1.0).otherwise(0.0)), "found").withColumn("match", F.col("c.match"))
    copies = real.where("label = 1")
    email, ip, card, phone = (F.col("c.kind") == k for k in range(4))
    plain = digits(F.col("match"))
    pick = F.pmod(F.xxhash64("match"), F.lit(3))
    dotted = F.regexp_replace("match", r"\.(?=[A-Za-z0-9-]+$)", " (dot) ")
    other_format = (
        F.when(email & (pick == 0), F.regexp_replace(dotted, "@", " (at) "))
        .when(email & (pick == 1), F.regexp_replace("match", "@", " [at] "))
        .when(email, F.regexp_replace(F.regexp_replace("match", r"\.(?=[^@]*$)", " dot "), "@", " at "))
        .when(card, F.regexp_replace(plain, r"([0-9]{4})(?=[0-9])", "$1."))
        .when(phone, F.concat(F.lit("00"), F.regexp_replace("match", r"^\+", "")))
    )
    last = F.pmod(F.substring(plain, -1, 1).cast("int") + 1, F.lit(10)).cast("string")
    stem = F.substring("match", F.lit(1), F.length("match") - 1)
    corrupted = (
        F.when(ip, F.regexp_replace("match", r"\.[0-9]+$", ".999"))
        .when(card & (pick == 0), F.regexp_replace(F.concat(F.substring(plain, F.lit(1), F.length(plain) - 1), last), r"([0-9]{4})(?=[0-9])", "$1-"))
        .when(card, F.concat(stem, last))
        .when(phone, F.regexp_replace(F.substring(plain, 1, 8), "^([0-9]{3})", "$1-"))
        .when(email, F.concat(F.regexp_extract("match", "^[^@ ]+", 0), F.lit(" at "), F.regexp_extract("match", "([A-Za-z0-9-]+)$", 1)))
    )
    # good ones stay good when other numbers stand around them
    crowded = F.col("c").withField("after", F.lit(" 4918 71")).withField("before", F.concat(F.col("c.before"), F.lit("6437 ")))
    both = (
        real.unionByName(copies.withColumn("match", other_format))
        .unionByName(copies.withColumn("c", crowded))
        .unionByName(copies.withColumn("match", corrupted).withColumn("label", F.lit(0.0)))
    )
    fixed = both.where("match is not null").withColumn("c", F.col("c").withField("match", F.col("match")))
    found = features(F.col("c"))
    return fixed.select(F.col("c.kind").alias("kind"), "label", "half", *(v.alias(n) for n, v in found.items()))


class Model:
    """Boosted trees and the threshold of each kind. A tree is a leaf value or (feature, limit, low, high)."""

    def __init__(self, trees: list[tuple[float, object]], thresholds: dict[int, float]):
        self.trees, self.thresholds = trees, thresholds

    def score(self, feature: Callable[[str], Column]) -> Column:
        """Probability that a candidate with these features is good."""

        def value(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            name, limit, low, high = node
            return F.when(feature(name) <= limit, value(low)).otherwise(value(high))

        total = F.lit(0.0)
        for weight, tree in self.trees:
            total = total + value(tree) * weight
        return 1 / (1 + F.exp(-2 * total))


def read_tree(text: str, names: list[str]) -> object:
    """A fitted tree from its printed form."""
    lines = [x.strip() for x in text.strip().splitlines()][1:]
    at = 0

    def node() -> object:
        nonlocal at
        line = lines[at]
        at += 1
        if m := re.match(r"Predict: (\S+)", line):
            return float(m[1])
        m = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
        if not m:
            raise ValueError(f"unknown line in a tree: {line}")
        low = node()
        at += 1  # Else
        return names[int(m[1])], float(m[2]), low, node()

    return node()


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Fit trees and thresholds on the candidates of all texts; a third of the texts, chosen by a hash, is held back
    from the trees for the thresholds."""
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_whole_text"))
    texts = texts.withColumn("half", F.pmod(F.xxhash64("_whole_text", F.lit("half")), F.lit(3)) == 0)
    each = training_rows(base_spans(texts, "_whole_text"))
    names = [c for c in each.columns if c not in ("kind", "label", "half")]
    rows = stage(each.groupBy(*each.columns).agg(F.count(F.lit(1)).cast("double").alias("weight")), "candidates")
    counts = {(r.half, r.label): r.n for r in rows.groupBy("half", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not all(counts.get((half, label)) for half in (False, True) for label in (0.0, 1.0)):
        return Model([], {})
    vectors = VectorAssembler(inputCols=names, outputCol="vector").transform(rows.where("not half"))
    # MLlib looks for limits of features in maxBins ** 2 rows; so it sees all
    bins = max(32, math.isqrt(counts[False, 0.0] + counts[False, 1.0]) + 1)
    fitted = GBTClassifier(
        featuresCol="vector", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, maxBins=bins, seed=3
    ).fit(vectors)
    trees = [(float(w), read_tree(t.toDebugString, names)) for w, t in zip(fitted.treeWeights, fitted.trees, strict=True)]
    scored = rows.where("half").withColumn("bin", F.floor(Model(trees, {}).score(F.col) * 100).cast("int"))
    shares = scored.groupBy("kind", "bin").agg(F.sum(F.col("label") * F.col("weight")).alias("good"), F.sum("weight").alias("n")).collect()  # 4 x 101 rows
    thresholds: dict[int, float] = {}
    for kind in range(len(KINDS)):
        good = n = 0.0
        for r in sorted((r for r in shares if r.kind == kind), key=lambda r: -r.bin):
            good, n = good + r.good, n + r.n
            if good < PRECISION * n:
                break
            thresholds[kind] = r.bin / 100
    return Model(trees, thresholds)


def _place(s: Column) -> Column:
    return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))


def _best(candidates_: Column) -> Column:
    """Candidates that no overlapping one beats: by score, then length, then place.

    Sorted by start, the array is cut where a span starts after all before it have ended; only inside such
    a run are candidates compared with each other.
    """

    def unbeaten(run: Column) -> Column:
        key = lambda x: F.struct(x["score"], x["end"] - x["start"], -x["start"], -x["kind"], -x["source"])
        beaten = lambda c: F.exists(
            run, lambda o: (o["start"] < c["end"]) & (c["start"] < o["end"]) & (key(o) > key(c))
        )
        return F.filter(run, lambda c: ~beaten(c))

    def runs(line: Column, cuts: Column) -> Column:
        last = F.size(line)
        return F.transform(
            cuts, lambda at, k: F.slice(line, at + 1, (F.coalesce(F.get(cuts, k + 1), last) - at).cast("int"))
        )

    def cuts(line: Column) -> Column:
        free = F.zip_with(line, _ends_before(line), lambda s, end: s["start"] >= end)
        marked = F.transform(free, lambda f, i: F.when(f | (i == 0), i))
        return F.filter(marked, lambda i: i.isNotNull())

    found = let(
        F.array_sort(candidates_), lambda line: F.flatten(F.transform(let(cuts(line), lambda c: runs(line, c)), unbeaten))
    )
    return F.when(F.size(candidates_) > 0, F.transform(found, _place)).otherwise(
        F.array().cast("array<struct<start:int,kind:int,end:int>>")
    )


def find(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add ``base`` and ``spans``: arrays of struct<start, kind, end>, by start, then kind; ``spans`` holds
    the base spans and the candidates that the model selects."""
    df = base_spans(df.drop("base", "spans", "blanked", "candidates"), text_col)
    base = F.transform("base", _place)
    if not model.thresholds:
        return df.withColumn("base", base).withColumn("spans", F.col("base")).drop("blanked")
    limit = F.create_map(*(F.lit(x) for pair in model.thresholds.items() for x in pair))
    place = ("start", "kind", "end", "source")

    def described(c: Column) -> Column:
        f = F.struct(*(v.alias(n) for n, v in features(c).items()))
        return F.struct(*(c[x].alias(x) for x in place), f.alias("f"))

    def scored(c: Column) -> Column:
        return F.struct(*(c[x].alias(x) for x in place), model.score(lambda n: c["f"][n]).alias("score"))

    df = candidates(df).withColumn("candidates", F.transform("candidates", described))
    df = df.withColumn(
        "candidates",
        F.filter(F.transform("candidates", scored), lambda c: c["score"] >= F.coalesce(F.element_at(limit, c["kind"]), F.lit(2.0))),
    )
    df = df.withColumn("base", base).withColumn("candidates", _best(F.col("candidates")))
    return df.withColumn("spans", F.array_sort(F.concat("base", "candidates"))).drop("blanked", "candidates")


def joined(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redact(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Write the kind, as <EMAIL>, in place of every span; overlapping spans share the first one's mark."""
    columns = df.columns
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    found = find(df.withColumnRenamed(text_col, "_redacted"), model, "_redacted")
    # a span that starts inside the spans before it leaves no mark of its own
    text = replaced(
        F.col("_redacted"), F.col("spans"), lambda s, start: F.when(start == s["start"], F.get(names, s["kind"])).otherwise("")
    )
    clean = F.when(F.size("spans") > 0, text).otherwise(F.col("_redacted"))
    return found.withColumn(text_col, clean).select(*columns)
