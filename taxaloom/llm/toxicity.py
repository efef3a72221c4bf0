"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: density and count of words of a learned lexicon (also after undoing character
substitutions), how many of them stand near a second-person word, and rates of second-person words, capitals,
punctuation, exclamation marks and obfuscated words. The lexicon, the trees and the calibration are learned
from at most about ``SAMPLE_ROWS`` labelled rows outside the held-out fold, chosen by a hash of the id: four
fifths for lexicon and trees, the rest for the calibration. The features cover whole texts.

Defined results: null and empty texts have all features 0 and get the score of that; without labelled
rows of both classes every score is the share of toxic labels (0 without labels); several labels of an id
count as toxic if one is; null labels and null ids are ignored in learning; rows are independent.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.llm.arrow import Work, add_columns, texts
from taxaloom.llm.langid import in_fold
from taxaloom.session import stage

#: labelled rows that are learned from, about; words in the lexicon; predicted toxic from this score on
SAMPLE_ROWS, LEXICON_WORDS, THRESHOLD = 20_000, 400, 0.7
#: words of the lexicon: least documents, and log ratio of the shares of toxic and other documents that hold them
LEAST_DOCS, LEAST_RATIO = 4, 2.0
#: words between a lexicon word and a second-person word near it
NEAR = 5
#: trees, depth and learning rate
TREES, DEPTH, STEP = 20, 3, 0.3
SECOND_PERSON = frozenset(
    "you your yours yourself ye du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos ti tus usted ustedes vosotros"
    .split()
)
#: characters written for letters (fixed values)
SUBSTITUTES = str.maketrans("013457@$!", "oieastasi")
# tried once per run of letters, without going back: linear in the longest word
OBFUSCATED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[0-9@$!*][^\W\d_]++)++")
#: ASCII letters lower-cased; other ASCII as spaces; bytes of other characters as they are
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
UPPER, PUNCTUATION = bytes(range(65, 91)), bytes(b for b in range(33, 127) if not chr(b).isalnum())
FEATURES = [
    "hits", "hit_rate", "different_hits", "weight_rate", "weight", "near_rate", "person_rate", "capital_rate",
    "punctuation_rate", "exclamation_rate", "obfuscated_rate", "hidden_hits", "log_words",
]


def words(text: str | None) -> list[str]:
    return text.lower().encode().translate(LETTERS).decode().split() if text else []


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """Values of ``FEATURES`` for one text."""
    if not text:
        return [0.0] * len(FEATURES)
    tokens = words(text)
    n = max(1, len(tokens))
    raw = text.encode()
    size = len(raw)
    places = [i for i, w in enumerate(tokens) if w in lexicon]
    weight = sum(lexicon[tokens[i]] for i in places)
    person = [i for i, w in enumerate(tokens) if w in SECOND_PERSON]
    near = at = 0
    for i in places:
        while at < len(person) and person[at] < i - NEAR:
            at += 1
        near += at < len(person) and person[at] <= i + NEAR
    odd = OBFUSCATED.findall(text)
    hidden = sum(w.lower().translate(SUBSTITUTES) in lexicon or w.lower().replace("*", "") in lexicon for w in odd)
    return [
        math.log1p(len(places)),
        len(places) / n,
        float(len({tokens[i] for i in places})),
        weight / n,
        math.log1p(weight),
        near / n,
        len(person) / n,
        (size - len(raw.translate(None, UPPER))) / size,
        (size - len(raw.translate(None, PUNCTUATION))) / size,
        raw.count(b"!") / size,
        len(odd) / n,
        math.log1p(hidden),
        math.log(n),
    ]


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, text, label, calibrates) of about ``SAMPLE_ROWS`` labelled rows outside the held-out fold."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~in_fold(id_col))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label).cast("double")).alias("label"))
    share = min(1.0, SAMPLE_ROWS / max(1, known.count()))
    unit = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    chosen = stage(known.where(unit < share).withColumn("calibrates", F.pmod(F.xxhash64("id"), F.lit(5)) == 0), "labels")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return stage(rows.join(F.broadcast(chosen), "id"), "sample")  # about SAMPLE_ROWS ids


def lexicon(sample: DataFrame) -> dict[str, float]:
    """Words that stand in a larger share of toxic rows, with the log of the ratio of shares."""

    def run(batches):
        for batch in batches:
            found = [sorted(set(words(t))) for t in texts(batch, "text")]
            marks = [y for y, ws in zip(batch["label"].to_pylist(), found, strict=True) for _ in ws]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for ws in found for w in ws], pa.string()), pa.array(marks, pa.float64())], names=["word", "label"]
            )

    rows, toxic = sample.agg(F.count("*"), F.sum("label")).first()
    plain = rows - (toxic or 0)
    if not toxic or not plain:
        return {}
    per_word = sample.select("text", "label").mapInArrow(run, "word string, label double").groupBy("word")
    counted = stage(per_word.agg(F.sum("label").alias("k"), F.count("*").alias("n")).where("k > 0"), "words")
    p, q = (F.col("k") + 0.5) / (toxic + 1), (F.col("n") - F.col("k") + 0.5) / (plain + 1)
    # likelihood ratio against the share of toxic rows; it has to exceed what the best of so many words reaches by chance
    base, left = toxic / rows, F.col("n") - F.col("k")
    own = F.col("k") * F.log(F.col("k") / (F.col("n") * base))
    rest = F.when(left > 0, left * F.log(left / (F.col("n") * (1 - base)))).otherwise(0.0)
    scored = counted.select("word", "k", F.log(p / q).alias("ratio"), (2 * (own + rest)).alias("g"))
    chance = 2 * math.log(max(2, counted.count()))
    best = scored.where((F.col("k") >= LEAST_DOCS) & (F.col("ratio") > LEAST_RATIO) & (F.col("g") > chance))
    return {r.word: r.ratio for r in best.orderBy(F.desc("g"), "word").limit(LEXICON_WORDS).collect()}


def add_features(docs: DataFrame, weights: dict[str, float], text_col: str = "text") -> DataFrame:
    """Add ``values``, the dense features of the text."""
    shipped = docs.sparkSession.sparkContext.broadcast(weights)  # at most LEXICON_WORDS words

    def make() -> Work:
        known = shipped.value

        def work(batch: pa.RecordBatch) -> list:
            return [[features(t, known) for t in texts(batch, text_col)]]

        return work

    return add_columns(docs, text_col, "values array<double>", make)


def _assembled(df: DataFrame) -> DataFrame:
    flat = df.select("*", *(F.col("values")[i].alias(f"_{name}") for i, name in enumerate(FEATURES)))
    return VectorAssembler(inputCols=[f"_{name}" for name in FEATURES], outputCol="vector").transform(flat)


def score(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, held_out, score, predicted) per row of ``docs``."""
    sample = labelled_sample(docs, labels, label, id_col, text_col)
    weights = lexicon(sample.where("not calibrates"))
    known = stage(add_features(sample, weights).select("id", "label", "calibrates", "values"), "features")
    counts = {(r.calibrates, r.label): r.n for r in known.groupBy("calibrates", "label").agg(F.count("*").alias("n")).collect()}
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"), in_fold(id_col).alias("held_out"))
    if not all(counts.get((False, y)) for y in (0.0, 1.0)):
        share = sum(n for (_, y), n in counts.items() if y) / max(1, sum(counts.values()))
        scored = rows.withColumn("score", F.lit(float(share)))
    else:
        trees = GBTClassifier(
            featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7, maxBins=64
        ).fit(_assembled(known.where("not calibrates")))

        def boosted(df: DataFrame) -> DataFrame:
            return trees.transform(_assembled(df)).withColumn("raw", vector_to_array("probability")[1])

        held = "calibrates" if all(counts.get((True, y)) for y in (0.0, 1.0)) else "not calibrates"
        curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(boosted(known.where(held)))
        scored = curve.transform(boosted(add_features(rows, weights).drop("text")).drop("rawPrediction", "probability", "prediction"))
    return scored.select(
        id_col,
        "held_out",
        F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0)).alias("score"),
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
