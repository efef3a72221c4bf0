"""Entities against the standard library's decoder."""

import random
from html import unescape
from html.entities import html5

from pyspark.sql import functions as F

from taxaloom.functions import text
from taxaloom.functions.entities import decode_entities


def decoded(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(4)
    return [r.d for r in df.select("i", decode_entities(F.col("t")).alias("d")).orderBy("i").collect()]


def test_all_names(spark):
    names = sorted(html5)
    texts = [f"a&{n}b" for n in names] + [f"&{n.rstrip(';')}" for n in names] + [f"&{n};&{n}x;" for n in names]
    assert decoded(spark, texts) == [unescape(t) for t in texts]


def test_all_kinds_of_numbers(spark):
    points = [*range(0, 700), 0x2028, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000]
    points += [p * 0x10000 + k for p in (1, 2, 15, 16) for k in (0xFFFD, 0xFFFE, 0xFFFF)] + [0x10FFFF, 0x110000, 10**7 - 1, 10**7, 16**7, 10**40]
    texts = [f for p in points for f in (f"&#{p};", f"x&#x{p:x}y", f"&#X{p:X};;", f"&#000000000000{p}")]
    assert decoded(spark, texts) == [unescape(t) for t in texts]


def test_random_texts(spark):
    rng = random.Random(3)
    parts = ["&", "&amp", "&amp;", "lt;", "&lt", "&notit;", "&#", "&#x", "&#38;", ";", " ", "é", "日", "&é;", "\t", "\n", "<", "#", "&ampamp;", "&" + "x" * 40, "&CounterClockwiseContourIntegral;", "&#x1F600;", "😀", "&😀;"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)] + ["", None]
    assert decoded(spark, texts) == [t if t is None else unescape(t) for t in texts]


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("<b>a &amp; b</b>",), ("NA",), (None,)], "t string").select(text.unescape_html("t").alias("t"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "BatchedArrow" not in plan
    assert [r.t for r in df.collect()] == ["a & b", None, None]
