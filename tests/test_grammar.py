"""Names read by the grammar."""

import pytest
from pyspark.sql import functions as F

from taxaloom.functions import grammar

CASES = [
    # name, canonical, authorship, subgenus, ranks, hybrid
    ("Beta prima B. & C.", "Beta prima", "B. & C.", None, [], None),
    ("Beta", "Beta", None, None, [], None),
    ("Alphaceae A.Auth", "Alphaceae", "A.Auth", None, [], None),
    ("Lomariopsis Fée", "Lomariopsis", "Fée", None, [], None),
    ("Beta de Vries", "Beta", "de Vries", None, [], None),
    ("Ericetorum (Jermy) Li Bing Zhang & X. M. Zhou", "Ericetorum", "(Jermy) Li Bing Zhang & X. M. Zhou", None, [], None),
    ("Beta (Gamma) prima L.", "Beta prima", "L.", "Gamma", [], None),
    ("Beta subg. Gamma Aut. ex Mill.", "Beta", "Aut. ex Mill.", "Gamma", [], None),
    ("Beta sect. Delta", "Beta", None, "Delta", [], None),
    ("Beta prima-alba (L.) van der Hoek", "Beta prima-alba", "(L.) van der Hoek", None, [], None),
    ("Beta nana L. f. ex M.", "Beta nana", "L. f. ex M.", None, [], None),
    ("Beta nana Hook. f. & Baker", "Beta nana", "Hook. f. & Baker", None, [], None),
    ("Beta nana Hook. f.", "Beta nana", "Hook. f.", None, [], None),
    ("Beta nana Hook. f. f. alba Mill.", "Beta nana alba", "Mill.", None, ["f."], None),
    ("Beta prima var. minor I.", "Beta prima minor", "I.", None, ["var."], None),
    ("Beta prima subsp. secunda var.tertia f. quarta Aut.", "Beta prima secunda tertia quarta", "Aut.", None, ["subsp.", "var.", "f."], None),
    ("Beta prima L. subsp. prima Aut. f. nana M.", "Beta prima prima nana", "M.", None, ["subsp.", "f."], None),
    ("Beta prima secunda Aut. in Herb. Kew", "Beta prima secunda", "Aut. in Herb. Kew", None, [], None),
    ("Beta × hybrida F.", "Beta hybrida", "F.", None, [], "named"),
    ("Beta x hybrida F.", "Beta hybrida", "F.", None, [], "named"),
    ("×Betagamma prima L.", "Betagamma prima", "L.", None, [], "named"),
    ("xBetagamma x prima K. S. Walter", "Betagamma prima", "K. S. Walter", None, [], "named"),
    ("Beta prima nothovar. × alba L.", "Beta prima alba", "L.", None, ["nothovar."], "named"),
    ("Beta prima L. × Beta secunda Mill.", "Beta prima × Beta secunda", "Mill.", None, None, "formula"),
    ("Beta prima × secunda", "Beta prima × Beta secunda", None, None, None, "formula"),
    ("Beta prima × B. secunda × Gamma tertia var. alba", "Beta prima × Beta secunda × Gamma tertia alba", None, None, None, "formula"),
    ("Beta × Gamma", "Beta × Gamma", None, None, None, "formula"),
    ("Beta L. × Gamma", "Beta × Gamma", None, None, None, "formula"),
    ("Beta nana Hook. f. × Beta alba", "Beta nana × Beta alba", None, None, None, "formula"),
    ("  Beta \t prima  ", "Beta prima", None, None, [], None),
]
REFUSED = [
    ("incerta sedis", "incerta"),
    ("", "end of name"),
    ("Beta prima var.", "var."),
    ("Beta prima var. Minor", "Minor"),
    ("Beta prima L. subsp. & x", "&"),
    ("Beta ×", "end of name"),
    ("Beta prima ×", "end of name"),
    ("Beta prima × 3", "3"),
    ("Beta subg. prima", "prima"),
    ("Beta prima secunda tertia", "tertia"),
    ("Beta prima sect. Gamma", "sect."),
    ("× × Beta", "×"),
    ("Beta prima × C. secunda", "C."),
]


def test_shapes_of_names(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES] + [(None,)], "name string")
    rows = {r.name: r.p for r in df.select("name", grammar.parse_name("name").alias("p")).collect()}
    for name, canonical, author, subgenus, ranks, hybrid in CASES:
        p = rows[name]
        assert p.refused is None, (name, p)
        assert (p.canonical, p.authorship, p.subgenus, p.ranks, p.hybrid) == (canonical, author, subgenus, ranks, hybrid), name
        assert p.genus == canonical.split(" ")[0]
    assert rows[None] is None


def test_refused_names_have_the_token(spark):
    df = spark.createDataFrame([(str(i), n) for i, (n, _) in enumerate(REFUSED + [c[:2] for c in CASES])], "taxonID string, scientificName string")
    found = {r.key: (r.rule, r.detail) for r in grammar.refused_names(df).collect()}
    assert found == {str(i): ("name_refused", token) for i, (_, token) in enumerate(REFUSED)}
    parsed = df.select(grammar.parse_name("scientificName").alias("p")).where("p.refused is not null").select("p.*")
    assert all(r.canonical is None and r.genus is None and r.epithets is None for r in parsed.collect())


def test_epithets(spark):
    df = spark.createDataFrame([("Beta (Gamma) prima L. var. alba Mill.",)], "n string")
    p = df.select(grammar.parse_name(F.col("n")).alias("p")).first().p
    assert p.epithets == ["prima", "alba"] and p.subgenus == "Gamma" and p.authorship == "Mill."


@pytest.mark.parametrize("n", [1, 200])
def test_long_authorships(spark, n):
    text = "Beta prima " + "(Aut. ex de Mill. & Hook. f.) " * n
    p = spark.createDataFrame([(text,)], "n string").select(grammar.parse_name("n").alias("p")).first().p
    assert p.canonical == "Beta prima" and len(p.authorship.split()) == 7 * n
