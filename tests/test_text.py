import pytest

from taxaloom.functions import names, text


def values(spark, data, *columns):
    rows = [(d,) if not isinstance(d, tuple) else d for d in data]
    schema = ", ".join(f"c{i} string" for i in range(len(rows[0])))
    df = spark.createDataFrame(rows, schema)
    got = df.select(*columns).collect()
    return [r[0] if len(columns) == 1 else tuple(r) for r in got]


def test_squish_is_unicode_aware(spark):
    assert values(spark, ["  a  b\t\nc ", None], text.squish("c0")) == ["a b c", None]


@pytest.mark.parametrize(
    "raw, plain",
    [
        ("You &amp; I", "You & I"),
        ("<i>Aus</i> bus&nbsp;L.", "Aus bus L."),
        ("a &lt; b", "a < b"),
        ("F&eacute;e <!-- note --> x", "Fée  x"),
        ("NA", None),
        (None, None),
        ("no markup", "no markup"),
    ],
)
def test_unescape_html(spark, raw, plain):
    assert values(spark, [raw], text.unescape_html("c0")) == [plain]


def test_split_multivalue_trims_then_drops_blank_pieces(spark):
    assert values(spark, ["= A  b = = C [x=1] "], text.split_multivalue("c0")) == [["A b", "C [x", "1]"]]


def test_split_first_keeps_later_separators(spark):
    assert values(spark, ["A [x [y]]", "B"], *text.split_first("c0", r"\[")) == [("A ", "x [y]]"), ("B", None)]


def test_split_longer(spark):
    assert values(spark, ["Sandia, B and C"], text.split_longer("c0")) == [["Sandia", "B", "C"]]
    assert values(spark, ["Sandia"], text.split_longer("c0", keep_inside_words=False)) == [["S", "ia"]]


def test_epithet_token(spark):
    data = ["Aus bus L.", "Aus x cus L.", "Aus", None]
    assert values(spark, data, text.epithet_token("c0")) == ["bus", "cus", None, None]


def test_code_parts(spark):
    assert values(spark, ["001.2110", "002.", "x", None], *text.code_parts("c0")) == [
        (1.0, 2110.0),
        (2.0, None),
        (None, None),
        (None, None),
    ]


def test_pad_left_keeps_long_text(spark):
    assert values(spark, ["1", "12", "123"], text.pad_left("c0")) == ["01", "12", "123"]


def test_content_key_tells_null_from_empty_and_columns_apart(spark):
    keys = values(spark, [("a", None), ("a", ""), ("", "a"), (None, "a")], text.content_key("c0", "c1"))
    assert len(set(keys)) == 4


def test_match_group_tells_no_match_from_empty_match(spark):
    assert values(spark, ["k: ", "x", "k: v"], text.match_group("c0", "k: (.*)")) == ["", None, "v"]


@pytest.mark.parametrize(
    "name, canonical, author",
    [
        ("Beta prima B. & C.", "Beta prima", "B. & C."),
        ("Beta x hybrida F.", "Beta hybrida", "F."),
        ("Beta prima var. minor I.", "Beta prima minor", "I."),
        ("Beta prima L. subsp. prima Aut. f. nana M.", "Beta prima prima nana", "M."),
        ("Beta nana L. f. ex M.", "Beta nana", "L. f. ex M."),
        ("Beta nana Hook. f. & Baker", "Beta nana", "Hook. f. & Baker"),
        ("xAsplenosorus x boydstoniae K. S. Walter", "Asplenosorus", None),
        ("xAsplenosorus pinnatus K. S. Walter", "Asplenosorus pinnatus", "K. S. Walter"),
        ("Alphaceae A.Auth", "Alphaceae", "A.Auth"),
        ("Lomariopsis Fée", "Lomariopsis", "Fée"),
        ("Beta de Vries", "Beta", "de Vries"),
        ("Beta prima-alba (L.) van der Hoek", "Beta prima-alba", "(L.) van der Hoek"),
        ("Ericetorum (Jermy) Li Bing Zhang & X. M. Zhou", "Ericetorum", "(Jermy) Li Bing Zhang & X. M. Zhou"),
        ("incerta", None, None),
        (None, None, None),
    ],
)
def test_canonical_name(spark, name, canonical, author):
    assert values(spark, [name], names.canonical_name("c0"), names.authorship("c0")) == [(canonical, author)]


@pytest.mark.parametrize(
    "name, rank",
    [
        ("Betophyta Old", "division"),
        ("Betophytina Old", "subdivision"),
        ("Betopsida Old", "class"),
        ("Betidae Old", "subclass"),
        ("Betales Old", "order"),
        ("Betineae Old", "suborder"),
        ("Betaceae Old", "family"),
        ("Betoideae Old", "subfamily"),
        ("Beteae Old", "tribe"),
        ("Betinae Old", "subtribe"),
        ("Beta prima var. b L.", "variety"),
        ("Beta prima ssp.bis L.", "subspecies"),
        ("Beta prima subvar. bis L.", "subvariety"),
        ("Beta prima monstr. bis L.", "monstrosity"),
        ("Beta prima var. cus f. dus L.", "form"),
        ("Beta nana L. f. ex M.", "form"),
        ("Beta una D.", "species"),
        ("Oldus X.", "genus"),
        ("xOldus X.", None),
        ("xAsplenosorus x boydstoniae K. S. Walter", None),
    ],
)
def test_rank_from_name(spark, name, rank):
    df = spark.createDataFrame([(name,)], "name string")
    assert names.rank_from_name(df, "name").first()["taxonRank"] == rank


def test_strict_markers_do_not_take_author_suffix_for_a_form(spark):
    df = spark.createDataFrame([("Beta nana L. f. ex M.",), ("Beta nana f. alba M.",)], "name string")
    assert [r["taxonRank"] for r in names.rank_from_name(df, "name", strict=True).collect()] == ["species", "form"]


def test_normalise_initials(spark):
    raw = "Actinostachys R. Br. ex Hook. & Baker"
    data = [raw, "Aus K. S. Walter"]
    assert values(spark, data, names.normalise_initials("c0")) == [
        "Actinostachys R.Br. ex Hook. & Baker",
        "Aus K.S.Walter",
    ]


def test_italicise_name(spark):
    data = [("Féea L.", "genus"), ("× Aus L.", "genus"), ("Alphaceae L.", "family"), ("Aus bus", None)]
    assert values(spark, data, names.italicise_name("c0", "c1")) == [
        "*Féea* L.",
        "× *Aus* L.",
        "Alphaceae L.",
        "Aus bus",
    ]


def test_decode_rank_and_groups(spark):
    data = ["SF", "FM", "Z", None]
    assert values(spark, data, text.decode_rank("c0")) == ["subfamily", "form", None, None]
    assert values(spark, ["tribe", "variety"], text.rank_to_group("c0")) == [None, "infraspecies"]


def test_not_in_keeps_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert {r[0] for r in df.filter(text.not_in("c", ["a"])).collect()} == {"b", None}


def test_last_match_and_counts(spark):
    data = ["a var. b f. c", "none"]
    assert values(spark, data, text.last_match("c0", r" var\. | f\. ")) == ["f.", None]
    assert values(spark, data, text.count_matches("c0", " ")) == [4, 0]


def test_url_helpers(spark):
    assert values(spark, ["/n/1"], text.prefix_url("c0")) == ["https://www.ipni.org/n/1"]
    got = values(spark, ["https://api.github.com/repos/a/b"], text.rewrite_url("c0"))
    assert got == ["https://github.com/a/b"]
    assert values(spark, ["subfam. Aus [x]"], text.strip_suffix(text.strip_prefix("c0"))) == ["Aus [x"]


def test_full_name_skips_nulls(spark):
    data = [("Aus", "L."), ("Aus", None), (None, None)]
    assert values(spark, data, text.full_name("c0", "c1")) == ["Aus L.", "Aus", None]
    assert values(spark, [None, "x"], text.is_present("c0")) == [False, True]
