"""The mini checklist through the whole plan."""

import pytest
from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.operators import lineage, ordering, parents, quality, reconcile, summary, synonyms
from taxaloom.plans import checklist as plans
from taxaloom.sources import checklist as files


def by_name(df, *columns):
    return {(r["scientificName"], *[r[c] for c in columns]) for r in df.select("scientificName", *columns).collect()}


def raw(spark, *records):
    """Raw rows from (number, code, name) or (number, code, name, synonyms)."""
    data = [(i, *r, *([None] * (4 - len(r)))) for i, r in enumerate(records, 1)]
    return spark.createDataFrame(data, "pos long, number string, taxon string, name string, synonyms string")


def violations(spark, *records):
    """{(rule, name)} of a checklist; the name is the key or the detail where the rule gives no id."""
    checklist = plans.prepare_checklist(raw(spark, *records)).cache()
    result = plans.checklist_to_taxa(checklist)
    names = {r["taxonID"]: r["scientificName"] for r in result.taxa.collect()}
    return {(r["rule"], names.get(r["key"], r["key"])) for r in plans.taxa_violations(result).collect()}


GOOD = [("001.", "O", "Aales X."), ("001.1000", "F", "Aaceae X."), ("001.1010", "G", "Aus X."), (None, "S", "Aus bus X.")]


def test_read_and_prepare(mini):
    rows = mini.orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(1, 18))
    assert "photo" not in mini.columns and "empty" not in mini.columns
    assert rows[9]["number"] == "002.1010" and rows[9]["scientificName"] == "Beta prima B. & C."
    assert rows[9]["namePublishedIn"] is None and rows[8]["taxonRemarks"] == 'said "nice" plant'
    assert [r["taxonRank"] for r in rows[:5]] == ["order", "family", "subfamily", "tribe", "genus"]


def test_synonyms(mini):
    rows = by_name(synonyms.explode_synonyms(mini), "namePublishedIn", "taxonRank", "taxonomicStatus")
    assert rows == {
        ("Oldus X.", "J. 2 [repr.]", "genus", "synonym"),
        ("Betopsida Old", "Bk. 1", "class", "synonym"),
        ("Beta una D.", "Bk. 3", "species", "ambiguous synonym"),
        ("Beta una D.", "Bk. 4", "species", "ambiguous synonym"),
        ("Beta duo E.", None, "species", "synonym"),
        ("Beta prima f. parva J.", None, "form", "synonym"),
        ("Beta nana L. f. ex M.", None, "form", "synonym"),
    }


def test_taxa(mini_taxa):
    taxa = mini_taxa.taxa
    assert taxa.count() == 25
    parents_of = dict(by_name(taxa.filter("taxonomicStatus = 'accepted'"), "parentNameUsage"))
    assert parents_of == {
        "Alphales A.Auth": None,
        "Alphaceae A.Auth": "Alphales A.Auth",
        "Alphoideae A.Auth": "Alphaceae A.Auth",
        "Alpheae A.Auth": "Alphoideae A.Auth",
        "Alpha A.Auth": "Alpheae A.Auth",
        "Gamma A.Auth": "Alphoideae A.Auth",
        "Betales B.Auth": None,
        "Betaceae B.Auth": "Betales B.Auth",
        "Beta B.Auth": "Betaceae B.Auth",
        "xBetalpha C.Auth": "Betaceae B.Auth",
        "Beta prima B. & C.": "Beta B.Auth",
        "Beta x hybrida F.": "Beta B.Auth",
        "Beta homonyma G.": "Beta B.Auth",
        "Beta homonyma H.": "Beta B.Auth",
        "Beta quarta K.": "Beta B.Auth",
        "Beta prima var. minor I.": "Beta prima B. & C.",
        "Beta prima f. nana L.": "Beta prima B. & C.",
        "Beta quarta ssp. quarta K.": "Beta quarta K.",
    }
    full = by_name(taxa, *vocab.LINEAGE_RANKS)
    assert ("Alpha A.Auth", "Alpha", "Alpheae", "Alphoideae", "Alphaceae", "Alphales") in full
    # a genus right below a subfamily that also has tribes
    assert ("Gamma A.Auth", "Gamma", None, "Alphoideae", "Alphaceae", "Alphales") in full
    assert ("Oldus X.", "Alpha", "Alpheae", "Alphoideae", "Alphaceae", "Alphales") in full
    assert ("Betopsida Old", None, None, None, None, "Betales") in full
    assert ("Beta quarta K.", "autonym") in by_name(taxa, "taxonRemarks")
    assert plans.taxa_violations(mini_taxa).count() == 0


def test_counts(mini):
    assert [tuple(r) for r in summary.count_taxa_by_rank(mini).collect()] == [
        ("order", 2, 1),
        ("family", 2, 0),
        ("subfamily", 1, 0),
        ("tribe", 1, 0),
        ("genus", 3, 1),
        ("nothogenus", 1, 0),
        ("species", 3, 2),
    ]


def test_ids_do_not_depend_on_partitions(spark):
    def ids(n):
        return {tuple(r) for r in plans.prepare_checklist(raw(spark, *GOOD).repartition(n)).select("pos", "taxonID", "number").collect()}

    assert ids(1) == ids(7)


def test_clean_checklist_has_no_violations_with_one_order(spark):
    assert violations(spark, *GOOD) == set()


def test_each_broken_rule_is_reported(spark):
    found = violations(
        spark,
        (None, "S", "Aus ante X."),  # before any genus code
        *GOOD,
        ("001.1011", "Q", "Bus X."),  # unknown rank code
        (None, "S", "Dus bus X."),
        (None, "S", "Dus bus X."),  # listed twice
        ("001.9000", "G", "Zus X."),  # outside every band
        (None, "V", "Zus bus var. cus X."),  # no such species
        ("001.1500", "F", "Baceae X."),
        ("001.1600", "G", "Cus X."),  # inside two bands
        (None, "S", "Cus dus X."),
        (None, "S", "Cus dus Y."),
        (None, "V", "Cus dus var. eus X."),  # its species is listed twice
    )
    assert {
        ("number_not_null", "Aus ante X."),
        ("parent_missing", "Aus ante X."),
        ("rank_not_null", "Bus X."),
        ("accepted_name_unique", "Dus bus X."),
        ("taxonID_unique", "Dus bus X."),
        ("parent_missing", "Zus X."),
        ("parent_missing", "Zus bus var. cus X."),
        ("ambiguous_parent", "Cus X."),
        ("ambiguous_parent", "Cus dus var. eus X."),
        ("parentless_accepted_is_order", "Zus X."),
        ("order_not_null", "Zus X."),
    } <= found
    assert not {n for _, n in found} & {"Aales X.", "Aaceae X.", "Aus X.", "Aus bus X."}


def test_missing_reference_and_status(spark):
    df = spark.createDataFrame(
        [("1", "A", "accepted", None, None), ("2", "B", "synonym", "9", None), ("3", "C", "odd", "3", "1")],
        "taxonID string, scientificName string, taxonomicStatus string, acceptedNameUsageID string, parentNameUsageID string",
    )
    found = {(r["rule"], r["key"]) for r in quality.rule_table(df).collect()}
    assert found == {
        ("acceptedNameUsageID_resolves", "2"),
        ("acceptedNameUsageID_not_self", "3"),
        ("taxonomicStatus_in_values", "3"),
    }
    with pytest.raises(quality.RuleViolation):
        quality.enforce(quality.rule_table(df))
    quality.enforce(quality.rule_table(df.filter("taxonID = '1'")))
    extra = quality.rule_table(df.withColumn("what", F.lit(1)))
    assert ("column_names", "what") in {(r["rule"], r["key"]) for r in extra.collect()}


def test_lineage_reports_circles_and_stops(spark):
    df = spark.createDataFrame(
        [("a", "b", "genus", "A"), ("b", "a", "family", "B"), ("c", "a", "species", "C")],
        "taxonID string, parentNameUsageID string, taxonRank string, scientificName string",
    )
    resolved = lineage.resolve_nodes(df, "taxonID", "parentNameUsageID", "taxonRank", "scientificName", ["genus"])
    assert {r["key"] for r in lineage.circle_violations(resolved).collect()} == {"a", "b"}
    assert lineage.ancestor_columns(df).count() == 3


def test_lineage_of_deep_chain(spark):
    ranks = [f"r{i}" for i in range(40)]
    data = [(str(i), str(i - 1) if i else None, ranks[i], f"n{i}") for i in range(40)]
    df = spark.createDataFrame(data, "taxonID string, parentNameUsageID string, taxonRank string, scientificName string")
    row = lineage.ancestor_columns(df, ranks=ranks).filter("taxonID = '39'").first()
    assert [row[r] for r in ranks] == [f"n{i}" for i in range(40)]
    resolved = lineage.resolve_nodes(df, "taxonID", "parentNameUsageID", "taxonRank", "scientificName", ["r0"])
    assert lineage.circle_violations(resolved).count() == 0


def test_filter_to_genus(mini_taxa):
    kept = {r["scientificName"] for r in lineage.filter_to_level(mini_taxa.taxa).collect()}
    assert "Oldus X." in kept and "Betopsida Old" in kept and "Gamma A.Auth" in kept
    assert not {"Beta prima B. & C.", "Beta una D.", "Beta prima f. parva J."} & kept


def test_treatment(spark, mini_taxa, tmp_path):
    lines, missing = plans.sorted_treatment(mini_taxa.taxa, mini_taxa.ranked)
    assert missing.count() == 0
    path = files.write_treatment(lines, str(tmp_path / "treatment"))
    text = [r["value"] for r in spark.read.text(path).select("value", "_metadata.file_name").orderBy("file_name").collect()]
    assert text[:13] == [
        "",
        "## Alphales A.Auth \\-\\- Bk. 0",
        "",
        "### Alphaceae A.Auth \\-\\- NA",
        "",
        "#### Alphoideae A.Auth \\-\\- NA",
        "",
        "##### Alpheae A.Auth \\-\\- NA",
        "",
        "###### *Alpha* A.Auth \\-\\- NA",
        "= *Oldus* X. \\-\\- J. 2 [repr.]  ",
        "",
        "###### *Gamma* A.Auth \\-\\- NA",
    ]
    assert "* *Beta* quarta K. \\-\\- NA  " in text and 'said "nice" plant  ' in text
    # ambiguous synonyms are not printed
    assert not any("Beta* una" in t for t in text)
    genus = plans.sorted_treatment(mini_taxa.taxa, mini_taxa.ranked, "genus").lines
    assert genus.filter(F.col("line").startswith("* ")).count() == 0
    with pytest.raises(ValueError):
        plans.sorted_treatment(mini_taxa.taxa, mini_taxa.ranked, "tribe")


def test_sort_numbers_are_complete(mini_taxa):
    ordered = ordering.hierarchical_sort(mini_taxa.taxa, mini_taxa.ranked)
    rows = ordered.orderBy("sort_order").collect()
    assert [r["sort_order"] for r in rows] == list(range(1, 26))
    assert rows[0]["scientificName"] == "Alphales A.Auth" and rows[0]["order_rank"] == "01"
    assert ordering.missing_order_violations(ordered).count() == 0


def test_reconcile(spark, mini_taxa):
    empty = dict.fromkeys(vocab.AUTHORITY_COLUMNS)

    def entry(ref_id, match, group, **values):
        values = {**empty, "name": match, **values}
        return (match, group, 1, ref_id, *values.values())

    reference = spark.createDataFrame(
        [
            entry("r2", "Beta prima", "species", authors="Better", reference="Ref 2", url="/n/2"),
            entry("r3", "Beta prima", "genera", authors="Worse", reference="Ref 3", url="/n/3"),
            entry("r9", "Beta prima", "species", authors="Later", reference="Ref 9", url="/n/9"),
            # claimed by both homonyms: kept only where the full name is the same
            entry("r4", "Beta homonyma", "species", authors="G.", reference="Ref 4", url="/n/4"),
        ],
        "match_name string, match_group string, priority int, ref_id string, "
        + ", ".join(f"{c} string" for c in vocab.AUTHORITY_COLUMNS),
    )
    taxa = mini_taxa.taxa
    results = reconcile.match_reference(reconcile.prepare_match_requests(taxa), reference)
    # the two orders, the tribe and the class are not asked for
    assert results.count() == 21
    keep = by_name(
        reconcile.summarise_matches(taxa, results).withColumnRenamed("wf_sci_name", "scientificName"), "keep"
    )
    assert {n for n, k in keep if k} == {"Beta prima B. & C.", "Beta homonyma G."}
    final = plans.reconcile_names(taxa, reference)
    assert final.columns == vocab.OUTPUT_COLUMNS
    rows = {r["taxonID"]: r for r in final.collect()}
    assert len(rows) == 25
    names = {r["scientificName"]: r for r in rows.values()}
    assert names["Beta prima Better"]["namePublishedIn"] == "Ref 2"
    assert names["Beta prima Better"]["ipniURL"] == "https://www.ipni.org/n/2"
    assert names["Beta prima var. minor I."]["parentNameUsage"] == "Beta prima Better"
    assert names["Beta duo E."]["acceptedNameUsage"] == "Beta prima Better"
    assert names["Beta duo E."]["parentNameUsageID"] is None
    assert [r["scientificName"] for r in final.collect()] == sorted(r["scientificName"] for r in rows.values())


def test_csv_round_trip(spark, mini_taxa, tmp_path):
    path = files.write_table_csv(mini_taxa.taxa, str(tmp_path / "csv"), ["scientificName", "taxonID"])
    back = files.read_checklist(spark, path, sep=",")
    want = mini_taxa.taxa.select("scientificName", "namePublishedIn", "taxonRemarks").collect()
    got = back.select("scientific_name", "name_published_in", "taxon_remarks").collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
    ordered = [r["scientific_name"] for r in back.orderBy("pos").collect()]
    assert ordered == sorted(ordered)


def test_one_sorted_file(spark, tmp_path):
    import csv

    rows = [(f"n{i:04}", None if i % 5 == 0 else f'say "{i}", x', i) for i in range(1000)]
    path = files.write_one_csv(spark.createDataFrame(rows[::-1], "name string, `a,b` string, n int").repartition(6), str(tmp_path / "one.csv"), ["name"])
    with open(path, newline="") as f:
        found = list(csv.reader(f))
    assert found[0] == ["name", "a,b", "n"] and found[1:] == [[a, b or "", str(n)] for a, b, n in rows]
    files.write_one_csv(spark.createDataFrame(rows[:0], "name string, b string, n int"), path, ["name"])
    assert open(path).read() == "name,b,n\n"


def test_file_order_over_files_and_splits(spark, tmp_path):
    n = 3000
    lines = [f"{i}|x{i}|" for i in range(n)]
    for part, (a, b) in enumerate([(0, 10), (10, 2900), (2900, n)]):
        text = "\n".join(["Number|Name|None", *lines[a:b]]) + "\n"
        (tmp_path / f"part-{part}.csv").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = files.read_checklist(spark, str(tmp_path)).orderBy("pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [int(r["number"]) for r in got] == list(range(n))
    assert [r["pos"] for r in got] == list(range(1, n + 1))


def test_issues_and_new_names(spark, mini_taxa, tmp_path):
    import json

    body = "### Name of taxon\r\n\r\nAlpha and Nova\r\n\r\n### Rank of taxon\r\n\r\nGenus\r\n\r\n### number of species affected\r\n\r\n12\r\n\r\n### Description of change\r\n\r\nsplit"
    base = {"url": "https://api.github.com/repos/a/b/1", "created_at": "2024", "user": {"login": "u"}, "state": "open"}
    records = [
        {"number": 1, "title": "[PASSED] x", "body": body, **base},
        {"number": 2, "title": "open", "body": "nothing", **base},
        {"number": 3, "title": "[PASSED] pr", "body": body, "draft": False, **base},
    ]
    (tmp_path / "issues.json").write_text("\n".join(map(json.dumps, records)))
    from taxaloom.sources.issues import read_issues

    issues = read_issues(spark, str(tmp_path / "issues.json"))
    rows = {r["number"]: r for r in issues.collect()}
    assert set(rows) == {1, 2}
    assert (rows[1]["name"], rows[1]["rank"], rows[1]["no_species"], rows[1]["description"]) == ("Alpha and Nova", "Genus", "12", "split")
    assert rows[1]["url"] == "https://github.com/a/b/1" and rows[1]["user"] == "u" and rows[2]["name"] is None
    report = reconcile.new_names_report(issues, mini_taxa.taxa.select("scientificName", "taxonomicStatus"))
    assert {(r["new_taxon"], r["new_rank"], r["taxonomicStatus"]) for r in report.collect()} == {
        ("Alpha", "Genus", "accepted"),
        ("Nova", "Genus", None),
    }


def test_exclusion_list(spark, mini_taxa, tmp_path):
    target = mini_taxa.taxa.filter("scientificName = 'Gamma A.Auth'").first()["taxonID"]
    (tmp_path / "dups.csv").write_text(f"Taxon ID,Comments MH\n{target},please delete\nx,keep\n")
    listed = files.read_exclusions(spark, str(tmp_path / "dups.csv"))
    assert plans.remove_duplicates(mini_taxa.taxa, listed).count() == 24


def test_autonyms(mini):
    made = parents.synthesise_autonyms(parents.rank_by_code(mini)).collect()
    assert [(r["scientificName"], r["taxonRank"], r["number"]) for r in made] == [("Beta quarta K.", "species", "002.1010")]


def test_staged_tables_are_released(spark, mini):
    import os

    from taxaloom.session import recording

    with recording(spark) as staged:
        rows = plans.checklist_to_taxa(mini).taxa.collect()
    paths = [p.removeprefix("file://") for p in staged.paths]
    assert rows and paths and all(os.path.isdir(p) for p in paths)
    staged.release()
    assert not any(os.path.exists(p) for p in paths) and staged.paths == []


def test_scratch_folder_without_setting(spark, monkeypatch):
    import os

    from taxaloom import session

    class Conf:
        def __init__(self, master):
            self.values = {"spark.master": master}

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Plain:
        sparkContext = spark.sparkContext

        def __init__(self, master):
            self.conf = Conf(master)

    own = session.scratch_dir(Plain("local[2]"))
    assert os.path.isdir(own) and session.scratch_dir(Plain("local[2]")) == own
    with pytest.raises(RuntimeError):
        session.scratch_dir(Plain("spark://host:7077"))
    shared = Plain("spark://host:7077")
    shared.conf.values["spark.checkpoint.dir"] = "/tmp/x"
    with pytest.warns(UserWarning):
        assert session.scratch_dir(shared) == "/tmp/x"


def test_unreadable_names_are_reported_and_not_asked_for(spark):
    from taxaloom.operators import reconcile

    df = spark.createDataFrame(
        [("1", "?nomen dubium Y.", "species", "synonym", None), ("2", "ined. specimen", None, "synonym", None), ("3", "Aus bus L.", "species", "accepted", None)],
        "taxonID string, scientificName string, taxonRank string, taxonomicStatus string, taxonRemarks string",
    )
    assert {(r["rule"], r["key"]) for r in reconcile.name_violations(df).collect()} == {("name_parsed", "1"), ("name_parsed", "2")}
    assert [r["taxonID"] for r in reconcile.prepare_match_requests(df).collect()] == ["3"]
