"""Reconciliation of names with a table of authority names."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.functions import names, text
from taxaloom.functions.grammar import parse_name
from taxaloom.operators.columns import (
    eligible_for_match,
    exclude_incertae,
    null_parent_for_aliases,
)
from taxaloom.operators.joins import anti_join, lookup_fill, lookup_join, one_per_key
from taxaloom.operators.quality import RowRule, row_rules
from taxaloom.operators.windows import add_count, first_hit
from taxaloom.session import stage

ANY_GROUP = ""


def prepare_match_requests(taxa: DataFrame, by_grammar: bool = False) -> DataFrame:
    """(taxonID, taxon, ipni_filter): canonical names to look up, one row per id.

    ``by_grammar`` reads names with ``functions.grammar`` (formulas, subgenera, chained ranks) in place of the rules.

    ``taxonID`` is the key of ``taxa``, so rows are distinct without a shuffle. Names that can't be read
    are not asked for; ``name_violations`` reports them.
    """
    asked = eligible_for_match(exclude_incertae(taxa))
    return asked.select(
        "taxonID",
        (parse_name("scientificName")["canonical"] if by_grammar else names.canonical_name("scientificName")).alias("taxon"),
        text.rank_to_group("taxonRank").alias("ipni_filter"),
    ).filter(F.col("taxon").isNotNull())


def name_rules(columns: Sequence[str], column: str = "scientificName") -> list[RowRule]:
    """Names without a canonical form, and names of infraspecific rank without a third part.

    Where the table has a status, parts are asked of accepted names only: the rank of a synonym is a guess.
    """
    parsed = names.canonical_name(column)
    below_species = F.col("taxonRank").isin(*vocab.INFRASPECIFIC_RANKS)
    if "taxonomicStatus" in columns:
        below_species = below_species & (F.col("taxonomicStatus") == "accepted")
    three = below_species & parsed.isNotNull() & (F.size(F.split(parsed, " ")) < 3)
    return [
        ("name_parsed", F.col(column).isNotNull() & parsed.isNull(), F.col("taxonID"), F.col(column)),
        ("name_has_three_parts", three, F.col("taxonID"), F.col(column)),
    ]


def name_violations(taxa: DataFrame, column: str = "scientificName") -> DataFrame:
    """Rows that break the ``name_rules``."""
    return row_rules(taxa, name_rules(taxa.columns, column))


def match_reference(
    requests: DataFrame,
    reference: DataFrame,
    id_col: str = "taxonID",
    name_col: str = "taxon",
    group_col: str = "ipni_filter",
    priority: Sequence[str] = ("priority", "ref_id"),
    columns: Sequence[str] = vocab.AUTHORITY_COLUMNS,
) -> DataFrame:
    """First authority row per request by name and, if given, filter group; none gives nulls.

    ``reference`` holds ``match_name``, ``match_group``, the priority columns and
    ``columns``. It is cut to its first row per name and per (name, group) before
    the join, so a name with many authority rows never multiplies requests.
    """
    kept = reference.select("match_name", "match_group", *dict.fromkeys([*priority, *columns]))
    grouped = first_hit(kept, ["match_name", "match_group"], priority)
    # a request without a group takes the best row over all groups
    overall = first_hit(grouped, ["match_name"], priority).withColumn("match_group", F.lit(ANY_GROUP))
    best = grouped.filter(F.col("match_group").isNotNull()).unionByName(overall)
    asked = requests.withColumn("_group", F.coalesce(F.col(group_col), F.lit(ANY_GROUP)))
    answers = best.select(
        F.col("match_name").alias("_match_name"), F.col("match_group").alias("_match_group"), *columns
    )
    joined = lookup_join(
        asked, answers, [(name_col, "_match_name"), ("_group", "_match_group")], salt_by=[id_col]
    )
    return joined.select(id_col, *columns)


#: letters of a name that stand together in the index, and the edits allowed for names of four and of eight letters
GRAM, EDITS = 3, {4: 1, 8: 2}
#: variants of a name up to which it is looked up by them; with two edits, names of 65 letters
MOST_VARIANTS = 2_200


def _grams(name: Column) -> Column:
    """Three letters in a row, with blanks around the name, numbered where one repeats: every edit changes three at most."""
    padded = F.concat(F.lit(" " * (GRAM - 1)), name, F.lit(" " * (GRAM - 1)))
    places = F.sequence(F.lit(1), F.length(padded) - (GRAM - 1))
    grams = F.transform(places, lambda i: F.substring(padded, i, F.lit(GRAM)))
    numbered = F.transform(grams, lambda g, i: F.struct(g.alias("g"), F.size(F.filter(F.slice(grams, 1, i + 1), lambda o: o == g)).alias("k")))
    return F.transform(numbered, lambda x: F.concat(x["g"], x["k"].cast("string")))


def _prefixes(named: DataFrame, counts: DataFrame, edits: int) -> DataFrame:
    """(name, gram) of the rarest grams of each name: names within so many edits have one of them in common."""
    each = named.select("name", F.explode(_grams(F.col("name"))).alias("gram"))
    weighed = each.join(counts, "gram", "left").select("name", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram").alias("place"))
    rarest = F.slice(F.array_sort(F.collect_list("place")), 1, GRAM * edits + 1)  # the grams of one name
    return weighed.groupBy("name").agg(F.explode(rarest).alias("place")).select("name", F.col("place.gram").alias("gram"))


def _variants(name: Column, deleted: Column, most: int) -> Column:
    """Hashes of a name and of what is left of it without any one letter, two letters and so on up to ``deleted``."""
    from_place = F.struct(name.alias("s"), F.lit(1).alias("p"))
    level = F.array(from_place)
    levels = [level]
    for n in range(1, most + 1):
        # letters go in order, so that each set of places is taken once
        def shorter(x: Column) -> Column:
            places = F.when(x["p"] <= F.length(x["s"]), F.sequence(x["p"], F.length(x["s"]))).otherwise(F.array().cast("array<int>"))
            return F.transform(
                places,
                lambda i: F.struct(
                    F.concat(F.substring(x["s"], F.lit(1), i - 1), F.substring(x["s"], i + 1, F.length(x["s"]))).alias("s"), i.alias("p")
                ),
            )

        level = F.when(deleted >= n, F.flatten(F.transform(level, shorter))).otherwise(F.array().cast("array<struct<s:string,p:int>>"))
        levels.append(level)
    return F.array_distinct(F.transform(F.concat(*levels), lambda x: F.xxhash64(x["s"])))


def _longest(edits: int) -> int:
    """Length up to which a name has at most ``MOST_VARIANTS`` variants."""
    length = edits
    while sum(math.comb(length + 1, n) for n in range(edits + 1)) <= MOST_VARIANTS:
        length += 1
    return length


def _meet_by_variants(asked: DataFrame, known: DataFrame, most: int) -> DataFrame:
    """(name, match_name, allowed) of names that are alike when up to ``allowed`` and ``most`` letters are deleted."""
    left = asked.select("name", "allowed", F.explode(_variants(F.col("name"), F.col("allowed"), most)).alias("variant"))
    right = known.select(F.col("name").alias("match_name"), F.explode(_variants(F.col("name"), F.lit(most), most)).alias("variant"))
    return left.join(right.hint("merge"), "variant").select("name", "match_name", "allowed")


def _meet_by_grams(asked: DataFrame, known: DataFrame, most: int) -> DataFrame:
    """(name, match_name, allowed) of names that have one of their rarest grams in common."""
    counts = stage(known.select(F.explode(_grams(F.col("name"))).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "grams")
    left = _prefixes(asked, counts, most).join(asked, "name")
    right = _prefixes(known, counts, most).withColumnRenamed("name", "match_name")
    return left.join(right.hint("merge"), "gram").select("name", "match_name", "allowed")


def similar_names(asked: DataFrame, known: DataFrame, edits: dict[int, int] | None = None) -> DataFrame:
    """(name, match_name, distance) of pairs of different names that few edits apart, for two columns ``name``.

    ``edits`` says from which length of the asked name on how many are allowed. Names that are so many edits apart have
    a variant in common, which is what remains when as many letters are deleted from each. How many names share a variant
    depends on their length and letters, not on the size of the table. Names with more than ``MOST_VARIANTS`` variants
    meet under the rarest grams of each instead. Pairs are then compared letter by letter; no pair is lost.
    """
    edits = EDITS if edits is None else edits
    most = max(edits.values())
    if any(length + GRAM - 1 <= GRAM * n for length, n in edits.items()):
        raise ValueError("so many edits may leave a short name without any gram in common")
    asked, known = (d.select("name").where(F.col("name").isNotNull()).distinct() for d in (asked, known))
    allowed = F.lit(0)
    for length, n in sorted(edits.items()):
        allowed = F.when(F.length("name") >= length, n).otherwise(allowed)
    long_enough = asked.withColumn("allowed", allowed).where("allowed > 0")
    longest, size = _longest(most), F.length("name")
    short = _meet_by_variants(long_enough.where(size <= longest), known.where(size <= longest + most), most)
    long = _meet_by_grams(long_enough.where(size > longest), known.where(size > longest - most), most)
    near = F.abs(size - F.length("match_name")) <= F.col("allowed")
    distance = F.levenshtein("name", "match_name", most)  # below 0 beyond that
    pairs = short.unionByName(long).where(near).withColumn("distance", distance).where("distance between 1 and allowed")
    return pairs.select("name", "match_name", "distance").distinct()


def match_similar(
    requests: DataFrame,
    reference: DataFrame,
    id_col: str = "taxonID",
    name_col: str = "taxon",
    priority: Sequence[str] = ("priority", "ref_id"),
    columns: Sequence[str] = vocab.AUTHORITY_COLUMNS,
    edits: dict[int, int] | None = None,
) -> DataFrame:
    """Most similar authority row of the requests whose name the authority doesn't have, by distance, then priority.

    Adds ``match_name`` and ``distance``; requests without a similar name have no row. Meant for review, so
    ``match_reference`` does not use it by itself.
    """
    best = first_hit(reference.select("match_name", *dict.fromkeys([*priority, *columns])), ["match_name"], priority)
    best = stage(best.where(F.col("match_name").isNotNull()), "best")
    names_ = best.select(F.col("match_name").alias("name"))
    open_ = anti_join(requests.where(F.col(name_col).isNotNull()), best, [(name_col, "match_name")])
    open_ = stage(open_.select(id_col, F.col(name_col).alias("name")), "open")
    pairs = similar_names(open_.select("name"), names_, edits)
    ranked = lookup_join(pairs, best, "match_name", "inner")
    nearest = first_hit(ranked, ["name"], ["distance", *priority, "match_name"])
    found = lookup_join(open_, nearest, "name", "inner", salt_by=[id_col])
    return found.select(id_col, "match_name", "distance", *columns)


def summarise_matches(taxa: DataFrame, results: DataFrame) -> DataFrame:
    """Results with status, own and authority name, requests per authority name and keep flag.

    Exact full name: keep. Name claimed by several requests: drop. Claimed once: keep.
    """
    own = taxa.select("taxonID", "taxonomicStatus", F.col("scientificName").alias("wf_sci_name"))
    joined = lookup_join(results, one_per_key(own, "taxonID"), "taxonID", "inner", skewed=False)
    counted = add_count(joined, ["name"], "n_ipni_hits", salt_by=["taxonID"])
    authority_name = F.when(F.col("name").isNotNull(), text.full_name("name", "authors"))
    return counted.withColumn("ipni_sci_name", authority_name).withColumn(
        "keep",
        F.when(F.col("name").isNull(), False)
        .when(F.col("wf_sci_name") == F.col("ipni_sci_name"), True)
        .otherwise(F.col("n_ipni_hits") == 1),
    )


def replace_names(taxa: DataFrame, summary: DataFrame) -> DataFrame:
    """Name and publication of kept matches from the authority, others unchanged; adds ``ipniURL``."""
    kept = summary.filter("keep").select(
        F.col("taxonID").alias("_id"),
        F.col("ipni_sci_name").alias("_name"),
        F.col("reference").alias("_reference"),
        text.prefix_url("url").alias("ipniURL"),
    )
    kept = one_per_key(kept, "_id").withColumn("_kept", F.lit(True))
    joined = lookup_join(taxa, kept, [("taxonID", "_id")], skewed=False)
    matched = F.col("_kept").isNotNull()
    return joined.withColumns(
        {
            "scientificName": text.strip_prefix(
                F.when(matched, F.col("_name")).otherwise(F.col("scientificName"))
            ),
            "namePublishedIn": F.when(matched, F.col("_reference")).otherwise(F.col("namePublishedIn")),
        }
    ).drop("_name", "_reference", "_kept")


def fill_name_usages(taxa: DataFrame, keys_from: DataFrame | None = None) -> DataFrame:
    """Names of the accepted and of the parent record, looked up by their ids."""
    for name in ("acceptedNameUsage", "parentNameUsage"):
        keys_from = keys_from if keys_from is not None else taxa
        taxa = lookup_fill(taxa, name, "scientificName", "taxonID", f"{name}ID", keys_from=keys_from)
    return taxa


def apply_reference_names(taxa: DataFrame, summary: DataFrame) -> DataFrame:
    """Final taxon table, unsorted: authority names applied and name usages refilled."""
    base = taxa.drop(*vocab.LINEAGE_RANKS, "acceptedNameUsage", "parentNameUsage")
    named = fill_name_usages(replace_names(base, summary), keys_from=base)
    return null_parent_for_aliases(named).select(*vocab.OUTPUT_COLUMNS)


def new_name_status(new_names: DataFrame, taxa: DataFrame, on: str = "taxon") -> DataFrame:
    """Status of newly passed names in the current table (all matches; none gives nulls)."""
    return lookup_join(new_names, taxa, on).withColumnsRenamed({on: "new_taxon", "rank": "new_rank"})


def new_names_report(issues: DataFrame, taxa: DataFrame, mark: str = r"\[PASSED\]") -> DataFrame:
    """Names in passed issues, one row each, with their rows in the current table."""
    passed = issues.filter(F.col("title").rlike(mark)).select(
        F.explode(text.split_longer("name")).alias("taxon"), "rank"
    )
    current = taxa.withColumn("taxon", names.canonical_name("scientificName"))
    return new_name_status(passed, current)
