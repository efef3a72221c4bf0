"""Column functions on scientific names: canonical form, authorship, rank, italics.

The canonical form is rule-based, not a full name grammar: capitalised genus
word, lower-case epithets, epithets after rank markers, authors skipped. Names
that do not start with a capitalised word give null, and a rule reports them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.functions.text import _col, count_matches, last_match, squish

# Lower-case words that belong to an authorship, never an epithet.
AUTHOR_PARTICLES = "ex|et|in|and|de|del|della|der|den|da|das|do|dos|du|la|le|van|von|zu|zur|bis|fil"

# Rank markers in front of an infraspecific epithet.
RANK_MARKERS = r"subsp\.|ssp\.|subvar\.|var\.|subf\.|fm\.|forma|f\.|monstr\.|nothovar\.|nothosubsp\."

_HYBRID = r"(?:[x×]\s+)?"
_GENUS = r"^\s*(?:[x×]\s?)?(\p{Lu}[\p{L}\-]+)(?![\p{L}.])"
_EPITHET = rf"{_HYBRID}((?!(?:{AUTHOR_PARTICLES})\b)\p{{Ll}}[\p{{Ll}}\-]+)(?![\p{{L}}.])"
# a hybrid genus with a second hybrid sign is read up to the genus only
_TWO_SIGNS = r"^\s*[x×]\s?\p{Lu}[\p{L}\-]+\s+[x×]\s"
_BINOMIAL = rf"(?!{_TWO_SIGNS}){_GENUS}\s+{_EPITHET}"
_TRINOMIAL = rf"{_BINOMIAL}\s+{_EPITHET}"
_MARKED = rf"\s(?:{RANK_MARKERS})\s*{_EPITHET}"


def _group(c: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def _override(c: Column, parsed: Column, part: int) -> Column:
    for name, values in vocab.NAME_OVERRIDES.items():
        parsed = F.when(c == F.lit(name), F.lit(values[part])).otherwise(parsed)
    return parsed


def canonical_name(c: Column | str) -> Column:
    """Genus and epithets without authors, markers and hybrid signs."""
    c = _col(c)
    species = _group(c, _BINOMIAL, 2)
    marked = F.when(species.isNotNull(), F.regexp_extract_all(c, F.lit(_MARKED), F.lit(1)))
    lower = F.coalesce(
        F.nullif(F.array_join(marked, " "), F.lit("")),
        _group(c, _TRINOMIAL, 3),
    )
    genus = _group(c, _GENUS, 1)
    parsed = F.when(genus.isNotNull(), F.concat_ws(" ", genus, species, lower))
    return _override(c, parsed, 0)


def authorship(c: Column | str) -> Column:
    """What follows the last epithet (or the genus of a one-word name)."""
    c = _col(c)
    epithet = _EPITHET.replace("((?!", "(?:(?!", 1)
    genus = _GENUS.replace("(\\p{Lu}", "(?:\\p{Lu}", 1)
    head = rf"{genus}(?:\s+{epithet}(?:.*\s(?:{RANK_MARKERS})\s*{epithet}|\s+{epithet})?)?"
    rest = F.when(c.rlike(rf"(?!{_TWO_SIGNS}){_GENUS}"), squish(F.regexp_replace(c, head, "")))
    return _override(c, F.nullif(rest, F.lit("")), 1)


def infraspecific_marker(c: Column | str, strict: bool = False) -> Column:
    """Last rank marker inside a name.

    ``strict`` asks for a lower-case word of three letters or more after it, so
    that the author suffix "f." is not taken for a form.
    """
    pattern = vocab.MARKER_PATTERN
    if strict:
        pattern = rf"(?: var\. | f\. | ssp\. ?| subvar\. | monstr\. )(?=(?!(?:{AUTHOR_PARTICLES})\b)\p{{Ll}}{{3}})"
    return last_match(c, pattern)


def rank_rules(
    name: Column | str,
    canonical: Column | str,
    blanks: Column | str,
    marker: Column | str,
    suffixes: list[tuple[str, str]] = vocab.UNINOMIAL_SUFFIXES,
) -> Column:
    """Rank by ending of a one-word name, then marker, then word count; null when none fits."""
    name, canonical, blanks, marker = _col(name), _col(canonical), _col(blanks), _col(marker)
    one_word = blanks == 0
    cases = [(one_word & canonical.endswith(end), rank) for end, rank in suffixes]
    cases += [(marker == mark, rank) for mark, rank in vocab.INFRASPECIFIC_MARKERS]
    cases.append((blanks == 1, "species"))
    # a capital first: xAsplenosorus x boydstoniae parses to one word but is no genus
    cases.append((one_word & name.rlike("^[A-Z][a-z]"), "genus"))
    return first_case(cases)


def first_case(cases: list[tuple[Column, str]]) -> Column:
    """Value of the first condition that holds."""
    rank = F.when(*cases[0])
    for condition, value in cases[1:]:
        rank = rank.when(condition, value)
    return rank


def rank_from_name(df: DataFrame, name: str, target: str = "taxonRank", strict: bool = False) -> DataFrame:
    """Adds the rank guessed from a name.

    The parts are columns of their own before the rules read them, so each is
    evaluated once per row.
    """
    return (
        df.withColumn("_canonical", canonical_name(name))
        .withColumns(
            {"_blanks": count_matches("_canonical", " "), "_marker": infraspecific_marker(name, strict)}
        )
        .withColumn(target, rank_rules(name, "_canonical", "_blanks", "_marker"))
        .drop("_canonical", "_blanks", "_marker")
    )


def normalise_initials(c: Column | str) -> Column:
    """``R. Br.`` -> ``R.Br.``"""
    return F.regexp_replace(_col(c), vocab.INITIALS_PATTERN, ".")


def italicise_name(name: Column | str, rank: Column | str) -> Column:
    """Markdown italics on the first word from genus down, after ``×`` for hybrids."""
    name, rank = _col(name), _col(rank)
    hybrid = name.startswith("× ")
    return (
        F.when(
            rank.isin(*vocab.ITALIC_RANKS) & ~hybrid,
            F.regexp_replace(name, r"(?U)^(\w+)", "*$1*"),
        )
        .when(hybrid, F.regexp_replace(name, r"(?U)^× (\w+)", "× *$1*"))
        .otherwise(name)
    )


def counted_rank(name: Column | str, rank: Column | str) -> Column:
    """Rank for the counts: hybrid genera and hybrid species are set apart."""
    name, rank = _col(name), _col(rank)
    return (
        F.when(name.rlike("^[x×]") & (rank == "genus"), "nothogenus")
        .when(name.rlike(" [x×] ") & rank.isin(*vocab.HYBRID_RANKS), "hybrid")
        .otherwise(rank)
    )
