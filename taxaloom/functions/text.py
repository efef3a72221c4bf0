"""Column functions on text. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.functions.entities import decode_entities

FIELD_SEPARATOR = "\x1f"
NULL_FIELD = "\\N"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squish(c: Column | str) -> Column:
    """Trim and collapse every run of white space (Unicode-aware) to one blank."""
    return F.trim(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def strip_tags(c: Column | str) -> Column:
    """Text content: comments and tags removed."""
    return F.regexp_replace(_col(c), r"(?s)<!--.*?-->|</?[A-Za-z!][^>]*>", "")


def unescape_html(c: Column | str) -> Column:
    """Text content with entities decoded; the literal text ``NA`` becomes null.

    Tags go first so that a decoded ``<`` stays text.
    """
    return F.nullif(decode_entities(strip_tags(c)), F.lit("NA"))


def decode_rank(c: Column | str, codes: dict[str, str] | None = None) -> Column:
    """Rank code -> rank; an unknown code gives null (see the ``rank_not_null`` rule)."""
    codes = codes or vocab.RANK_CODES
    lookup = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return lookup[_col(c)]


def split_multivalue(c: Column | str, sep: str = "=") -> Column:
    """Array of squished, non-empty pieces of a packed text (``sep`` is a regex)."""
    pieces = F.transform(F.split(_col(c), sep), squish)
    return F.filter(pieces, lambda piece: piece != "")


def split_longer(c: Column | str, keep_inside_words: bool = True) -> Column:
    """Array of names in a list such as ``A, B and C``.

    ``keep_inside_words=False`` also splits at an "and" inside a word.
    """
    pattern = r"(?U)\band\b" if keep_inside_words else "and"
    return F.transform(F.split(F.regexp_replace(_col(c), pattern, ","), ","), squish)


def split_first(c: Column | str, sep: str) -> tuple[Column, Column]:
    """(text before the first ``sep``, text after it or null); ``sep`` is a regex."""
    parts = F.split(_col(c), sep, 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def split_fixed(c: Column | str, n: int, sep: str = " ") -> list[Column]:
    """The first ``n`` pieces; missing ones are null."""
    parts = F.split(_col(c), sep)
    return [F.get(parts, F.lit(i)) for i in range(n)]


def strip_suffix(c: Column | str, pattern: str = r"\]") -> Column:
    return F.regexp_replace(_col(c), f"(?:{pattern})$", "")


def strip_prefix(c: Column | str, pattern: str = r"subfam\. ") -> Column:
    return F.regexp_replace(_col(c), f"^(?:{pattern})", "")


def first_token(c: Column | str, sep: str = " ") -> Column:
    return F.substring_index(_col(c), sep, 1)


def epithet_token(c: Column | str) -> Column:
    """Second word, or the third when the second is one character (a hybrid sign)."""
    words = F.split(_col(c), " ")
    second, third = F.get(words, F.lit(1)), F.get(words, F.lit(2))
    return F.when(F.length(second) == 1, third).otherwise(second)


def last_match(c: Column | str, pattern: str) -> Column:
    """Last match of ``pattern``, trimmed; null when there is none."""
    found = F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(0))
    return squish(F.try_element_at(found, F.lit(-1)))


def match_group(c: Column | str, pattern: str, group: int = 1) -> Column:
    """Group of the first match; null without a match (an empty match stays empty)."""
    c = _col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def count_matches(c: Column | str, pattern: str) -> Column:
    return F.regexp_count(_col(c), F.lit(pattern))


def code_parts(c: Column | str) -> tuple[Column, Column]:
    """(major, minor) of a position code ``ddd.d+`` as doubles; null when absent."""
    major = F.nullif(F.regexp_extract(_col(c), r"(\d{3})\.", 1), F.lit(""))
    minor = F.nullif(F.regexp_extract(_col(c), r"\.(\d+)", 1), F.lit(""))
    return major.try_cast("double"), minor.try_cast("double")


def pad_left(c: Column | str, width: int = 2, fill: str = "0") -> Column:
    """Left-pad to ``width``; longer text is kept whole."""
    c = _col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, fill)).otherwise(c)


def full_name(*cols: Column | str) -> Column:
    """Non-null parts joined by a blank; null when all are null."""
    return F.nullif(F.concat_ws(" ", *[_col(c) for c in cols]), F.lit(""))


def content_key(*cols: Column | str) -> Column:
    """Key made from column values only, so it does not change with partitioning."""
    fields = [F.coalesce(_col(c).cast("string"), F.lit(NULL_FIELD)) for c in cols]
    return F.md5(F.concat_ws(FIELD_SEPARATOR, *fields))


def rank_to_group(c: Column | str, groups: dict[str, str] | None = None) -> Column:
    """Rank -> filter group of the name authority; null for other ranks."""
    return decode_rank(c, groups or vocab.AUTHORITY_GROUPS)


def prefix_url(c: Column | str, host: str = vocab.AUTHORITY_URL) -> Column:
    return F.concat(F.lit(host), _col(c))


def rewrite_url(
    c: Column | str,
    old: str = "https://api.github.com/repos/",
    new: str = "https://github.com/",
) -> Column:
    return F.replace(_col(c), F.lit(old), F.lit(new))


def is_present(c: Column | str) -> Column:
    return _col(c).isNotNull()


def not_in(c: Column | str, values: list) -> Column:
    """``NOT IN`` that keeps null rows."""
    c = _col(c)
    return c.isNull() | ~c.isin(*values)
