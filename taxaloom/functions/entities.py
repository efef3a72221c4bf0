"""HTML entities decoded by built-in functions, as the standard library's decoder does.

A text is cut at its entities; each is decoded on its own and the parts are joined again. Names come from the standard
library's table, as literal maps by first letter. A name without semicolon counts up to its longest known
beginning. Numbers are code points; those that HTML reads otherwise are replaced.
"""

from __future__ import annotations

import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: an ampersand and what may be a number or a name (fixed value of the HTML standard)
ENTITY = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: what stands for code points that are none (fixed value)
REPLACEMENT = "�"
LAST_POINT = 0x10FFFF


@lru_cache(maxsize=1)
def _tables() -> tuple[str, str, str]:
    """(names by first letter as JSON, pattern of the names that need no semicolon, numbers read otherwise as JSON)"""
    names: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        names.setdefault(name[0], {})[name] = text
    bare = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    # code points 128 to 159 are read in the Western Windows encoding, where it has a character there
    western = {i: bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0)}
    read = {str(i): c for i, c in western.items()} | {"0": REPLACEMENT, "13": "\r"}
    return json.dumps(names), f"^({'|'.join(bare)})", json.dumps(read)


def _map(text: str, kind: str) -> Column:
    return F.from_json(F.lit(text), kind)  # of a literal: Spark evaluates it once


def _character(point: Column) -> Column:
    """Text of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")


def _no_character(point: Column) -> Column:
    """Control characters and code points that are set aside."""
    control = point.between(1, 8) | (point == 11) | point.between(14, 31) | point.between(127, 159)
    return control | point.between(0xFDD0, 0xFDEF) | (point % 0x10000 >= 0xFFFE)


def _number(entity: Column) -> Column:
    digits = F.regexp_extract(entity, "^#[xX]?([0-9a-fA-F]+)", 1)
    is_hex = entity.rlike("^#[xX]")
    bare = F.regexp_replace(digits, "^0+", "")
    # seven digits hold all code points, whichever they are
    point = F.coalesce(F.conv(F.lpad(bare, 7, "0"), 16, 10), F.lit("0")).cast("long")
    point = F.when(is_hex, point).otherwise(F.lpad(bare, 7, "0").try_cast("long"))
    other = F.element_at(_map(_tables()[2], "map<string,string>"), point.cast("string"))
    none = (F.length(bare) > 7) | (point > LAST_POINT) | point.between(0xD800, 0xDFFF)
    return F.when(none, F.lit(REPLACEMENT)).otherwise(
        F.coalesce(other, F.when(_no_character(point), F.lit("")).otherwise(_character(point)))
    )


def _name(entity: Column) -> Column:
    names, bare, _ = _tables()
    known = F.element_at(F.element_at(_map(names, "map<string,map<string,string>>"), F.substring(entity, 1, 1)), entity)
    beginning = F.regexp_extract(entity, bare, 1)
    short = F.element_at(F.element_at(_map(names, "map<string,map<string,string>>"), F.substring(beginning, 1, 1)), beginning)
    rest = F.substring(entity, F.length(beginning) + 1, F.length(entity))
    return F.coalesce(known, F.when(beginning != "", F.concat(short, rest)), F.concat(F.lit("&"), entity))


def _decoded(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(1))
    between = F.split(text, ENTITY, -1)  # one more than there are entities
    decoded = F.transform(found, lambda e: F.when(e.startswith("#"), _number(e)).otherwise(_name(e)))
    parts = F.zip_with(between, F.concat(decoded, F.array(F.lit(""))), lambda rest, e: F.concat(rest, e))
    return F.when(text.contains("&"), F.array_join(parts, "")).otherwise(text)


def decode_entities(c: Column) -> Column:
    """Text with all entities decoded; null stays null."""
    return F.transform(F.array(c), _decoded)[0]  # a name for the text, so that it is made once
