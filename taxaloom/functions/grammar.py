"""Scientific names read by a grammar: tokens are classified once, then folded by a small state machine.

It reads subgenera in brackets, sections and other infrageneric marks, signs of hybrids before genera and epithets, formulas of
two or more parents, chained ranks, unmarked third names, and authorships with particles, ``ex``, ``in``, ``f.`` and
brackets. What it can't place is not guessed at: the name is refused, with the token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.functions.text import _col, squish
from taxaloom.operators.quality import RowRule, row_rules

# Lower-case words of an authorship, never an epithet.
PARTICLES = "ex|et|in|and|de|del|della|der|den|da|das|do|dos|du|la|le|van|von|zu|zur|bis|fil|al|auct|non|sensu|emend|y|ter"
# Marks of ranks below species, and between genus and species.
LOWER_RANKS = r"subsp\.|ssp\.|subvar\.|var\.|subf\.|fm\.|forma|f\.|monstr\.|nothovar\.|nothosubsp\.|nothof\.|convar\.|lusus"
GENUS_RANKS = r"subg\.|subgen\.|sect\.|subsect\.|ser\.|subser\."

#: kinds of tokens by number, the first that fits; all else is OTHER
HYBRID, SON, RANK_MARK, GROUP_MARK, PARTICLE, BRACKET, CAPITAL, INITIAL, LOWER, OTHER = range(10)
KINDS = {
    HYBRID: r"^[x×X]$",
    SON: r"^f\.$",  # a form if an epithet follows, the son of an author otherwise
    RANK_MARK: rf"^(?:{LOWER_RANKS})$",
    GROUP_MARK: rf"^(?:{GENUS_RANKS})$",
    PARTICLE: rf"^(?:{PARTICLES})$",
    BRACKET: r"^\(\p{Lu}[\p{L}\-]+\)$",
    CAPITAL: r"^\p{Lu}[\p{L}\-]+$",
    INITIAL: r"^\p{Lu}\.$",
    LOWER: r"^\p{Ll}[\p{Ll}\-]+$",
}
STATES = [
    "start", "crossed start", "genus", "bracket", "group", "genus author", "genus crossed", "species", "rank", "author",
    "author rank", "author son", "formula", "refused",
]
ACTIONS = [
    "none", "cross", "genus", "same genus", "hold", "subgenus", "epithet", "crossed epithet", "epithet of subgenus",
    "epithet of rank", "third epithet", "epithet of parent", "author", "author held", "author held, hold", "parent",
    "parent of genera", "refuse",
]
_WORDS = [PARTICLE, BRACKET, CAPITAL, INITIAL, OTHER]  # what may stand in an authorship besides marks

#: what a token does: {state: {kind: (next state, action)}}; anything else refuses the name
MOVES: dict[str, dict[int, tuple[str, str]]] = {
    "start": {HYBRID: ("crossed start", "cross"), CAPITAL: ("genus", "genus")},
    "crossed start": {CAPITAL: ("genus", "genus")},
    "genus": {
        **dict.fromkeys([*_WORDS, SON], ("genus author", "author")),
        BRACKET: ("bracket", "hold"),
        GROUP_MARK: ("group", "none"),
        HYBRID: ("genus crossed", "none"),
        LOWER: ("species", "epithet"),
    },
    # a bracket is a subgenus if an epithet follows, an author otherwise
    "bracket": {**dict.fromkeys([*_WORDS, SON], ("genus author", "author held")), LOWER: ("species", "epithet of subgenus")},
    "group": {CAPITAL: ("genus author", "subgenus")},
    "genus author": {**dict.fromkeys([*_WORDS, LOWER, SON], ("genus author", "author")), HYBRID: ("formula", "parent")},
    "genus crossed": {LOWER: ("species", "crossed epithet"), CAPITAL: ("genus", "parent of genera")},
    "species": {
        **dict.fromkeys(_WORDS, ("author", "author")),
        **dict.fromkeys([RANK_MARK, SON], ("rank", "hold")),
        LOWER: ("species", "third epithet"),
        HYBRID: ("formula", "parent"),
    },
    "rank": {LOWER: ("species", "epithet of rank"), HYBRID: ("rank", "cross")},
    "author": {
        **dict.fromkeys([*_WORDS, LOWER], ("author", "author")),
        RANK_MARK: ("author rank", "hold"),
        SON: ("author son", "hold"),
        HYBRID: ("formula", "parent"),
    },
    "author rank": {LOWER: ("species", "epithet of rank"), HYBRID: ("author rank", "cross")},
    "author son": {
        **dict.fromkeys(_WORDS, ("author", "author held")),
        LOWER: ("species", "epithet of rank"),
        RANK_MARK: ("author rank", "author held, hold"),
        SON: ("author son", "author held, hold"),
        HYBRID: ("formula", "parent"),
    },
    "formula": {CAPITAL: ("genus", "genus"), INITIAL: ("genus", "same genus"), LOWER: ("species", "epithet of parent")},
    "refused": dict.fromkeys(range(10), ("refused", "none")),
}
#: states that may not be the end of a name
OPEN = ["start", "crossed start", "group", "genus crossed", "rank", "author rank", "formula"]

_STATE = (
    "struct<state: int, genus: string, subgenus: string, names: array<string>, ranks: array<string>, author: array<string>, "
    "held: string, parents: array<string>, first_genus: string, crossed: boolean, refused: string>"
)
_FIELDS = dict(f.split(": ") for f in _STATE[len("struct<") : -1].split(", "))


def _tokens(name: Column) -> Column:
    """Classified tokens. Signs that stick to a word are cut off, and words that stick to the dot of a mark."""
    text = F.regexp_replace(name, r"(^|\s)[x×](?=\p{Lu}\p{Ll})", "$1× ")
    text = F.regexp_replace(text, r"×(?=\S)", "× ")
    text = F.regexp_replace(text, rf"(\s(?:{LOWER_RANKS}))(?=\p{{Ll}})", "$1 ")
    words = F.filter(F.split(squish(text), " "), lambda w: w != "")

    def classified(word: Column) -> Column:
        kind = F.when(word.rlike(KINDS[HYBRID]), HYBRID)
        for number, pattern in KINDS.items():
            if number != HYBRID:
                kind = kind.when(word.rlike(pattern), number)
        return F.struct(kind.otherwise(OTHER).alias("kind"), word.alias("word"))

    return F.transform(words, classified)


def _canonical(s: Column) -> Column:
    return F.array_join(F.concat(F.array(s["genus"]), s["names"]), " ")


def _table(part: int, numbers: list[str]) -> Column:
    """Next states or actions by state and kind, as a literal array."""
    cells = [MOVES[state].get(kind, ("refused", "refuse"))[part] for state in STATES for kind in range(10)]
    return F.array(*[F.lit(numbers.index(cell)) for cell in cells])


def _step(s: Column, t: Column) -> Column:
    """State after one more token."""
    place = s["state"] * 10 + t["kind"] + 1
    state, action = (F.element_at(_table(part, names), place) for part, names in ((0, STATES), (1, ACTIONS)))
    bound = F.struct(s.alias("s"), t["word"].alias("word"), state.alias("state"), action.alias("action"))
    return F.transform(F.array(bound), _moved)[0]  # a name for what has been looked up


def _moved(move: Column) -> Column:
    s, word, action = move["s"], move["word"], move["action"]
    none, nothing = F.array().cast("array<string>"), F.lit(None).cast("string")
    is_ = lambda *names: action.isin(*[ACTIONS.index(n) for n in names])
    bad = (
        is_("refuse")
        | (is_("same genus") & ~s["first_genus"].startswith(F.substring(word, 1, 1)))
        | (is_("third epithet") & (F.size(s["names"]) != 1))
    )
    held = F.array(s["held"])
    changes: dict[str, list[tuple[Column, Column]]] = {
        "state": [(bad, F.lit(STATES.index("refused"))), (F.lit(True), move["state"])],
        "genus": [(is_("genus", "parent of genera"), word), (is_("same genus", "epithet of parent"), s["first_genus"])],
        "first_genus": [(is_("genus") & s["first_genus"].isNull(), word)],
        "subgenus": [(is_("subgenus"), word), (is_("epithet of subgenus"), F.translate(s["held"], "()", ""))],
        "names": [
            (is_("epithet", "crossed epithet", "epithet of subgenus", "epithet of rank", "third epithet"), F.array_append(s["names"], word)),
            (is_("epithet of parent"), F.array(word)),
            (is_("parent"), none),
        ],
        "ranks": [(is_("epithet of rank"), F.concat(s["ranks"], held)), (is_("parent"), none)],
        "author": [
            (is_("author"), F.array_append(s["author"], word)),
            (is_("author held"), F.concat(s["author"], held, F.array(word))),
            (is_("author held, hold"), F.concat(s["author"], held)),
            (is_("epithet of rank", "parent", "parent of genera"), none),
        ],
        "held": [(is_("hold", "author held, hold"), word), (is_("author held", "epithet of rank", "epithet of subgenus", "parent"), nothing)],
        "parents": [(is_("parent", "parent of genera"), F.array_append(s["parents"], _canonical(s)))],
        "crossed": [(is_("cross", "crossed epithet"), F.lit(True))],
        "refused": [(bad, word)],
    }

    def field(name: str, kind: str) -> Column:
        value = F
        for condition, new in changes[name]:
            value = value.when(condition, new.cast(kind))
        return value.otherwise(s[name]).alias(name)

    return F.struct(*[field(*f) for f in _FIELDS.items()])


def parse_name(c: Column | str) -> Column:
    """Struct of a name: ``canonical``, ``authorship`` (of the last part), ``genus``, ``subgenus``, ``epithets``, ``ranks``
    (marks, in order), ``hybrid`` (``named`` or ``formula``) and ``refused``, the token where reading stopped.

    A refused name has the token only; a null name is null.
    """
    c = _col(c)
    empty = F.array().cast("array<string>")
    none = F.lit(None).cast("string")
    start = F.struct(
        F.lit(STATES.index("start")).alias("state"), none.alias("genus"), none.alias("subgenus"), empty.alias("names"), empty.alias("ranks"),
        empty.alias("author"), none.alias("held"), empty.alias("parents"), none.alias("first_genus"), F.lit(False).alias("crossed"),
        none.alias("refused"),
    ).cast(_STATE)

    def finish(s: Column) -> Column:
        open_ = s["state"].isin(*[STATES.index(x) for x in OPEN])
        refused = F.coalesce(s["refused"], F.when(open_, F.coalesce(s["held"], F.lit("end of name"))))
        author = F.concat(s["author"], F.when(s["held"].isNotNull(), F.array(s["held"])).otherwise(F.array().cast("array<string>")))
        formula = F.size(s["parents"]) > 0
        canonical = F.array_join(F.array_append(s["parents"], _canonical(s)), " × ")
        known = lambda value: F.when(refused.isNull(), value)
        return F.struct(
            known(canonical).alias("canonical"),
            known(F.nullif(F.array_join(author, " "), F.lit(""))).alias("authorship"),
            known(F.coalesce(s["first_genus"], s["genus"])).alias("genus"),
            known(s["subgenus"]).alias("subgenus"),
            known(F.when(~formula, s["names"])).alias("epithets"),
            known(F.when(~formula, s["ranks"])).alias("ranks"),
            known(F.when(formula, "formula").when(s["crossed"], "named")).alias("hybrid"),
            refused.alias("refused"),
        )

    return F.when(c.isNotNull(), F.aggregate(_tokens(c), start, _step, finish))


def refused_rule(name: str = "scientificName", key: str = "taxonID") -> RowRule:
    """Names that the grammar refuses, with the token."""
    refused = parse_name(name)["refused"]
    return "name_refused", refused.isNotNull(), F.col(key), refused


def refused_names(df: DataFrame, name: str = "scientificName", key: str = "taxonID") -> DataFrame:
    return row_rules(df, [refused_rule(name, key)])
