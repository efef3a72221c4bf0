"""Column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.catalog.registry import query, table
from taxaloom.functions import grammar, names, text
from taxaloom.sources.issues import parse_issues


@query(
    r"""
    SELECT page_id,
           nullif(replace(replace(replace(replace(
             regexp_replace(html, '(?s)<!--.*?-->|</?[A-Za-z!][^>]*>', '', 'g'),
             '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), 'NA') AS page_text
    FROM pages
    """
)
def unescape_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.unescape_html("html").alias("page_text"))


@query(
    r"""
    SELECT doc_id, piece FROM (
      SELECT doc_id, trim(regexp_replace(unnest(string_split(text, chr(10))), '\s+', ' ', 'g')) AS piece
      FROM documents) WHERE piece <> ''
    """
)
def explode_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.explode(text.split_multivalue("text", "\n")).alias("piece"))


@query(
    r"""
    SELECT page_id,
           split_part(url, '?', 1) AS address,
           regexp_replace(CASE WHEN instr(url, '?') > 0 THEN substr(url, instr(url, '?') + 1) END, '(&ref=x|#top)$', '')
             AS parameters,
           regexp_replace(url, '^http://', '') AS bare_url,
           'https://archive.example' || '/' || url AS archive_url
    FROM pages
    """
)
def split_first_url(spark, sf_dir):
    address, parameters = text.split_first("url", r"\?")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        address.alias("address"),
        text.strip_suffix(parameters, r"&ref=x|#top").alias("parameters"),
        text.strip_prefix("url", "http://").alias("bare_url"),
        text.prefix_url(F.concat(F.lit("/"), "url"), "https://archive.example").alias("archive_url"),
    )


@query(
    r"""
    SELECT c_custkey, code, CAST(regexp_extract(code, '(\d{3})\.', 1) AS DOUBLE) AS major,
           CAST(regexp_extract(code, '\.(\d+)', 1) AS DOUBLE) AS minor,
           CASE WHEN length(key_text) < 2 THEN lpad(key_text, 2, '0') ELSE key_text END AS padded
    FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS key_text,
                 lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || '.' || regexp_extract(c_name, '\d+') AS code
          FROM customer)
    """
)
def code_parts(spark, sf_dir):
    code = F.concat(
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0"), F.lit("."), F.regexp_extract("c_name", r"\d+", 0)
    )
    coded = table(spark, sf_dir, "customer").select("c_custkey", code.alias("code"))
    major, minor = text.code_parts("code")
    return coded.select(
        "c_custkey",
        "code",
        major.alias("major"),
        minor.alias("minor"),
        text.pad_left(F.col("c_custkey").cast("string")).alias("padded"),
    )


@query(
    """
    SELECT p_partkey, split_part(full_text, ' ', 1) AS genus,
           CASE WHEN length(split_part(full_text, ' ', 2)) = 1 THEN split_part(full_text, ' ', 3)
                ELSE split_part(full_text, ' ', 2) END AS epithet,
           split_part(full_text, ' ', 2) AS second, nullif(split_part(full_text, ' ', 4), '') AS fourth,
           length(full_text) - length(replace(full_text, ' ', '')) AS n_spaces
    FROM (SELECT p_partkey,
                 CASE p_type WHEN 'PROMO' THEN replace(p_name, ' ', ' x ') ELSE p_name END || ' ' || p_type AS full_text
          FROM part)
    """
)
def token_names(spark, sf_dir):
    hybrid = F.when(F.col("p_type") == "PROMO", F.replace("p_name", F.lit(" "), F.lit(" x "))).otherwise(F.col("p_name"))
    parts = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", hybrid, "p_type").alias("full_text"))
    _, second, _, fourth = text.split_fixed("full_text", 4)
    return parts.select(
        "p_partkey",
        text.first_token("full_text").alias("genus"),
        text.epithet_token("full_text").alias("epithet"),
        second.alias("second"),
        fourth.alias("fourth"),
        text.count_matches("full_text", " ").cast("long").alias("n_spaces"),
    )


@query(
    """
    SELECT doc_id, trim(regexp_extract_all(text, ' the | of | and ')[-1]) AS marker FROM documents
    """
)
def last_marker(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.last_match("text", " the | of | and ").alias("marker"))


SUFFIXES = [("tion", "noun"), ("ent", "adverb"), ("ing", "gerund"), ("en", "plural"), ("on", "particle")]


@query(
    r"""
    WITH words AS (
      SELECT DISTINCT unnest(string_split_regex(text, '[^\p{L}]+')) AS word FROM documents)
    SELECT word,
           CASE WHEN word LIKE '%tion' THEN 'noun' WHEN word LIKE '%ent' THEN 'adverb'
                WHEN word LIKE '%ing' THEN 'gerund' WHEN word LIKE '%en' THEN 'plural'
                WHEN word LIKE '%on' THEN 'particle'
                WHEN regexp_matches(word, '^[A-Z][a-z]') THEN 'genus' END AS word_rank
    FROM words WHERE word <> ''
    """
)
def rank_from_suffix(spark, sf_dir):
    words = (
        table(spark, sf_dir, "documents")
        .select(F.explode(F.split("text", r"[^\p{L}]+")).alias("word"))
        .filter("word <> ''")
        .distinct()
    )
    rank = names.rank_rules("word", "word", F.lit(0), F.lit(None).cast("string"), SUFFIXES)
    return words.select("word", rank.alias("word_rank"))


@query(
    r"""
    SELECT p_partkey, md5(concat_ws(chr(31), p_name, p_brand, CAST(nullif(p_size, 7) AS VARCHAR))) AS with_gap,
           md5(concat_ws(chr(31), CAST(p_partkey AS VARCHAR), p_name,
                         coalesce(CAST(nullif(p_size, 7) AS VARCHAR), '\N'))) AS part_id
    FROM part
    """
)
def content_key(spark, sf_dir):
    size = F.nullif("p_size", F.lit(7))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.md5(F.concat_ws("\x1f", "p_name", "p_brand", size.cast("string"))).alias("with_gap"),
        text.content_key("p_partkey", "p_name", size).alias("part_id"),
    )


@query(
    r"""
    SELECT doc_id,
           regexp_replace(regexp_replace(text, '([A-Z])\.\s+([A-Z])', '\1.\2', 'g'),
                          '([A-Z])\.\s+([A-Z])', '\1.\2', 'g') AS normalised
    FROM documents
    """
)
def initials(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", names.normalise_initials("text").alias("normalised"))


@query(
    r"""
    SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS squished, regexp_extract_all(text, ' le | la ')[1] AS article
    FROM documents
    """
)
def squish_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.squish("text").alias("squished"),
        text.match_group("text", " le | la ", 0).alias("article"),
    )


@query(
    """
    SELECT page_id AS number, '[PASSED] page ' || page_id AS title, 'https://github.com/example/' || page_id AS url,
           '2024-01-01' AS created_at, 'user' || page_id AS "user", 'open' AS state,
           regexp_extract(html, '<title>(.*?)</title>', 1) AS name, 'genus' AS rank,
           CAST(length(html) AS VARCHAR) AS no_species, url AS description
    FROM pages WHERE instr(url, 'ref=') = 0
    """
)
def issue_fields(spark, sf_dir):
    body = F.concat(
        F.lit("### Name of taxon\r\n\r\n"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1),
        F.lit("\r\n\r\n### Rank of taxon\r\n\r\ngenus\r\n\r\n### number of species affected\r\n\r\n"),
        F.length("html"),
        F.lit("\r\n\r\n### Description of change\r\n\r\n"),
        F.col("url"),
        F.lit("\r\nmore"),
    )
    records = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("number"),
        F.concat(F.lit("[PASSED] page "), "page_id").alias("title"),
        F.concat(F.lit("https://api.github.com/repos/example/"), "page_id").alias("url"),
        F.lit("2024-01-01").alias("created_at"),
        F.struct(F.concat(F.lit("user"), "page_id").alias("login")).alias("user"),
        F.lit("open").alias("state"),
        body.alias("body"),
        F.when(F.col("url").contains("ref="), F.lit(True)).alias("draft"),
    )
    return parse_issues(records)


@query(
    """
    SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS canonical,
           'P. ' || upper(substr(lower(p_type), 1, 1)) || substr(lower(p_type), 2) || ' ex Aut.' AS author,
           '*' || upper(substr(p_name, 1, 1)) || substr(split_part(p_name, ' ', 1), 2) || '* ' || split_part(p_name, ' ', 2)
             || ' P. ' || upper(substr(lower(p_type), 1, 1)) || substr(lower(p_type), 2) || ' ex Aut.' AS italic,
           upper(substr(p_name, 1, 1)) || substr(p_name, 2) || ' ' || split_part(p_name, ' ', 2) AS autonym
    FROM part
    """
)
def canonical_names(spark, sf_dir):
    genus, epithet = F.initcap(text.first_token("p_name")), text.epithet_token("p_name")
    author = F.concat(F.lit("P. "), F.initcap(F.lower("p_type")), F.lit(" ex Aut."))
    named = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat_ws(" ", genus, epithet, author).alias("plain"),
        F.concat_ws(" ", genus, epithet, F.lit("L. f. subsp."), epithet, author).alias("lower"),
    )
    return named.select(
        "p_partkey",
        names.canonical_name("plain").alias("canonical"),
        names.authorship("plain").alias("author"),
        names.italicise_name("plain", F.lit("species")).alias("italic"),
        names.canonical_name("lower").alias("autonym"),
    )


_GRAMMAR_SQL = """
    WITH w AS (
      SELECT p_partkey, p_partkey % 10 AS k, upper(substr(p_name, 1, 1)) || substr(split_part(p_name, ' ', 1), 2) AS g,
             split_part(p_name, ' ', 2) AS e, lower(p_type) AS t, upper(substr(p_type, 1, 1)) || substr(lower(p_type), 2) AS a FROM part)
"""


@query(
    _GRAMMAR_SQL
    + """
    SELECT p_partkey,
           CASE WHEN k IN (0, 2) THEN g || ' ' || e WHEN k = 1 THEN g WHEN k IN (3, 4) THEN g || ' ' || e || ' ' || t
                WHEN k = 5 THEN g || ' ' || e WHEN k = 6 THEN g || ' ' || e || ' × ' || a || ' ' || e || ' ' || t
                WHEN k = 7 THEN g || ' ' || e || ' × ' || g || ' ' || t END AS canonical,
           CASE WHEN k = 0 THEN 'L. f. ex ' || a WHEN k = 1 THEN '(' || a || ') van der Hoek & ' || a WHEN k = 2 THEN a || ' in Aut.'
                WHEN k = 3 THEN 'Hook. f. & ' || a WHEN k = 5 THEN 'Mill.' WHEN k = 7 THEN a END AS authorship,
           CASE WHEN k = 2 THEN a END AS subgenus,
           CASE WHEN k = 5 THEN 'named' WHEN k IN (6, 7) THEN 'formula' END AS hybrid,
           CASE WHEN k = 8 THEN t WHEN k = 9 THEN 'subsp.' END AS refused
    FROM w
    """
)
def names_grammar(spark, sf_dir):
    """Names of ten shapes made from the parts, two of which can't be read."""
    genus, epithet = F.initcap(text.first_token("p_name")), text.epithet_token("p_name")
    kind, author = F.lower("p_type"), F.initcap(F.lower("p_type"))
    shapes = [
        F.concat_ws(" ", genus, epithet, F.lit("L. f. ex"), author),
        F.concat_ws(" ", genus, F.concat(F.lit("("), author, F.lit(")")), F.lit("van der Hoek &"), author),
        F.concat_ws(" ", genus, F.concat(F.lit("("), author, F.lit(")")), epithet, author, F.lit("in Aut.")),
        F.concat_ws(" ", genus, epithet, F.lit("L. subsp."), kind, F.lit("Hook. f. &"), author),
        F.concat_ws(" ", genus, epithet, kind),
        F.concat_ws(" ", F.concat(F.lit("×"), genus), F.lit("x"), epithet, F.lit("Mill.")),
        F.concat_ws(" ", genus, epithet, F.lit("L. ×"), author, epithet, F.lit("var."), kind),
        F.concat_ws(" ", genus, epithet, F.lit("×"), F.concat(F.substring(genus, 1, 1), F.lit(".")), kind, author),
        F.concat_ws(" ", genus, epithet, kind, kind),
        F.concat_ws(" ", genus, epithet, author, F.lit("subsp.")),
    ]
    name = F.element_at(F.array(*shapes), (F.col("p_partkey") % 10 + 1).cast("int"))
    parsed = table(spark, sf_dir, "part").select("p_partkey", grammar.parse_name(name).alias("p"))
    return parsed.select("p_partkey", "p.canonical", "p.authorship", "p.subgenus", "p.hybrid", "p.refused")


@query(
    _GRAMMAR_SQL
    + """
    SELECT 'name_refused' AS rule, CAST(p_partkey AS VARCHAR) AS key, CASE WHEN k = 8 THEN t ELSE 'subsp.' END AS detail FROM w WHERE k > 7
    """
)
def names_refused(spark, sf_dir):
    """The names that the grammar can't read, with the token where it stopped."""
    genus, epithet, kind = F.initcap(text.first_token("p_name")), text.epithet_token("p_name"), F.lower("p_type")
    third = F.col("p_partkey") % 10
    tail = F.when(third == 8, F.concat_ws(" ", kind, kind)).when(third == 9, F.lit("Aut. subsp.")).otherwise(F.lit("Aut. f. & Mill."))
    named = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("taxonID"), F.concat_ws(" ", genus, epithet, tail).alias("scientificName")
    )
    return grammar.refused_names(named)


@query(
    r"""
    WITH squished AS (
      SELECT conv_id, turn, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM conversations),
    once AS (
      SELECT conv_id, turn, regexp_replace(text, '(^|[^\p{L}\p{N}_])and($|[^\p{L}\p{N}_])', '\1,\2', 'g') AS text
      FROM squished),
    twice AS (
      SELECT conv_id, turn, regexp_replace(text, '(^|[^\p{L}\p{N}_])and($|[^\p{L}\p{N}_])', '\1,\2', 'g') AS text
      FROM once)
    SELECT conv_id, turn, trim(unnest(string_split(text, ','))) AS name FROM twice
    """
)
def split_longer(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", text.squish("text").alias("text"))
    return turns.select("conv_id", "turn", F.explode(text.split_longer("text")).alias("name"))
