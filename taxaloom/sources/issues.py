"""Issue records with name proposals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.functions import text

ISSUE_SCHEMA = (
    "number long, title string, url string, created_at string, "
    "user struct<login: string>, state string, body string, draft boolean"
)


def issue_fields(df: DataFrame, body: str = "body", fields: dict[str, str] | None = None) -> DataFrame:
    """Labelled values of a free text as columns; the text itself is dropped."""
    fields = fields or vocab.ISSUE_FIELDS
    return df.withColumns({c: text.match_group(body, p) for c, p in fields.items()}).drop(body)


def parse_issues(records: DataFrame) -> DataFrame:
    """Issue records to one flat row each; pull requests (``draft`` set) are dropped."""
    issues = records.filter(F.col("draft").isNull()).select(
        "number",
        "title",
        text.rewrite_url("url").alias("url"),
        "created_at",
        F.col("user.login").alias("user"),
        "state",
        "body",
    )
    return issue_fields(issues)


def read_issues(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Issue dump, one JSON record per line (``multi_line`` for a JSON array)."""
    records = spark.read.schema(ISSUE_SCHEMA).json(path, multiLine=multi_line)
    return parse_issues(records)
