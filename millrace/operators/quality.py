"""Reports: sanity of a unified table, and format compliance of model outputs."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as t
from millrace.sources.sinks import write_json

REQUIRED = ("id", "source", "domain", "language", "prompt", "solution", "assistant", "messages", "verifiable", "difficulty")
BLANKS = ("id", "prompt", "solution", "assistant", "messages")
THINK_ANSWER = rf"(?sd)\A<think>{t.SPACE}*.*?{t.SPACE}*</think>{t.SPACE}*<answer>{t.SPACE}*.*?{t.SPACE}*</answer>{t.SPACE}*\n?\z"
EVAL_STRICT = rf"(?sd)\A<think>{t.SPACE}*\n.*?\n{t.SPACE}*</think>{t.SPACE}*\n<answer>{t.SPACE}*\n(.*?)\n{t.SPACE}*</answer>{t.SPACE}*\n?\z"


def messages_valid(messages: Column) -> Column:
    says = lambda role: F.exists(messages, lambda m: (t.safe(m["role"]) == role) & (t.safe(m["content"]) != ""))
    return F.coalesce((F.size(messages) >= 2) & says("user") & says("assistant"), F.lit(False))


def blank(df: DataFrame, name: str) -> Column:
    """Whether a column is missing, null, white space or an empty list."""
    if name not in df.columns:
        return F.lit(True)
    kind = df.schema[name].dataType.typeName()
    return F.coalesce(F.size(name) == 0, F.lit(True)) if kind in ("array", "map") else t.safe(F.col(name)) == ""


def with_valid_ids(df: DataFrame, name: str = "id") -> DataFrame:
    """Rows whose id isn't blank; none left is an error."""
    kept = df.filter(~blank(df, name))
    if kept.isEmpty():
        raise ValueError("no row has an id")
    return kept


def sanity(df: DataFrame) -> DataFrame:
    """One row of counts, ratios and mean lengths; columns that are missing count as blank throughout."""
    text = lambda c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    rows = F.count(F.lit(1))
    share = lambda cond: F.coalesce(F.try_divide(F.count_if(cond).cast("double"), rows.cast("double")), F.lit(0.0))
    blanks = [F.count_if(blank(df, c)).alias(f"empty_{c}") for c in BLANKS]
    messages = messages_valid(F.col("messages")) if "messages" in df.columns else F.lit(False)
    verifiable = F.coalesce(F.col("verifiable"), F.lit(False)) if "verifiable" in df.columns else F.lit(False)
    means = [F.coalesce(F.avg(F.coalesce(F.length(text(c)), F.lit(0)).cast("double")), F.lit(0.0)).alias(f"mean_{c}_chars") for c in ("prompt", "solution", "assistant")]
    return df.agg(
        rows.alias("inspected"), *blanks, share(F.coalesce(text("assistant").rlike(THINK_ANSWER), F.lit(False))).alias("format_valid_ratio"),
        share(messages).alias("messages_valid_ratio"), share(verifiable).alias("verifiable_ratio"), *means,
    )


def group_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows of each value; null counts as empty."""
    return df.groupBy(F.coalesce(column, F.lit("")).alias(column)).agg(F.count("*").alias("n"))


def warnings(report: dict[str, Any], columns: list[str]) -> list[str]:
    """Which of the five rules a sanity row breaks."""
    n = max(1, report["inspected"])
    empty = max(report[f"empty_{c}"] for c in BLANKS) / n
    rules = [
        (f"missing columns: {sorted(set(REQUIRED) - set(columns))}", bool(set(REQUIRED) - set(columns))), ("empty ratio above 0.01", empty > 0.01), ("format valid ratio below 0.95", report["format_valid_ratio"] < 0.95),
        ("messages valid ratio below 0.99", report["messages_valid_ratio"] < 0.99), ("verifiable ratio below 0.5", report["verifiable_ratio"] < 0.5),
    ]
    return [text for text, broken in rules if broken]


def write_report(df: DataFrame, path: str) -> dict[str, Any]:
    """sanity() and its warnings as a JSON file."""
    report = sanity(df).first().asDict()
    report["warnings"] = warnings(report, df.columns)
    write_json(report, path)
    return report


def _strict(own: Column) -> Column:
    """Whether stripped text keeps the format; both ends are looked at first, as the pattern reads the whole text."""
    return own.startswith("<think>") & own.endswith("</answer>") & own.rlike(EVAL_STRICT)


def _tags(text: Column) -> Column:
    tags = F.lit(0)
    for tag in ("<think>", "</think>", "<answer>", "</answer>"):
        tags = tags + F.when(t.count_of(text, tag) == 1, 1).otherwise(0)
    return tags


def analyze(text: Column) -> dict[str, Column]:
    """What a format report says of an output."""
    own = t.strip(text)
    strict = _strict(own)
    answer = t.strip(F.when(strict, F.regexp_extract(own, EVAL_STRICT, 1)).otherwise(own))
    tags = _tags(text)
    return {"strict_format_ok": strict, "tag_complete_ok": tags == 4, "tag_score": tags, "answer_chars": F.length(answer), "empty_answer": answer == "", "refusal_like": t.refuses(answer)}


def format_report(df: DataFrame, text: str) -> DataFrame:
    """One row: rates, and mean and median length of the answers; zeros on no rows."""
    rows = df.select(*[c.alias(n) for n, c in analyze(F.col(text)).items()])
    rate = lambda c: F.coalesce(F.avg(F.col(c).cast("double")), F.lit(0.0)).alias(f"{c}_rate")
    lengths = [F.coalesce(f(F.col("answer_chars").cast("double")), F.lit(0.0)).alias(n) for f, n in ((F.avg, "mean_chars"), (F.median, "median_chars"))]
    return rows.agg(F.count("*").alias("n"), *map(rate, ("strict_format_ok", "tag_complete_ok", "empty_answer", "refusal_like")), *lengths)


def failures(df: DataFrame, text: str) -> DataFrame:
    """Rows that break the format, are empty or refuse: what costs least is asked first, and the answer is read only where the format is kept."""
    own = t.strip(F.col(text))
    said = t.strip(F.regexp_extract(own, EVAL_STRICT, 1))
    return df.filter(~_strict(own) | (_tags(F.col(text)) != 4) | t.let(said, lambda answer: (answer == "") | t.refuses(answer)))
