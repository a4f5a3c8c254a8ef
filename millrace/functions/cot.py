"""Cleaning of chain-of-thought answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import text as t

PREFIX, PHRASE = "A: Let's think step by step.", "Let's think step by step."
LABELS = ("Reasoning:", "Answer:", "Final Answer:", "Final answer:", "Output:")


def has_cjk(text: Column) -> Column:
    return text.rlike("[\u4e00-\u9fff]")


def choice_letter(text: Column) -> Column:
    """The first (A) to (J), else a lone letter in the last word."""
    word = t.last(t.split(text))
    pick = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    return F.coalesce(pick(text, r"\(([A-J])\)"), pick(word, r"(?U)\b([A-J])\b"))


def forced_choice(answer: Column) -> Column:
    own = t.safe(answer)
    return F.when(own.rlike(r"\A[A-Ja-j]\z"), F.upper(own))


def clean(text: Column, forced: Column) -> Column:
    """One paragraph with the required beginning and end; null text is empty, Chinese characters give null."""
    out = t.strip(F.replace(t.strip(text), F.lit("```"), F.lit("")))
    for label in LABELS:
        out = t.let(out, _without(label))
    done = t.let(F.array_join(t.tail_lines(out), " "), lambda flat: F.when(~has_cjk(flat), t.let(_prefixed(flat), lambda whole: _ended(whole, forced))))
    return F.when(text.isNull(), F.lit("")).otherwise(done)


def _without(label: str) -> Callable[[Column], Column]:
    return lambda text: F.when(text.startswith(label), t.strip_left(F.substr(text, F.lit(len(label) + 1)))).otherwise(text)


def _prefixed(flat: Column) -> Column:
    after = lambda at: t.strip_left(F.substr(flat, at + len(PHRASE)))
    at = F.locate(PHRASE, flat)
    return F.when(flat.startswith(PREFIX), flat).when(at > 0, F.concat(F.lit(PREFIX + " "), after(at))).otherwise(F.concat(F.lit(PREFIX + " "), flat))


def _ended(whole: Column, forced: Column) -> Column:
    bare = whole
    for beginning, ending in (("The answer is", r"@\([A-J]\)\.?"), ("Answer", r"@:@\(?[A-J]\)?\.?")):
        pattern = rf"{t.SPACE}*{beginning}{ending.replace('@', t.SPACE + '*')}{t.SPACE}*\z"
        bare = t.let(bare, _cut(beginning, pattern))
    return F.concat(bare, F.lit(" The answer is ("), F.coalesce(forced, choice_letter(whole), F.lit("A")), F.lit(")."))


def _cut(beginning: str, pattern: str) -> Callable[[Column], Column]:
    """Without what the pattern finds; it isn't tried where its beginning is absent."""
    return lambda text: t.strip(F.when(text.contains(beginning), F.regexp_replace(text, pattern, "")).otherwise(text))


def is_error(text: Column) -> Column:
    own = t.safe(text)
    return (own == "") | own.startswith("__ERROR__")
