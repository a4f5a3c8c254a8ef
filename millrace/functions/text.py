"""String and array expressions with Python's meaning of white space, falsiness and counting."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python splits and strips at, as characters and as a class; Java's own class is narrower. Characters below 256 stand one by one, which Java looks up in a table.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
SPACE = r"[\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: What ends a line in Python.
LINE_ENDS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
REFUSALS = ("i can't", "i cannot", "i'm unable", "as an ai", "无法", "不能", "抱歉")


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def strip_left(text: Column) -> Column:
    return F.ltrim(text, F.lit(BLANKS))


def safe(value: Column) -> Column:
    """Stripped string; null is empty."""
    return F.coalesce(strip(value.cast("string")), F.lit(""))


def _replaced(text: Column, characters: str, by: str) -> Column:
    """Each of the characters replaced, in one pass: a class of them in a pattern takes several times as long."""
    others = characters.replace(by, "")
    return F.translate(text, others, by * len(others))


def split(text: Column) -> Column:
    """Words between white space, without empty ones."""
    return F.filter(F.split(_replaced(text, BLANKS, " "), " "), lambda w: w != "")


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor empty (white space counts as filled)."""
    return F.coalesce(*[let(v, lambda x: F.when(x != "", x)) for v in values])


def normal(text: Column) -> Column:
    return F.array_join(split(F.lower(text)), " ")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value worked out once; a lambda inside body would work it out for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ngrams(words: Column, n: int) -> Column:
    """The n-grams in order, joined by spaces; empty when there are fewer than n words."""

    def grams(w: Column) -> Column:
        # single elements, as slice() copies the whole array each time
        found = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]))
        return F.when(F.size(w) >= n, found).otherwise(F.array().cast("array<string>"))

    return let(words, grams)


def distinct_ngram_share(words: Column, n: int) -> Column:
    """Distinct n-grams to n-grams; null when there are none."""
    return let(ngrams(words, n), lambda g: F.try_divide(F.size(F.array_distinct(g)).cast("double"), F.size(g).cast("double")))


def count_of(text: Column, part: str) -> Column:
    """How often part occurs, not overlapping."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def refuses(text: Column) -> Column:
    return let(F.lower(text), lambda low: reduce(or_, [low.contains(marker) for marker in REFUSALS]))


def last(values: Column) -> Column:
    return F.try_element_at(values, F.lit(-1))


def tail_lines(text: Column) -> Column:
    """Stripped lines that are not blank."""
    return F.filter(F.transform(F.split(_replaced(text, LINE_ENDS, "\n"), "\n"), strip), lambda x: x != "")


def encoded(text: Column) -> Column:
    """Base64 of the text's UTF-8 bytes, without line breaks."""
    return F.replace(F.base64(text.cast("binary")), F.lit("\r\n"), F.lit(""))


def last_part(path: Column) -> Column:
    """What follows the last slash of a name such as owner/model."""
    return F.element_at(F.split(path, "/"), -1)
