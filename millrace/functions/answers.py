"""Mathematical answers: finding them in text, and whether two say the same.

An answer is read into a normal form: numbers become exact fractions (decimals, percentages, thousands
separators, fractions, roots of squares, sums, products and powers of numbers), tuples and intervals keep
their order and brackets, sets and bare lists lose their order, `x = 3` is its right side. What holds a
symbol stays text without spaces. Two answers are equal when their normal forms are.
"""

from __future__ import annotations

import math
import re
from fractions import Fraction
from functools import lru_cache

_DROPPED = re.compile(r"\\(?:left|right|displaystyle|quad|qquad|limits)(?![a-zA-Z])|\\[,;:! ]|[$\s~]")
_WRAPPED = re.compile(r"\\(?:text|textbf|mathrm|mathbf|operatorname|mbox)\{([^{}]*)\}")
_THOUSANDS = re.compile(r"(?<![\d.,])\d{1,3}(?:,\d{3})+(?![\d,])")
_NAMED = {r"\dfrac": r"\frac", r"\tfrac": r"\frac", r"\cdot": "*", r"\times": "*", r"\div": "/", "−": "-", "×": "*", "÷": "/", "π": r"\pi", r"\lbrace": r"\{", r"\rbrace": r"\}"}
_UNIT = re.compile(r"(?:\^\{?\\circ\}?|°|\\degree)$")
_PAIRS = {"(": ")", "[": "]"}


def final_answer(text: str) -> str | None:
    """The last boxed expression, with nested braces; else the last formula between dollars; else null."""
    at = text.rfind("\\boxed{")
    if at >= 0:
        depth = 0
        for i in range(at + 6, len(text)):
            depth += (text[i] == "{") - (text[i] == "}")
            if depth == 0:
                return text[at + 7 : i]
    found = re.findall(r"\$([^$]+)\$|\\\((.+?)\\\)|\\\[(.+?)\\\]", text, re.DOTALL)
    return next((x for x in found[-1] if x), None) if found else None


class _Reader:
    """Sums, products, powers, fractions and square roots of numbers; anything else raises ValueError."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def whole(self) -> Fraction:
        value = self.sum()
        if self.at < len(self.text):
            raise ValueError
        return value

    def taken(self, *signs: str) -> str:
        for sign in signs:
            if self.text.startswith(sign, self.at):
                self.at += len(sign)
                return sign
        return ""

    def sum(self) -> Fraction:
        value = self.product()
        while sign := self.taken("+", "-"):
            value = value + self.product() if sign == "+" else value - self.product()
        return value

    def product(self) -> Fraction:
        value = self.power()
        while True:
            sign = self.taken("*", "/")
            if sign == "/":
                value /= self.power()
            elif sign or self.text.startswith(("(", r"\frac", r"\sqrt"), self.at):
                value *= self.power()
            else:
                return value

    def power(self) -> Fraction:
        if sign := self.taken("-", "+"):
            value = self.power()
            return -value if sign == "-" else value
        value = self.atom()
        if self.taken("^"):
            power = self.group() if self.text.startswith("{", self.at) else self.power()
            if power.denominator != 1 or abs(power) > 256 or abs(value.numerator) > 10**12 or value.denominator > 10**12:
                raise ValueError
            value **= int(power)
        return value

    def group(self, close: str = "}") -> Fraction:
        self.at += 1
        value = self.sum()
        if not self.taken(close):
            raise ValueError
        return value

    def atom(self) -> Fraction:
        if self.text.startswith("(", self.at):
            return self.group(")")
        if self.text.startswith("{", self.at):
            return self.group()
        if self.taken(r"\frac"):
            return self.argument() / self.argument()
        if self.taken(r"\sqrt"):
            value = self.argument()
            roots = [math.isqrt(x) for x in (max(0, value.numerator), value.denominator)]
            if value < 0 or Fraction(roots[0] ** 2, roots[1] ** 2) != value:
                raise ValueError
            return Fraction(*roots)
        number = re.compile(r"\d+(?:\.\d*)?|\.\d+").match(self.text, self.at)
        if not number:
            raise ValueError
        self.at = number.end()
        return Fraction(number.group().rstrip("."))

    def argument(self) -> Fraction:
        """The argument of a command: a group, or one digit."""
        if self.text.startswith("{", self.at):
            return self.group()
        self.at += 1
        return Fraction(self.text[self.at - 1 : self.at] or "x")


def _parts(text: str) -> list[str]:
    """The text between commas that stand in no bracket."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c in "([{") - (c in ")]}")
        if c == "," and depth == 0:
            out.append(text[start:i])
            start = i + 1
    return [*out, text[start:]]


def _encloses(text: str) -> bool:
    """Whether the first bracket closes at the end."""
    depth = 0
    for i, c in enumerate(text):
        depth += (c in "([{") - (c in ")]}")
        if depth == 0:
            return i == len(text) - 1
    return False


@lru_cache(maxsize=4096)
def normal_form(answer: str):
    """A hashable normal form; null for an empty answer."""
    text = answer
    for name, plain in _NAMED.items():
        text = re.sub(re.escape(name) + (r"(?![a-zA-Z])" if name.startswith("\\") and not plain.startswith("\\{") else ""), lambda _, p=plain: p, text)
    text = _WRAPPED.sub(r"\1", text)
    text = _UNIT.sub("", _DROPPED.sub("", text).rstrip("."))
    return _form(_THOUSANDS.sub(lambda m: m.group().replace(",", ""), text) if _THOUSANDS.fullmatch(text.lstrip("+-")) else text) if text else None


def _form(text: str):
    equal = re.fullmatch(r"[A-Za-z]\w*(?:\([a-z]\))?=([^=<>]+)", text)
    if equal:
        return _form(equal.group(1))
    percent = re.fullmatch(r"(.+?)\\?%", text)
    if percent:
        inner = _form(percent.group(1))
        return inner / 100 if isinstance(inner, Fraction) else text
    if text.startswith(r"\{") and text.endswith(r"\}"):
        return ("set", frozenset(_form(p) for p in _parts(text[2:-2])))
    parts = _parts(text)
    if len(parts) > 1:
        return ("set", frozenset(map(_form, parts)))
    if text[:1] in ("(", "[") and text[-1:] in (")", "]"):
        inner = _parts(text[1:-1])
        if len(inner) > 1:
            return (text[0] + text[-1], *map(_form, inner))
        if _PAIRS[text[0]] == text[-1] and _encloses(text):
            return _form(text[1:-1])
    try:
        return _Reader(text).whole()
    except (ValueError, ZeroDivisionError, OverflowError, RecursionError):
        return text


def equal(a: str, b: str) -> bool:
    return normal_form(a) == normal_form(b)
