"""Rewards as columns. Each takes the completion's text and what else it needs; null means "skip this row"."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from millrace.functions import text as t
from millrace.functions.answers import equal, final_answer
from millrace.operators.lineage import small
from millrace.streaming import providers

FORMAT = r"(?smd)\A<think>\n.*?\n</think>\n<answer>\n.*?\n</answer>$"
STRICT = rf"(?smd)\A<think>{t.SPACE}*\n.*?\n{t.SPACE}*</think>{t.SPACE}*\n<answer>{t.SPACE}*\n(.*?)\n{t.SPACE}*</answer>{t.SPACE}*$"
TAGS = ("<think>\n", "\n</think>\n", "\n<answer>\n", "\n</answer>")
STEPS = r"(Step \d+:|^\d+\.|\n-|\n\*|First,|Second,|Next,|Finally,)"


def format_reward(text: Column) -> Column:
    return text.rlike(FORMAT).cast("double")


def tag_count(text: Column) -> Column:
    score = F.lit(0.0)
    for tag in TAGS:
        score = score + F.when(t.count_of(text, tag) == 1, 0.25).otherwise(0.0)
    return score


def reasoning_steps(text: Column) -> Column:
    return F.least(F.lit(1.0), F.regexp_count(text, F.lit(STEPS)) / 3)


def gspo_default(text: Column) -> Column:
    """Structure, length of the answer, repetition and refusals, held to [-1, 1]."""
    strict = text.rlike(STRICT)
    answer = t.strip(F.when(strict, F.regexp_extract(text, STRICT, 1)).otherwise(text))
    size, share = F.length(answer), t.distinct_ngram_share(t.split(F.lower(answer)), 3)
    score = F.when(strict, 0.6).otherwise(-0.3) + F.when(size >= 32, 0.25).when(size >= 8, 0.10).otherwise(-0.25)
    score = score + F.when(share < 0.55, -0.20).when(share > 0.80, 0.05).otherwise(0.0) + F.when(t.refuses(answer), -0.30).otherwise(0.0)
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), score))


def repetition_penalty(text: Column, n: int, max_penalty: float, language: str = "en", segment: Callable[[str], list[str]] | None = None) -> Column:
    """(1 - distinct share of n-grams) * max_penalty; 0 for fewer than n words. Chinese needs a word segmenter."""
    if max_penalty > 0:
        raise ValueError(f"max_penalty {max_penalty} should not be positive")
    if language == "en":
        words = t.split(F.lower(text))
    elif language == "zh":
        if segment is None:
            raise ValueError("a word segmenter is needed for Chinese")
        words = F.udf(lambda s: list(segment(s or "")), "array<string>", useArrow=True)(text)
    else:
        raise ValueError(f"Word splitting for language `{language}` is not yet implemented.")
    return F.coalesce((1 - t.distinct_ngram_share(words, n)) * max_penalty, F.lit(0.0))



def cosine(text: Column, correct: Column, min_wrong: float = -1.0, max_wrong: float = -0.5, min_right: float = 0.5, max_right: float = 1.0, max_len: int = 1000) -> Column:
    """A cosine over the length; progress isn't held to 1. Null correctness (unparseable gold) gives 1.0."""
    wave = F.cos(F.length(text) * (math.pi / max_len))
    scaled = lambda lo, hi: F.lit(lo) + F.lit(0.5 * (hi - lo)) * (1 + wave)
    return F.when(correct.isNull(), 1.0).when(correct, scaled(min_right, max_right)).otherwise(scaled(max_wrong, min_wrong))


def length(text: Column, correct: Column, group: WindowSpec) -> Column:
    """0.5 less the place between the group's shortest and longest; at most 0 when wrong. A window brings all of a group, texts too, to one task: see length_by."""
    size = F.length(text)
    return _by_length(size, F.min(size).over(group), F.max(size).over(group), correct)


def length_by(rows: DataFrame, text: str, correct: Column, by: list[str], name: str = "reward") -> DataFrame:
    """rows with the length reward within groups of equal `by`, null being a value like others; the groups' bounds are joined, so rows stay in their tasks where bounds can be broadcast."""
    size = F.length(text)
    own = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    group = F.struct(*[F.col(f"`{c}`") for c in by])
    bounds = rows.select(group.alias("group"), size.alias("size")).groupBy("group").agg(F.min("size").alias("lo"), F.max("size").alias("hi"))
    marked = rows.select(own.alias("own"), group.alias("group"), size.alias("size"), correct.alias("correct")).join(small(bounds, 200), "group")
    kept = [F.col("own").getField(c).alias(c) for c in rows.columns if c != name]
    return marked.select(*kept, _by_length(F.col("size"), F.col("lo"), F.col("hi"), F.col("correct")).alias(name))


def _by_length(size: Column, lo: Column, hi: Column, correct: Column) -> Column:
    place = F.lit(0.5) - (size - lo) / (hi - lo)
    return F.when(correct.isNull(), 1.0).when(hi == lo, 0.0).when(correct, place).otherwise(F.least(F.lit(0.0), place))


def soft_overlong(ids: Column, max_len: int = 16384, cache: int = 4096) -> Column:
    n = F.size(ids)
    return F.when(n <= max_len - cache, 0.0).when(n <= max_len, (max_len - cache - n) / cache).otherwise(-1.0)


def code_format(text: Column, language: Column) -> Column:
    pattern = F.concat(F.lit(r"(?smd)\A<think>\n.*?\n</think>\n<answer>\n.*?```"), language, F.lit(r".*?```.*?\n</answer>$"))
    return F.rlike(text, pattern).cast("double")


def extract_code(text: Column, language: str | None = "python") -> Column:
    """The last fenced block of the language; empty when there is none."""
    if language is None:
        return F.lit("")
    return F.coalesce(t.last(F.regexp_extract_all(text, F.lit(rf"(?sd)```{language}\n(.*?)```"), F.lit(1))), F.lit(""))


def output_matches(actual: Column, expected: Column) -> Column:
    """Stripped lines agree as far as both go: surplus lines of either are ignored."""
    a, b = (F.split(t.strip(x), "\n") for x in (actual, expected))
    same = F.zip_with(a, b, lambda x, y: x.isNull() | y.isNull() | (t.strip(x) == t.strip(y)))
    return F.forall(same, lambda x: x)


def binary_code(score: Column) -> Column:
    return F.when(score.isNull(), F.lit(None).cast("double")).when(score > 0.99, 1.0).otherwise(0.0)


def combine(rewards: dict[str, Column], weights: dict[str, float]) -> Column:
    """Weighted sum; a skipped reward counts as 0."""
    total = F.lit(0.0)
    for name, reward in rewards.items():
        total = total + F.lit(weights.get(name, 1.0)) * F.coalesce(reward, F.lit(0.0))
    return total


@F.pandas_udf(DoubleType())
def accuracy(text: pd.Series, gold: pd.Series) -> pd.Series:
    """1 or 0 as the answer equals the gold one; null when the gold one holds no formula."""

    def one(said: str | None, want: str | None) -> float | None:
        wanted = final_answer(want) if want else None
        if wanted is None:
            return None
        found = final_answer(said) if said else None
        return float(found is not None and equal(found, wanted))

    return pd.Series([one(a, b) for a, b in zip(text, gold)], dtype="Float64")


def passed_share(outputs: Column, expected: Column) -> Column:
    """Share of the tests whose output matches; an output of null failed. Null for no tests, or where nothing was run."""
    fits = lambda got, want: F.coalesce(output_matches(got, want), F.lit(False))
    right = F.size(F.filter(F.zip_with(outputs, expected, fits), lambda ok: ok))
    return F.when(outputs.isNotNull(), F.try_divide(right.cast("double"), F.size(expected).cast("double")))


def code(text: Column, tests: Column, language: str = "python", provider: str = "literal") -> Column:
    """Share of the tests, array<struct<input, output>>, that the text's code passes; null where the provider failed or there are no tests."""
    outputs = providers.run(extract_code(text, language), F.transform(tests, lambda x: x["input"]), F.lit(language), provider)
    return passed_share(outputs, F.transform(tests, lambda x: x["output"]))


def cf_code(code: Column, results: Column, mode: str = "weighted_sum", no_compile: float = -0.1, no_submission: float = -1.0) -> Column:
    """Score of a submission from its results, array<struct<compiled, code, output>>, one for each of its problem's tests.

    No tests: null. No code: no_submission. Anything that didn't compile: no_compile. A test is passed where the
    program ended well and the checker printed 1; a missing result (the runner failed) isn't.
    """
    scores = {"pass_fail": lambda whole, share: whole, "partial": lambda whole, share: share, "weighted_sum": lambda whole, share: whole + share * 0.1}
    if mode not in scores:
        raise ValueError(f"Invalid scoring mode: {mode}")
    well = lambda r: F.coalesce((r["code"] == 0) & (t.strip(r["output"]) == "1"), F.lit(False))
    share = F.size(F.filter(results, well)).cast("double") / F.size(results).cast("double")
    score = scores[mode](F.when(share == 1.0, 1.0).otherwise(0.0), share)
    broken = F.exists(results, lambda r: F.coalesce(~r["compiled"], F.lit(False)))
    none = F.coalesce(F.size(results), F.lit(0)) <= 0
    return F.when(none, F.lit(None).cast("double")).when(F.coalesce(code, F.lit("")) == "", no_submission).when(broken, no_compile).otherwise(score)


def ioi_code(code: Column, scores: Column, precision: int = 2) -> Column:
    """Score of a sub-task from the scores of its tests, the worst counts; 0 without code or tests, and where the runner failed."""
    ran = (F.coalesce(code, F.lit("")) != "") & (F.size(scores) > 0) & ~F.exists(scores, lambda x: x.isNull())
    return F.when(ran, F.bround(F.array_min(scores), precision)).otherwise(0.0)


#: Rewards by name, in the order in which they are documented.
REGISTRY: dict[str, Callable[..., Column]] = {
    "gspo_default": gspo_default, "accuracy": accuracy, "format": format_reward, "reasoning_steps": reasoning_steps, "cosine": cosine, "repetition_penalty": repetition_penalty,
    "length": length, "code": code, "binary_code": lambda *a, **k: binary_code(code(*a, **k)), "ioi_code": ioi_code, "cf_code": cf_code, "code_format": code_format,
    "tag_count": tag_count, "soft_overlong_punishment": soft_overlong,
}


@dataclass
class RewardConfig:
    """Parameters of the rewards that get_reward_funcs binds."""

    cosine_min_value_wrong: float = -1.0
    cosine_max_value_wrong: float = -0.5
    cosine_min_value_correct: float = 0.5
    cosine_max_value_correct: float = 1.0
    cosine_max_len: int = 1000
    repetition_n_grams: int = 3
    repetition_max_penalty: float = -1.0
    code_language: str = "python"
    code_provider: str = "literal"
    code_eval_scoring_mode: str = "weighted_sum"
    max_completion_len: int = 16384
    soft_punish_cache: int = 4096
    parameters: dict[str, dict[str, object]] = field(default_factory=dict)

    def of(self, name: str) -> dict[str, object]:
        """Keyword arguments of a reward; `parameters` goes before the fields."""
        provided = {"language": self.code_language, "provider": self.code_provider}
        own = {
            "cosine": {"min_wrong": self.cosine_min_value_wrong, "max_wrong": self.cosine_max_value_wrong, "min_right": self.cosine_min_value_correct, "max_right": self.cosine_max_value_correct, "max_len": self.cosine_max_len},
            "repetition_penalty": {"n": self.repetition_n_grams, "max_penalty": self.repetition_max_penalty}, "code": provided, "binary_code": provided,
            "cf_code": {"mode": self.code_eval_scoring_mode}, "soft_overlong_punishment": {"max_len": self.max_completion_len, "cache": self.soft_punish_cache},
        }
        return own.get(name, {}) | self.parameters.get(name, {})


def get_reward_funcs(names: list[str], config: RewardConfig | None = None) -> dict[str, Callable[..., Column]]:
    """The named rewards in that order, with their parameters bound; an unknown name is a KeyError."""
    config = config or RewardConfig()
    return {name: partial(REGISTRY[name], **config.of(name)) if config.of(name) else REGISTRY[name] for name in names}
