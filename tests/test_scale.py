"""What plans and steps must not do on large tables, and the same results as plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import cot, rewards
from millrace.functions import text as t
from millrace.operators import contest, decontam, quality


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_format_failures_read_texts_once(spark):
    """The pattern is tried once for a text and read once more where it fits; stripping needs no pattern."""
    made = spark.createDataFrame([("<think>\na\n</think>\n<answer>\nb\n</answer>",), ("x",), (" <think>\na\n</think>\n<answer>\nI cannot\n</answer>\n",), ("",), (None,)], "c string")
    bad = quality.failures(made, "c")
    assert {r.c for r in bad.collect()} == {"", " <think>\na\n</think>\n<answer>\nI cannot\n</answer>\n", "x", None}
    assert plan(bad).count("RLIKE") == 1 and plan(bad).count("regexp_extract(") == 1 and "regexp_replace(" not in plan(bad)


def test_cleaning_needs_no_pattern_for_white_space(spark):
    """Only the two endings are patterns, and they are tried only where their first words occur."""
    rows = spark.createDataFrame([(" Reasoning:　a\r\nb \x85 c\nThe answer is (B).",), ("x Answer : C",), ("é 中",), (None,)], "c string")
    cleaned = rows.select(cot.clean(F.col("c"), F.lit("A")).alias("c"))
    assert [r.c for r in cleaned.collect()] == ["A: Let's think step by step. a b c The answer is (A).", "A: Let's think step by step. x The answer is (A).", None, ""]
    assert plan(cleaned).count("regexp_replace(") == 2 == plan(cleaned).lower().count("contains(")


def test_white_space_as_python_has_it(spark):
    random.seed(1)
    texts = ["".join(random.choice(t.BLANKS * 2 + "abİé中​﻿\x1b") for _ in range(random.randint(0, 14))) for _ in range(500)]
    got = spark.createDataFrame([(x,) for x in texts], "x string").select("x", t.strip(F.col("x")).alias("s"), t.split(F.col("x")).alias("w"), t.tail_lines(F.col("x")).alias("l")).collect()
    for r in got:
        assert (r.s, r.w, r.l) == (r.x.strip(), r.x.split(), [y for y in (line.strip() for line in r.x.splitlines()) if y])


@pytest.mark.parametrize("few", [True, False])
def test_decontamination_makes_few_ngrams(spark, monkeypatch, few):
    """Flags as by sets of n-grams; n-grams are made only near words that benchmarks hold rarely."""
    if not few:
        monkeypatch.setattr(decontam, "ANCHOR_BYTES", -1)
    random.seed(2)
    word = lambda: f"w{int(random.paretovariate(0.4)) % 500}"
    items = [" ".join(word() for _ in range(12)) for _ in range(20)]
    texts = [" ".join(word() for _ in range(60)) for _ in range(200)] + ["", None, "w1 w2"]
    texts = [x.replace(" ", "\n ", 3) + " " + items[k % 20].upper() if x and k % 5 == 0 else x for k, x in enumerate(texts)]
    sets = lambda x: {tuple(w[i : i + 8]) for w in [(x or "").lower().split()] for i in range(len(w) - 7)}
    known = set().union(*map(sets, items))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    flagged = decontam.flags(docs, {"b": spark.createDataFrame([(x,) for x in items], "text string")})
    assert {r.doc_id: r.contaminated_b for r in flagged.collect()} == {k: bool(sets(x) & known) for k, x in enumerate(texts)}
    if few:
        made = decontam.anchored_ngrams(decontam.words_of(F.col("text")), spark, decontam.anchors([" ".join(g) for g in sorted(known)]), 8)
        n, every = docs.select(F.sum(F.size(made)), F.sum(F.size(t.ngrams(decontam.words_of(F.col("text")), 8)))).first()
        assert n * 2 < every


def test_length_reward_moves_no_groups(spark):
    """Bounds of a group are joined; no task receives a whole group's texts."""
    rows = spark.createDataFrame([(1, "en", "a", True), (2, "en", "aaa", False), (3, None, "aa", True), (4, None, "a", None), (5, "de", "a", True)], "id long, lang string, text string, ok boolean")
    got = rewards.length_by(rows, "text", F.col("ok"), ["lang"])
    assert {r.id: r.reward for r in got.collect()} == {1: 0.5, 2: -0.5, 3: -0.5, 4: 1.0, 5: 0.0}
    assert "Window" not in plan(got)
    from millrace.plans.queries import QUERIES

    assert "Window" not in plan(QUERIES["length_reward"](spark, "/root/testdata/sf0.001"))


def test_subtasks_are_read_as_columns(spark):
    """Two submissions; what the first sub-task ran the second one knows. Rows aren't made objects one by one."""
    rows = [("a", 1, 1, "x", 1.0, "AC"), ("a", 1, 2, "y", 0.0, "WA"), ("a", 1, 3, "z", 0.5, "PA"), ("a", 2, 1, "z", 0.5, "PA"), ("a", 2, 2, "x", 1.0, "AC"), ("a", 3, 1, "y", 1.0, "AC"), ("b", 1, 1, None, None, None)]
    runs = spark.createDataFrame(rows, "s string, subtask int, place int, test string, score double, status string").withColumns({"points": F.lit(25.0), "precision": F.lit(2)})
    got = contest.score_subtasks(runs, ["s"])
    assert sorted(map(tuple, got.collect())) == [("a", 1, 0.0, 0.0, "WA"), ("a", 2, 0.5, 12.5, "PA"), ("a", 3, 0.0, 0.0, "WA"), ("b", 1, 0.0, 0.0, "SKIPPED")]
    assert "ArrowEvalPython" not in plan(got)
