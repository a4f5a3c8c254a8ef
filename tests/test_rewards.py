"""Golden values of the rewards, and the traps between Python's and Java's text rules."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import code, cot, extract, rewards
from millrace.functions import text as t


def values(spark, column, texts, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_format(spark):
    good = "<think>\na\nb\n</think>\n<answer>\nc\n</answer>"
    texts = [good, "x\n" + good, good + "\nmore", good + "\r\nx", good + " x", "<think>a</think><answer>b</answer>", "<answer>\n1\n</answer>\n<think>\n2\n</think>", None]
    assert values(spark, rewards.format_reward, texts) == [1, 0, 1, 0, 0, 0, 0, None]


def test_tag_count(spark):
    full = "<think>\na\n</think>\n<answer>\nb\n</answer>"
    texts = [full, full.replace("<think>\n", ""), full.replace("\n</think>\n", "\n"), full.replace("\n</answer>", ""), "none"]
    assert values(spark, rewards.tag_count, texts) == [1.0, 0.75, 0.75, 0.75, 0.0]


def test_reasoning_steps(spark):
    texts = ["Step 1: a\nStep 2: b\nStep 3: c", "First, x", "First, x\nNext, y", "nothing", "1. a\n2. b"]
    assert values(spark, rewards.reasoning_steps, texts) == pytest.approx([1.0, 1 / 3, 2 / 3, 0.0, 1 / 3])


def test_repetition(spark):
    two = values(spark, lambda c: rewards.repetition_penalty(c, 2, -1.0), ["this this this this this", "this is a this is a test", "", "one", None])
    assert two == pytest.approx([-0.75, -1 / 3, 0.0, 0.0, 0.0])
    three = values(spark, lambda c: rewards.repetition_penalty(c, 3, -1.0), ["A B C A B C", "a b"])
    assert three == pytest.approx([-0.25, 0.0])
    assert values(spark, lambda c: rewards.repetition_penalty(c, 2, -1.0, "zh", list), ["哈哈哈"]) == pytest.approx([-0.5])
    with pytest.raises(ValueError):
        rewards.repetition_penalty(F.lit(""), 2, 0.1)
    with pytest.raises(ValueError):
        rewards.repetition_penalty(F.lit(""), 2, -1.0, "xx")


def test_cosine(spark):
    make = lambda ok: lambda c: F.round(rewards.cosine(c, F.lit(ok).cast("boolean"), -1.0, -0.5, 0.5, 1.0, 100), 3)
    assert values(spark, make(True), ["x" * 20, "x" * 80]) == [0.952, 0.548]
    assert values(spark, make(False), ["x" * 20, "x" * 80]) == [-0.952, -0.548]
    assert values(spark, make(None), ["x"]) == [1.0]


def test_length(spark):
    df = spark.createDataFrame([(1, "aa", True), (1, "aaaa", True), (1, "aaaaaa", False), (1, "aa", False), (2, "a", True), (2, "b", False), (3, "a", None)], "g int, x string, ok boolean")
    got = {(r.g, r.x, r.ok): r.v for r in df.select("*", rewards.length(F.col("x"), F.col("ok"), Window.partitionBy("g")).alias("v")).collect()}
    assert got == {(1, "aa", True): 0.5, (1, "aaaa", True): 0.0, (1, "aaaaaa", False): -0.5, (1, "aa", False): 0.0, (2, "a", True): 0.0, (2, "b", False): 0.0, (3, "a", None): 1.0}


def test_overlong(spark):
    df = spark.range(1).select(*[rewards.soft_overlong(F.array_repeat(F.lit(1), n), 100, 20).alias(str(n)) for n in (50, 90, 110)])
    assert list(df.first()) == [0.0, -0.5, -1.0]


def test_code_format_and_extract(spark):
    text = "<think>\nx\n</think>\n<answer>\n```{}\nprint()\n```\n</answer>"
    make = lambda lang: lambda c: rewards.code_format(c, F.lit(lang))
    assert values(spark, make("python"), [text.format("python"), text.format("javascript"), "```python\n```"]) == [1, 0, 0]
    assert values(spark, make("javascript"), [text.format("javascript")]) == [1]
    assert values(spark, rewards.extract_code, ["```python\na\n``` ```python\nb\n```", "none", None]) == ["b\n", "", ""]


def test_accuracy(spark):
    df = spark.createDataFrame(
        [(r"\boxed{\frac{63}{400}}", r"\boxed{\frac{63}{400}}"), (r"\boxed{\frac{64}{400}}", r"\frac{63}{400} is $\frac{63}{400}$"), ("3", "no formula"), (r"so $3$", r"$6$"), (r"\boxed{0.5}",  r"$\frac{1}{2}$"), (None, "$1$"), ("$1$", None)],
        "a string, b string",
    )
    assert [r[0] for r in df.select(rewards.accuracy("a", "b")).collect()] == [1.0, 0.0, None, 0.0, 1.0, 0.0, None]


def test_output_matches(spark):
    pairs = [("1\n2", "1\n2\n3", True), (" 1 \n2", "1\n2", True), ("1\n3", "1\n2", False), ("", "", True)]
    df = spark.createDataFrame(pairs, "a string, b string, want boolean")
    assert all(r[0] == r[1] for r in df.select(rewards.output_matches(F.col("a"), F.col("b")), "want").collect())


def test_python_white_space(spark):
    assert values(spark, lambda c: F.size(t.split(c)), ["a b c\x1cd\x85e", "  a  ", "", "\n"]) == [5, 1, 0, 0]
    assert values(spark, t.strip, ["  a b\x1f\n", " \n"]) == ["a b", ""]


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9])
def test_ngrams_of_few_words(spark, n):
    text = " ".join(f"w{i}" for i in range(n))
    assert values(spark, lambda c: F.size(t.ngrams(t.split(c), 8)), [text]) == [max(0, n - 7)]


def test_final_answer(spark):
    texts = [r"a \boxed{1} b \boxed{ 2 }", "x\n Therefore, y = 3 \n\n", "", None, "so what"]
    assert values(spark, extract.final_answer, texts) == ["2", "y = 3", "", "", "what"]


def test_trim_tail_with_pattern_characters(spark):
    texts = ["we see. Thus it is a+b(c).", r"end \E1 x", "plain"]
    answers = ["a+b(c)", r"\E1 x", "zzz"]
    df = spark.createDataFrame(list(zip(texts, answers)), "r string, a string")
    assert [r[0] for r in df.select(extract.trim_tail(F.col("r"), F.col("a"))).collect()] == ["we see.", "end", "plain"]


def test_falsy_columns(spark):
    df = spark.createDataFrame([(None, "", "x"), ("", "b", "x"), ("  ", "b", "x")], "problem string, question string, solution string")
    assert [r.prompt for r in extract.numina(df, "o/s").collect()] == ["b"]


def test_openbook_duplicate_labels(spark):
    df = spark.sql("SELECT 'q' AS question_stem, struct(array('A', 'A', 'B') AS label, array('x', 'y', ' ') AS text) AS choices, 'A' AS answerKey")
    row = extract.openbook(df, "o/s", include_assistant=True).first()
    assert row.solution == "y" and row.prompt == "q\n\nOptions:\nA. x\nA. y" and row.id.startswith("s-") and len(row.id) == 18


def test_hotpot_duplicate_titles(spark):
    df = spark.sql("SELECT 'q' AS question, 'a' AS answer, struct(array('T', 'T') AS title, array(array('old'), array(' ', 'new', 'more')) AS sentences) AS context, struct(array('T', 'T', 'U') AS title, array(1, 9, 0) AS sent_id) AS supporting_facts")
    assert "T: more T: new" in extract.hotpot(df, "o/s", include_assistant=True).first().assistant


def test_cot(spark):
    texts = ["Reasoning: a\n b ```", "x Let's think step by step. y (C)", "中文", None, "A: Let's think step by step. z The answer is (B)."]
    got = values(spark, lambda c: cot.clean(c, F.lit(None).cast("string")), texts)
    head = "A: Let's think step by step. "
    assert got == [head + "a b The answer is (A).", head + "y (C) The answer is (C).", None, "", head + "z The answer is (B)."]


def test_python_patching():
    old = "from collections import Mapping\nfrom fractions import gcd\nprint(gcd(2, 4))\n"
    new = code.modern_python(old)
    assert "collections.abc import Mapping" in new and "from math import gcd" in new and "fractions" not in new
    assert code.modern_python("x = 1").count("x = 1") == 1 and code.modern_python("x = 1", compat=True).count("x = 1") == 2


def test_param_count(spark):
    assert values(spark, code.param_count, ["a-1.5b", "moe-8x7B", "t-42m-1b", "none"]) == [1_500_000_000, 56_000_000_000, 1_000_000_000, -1]
