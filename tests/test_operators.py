"""Mixing, contests, reports, sources, sinks and streaming on small fixtures."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import chat, contest, mixture, quality, resume
from millrace.sources import json_tables, scans, sinks
from millrace.streaming import generation, providers


def test_targets():
    assert mixture.targets(100_000) == {"numina": 60000, "codeforces": 20000, "hotpotqa": 12000, "openbookqa": 8000}
    assert mixture.targets(10, {"a": 1, "b": 1, "c": 1}) == {"a": 4, "b": 3, "c": 3}
    with pytest.raises(ValueError):
        mixture.targets(10, {"a": 0})
    assert mixture.working_set(10, 5) == 10 and mixture.working_set(10**6, 100) == 5100


def test_mixture(spark):
    a, b = spark.range(40), spark.range(100, 130)
    assert mixture.mixture([(a, 1.0), (b, 1.0)], "id").count() == 70
    assert mixture.mixture([(a, 0.25), (b, 0.5)], "id").count() == 40 // 4 + 30 // 2
    split = mixture.exact_split(spark.range(10), 0.2, "id").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in split} == {"train": 8, "test": 2}
    with pytest.raises(ValueError):
        mixture.validate_columns([["a"], None, ["b"]])
    mixture.validate_columns([["a", "b"], ["b", "a"], None])


def test_sampling(spark):
    df = spark.range(7)
    assert mixture.sample(df, 20, "id").count() == 7
    with pytest.raises(ValueError):
        mixture.sample_exact(df, 8, "id")
    counts = [r["count"] for r in mixture.sample_with_replacement(df, 16, "id").groupBy("id").count().collect()]
    assert sorted(counts) == [2] * 5 + [3] * 2
    assert mixture.sample_with_replacement(df, 0, "id").count() == 0
    ranks = mixture.ranked(spark.range(500), "id", 1).orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == list(range(1, 501))


def test_contest(spark):
    rows = [("a", 1, True), ("a", 2, False), ("a", 3, True), ("b", 1, True), ("b", 2, True)]
    df = spark.createDataFrame(rows, "s string, t int, ok boolean")
    score = lambda mode: {r.s: r.score for r in contest.codeforces_score(df, "s", F.col("ok"), F.lit(True), mode).collect()}
    assert score("pass_fail") == {"a": 0.0, "b": 1.0} and score("partial")["a"] == pytest.approx(2 / 3) and score("weighted_sum")["b"] == pytest.approx(1.1)
    assert {r.score for r in contest.codeforces_score(df, "s", F.col("ok"), F.col("t") < 3).collect()} == {-0.1, 1.1}
    with pytest.raises(ValueError):
        score("x")
    assert contest.until_first_failure(df, "s", ["t"], F.col("ok")).count() == 4
    assert contest.until_first_failure(df, "s", ["t"], F.col("ok"), -1).count() == 5


def test_pass_rate_bounds(spark):
    rows = [("in", 1.0), ("in", 0.0), ("low", 0.1), ("high", 0.9), ("null", None), ("some", None), ("some", 0.5)]
    df = spark.createDataFrame(rows, "g string, r double")
    assert {r.g for r in contest.pass_rates(df, "g", "r").collect()} == {"in", "some"}


def test_generated_tests(spark):
    kind = "id string, official_tests array<struct<input:string,output:string>>"
    problems = spark.createDataFrame([("a", [("1", "2")]), ("b", None), ("c", None)], kind)
    generated = spark.createDataFrame([("b", "x", "y")], "problem_id string, input string, output string")
    got = {r.id: r.tests and len(r.tests) for r in contest.with_generated_tests(problems, generated).collect()}
    assert got == {"a": 1, "b": 1, "c": None}


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([], "id string, prompt string")
    report = quality.write_report(df, str(tmp_path / "r.json"))
    assert report["inspected"] == 0 and report["format_valid_ratio"] == 0.0 and any("missing columns" in w for w in json.loads((tmp_path / "r.json").read_text())["warnings"])
    empty = quality.format_report(spark.createDataFrame([], "x string"), "x").first()
    assert empty.n == 0 and empty.median_chars == 0.0


def test_chat(spark):
    assert chat.detect(["messages"]) is None and chat.detect(["conversations"]) == "sharegpt" and chat.detect(["question", "cot_content"]) == "cot" and chat.detect(["text"]) == "text"
    with pytest.raises(ValueError):
        chat.make_conversation(spark.range(1), "absent")
    df = spark.createDataFrame([("q", "o", None, "fine")], "question string, options string, cot_content string, response string")
    assert [m.content for m in chat.from_cot(df).first().messages] == ["q\n\nOptions:\no", "fine"]
    rows = spark.createDataFrame([("do", "it", "ok"), ("do", "", None)], "instruction string, input string, output string")
    assert [r.text for r in chat.to_text(rows).collect()] == ["user: do\nit\nassistant: ok", "user: do\nassistant: "]
    assert chat.to_text(spark.createDataFrame([(1, "", "b")], "a int, c string, d string")).first().text == "b"


def test_scans(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a.parquet"))
    spark.range(3).selectExpr("id AS x", "'t' AS text").coalesce(1).write.parquet(str(tmp_path / "deep/b"))
    spark.range(2).selectExpr("id AS x", "'u' AS text").coalesce(1).write.parquet(str(tmp_path / "deep/c"))
    spark.range(2).selectExpr("'v' AS text").coalesce(1).write.parquet(str(tmp_path / "deep/d"))
    deep = str(tmp_path / "deep")
    assert len(scans.parquet_files(deep)) == 3 and scans.read(spark, f"{deep}/*/*.parquet").count() > 0
    said: list[str] = []
    assert scans.read_largest_group(spark, deep, said.append).count() == 5 and len(said) == 1
    assert scans.read_mixed(spark, deep).count() == 7
    assert scans.expand_paths(f"'{deep}', nowhere, {deep}/") == [deep, "nowhere"]
    with pytest.raises(ValueError):
        scans.resolve(None)
    assert scans.resolve("x", mixture=object()) is None and scans.resolve("data", root="/r") == "/r/data"
    (tmp_path / "data").mkdir()
    spark.range(1).toPandas().to_parquet(tmp_path / "data/a.parquet")
    assert scans.resolve("org/own-set", root=str(tmp_path), local=("own-set",)).endswith("data/*.parquet")
    assert scans.resolve("org/x", catalog={"org/x": "/c"}) == "/c"
    with pytest.raises(FileNotFoundError):
        scans.read(spark, str(tmp_path / "none"))


def test_json(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1, "n": [{"x": 1, "y": "s"}]}\n\n{"b": 2, "n": [{"y": {"z": 1}}]}\n')
    rows = json_tables.read_any(spark, str(tmp_path / "a.jsonl"))
    assert set(rows.columns) == {"a", "b", "n"} and rows.count() == 2
    assert dict(rows.dtypes)["n"] == "array<struct<x:bigint,y:string>>"
    with gzip.open(tmp_path / "c.json.gz", "wt") as f:
        f.write('[{"a": 1}, {"a": 2}]')
    assert json_tables.detect_format(str(tmp_path / "c.json.gz")) == "json" and json_tables.read_any(spark, str(tmp_path / "c.json.gz")).count() == 2
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n[1]\n')
    with pytest.raises(ValueError, match="bad.jsonl:2"):
        json_tables.read_jsonl(spark, str(tmp_path / "bad.jsonl"))
    (tmp_path / "odd").write_text("\n 5")
    assert json_tables.detect_format(str(tmp_path / "odd")) == "jsonl"
    assert json_tables.read_stdin(spark, stream=iter(['{"a": 1}\n', "\n"])).count() == 1
    json_tables.convert(spark, str(tmp_path / "a.jsonl"), str(tmp_path / "out"), "none")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parquet(spark.range(10).coalesce(1), path, None, 4)
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 3
    sinks.write_parquet(spark.read.parquet(path).filter("id < 5"), path, index="id")
    assert spark.read.parquet(path).agg(F.max("__index_level_0__")).first()[0] == 4
    assert sinks.push(spark.range(1), str(tmp_path), "n", "c", "gen").endswith("n/config=c/revision=gen")


def test_resumed_generation(spark, tmp_path):
    target = str(tmp_path / "g")
    rows = spark.range(6).selectExpr("id", "CAST(id AS STRING) AS prompt")
    calls = generation.with_retries(lambda p: str(int(p) // (int(p) - 3)), 2, 0.0)
    assert generation.resume(spark, rows.filter("id < 4"), target, calls, "id") == 4
    assert generation.resume(spark, rows, target, calls, "id") == 2
    done = spark.read.parquet(target)
    assert done.count() == 6 and resume.without_errors(done).count() == 5
    two = generation.generate(rows.limit(1), lambda p: p, n=2).first()
    assert two.cot_content == ["0", "0"]


def test_stream(spark, tmp_path):
    rows = spark.range(4).selectExpr("id", "CAST(id AS STRING) AS prompt")
    rows.write.parquet(str(tmp_path / "in"))
    source = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        generation.stream(source(), str(tmp_path / "out"), str(tmp_path / "cp"), lambda p: p + "!").awaitTermination()
    assert sorted(r.cot_content for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["0!", "1!", "2!", "3!"]


def test_providers(spark):
    with pytest.raises(ValueError):
        providers.get_provider("none")
    assert providers.EchoProvider().execute(["x\n0.5", ""], ["python"] * 2) == [0.5, 0.0]
