"""Contest scores from tables of test results, and pass rates of groups of completions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.mixture import replicate

STATUS = {"CE": -1, "RE": 0, "WA": 1, "MLE": 2, "TLE": 3, "PA": 4, "AC": 5, "SKIPPED": 999}


def codeforces_score(results: DataFrame, by: str, passed: Column, compiled: Column, mode: str = "weighted_sum", no_compile: float = -0.1) -> DataFrame:
    """(by, score) over a row for each test; a submission that doesn't compile gets no_compile."""
    share = F.count_if(passed) / F.count(F.lit(1))
    whole = F.when(F.count_if(passed) == F.count(F.lit(1)), 1.0).otherwise(0.0)
    score = {"pass_fail": whole, "partial": share, "weighted_sum": whole + share * 0.1}
    if mode not in score:
        raise ValueError(f"Invalid scoring mode: {mode}")
    return results.groupBy(by).agg(F.when(F.bool_or(~compiled), no_compile).otherwise(score[mode]).alias("score"))


def until_first_failure(results: DataFrame, by: str, at: list[str], passed: Column, batch: int = 1) -> DataFrame:
    """The tests that run: batches in order of `at`, the first with a failure being the last. Less than 1 is one batch."""
    rows = results.withColumn("_batch", F.floor((F.row_number().over(Window.partitionBy(by).orderBy(*at)) - 1) / batch) if batch >= 1 else F.lit(0))
    rows = rows.withColumn("_failing", F.min(F.when(~passed, F.col("_batch"))).over(Window.partitionBy(by)))
    return rows.filter("_failing IS NULL OR _batch <= _failing").drop("_batch", "_failing")


def status_of(score: Column, feedback: Column) -> Column:
    """Status of a test by its score and message."""
    failed = F.when(feedback.contains("Compilation error"), "CE").when(feedback.contains("Memory limit exceeded"), "MLE").when(feedback.contains("Time limit exceeded"), "TLE").when(feedback.contains("Output isn't correct"), "WA").otherwise("RE")
    return F.when(score == 0.0, failed).when(score == 1.0, "AC").otherwise("PA")


def response_of(response: Column) -> Column:
    """struct(score, feedback) of a JSON response of the runner; null where the runner itself failed."""
    got = F.from_json(response, "message string, compile struct<code:int,stderr:string>, run struct<code:int,stdout:string,stderr:string,signal:string>")
    answer = lambda score, feedback: F.struct(score.alias("score"), feedback.alias("feedback"))
    zero, run = F.lit("0"), got["run"]
    return (
        F.when(got["message"].isNotNull(), None)
        .when(got["compile"]["code"] != 0, answer(zero, F.concat(F.lit("Compilation error exit code "), got["compile"]["code"].cast("string"), F.lit("\n"), F.coalesce(got["compile"]["stderr"], F.lit("")))))
        .when(run.isNull(), None)
        .when((run["code"] == 1) & run["stderr"].contains("MemoryError"), answer(zero, F.lit("Memory limit exceeded")))
        .when(F.coalesce(run["stdout"], F.lit("")) != "", answer(run["stdout"], run["stderr"]))
        .when(run["signal"] == "SIGKILL", answer(zero, F.lit("Time limit exceeded")))
        .when(run["code"] != 0, None)
        .otherwise(answer(zero, F.lit("Unknown error")))
    )


def subtask_score(tests: DataFrame, by: list[str], points: Column, precision: int = 2) -> DataFrame:
    """(by, score, weighted_score, status) over rows with score and status; the worst test counts."""
    priority = F.coalesce(*[F.when(F.col("status") == name, rank) for name, rank in STATUS.items()])
    return tests.groupBy(*by).agg(
        F.bround(F.min("score"), precision).alias("score"), F.bround(F.min("score") * F.max(points), precision).alias("weighted_score"), F.min(F.struct(priority.alias("rank"), "status"))["status"].alias("status")
    )


def with_generated_tests(problems: DataFrame, generated: DataFrame, key: str = "id") -> DataFrame:
    """Official and generated tests of each problem, official first, generated ones in their text's order; both missing is null."""
    kind = "array<struct<input:string,output:string>>"
    lists = generated.groupBy(F.col("problem_id").alias(key)).agg(F.sort_array(F.collect_list(F.struct("input", "output"))).alias("_generated"))
    both = F.concat(F.coalesce("official_tests", F.array().cast(kind)), F.coalesce("_generated", F.array().cast(kind)))
    return problems.join(lists, key, "left").withColumn("tests", F.when(F.size(both) > 0, both)).drop("_generated")


def pass_rates(rewards: DataFrame, by: str, reward: str, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """(by, pass_rate) of groups whose mean reward lies strictly between the bounds, in single precision; null rewards don't count."""
    mean = rewards.groupBy(by).agg(F.avg(reward).cast("float").alias("pass_rate"))
    return mean.filter((F.col("pass_rate") > F.lit(low).cast("float")) & (F.col("pass_rate") < F.lit(high).cast("float")))


def lookup_tests(wanted: DataFrame, tests: DataFrame) -> DataFrame:
    """wanted (year, problem_id, test_name, …) with test_input and test_output of the same three keys; null where there is no such test."""
    return wanted.join(tests.select("year", "problem_id", "test_name", "test_input", "test_output"), ["year", "problem_id", "test_name"], "left")


def score_subtasks(runs: DataFrame, by: list[str], batch: int = 1) -> DataFrame:
    """(by, subtask, score, weighted_score, status) of sub-tasks that share tests, each test run once for a submission.

    runs has, beside `by`, a row for each test of each sub-task: subtask, points, precision, place (of the test in the
    sub-task), test, and what running it would give: score and status. Sub-tasks are worked off in their order. One that
    holds a test known to have failed runs nothing more; else its unknown tests run in batches (below 1: all at once) up to the first failure.
    Tests that didn't run are SKIPPED. No tests at all: score 0, SKIPPED. A submission's tests are one group of a task.
    """
    fields = ["subtask", "place", "test", "score", "status", "points", "precision"]
    grouped = runs.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("rows"))
    result = StructType([*[f for f in grouped.schema if f.name != "rows"], runs.schema["subtask"], *StructType.fromDDL("score double, weighted_score double, status string")])
    return grouped.mapInArrow(_score_subtasks(by, batch), result)


def _score_subtasks(by: list[str], batch: int):
    """Over submissions with their sorted rows: a row for each sub-task. Fields are read as columns, since a row as an object takes far longer than its score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            lists = given.column("rows")
            bounds = lists.offsets.to_pylist()
            subtasks, tests, scores, states, points, digits = (lists.values.field(name).to_pylist() for name in ("subtask", "test", "score", "status", "points", "precision"))
            out: list[tuple] = []
            for group, (at, to) in enumerate(zip(bounds, bounds[1:])):
                known: dict[object, tuple[float, str]] = {}
                while at < to:
                    end = at + 1
                    while end < to and subtasks[end] == subtasks[at]:
                        end += 1
                    own = [i for i in range(at, end) if tests[i] is not None]
                    todo = [i for i in own if tests[i] not in known]
                    if not any(tests[i] in known and known[tests[i]][0] == 0.0 for i in own):
                        step = batch if batch >= 1 else max(1, len(todo))
                        for k in range(0, len(todo), step):
                            part = todo[k : k + step]
                            known.update((tests[i], (scores[i], states[i])) for i in part)
                            if any(scores[i] == 0.0 for i in part):
                                break
                    seen = [known.get(tests[i], (0.0, "SKIPPED")) for i in own]
                    least = min((s for s, _ in seen), default=0.0)
                    status = min((s for _, s in seen), key=STATUS.__getitem__, default="SKIPPED")
                    out.append((group, subtasks[at], float(round(least, int(digits[at]))), float(round(least * points[at], int(digits[at]))), status))
                    at = end
            groups, *columns = zip(*out) if out else ((),) * 5
            keys = [given.column(name).take(pa.array(groups, pa.int64())) for name in by]
            kinds = (lists.values.field("subtask").type, pa.float64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([*keys, *[pa.array(c, kind) for c, kind in zip(columns, kinds)]], names=[*by, "subtask", "score", "weighted_score", "status"])

    return run


def explode_generations(rows: DataFrame, generations: str, name: str = "generation") -> DataFrame:
    """A row for each generation of each row, numbered in generation_index; rows without one vanish."""
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != generations], F.posexplode(generations).alias("generation_index", name))


def score_groups(rows: DataFrame, key: str, generations: str, reward: Column, n: int | None = None) -> DataFrame:
    """(key, pass_rate_rewards, pass_rate): rewards of each row's generations in their order, and their mean without nulls.

    reward is an expression over the row's columns and `generation`. Rows without generations have none; with n, a string
    column of one text counts as n copies of it.
    """
    each = explode_generations(rows, generations) if n is None else replicate(rows.withColumnRenamed(generations, "generation"), n, "generation_index")
    scored = each.select(key, "generation_index", reward.alias("r"))
    grouped = scored.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("generation_index", "r"))).alias("rs"), F.avg("r").alias("pass_rate"))
    return grouped.select(key, F.transform("rs", lambda x: x["r"]).alias("pass_rate_rewards"), "pass_rate")
