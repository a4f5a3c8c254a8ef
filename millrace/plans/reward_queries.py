"""Queries of rewards over test results, contests, samples and small functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import code, cot, extract, rewards
from millrace.functions import text as t
from millrace.operators import chat, contest, mixture, quality
from millrace.plans.queries import NL, query

# --- answers -------------------------------------------------------------------------------------

#: Pairs of answers and whether they are equal; n is the document's id.
_ANSWERS = [
    (r"\frac{n}{400}", r"n/400", True), (r"\dfrac{n}{400}", r"\frac{n1}{400}", False), ("(n, 2)", "(n,2)", True), ("(n,2)", "n2", False), ("(n,2)", "(2,n)", False), (r"\{n, -1\}", r"\{-1,n\}", True),
    ("[0,n)", "[0,n]", False), ("n,000", "n000", None), (r"n\%", r"\frac{n}{100}", True), ("x = n", "n", True), (r"\left(n,\frac{1}{2}\right)", "(n, 0.5)", True), (r"n \cdot 2", "n+n", True),
    (r"\sqrt{16}", "4", True), (r"2^{10}", "1024", True), (r"n\sqrt{2}", "n", False), ("n.50", r"n+\frac12", True), (r"\text{n}", "n", True), ("(n)", "n", True),
]


def _answer(which: int):
    out = None
    for k, pair in enumerate(_ANSWERS):
        text = F.lit(pair[which].replace("n1", "@").replace("n", "#"))
        made = F.replace(F.replace(text, F.lit("@"), (F.col("doc_id") + 1).cast("string")), F.lit("#"), F.col("doc_id").cast("string"))
        out = F.when(F.col("doc_id") % len(_ANSWERS) == k, made) if out is None else out.when(F.col("doc_id") % len(_ANSWERS) == k, made)
    return out


_TRUE = " ".join(f"WHEN {k} THEN {'1.0' if right else '0.0' if right is False else 'CASE WHEN doc_id < 1000 THEN 1.0 ELSE 0.0 END'}" for k, (_, _, right) in enumerate(_ANSWERS))


@query("accuracy", f"SELECT doc_id, CASE WHEN doc_id % 19 = 0 THEN NULL ELSE (CASE doc_id % {len(_ANSWERS)} {_TRUE} END)::DOUBLE END AS reward FROM documents")
def _(tables):
    """Answers boxed at the end of whole texts against gold formulas, equal and unequal; a gold text without a formula gives none."""
    said = F.concat(F.coalesce("text", F.lit("")), F.lit(r" thus \boxed{"), _answer(0), F.lit("}"))
    gold = F.when(F.col("doc_id") % 19 == 0, F.lit("no formula")).otherwise(F.concat(F.lit("so $"), _answer(1), F.lit("$")))
    # where a text itself holds a dollar, it comes before the box and doesn't count
    return tables("documents").select("doc_id", rewards.accuracy(said, gold).alias("reward"))


# --- code ----------------------------------------------------------------------------------------


@query(
    "code_reward",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 WHEN 2 THEN 0.0 END::DOUBLE AS reward, CASE doc_id % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 WHEN 2 THEN 0.0 END::DOUBLE AS passed FROM documents""",
)
def _(tables):
    """Programs that echo, print a constant, or don't parse, over two tests; and one without tests."""
    program = F.expr("CASE doc_id % 4 WHEN 0 THEN 'print(input())' WHEN 1 THEN 'print(7)' WHEN 2 THEN 'prin(' ELSE 'print(1)' END")
    said = F.concat(F.coalesce("text", F.lit("")), F.lit("\n```python\n"), program, F.lit("\n```"))
    one = lambda given, want: F.struct(given.alias("input"), want.alias("output"))
    number = F.lit("7")
    tests = F.when(F.col("doc_id") % 4 == 3, F.array().cast("array<struct<input:string,output:string>>")).otherwise(F.array(one(number, number), one(F.lit("8"), F.lit(" 8 "))))
    rows = tables("documents").select("doc_id", rewards.code(said, tests).alias("reward"))
    return rows.select("doc_id", "reward", rewards.binary_code(F.col("reward")).alias("passed"))


for _mode, _score in (("pass_fail", "w"), ("partial", "s"), ("weighted_sum", "w + s * 0.1::DOUBLE")):

    @query(
        f"cf_code_{_mode}",
        f"""WITH x AS (SELECT o_orderkey, count(l_orderkey) AS n, count_if(l_quantity < 45) AS p, coalesce(bool_or(l_quantity > 49 AND l_linestatus = 'F'), false) AS bad FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey),
 y AS (SELECT *, p / n::DOUBLE AS s, CASE WHEN p = n THEN 1::DOUBLE ELSE 0::DOUBLE END AS w FROM x)
 SELECT o_orderkey, CASE WHEN n = 0 THEN NULL WHEN o_orderkey % 10 = 0 THEN -1::DOUBLE WHEN bad THEN -0.1::DOUBLE ELSE {_score} END AS reward FROM y""",
    )
    def _(tables, mode=_mode):
        q = F.col("l_quantity")
        result = F.struct((~((q > 49) & (F.col("l_linestatus") == "F"))).alias("compiled"), F.when(q < 48, 0).otherwise(1).alias("code"), F.when(q < 45, " 1\n").otherwise("0").alias("output"))
        results = tables("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(result).alias("results"))
        submitted = F.when(F.col("o_orderkey") % 10 != 0, F.lit("int main() {}"))
        return tables("orders").join(results, "o_orderkey", "left").select("o_orderkey", rewards.cf_code(submitted, F.col("results"), mode).alias("reward"))


@query("ioi_code", "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 OR count(l_orderkey) = 0 OR bool_or(l_quantity = 50) THEN 0::DOUBLE ELSE round_even(min(l_discount * 5), 1) END AS reward FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def _(tables):
    """The worst test of a sub-task; no code, no tests or a failed runner give 0."""
    score = F.struct(F.when(F.col("l_quantity") != 50, F.col("l_discount") * 5).alias("score"))
    results = tables("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(score).alias("results"))
    submitted = F.when(F.col("o_orderkey") % 10 != 0, F.lit("int main() {}"))
    scores = F.coalesce(F.transform("results", lambda r: r["score"]), F.array().cast("array<double>"))
    return tables("orders").join(results, "o_orderkey", "left").select("o_orderkey", rewards.ioi_code(submitted, scores, 1).alias("reward"))


@query("reward_registry", "SELECT doc_id, least(1.0::DOUBLE, len(regexp_extract_all(text, '(Step \\d+:|\\A\\d+\\.|\\n-|\\n\\*|First,|Second,|Next,|Finally,)')) / 3::DOUBLE) + CASE WHEN length(text) % 900 <= 400 THEN 0::DOUBLE WHEN length(text) % 900 <= 800 THEN (400 - length(text) % 900)::DOUBLE / 400 ELSE -1::DOUBLE END AS reward FROM documents")
def _(tables):
    """Rewards by name, with their parameters bound, summed up."""
    own = rewards.get_reward_funcs(["reasoning_steps", "soft_overlong_punishment"], rewards.RewardConfig(max_completion_len=800, soft_punish_cache=400))
    ids = F.array_repeat(F.lit(1), (F.length("text") % 900).cast("int"))
    return tables("documents").select("doc_id", (own["reasoning_steps"](F.col("text")) + own["soft_overlong_punishment"](ids)).alias("reward"))


@query(
    "response_statuses",
    """SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'CE' WHEN 1 THEN 'MLE' WHEN 2 THEN 'TLE' WHEN 3 THEN 'RE' WHEN 4 THEN 'AC' WHEN 5 THEN 'PA' ELSE 'WA' END AS status,
 CASE event_id % 7 WHEN 0 THEN 'Compilation error exit code 1' || chr(10) || props WHEN 1 THEN 'Memory limit exceeded' WHEN 2 THEN 'Time limit exceeded' WHEN 3 THEN 'Unknown error' WHEN 6 THEN 'Output isn''t correct' ELSE 'fine' END AS feedback FROM events""",
)
def _(tables):
    """Every answer of a runner, and the status read from it."""
    run = lambda **k: F.struct(*[F.lit(v).alias(n) for n, v in k.items()])
    fields = lambda code, out, err, signal: F.struct(F.lit(code).alias("code"), F.lit(out).alias("stdout"), F.lit(err).alias("stderr"), F.lit(signal).alias("signal"))
    d = F.col("event_id") % 7
    compiled = F.when(d == 0, F.struct(F.lit(1).alias("code"), F.col("props").alias("stderr")))
    ran = (
        F.when(d == 1, fields(1, "", "MemoryError: x", None)).when(d == 2, fields(137, "", "", "SIGKILL")).when(d == 3, fields(0, "", "", None))
        .when(d == 4, fields(0, "1", "fine", None)).when(d == 5, fields(0, "0.4", "fine", None)).when(d == 6, fields(0, "0", "Output isn't correct", None))
    )
    rows = tables("events").select("event_id", contest.response_of(F.to_json(F.struct(compiled.alias("compile"), ran.alias("run")))).alias("r"))
    return rows.select("event_id", contest.status_of(F.col("r.score").cast("double"), F.col("r.feedback")).alias("status"), "r.feedback")


@query(
    "subtask_cache",
    """WITH x AS (SELECT l_orderkey AS o, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS i, CASE WHEN l_quantity > 40 THEN 0::DOUBLE WHEN l_quantity > 20 THEN 1::DOUBLE ELSE 0.5::DOUBLE END AS s, l_returnflag AS f FROM lineitem),
 y AS (SELECT *, CASE WHEN s = 1 THEN 'AC' WHEN s > 0 THEN 'PA' WHEN f = 'R' THEN 'WA' ELSE 'TLE' END AS st FROM x),
 fail AS (SELECT o, min(CASE WHEN s = 0 AND i <= 3 THEN i END) AS fa, min(CASE WHEN s = 0 AND i BETWEEN 4 AND 5 THEN i END) AS fb FROM y GROUP BY o),
 seen AS (SELECT 1 AS subtask, o, CASE WHEN fa IS NULL OR i <= fa THEN s ELSE 0 END AS s, CASE WHEN fa IS NULL OR i <= fa THEN st ELSE 'SKIPPED' END AS st FROM y JOIN fail USING (o) WHERE i <= 3
  UNION ALL SELECT 2, o, CASE WHEN i <= 3 AND (fa IS NULL OR i <= fa) THEN s WHEN (fa IS NULL OR fa < 2) AND (fa IS NOT DISTINCT FROM NULL OR fa < 2) AND i > coalesce(fa, 3) AND (i <= fc OR fc IS NULL) THEN s ELSE 0 END,
    CASE WHEN i <= 3 AND (fa IS NULL OR i <= fa) THEN st WHEN (fa IS NULL OR fa < 2) AND i > coalesce(fa, 3) AND (i <= fc OR fc IS NULL) THEN st ELSE 'SKIPPED' END
   FROM (SELECT y.*, fa, (SELECT min(i) FROM y z WHERE z.o = y.o AND z.s = 0 AND z.i BETWEEN 2 AND 5 AND z.i > coalesce(fa, 3)) AS fc FROM y JOIN fail USING (o)) WHERE i BETWEEN 2 AND 5)
 SELECT o AS l_orderkey, subtask, min(s) AS score, min(s) * 25 AS weighted_score, min_by(st, CASE st WHEN 'WA' THEN 1 WHEN 'TLE' THEN 3 WHEN 'PA' THEN 4 WHEN 'AC' THEN 5 ELSE 999 END) AS status FROM seen GROUP BY o, subtask""",
)
def _(tables):
    """Two sub-tasks that share tests 2 and 3 of each order; what the first one ran the second one knows."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    score = F.when(F.col("l_quantity") > 40, 0.0).when(F.col("l_quantity") > 20, 1.0).otherwise(0.5)
    rows = tables("lineitem").select("l_orderkey", place.alias("place"), score.alias("score"), "l_returnflag")
    status = F.when(F.col("score") == 1, "AC").when(F.col("score") > 0, "PA").when(F.col("l_returnflag") == "R", "WA").otherwise("TLE")
    rows = rows.select("l_orderkey", "place", F.col("place").alias("test"), "score", status.alias("status"), F.lit(25.0).alias("points"), F.lit(2).alias("precision"))
    runs = rows.filter("place <= 5").withColumn("subtask", F.explode(F.expr("CASE WHEN place = 1 THEN array(1) WHEN place <= 3 THEN array(1, 2) ELSE array(2) END")))
    return contest.score_subtasks(runs, ["l_orderkey"])


@query(
    "pass_rate_groups",
    "SELECT conv_id, string_agg(CASE WHEN text IS NULL THEN 'null' WHEN length(text) > 60 THEN '1' ELSE '0' END, ',' ORDER BY turn) AS rewards, avg(CASE WHEN text IS NOT NULL THEN CASE WHEN length(text) > 60 THEN 1::DOUBLE ELSE 0::DOUBLE END END) AS pass_rate FROM conversations GROUP BY conv_id",
)
def _(tables):
    """Generations of a row scored one by one and gathered again."""
    rows = tables("conversations").groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("generations"))
    scored = contest.score_groups(rows, "conv_id", "generations", F.when(F.length("generation") > 60, 1.0).when(F.col("generation").isNotNull(), 0.0))
    return scored.select("conv_id", F.array_join(F.transform("pass_rate_rewards", lambda r: r.cast("int").cast("string")), ",", "null").alias("rewards"), "pass_rate")


@query("replicate_rows", "SELECT doc_id, text, unnest(range(1, doc_id % 4 + 1))::INT AS copy FROM documents")
def _(tables):
    return mixture.replicate(tables("documents").select("doc_id", "text"), F.col("doc_id") % 4, "copy")


# --- samples -------------------------------------------------------------------------------------

_RANKED = "SELECT *, row_number() OVER (ORDER BY md5('42:' || {key}), {key}) AS r, count(*) OVER () AS n FROM {table}"


@query("sample_without_replacement", f"SELECT doc_id, text FROM ({_RANKED.format(key='doc_id', table='documents')}) WHERE r <= 150")
def _(tables):
    return mixture.sample_exact(tables("documents").select("doc_id", "text"), 150, "doc_id")


@query("large_sample", f"SELECT l_orderkey, k FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || k), k) AS r, count(*) OVER () AS n FROM (SELECT l_orderkey, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS k FROM lineitem)) WHERE r <= n // 2")
def _(tables):
    """A sample beyond a top-n: whole ranges of the order, and the first rows of one."""
    rows = tables("lineitem").select("l_orderkey", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("k"))
    return mixture.sample(rows, rows.count() // 2, "k")


@query("working_set_sample", f"SELECT item_id FROM ({_RANKED.format(key='item_id', table='benchmark')}) WHERE r <= least(n, greatest(3 * 10, 10 + 5000))")
def _(tables):
    rows = tables("benchmark").select("item_id")
    return mixture.sample(rows, mixture.working_set(rows.count(), 10), "item_id")


@query("take_target", f"SELECT 'some' AS part, doc_id AS id FROM ({_RANKED.format(key='doc_id', table='documents')}) WHERE r <= 120 UNION ALL SELECT 'all', item_id FROM benchmark UNION ALL SELECT 'only ' || (SELECT count(*) FROM benchmark) || ' of 5000 rows', NULL")
def _(tables):
    """A target that is met, and one that isn't, with its warning."""
    said: list[str] = []
    some = mixture.take_target(tables("documents").select(F.lit("some").alias("part"), F.col("doc_id").alias("id")), 120, "id", warn=said.append)
    rest = mixture.take_target(tables("benchmark").select(F.lit("all").alias("part"), F.col("item_id").alias("id")), 5000, "id", warn=said.append)
    return some.unionByName(rest).unionByName(some.sparkSession.createDataFrame([(x, None) for x in said], some.schema))


@query("full_shuffle", f"SELECT doc_id, CAST(r AS BIGINT) AS place FROM ({_RANKED.format(key='doc_id', table='documents')})")
def _(tables):
    """The order of all rows, told by the places that ranks by ranges give them."""
    docs = tables("documents").select("doc_id")
    return mixture.shuffle(mixture.ranked(docs, "doc_id", 42, "place"), "doc_id").select("doc_id", F.col("place").cast("long").alias("place"))


@query("column_check", "SELECT * FROM (VALUES ('equal', true), ('other order', true), ('unnamed', true), ('different', false)) v(name, valid)")
def _(tables):
    docs, bench = tables("documents").columns, tables("benchmark").columns

    def valid(columns: list) -> bool:
        try:
            mixture.validate_columns(columns)
        except ValueError:
            return False
        return True

    cases = {"equal": [docs, docs], "other order": [docs, docs[::-1]], "unnamed": [docs, None], "different": [docs, bench]}
    return tables("region").sparkSession.createDataFrame([(k, valid(v)) for k, v in cases.items()], "name string, valid boolean")


# --- prompts, records and small functions ----------------------------------------------------------


@query("choice_prompt", f"SELECT doc_id, 'Explain.' || {NL} || 'Question: ' || coalesce(text, '') || {NL} || 'Options: ' || lang || {NL} || 'Correct answer: ' || source || {NL} || 'Write the output in the exact format (one paragraph):' AS prompt FROM documents")
def _(tables):
    return tables("documents").select("doc_id", chat.choice_prompt(F.col("text"), F.col("lang"), F.col("source"), "Explain.").alias("prompt"))


@query(
    "map_record",
    f"""SELECT CASE WHEN ok THEN 'm-' || substr(sha1('org/m' || {NL} || p || {NL} || a), 1, 16) ELSE '' END AS id, CASE WHEN ok THEN p ELSE '' END AS prompt, CASE WHEN ok THEN a ELSE '' END AS solution, CASE WHEN ok THEN 'multihop_qa' ELSE '' END AS domain, CASE WHEN ok THEN 2 ELSE 0 END AS messages
 FROM (SELECT *, doc_id % 3 <> 0 AND text <> '' AS ok FROM (SELECT doc_id, text, 'Q ' || text || '.' AS p, source AS a FROM documents))""",
)
def _(tables):
    """A record for each row; rows without a question give a blank one."""
    asked = F.when(F.col("doc_id") % 3 != 0, F.when(F.col("text") != "", F.concat(F.lit("Q "), "text", F.lit("."))))
    rows = tables("documents").select(asked.alias("question"), F.col("source").alias("answer"))
    return extract.map_record(rows, "hotpotqa", "org/m").select("id", "prompt", "solution", "domain", F.size("messages").alias("messages"))


@query("cot_messages", f"SELECT doc_id, CASE WHEN lang <> '' THEN 'Q ' || text || '.' || {NL} || {NL} || 'Options:' || {NL} || lang ELSE 'Q ' || text || '.' END AS asked, CASE WHEN doc_id % 2 = 0 THEN 'C ' || text || '.' ELSE 'R ' || source END AS said FROM documents WHERE text IS NOT NULL")
def _(tables):
    own = lambda name: F.concat(F.lit(f"{name} "), "text", F.lit("."))
    rows = tables("documents").filter("text IS NOT NULL").select(
        "doc_id", own("Q").alias("question"), F.col("lang").alias("options"), F.when(F.col("doc_id") % 2 == 0, own("C")).alias("cot_content"), F.concat(F.lit("R "), "source").alias("response")
    )
    return chat.from_cot(rows).select("doc_id", F.col("messages")[0]["content"].alias("asked"), F.col("messages")[1]["content"].alias("said"))


@query("cjk_test", "SELECT doc_id, doc_id % 3 = 0 AS cjk, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'ok' END AS cleaned FROM documents")
def _(tables):
    made = F.when(F.col("doc_id") % 3 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit(" 中 x"))).otherwise(F.concat(F.coalesce("text", F.lit("")), F.lit(" あ é x")))
    return tables("documents").select("doc_id", cot.has_cjk(made).alias("cjk"), F.when(cot.clean(made, F.lit("A")).isNotNull(), "ok").alias("cleaned"))


@query("parallel_degree", "SELECT p_partkey, (SELECT max(g) FROM range(1, 9) r(g) WHERE p_size % g = 0 AND 64 % g = 0)::INT AS degree FROM part")
def _(tables):
    return tables("part").select("p_partkey", code.parallel_degree(F.col("p_size")).alias("degree"))


@query("encoded_text", "SELECT doc_id, to_base64(encode(text)) AS encoded, source AS folder FROM documents")
def _(tables):
    return tables("documents").select("doc_id", t.encoded(F.col("text")).alias("encoded"), t.last_part(F.concat(F.lit("org/sub/"), "source")).alias("folder"))


@query("blank_columns", "SELECT count_if(n = 0)::BIGINT AS empty_messages, count_if(trim(coalesce(text, '')) = '')::BIGINT AS empty_prompt, count(*) AS inspected FROM (SELECT text, CASE WHEN doc_id % 5 = 0 THEN 0 ELSE 1 END AS n FROM documents)")
def _(tables):
    turns = F.when(F.col("doc_id") % 10 == 0, F.array().cast("array<struct<role:string,content:string>>")).when(F.col("doc_id") % 5 != 0, F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))))
    return quality.sanity(tables("documents").select(F.col("text").alias("prompt"), turns.alias("messages"))).select("empty_messages", "empty_prompt", "inspected")
