"""Queries of sources, sinks and resumed generation: each writes tables to the shared folder and reads them back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import chat, contest, mixture, quality
from millrace.operators.lineage import new_folder
from millrace.plans.queries import NL, query
from millrace.sources import files, json_tables, scans, sinks
from millrace.streaming import generation


def _folder(tables, name: str) -> tuple[SparkSession, str]:
    spark = tables("region").sparkSession
    return spark, new_folder(spark, name)


def _by_language(tables, name: str) -> tuple[SparkSession, str]:
    """documents as one folder for each language."""
    spark, root = _folder(tables, name)
    docs = tables("documents").select("doc_id", "text", "lang")
    for lang in ("de", "en", "es", "fr"):
        docs.filter(F.col("lang") == lang).drop("lang").write.parquet(f"{root}/{lang}")
    return spark, root


# --- scans ---------------------------------------------------------------------------------------


@query("parquet_scan_folder", "SELECT doc_id, text FROM documents WHERE lang IN ('de', 'en', 'es', 'fr')")
def _(tables):
    spark, root = _by_language(tables, "scan")
    return scans.read(spark, root)


@query("parquet_scan_pattern", "SELECT doc_id, text FROM documents WHERE lang IN ('en', 'es')")
def _(tables):
    spark, root = _by_language(tables, "scan")
    return scans.read(spark, f"{root}/e*/*.parquet")


@query("parquet_scan_deep_pattern", "SELECT doc_id, text FROM documents WHERE lang IN ('de', 'en', 'es', 'fr')")
def _(tables):
    spark, root = _by_language(tables, "scan")
    return scans.read(spark, f"{root}/**/*.parquet")


@query("parquet_scan_file", "SELECT p_partkey, p_name FROM part")
def _(tables):
    spark, root = _folder(tables, "scan")
    tables("part").select("p_partkey", "p_name").coalesce(1).write.parquet(root)
    (path,) = scans.parquet_files(root)
    return scans.read(spark, path)


@query("dataset_resolve", "SELECT r_regionkey AS key, r_name AS name FROM region UNION ALL SELECT n_nationkey, n_name FROM nation UNION ALL SELECT s_suppkey::INT, s_name FROM supplier")
def _(tables):
    """An alias, a catalog's entry and a path."""
    spark, root = _folder(tables, "resolve")
    tables("region").selectExpr("r_regionkey AS key", "r_name AS name").write.parquet(f"{root}/data")
    tables("nation").selectExpr("n_nationkey AS key", "n_name AS name").write.parquet(f"{root}/nations")
    tables("supplier").selectExpr("CAST(s_suppkey AS INT) AS key", "s_name AS name").write.parquet(f"{root}/suppliers")
    found = [scans.resolve("data", root=root), scans.resolve("org/nations", catalog={"org/nations": f"{root}/nations"}), scans.resolve(f"{root}/suppliers")]
    return scans.read(spark, found[0]).unionByName(scans.read(spark, found[1])).unionByName(scans.read(spark, found[2]))


@query("local_override", "SELECT n_nationkey, n_name FROM nation")
def _(tables):
    """A dataset named like one that lies in the data folder is read from there."""
    spark, root = _folder(tables, "override")
    tables("nation").select("n_nationkey", "n_name").coalesce(1).write.parquet(f"{root}/data")
    return scans.read(spark, scans.resolve("org/own-set", root=root, local=("own-set",)))


def _two_schemas(tables) -> tuple[SparkSession, str]:
    """A file for each region; those of even keys have one column more."""
    spark, root = _folder(tables, "groups")
    nation = tables("nation")
    for key in range(5):
        columns = ["n_nationkey", "n_name"] if key % 2 == 0 else ["n_name"]
        nation.filter(F.col("n_regionkey") == key).select(*columns).coalesce(1).write.parquet(f"{root}/{key}")
    return spark, root


@query("schema_groups", "SELECT CASE WHEN n_regionkey % 2 = 0 THEN 'n_nationkey,n_name' ELSE 'n_name' END AS columns, count(DISTINCT n_regionkey) AS files FROM nation GROUP BY 1")
def _(tables):
    spark, root = _two_schemas(tables)
    groups = scans.schema_groups(spark, scans.parquet_files(root))
    return spark.createDataFrame([(",".join(columns), len(paths)) for columns, paths in groups], "columns string, files long")


@query("largest_schema_group", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey % 2 = 0")
def _(tables):
    return scans.read_largest_group(*_two_schemas(tables), warn=lambda _: None)


@query(
    "mixed_schema_text",
    f"""SELECT string_agg(CASE role WHEN 'assistant' THEN 'assistant' WHEN 'system' THEN 'system' ELSE 'user' END || ': ' || coalesce(text, ''), {NL} ORDER BY turn) AS text FROM conversations GROUP BY conv_id
 UNION ALL SELECT CASE doc_id % 7 WHEN 0 THEN 'user: '||lang||{NL}||source||{NL}||'assistant: '||text WHEN 1 THEN 'user: '||lang||{NL}||'assistant: '||text WHEN 2 THEN 'user: '||source||{NL}||'assistant: '||text
  WHEN 3 THEN 'user: '||source||{NL}||'assistant: '||text WHEN 4 THEN 'user: '||lang||{NL}||'assistant: '||text WHEN 5 THEN text ELSE lang END FROM documents""",
)
def _(tables):
    """Every layout that becomes text, each in files of its own."""
    spark, root = _folder(tables, "mixed")
    d = F.coalesce(F.col("doc_id") % 7, F.lit(6))
    docs = tables("documents")
    layouts = [
        ("lang AS instruction", "source AS input", "text AS output"), ("lang AS instruction", "text AS output"), ("source AS prompt", "text AS response"), ("source AS prompt", "text AS completion"),
        ("lang AS question", "text AS answer"), ("text",), ("lang AS other", "source AS more"),
    ]
    for k, columns in enumerate(layouts):
        docs.filter(d == k).selectExpr(*columns).write.parquet(f"{root}/{k}")
    turn = F.struct(F.col("role").alias("from"), F.col("text").alias("value"))
    turns = F.transform(F.sort_array(F.collect_list(F.struct("turn", turn.alias("m")))), lambda x: x["m"])
    tables("conversations").groupBy("conv_id").agg(turns.alias("conversations")).write.parquet(f"{root}/chat")
    return scans.read_mixed(spark, root)


@query("multi_file_union", "SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def _(tables):
    spark, root = _folder(tables, "union")
    tables("customer").selectExpr("c_custkey AS key", "c_name AS name", "c_acctbal AS balance").write.parquet(f"{root}/a")
    tables("supplier").selectExpr("s_suppkey AS key", "s_name AS name").write.parquet(f"{root}/b")
    return scans.read_union(spark, [f"{root}/a", f"{root}/b"])


@query("contest_tests_scan", "SELECT (l_suppkey % 5)::VARCHAR || '/' || l_orderkey AS problem_id, l_partkey::VARCHAR AS input, l_linenumber::VARCHAR AS output FROM lineitem WHERE l_suppkey % 5 IN (1, 3)")
def _(tables):
    spark, root = _folder(tables, "contests")
    rows = tables("lineitem").selectExpr("l_suppkey % 5 AS contest", "concat(l_suppkey % 5, '/', l_orderkey) AS problem_id", "CAST(l_partkey AS STRING) AS input", "CAST(l_linenumber AS STRING) AS output")
    for contest_id in range(4):
        rows.filter(F.col("contest") == contest_id).drop("contest").write.parquet(f"{root}/test_cases_{contest_id:04d}.parquet")
    return scans.contest_tests(spark, root, [3, 1, 9, 1])


def _olympiad(tables) -> DataFrame:
    spark, root = _folder(tables, "olympiad")
    rows = tables("lineitem").selectExpr("2020 + l_suppkey % 3 AS year", "CAST(l_partkey AS STRING) AS problem_id", "concat(l_orderkey, '-', l_linenumber, '-', l_suppkey) AS test_name", "l_returnflag AS test_input", "l_linestatus AS test_output")
    for year in (2020, 2021, 2022):
        rows.filter(F.col("year") == year).drop("year").write.parquet(f"{root}/{year}")
    return scans.olympiad_tests(spark, root, [2021, 2020, 1999])


_OLYMPIAD = "SELECT (2020 + l_suppkey % 3)::INT AS year, l_partkey::VARCHAR AS problem_id, l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS test_name, l_returnflag AS test_input, l_linestatus AS test_output FROM lineitem WHERE l_suppkey % 3 < 2"


@query("olympiad_tests_scan", _OLYMPIAD)
def _(tables):
    return _olympiad(tables)


@query(
    "olympiad_tests_lookup",
    f"""WITH w AS (SELECT DISTINCT (2020 + l_suppkey % 3)::INT AS year, l_partkey::VARCHAR AS problem_id, l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS test_name FROM lineitem WHERE l_linenumber = 2),
 t AS (SELECT DISTINCT * FROM ({_OLYMPIAD})) SELECT w.*, test_input, test_output FROM w LEFT JOIN t USING (year, problem_id, test_name)""",
)
def _(tables):
    wanted = tables("lineitem").filter("l_linenumber = 2").selectExpr("CAST(2020 + l_suppkey % 3 AS INT) AS year", "CAST(l_partkey AS STRING) AS problem_id", "concat(l_orderkey, '-', l_linenumber, '-', l_suppkey) AS test_name").distinct()
    return contest.lookup_tests(wanted, _olympiad(tables).distinct())


@query("upload_scan", "SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region UNION ALL SELECT s_suppkey, s_name FROM supplier")
def _(tables):
    """Uploads as one JSON array, as JSON lines, and as Parquet."""
    spark, root = _folder(tables, "upload")
    pair = "n_nationkey long, n_name string"
    files.make_folder(root)
    files.write_text(f"{root}/a.json", json.dumps([r.asDict() for r in tables("nation").select("n_nationkey", "n_name").collect()]))  # 25 rows
    files.write_text(f"{root}/b.jsonl", "\n".join(tables("region").selectExpr("r_regionkey AS n_nationkey", "r_name AS n_name").toJSON().collect()))  # 5 rows
    tables("supplier").selectExpr("s_suppkey AS n_nationkey", "s_name AS n_name").write.parquet(f"{root}/c.parquet")
    out = [scans.read_upload(spark, [f"{root}/{name}"]) for name in ("a.json", "b.jsonl", "c.parquet")]
    return out[0].to(generation.StructType.fromDDL(pair)).unionByName(out[1]).unionByName(out[2])


@query("split_slice", "SELECT * FROM (SELECT 'first' AS part, doc_id FROM documents ORDER BY doc_id LIMIT 10) UNION ALL SELECT * FROM (SELECT 'share', doc_id FROM documents ORDER BY doc_id LIMIT (SELECT round(count(*) * 0.25)::BIGINT FROM documents)) UNION ALL SELECT * FROM (SELECT 'last', doc_id FROM documents ORDER BY doc_id DESC LIMIT 5) UNION ALL SELECT 'all', item_id FROM benchmark")
def _(tables):
    spark, root = _folder(tables, "splits")
    tables("documents").select("doc_id").write.parquet(f"{root}/train")
    tables("benchmark").selectExpr("item_id AS doc_id").write.parquet(f"{root}/test")
    splits = {"train": f"{root}/train", "test": f"{root}/test"}
    parts = [("first", "train[:10]"), ("share", "train[:25%]"), ("last", "train[-5:]"), ("all", "test")]
    out = [scans.read_split(spark, splits, spec, "doc_id").select(F.lit(name).alias("part"), "doc_id") for name, spec in parts]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("path_expansion", "SELECT 'listed' AS kind, 'r' || r_regionkey AS name FROM region WHERE r_regionkey IN (1, 2) UNION ALL SELECT 'listed', 'absent' UNION ALL SELECT 'existing', 'r' || r_regionkey FROM region UNION ALL SELECT 'sorted', 'r' || r_regionkey FROM region")
def _(tables):
    """A list with quotes, a pattern, a repeated and an absent path; patterns below a root; the files of a folder."""
    spark, root = _folder(tables, "paths")
    for r in tables("region").collect():  # 5 rows
        files.write_text(f"{root}/r{r.r_regionkey}.parquet", "")
    named = lambda paths: [p.rsplit("/", 1)[-1].removesuffix(".parquet") for p in paths]
    listed = scans.expand_paths(f"'{root}/r[12].parquet', {root}/r1.parquet, {root}/absent")
    existing = scans.expand_existing(["r*.parquet", "r1.parquet"], root)
    rows = [(kind, n) for kind, paths in (("listed", listed), ("existing", existing), ("sorted", scans.parquet_files(root))) for n in named(paths)]
    return spark.createDataFrame(rows, "kind string, name string")


# --- JSON ----------------------------------------------------------------------------------------


@query("json_array_read", "SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation")
def _(tables):
    spark, root = _folder(tables, "json")
    files.make_folder(root)
    files.write_text(f"{root}/nation", "\n " + json.dumps([r.asDict() for r in tables("nation").select("n_nationkey", "n_name").collect()]))  # 25 rows; the format is found by the first character
    return json_tables.read_any(spark, f"{root}/nation")


@query("json_object_read", "SELECT count(*) AS regions FROM region")
def _(tables):
    spark, root = _folder(tables, "json")
    files.make_folder(root)
    files.write_text(f"{root}/one.json", json.dumps({"regions": tables("region").count()}, indent=1))
    return json_tables.read_any(spark, f"{root}/one.json")


for _codec in ("none", "gzip"):

    @query(f"jsonl_read_{_codec}", "SELECT event_id, event_type, value FROM events")
    def _(tables, codec=_codec):
        spark, root = _folder(tables, "jsonl")
        tables("events").select("event_id", "event_type", "value").write.option("compression", codec).json(root)
        return json_tables.read_jsonl(spark, root)


@query("stdin_read", "SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation")
def _(tables):
    lines = tables("nation").select("n_nationkey", "n_name").toJSON().collect()  # 25 rows, as if they were piped in
    return json_tables.read_stdin(tables("region").sparkSession, stream=iter(x + "\n" for x in lines))


@query("json_schema_align", "SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN event_type END AS event_type, CASE WHEN event_id % 2 = 0 THEN '{\"v\":' || event_id || '}' ELSE 'plain ' || event_id END AS extra FROM events")
def _(tables):
    """Lines that lack a key, and a key that holds now an object, now a string."""
    spark, root = _folder(tables, "align")
    d = F.col("event_id").cast("string")
    extra = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"v":'), d, F.lit("}"))).otherwise(F.concat(F.lit('"plain '), d, F.lit('"')))
    kind = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit('"event_type":"'), "event_type", F.lit('",'))).otherwise("")
    tables("events").select(F.concat(F.lit('{"event_id":'), d, F.lit(","), kind, F.lit('"extra":'), extra, F.lit("}")).alias("value")).write.text(root)
    return json_tables.read_jsonl(spark, root).select("event_id", "event_type", "extra")


@query("json_convert", "SELECT event_id, event_type, row_number() OVER (ORDER BY event_id) - 1 AS __index_level_0__ FROM events")
def _(tables):
    spark, root = _folder(tables, "convert")
    tables("events").select("event_id", "event_type").write.json(f"{root}/in.jsonl")
    json_tables.convert(spark, f"{root}/in.jsonl", f"{root}/out", "none", 1000, "event_id")
    return spark.read.parquet(f"{root}/out")


# --- sinks ---------------------------------------------------------------------------------------


@query("sink_sized", "SELECT max(n) <= 1000 AS sized, sum(n)::BIGINT AS n FROM (SELECT count(*) AS n FROM documents GROUP BY (doc_id - 1) // 1000)")
def _(tables):
    """No file holds more rows than asked for."""
    spark, root = _folder(tables, "sized")
    sinks.write_parquet(tables("documents").select("doc_id", "text"), root, "zstd", 1000)
    counts = spark.read.parquet(root).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    return counts.agg((F.max("n") <= 1000).alias("sized"), F.sum("n").alias("n"))


@query("sink_indexed", "SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) - 1 AS __index_level_0__ FROM documents")
def _(tables):
    spark, root = _folder(tables, "indexed")
    sinks.write_parquet(tables("documents").select("doc_id", "source"), root, index="doc_id")
    return spark.read.parquet(root)


@query("sink_overwrite", "SELECT doc_id, text FROM documents WHERE lang = 'en'")
def _(tables):
    """A table replaced by a part of itself."""
    spark, root = _folder(tables, "overwrite")
    sinks.write_parquet(tables("documents").select("doc_id", "text", "lang"), root)
    sinks.write_parquet(spark.read.parquet(root).filter("lang = 'en'").drop("lang"), root)
    return spark.read.parquet(root)


@query("report_json", "SELECT count(*) AS inspected, count_if(trim(coalesce(text, '')) = '')::BIGINT AS empty_prompt, avg(length(coalesce(text, ''))) AS mean_prompt_chars FROM documents")
def _(tables):
    spark, root = _folder(tables, "report")
    quality.write_report(tables("documents").select(F.col("text").alias("prompt"), F.col("doc_id").alias("id")), f"{root}/report.json")
    return spark.read.option("multiLine", "true").json(f"{root}/report.json").select("inspected", "empty_prompt", "mean_prompt_chars")


@query(
    "threshold_warnings",
    """WITH r AS (SELECT count_if(trim(coalesce(text, '')) = '') / count(*) AS e FROM documents)
 SELECT unnest(['missing columns: [''difficulty'', ''domain'', ''language'', ''solution'', ''source'', ''verifiable'']', 'empty ratio above 0.01', 'format valid ratio below 0.95', 'messages valid ratio below 0.99', 'verifiable ratio below 0.5']) AS warning FROM r""",
)
def _(tables):
    """Warnings of a table that lacks columns; what is missing counts as blank."""
    spark, root = _folder(tables, "report")
    pair = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    report = quality.write_report(tables("documents").select(F.col("doc_id").alias("id"), F.col("text").alias("prompt"), F.col("text").alias("assistant"), pair.alias("messages")), f"{root}/report.json")
    return spark.createDataFrame([(w,) for w in report["warnings"]], "warning string")


@query("failures_jsonl", "SELECT doc_id, text FROM documents WHERE doc_id % 2 = 1")
def _(tables):
    spark, root = _folder(tables, "failures")
    good = F.concat(F.lit("<think>\n"), "text", F.lit("\n</think>\n<answer>\nit is done\n</answer>"))
    made = tables("documents").filter("text IS NOT NULL").withColumn("said", F.when(F.col("doc_id") % 2 == 0, good).otherwise(F.col("text")))
    sinks.write_jsonl(quality.failures(made, "said").select("doc_id", "text"), root)
    return spark.read.schema("doc_id long, text string").json(root)


@query("append_jsonl", "SELECT item_id, text FROM benchmark")
def _(tables):
    spark, root = _folder(tables, "append")
    for part in (0, 1, 2):
        sinks.append_jsonl(tables("benchmark").filter(F.col("item_id") % 3 == part), root)
    return json_tables.read_jsonl(spark, root).select("item_id", "text")


@query("hub_push", "SELECT item_id, text FROM benchmark")
def _(tables):
    spark, root = _folder(tables, "hub")
    return scans.read(spark, sinks.push(tables("benchmark"), root, "org/benchmark", "small", "v1"))


# --- mixtures over files -------------------------------------------------------------------------


@query("chunk_merge", "SELECT doc_id, text FROM documents")
def _(tables):
    """Rows in chunks of 200, each a file of its own, merged again."""
    spark, root = _folder(tables, "chunks")
    sinks.write_chunks(tables("documents").select("doc_id", "text"), root, 200, "doc_id")
    return scans.read(spark, root)


@query("fixed_chunks", "SELECT CAST(floor((r - 1) / 200) AS BIGINT) AS chunk, count(*) AS n, min(doc_id) AS least FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r FROM documents) GROUP BY 1")
def _(tables):
    return mixture.chunks(tables("documents").select("doc_id"), 200, "doc_id").groupBy("chunk").agg(F.count("*").alias("n"), F.min("doc_id").alias("least"))


# --- generation ----------------------------------------------------------------------------------


def _call(prompt: str) -> str:
    item, _, text = prompt.partition("|")
    if int(item) % 5 == 0:
        raise ValueError("no")
    return f"A{len(text)}"


@query("generation_resume", "SELECT item_id, CASE WHEN item_id % 5 = 0 THEN '__ERROR__ ValueError: no' ELSE 'A' || length(text) END AS cot_content FROM benchmark")
def _(tables):
    """Half of the rows first, as if the run broke off, then all: only what is left is generated, and appended."""
    spark, root = _folder(tables, "generated")
    rows = tables("benchmark").select("item_id", F.concat_ws("|", "item_id", "text").alias("prompt"))
    call = generation.with_retries(_call, 2, 0.0)
    done = generation.resume(spark, rows.filter("item_id % 2 = 0"), root, call, "item_id")
    if generation.resume(spark, rows, root, call, "item_id") != rows.count() - done:
        raise RuntimeError("finished rows were generated again")
    return spark.read.parquet(root).select("item_id", "cot_content")


def _complete(prompt: str) -> dict | None:
    item, _, text = prompt.partition("|")
    if int(item) % 7 == 0:
        return None
    return {"text": f"A{len(text)}", "finish_reason": "stop" if int(item) % 2 else "length", "usage": {"total_tokens": len(text)}}


@query(
    "generation_metadata",
    "SELECT item_id, 'A' || length(text) || ',A' || length(text) AS generations, CASE WHEN item_id % 2 = 1 THEN 'stop,stop' ELSE 'length,length' END AS finish_reasons, 2 * length(text) AS tokens FROM benchmark WHERE item_id % 7 <> 0",
)
def _(tables):
    """Two generations a row with their reasons and usage, in JSON lines; a row that lacks one is left for the next run."""
    spark, root = _folder(tables, "generated")
    rows = tables("benchmark").select("item_id", F.concat_ws("|", "item_id", "text").alias("prompt"))
    generation.resume(spark, rows, root, _complete, "item_id", "json", generation.complete, n=2, attempts=2, backoff=0.0)
    got = spark.read.schema("item_id long, generations array<string>, finish_reasons array<string>, api_metadata array<struct<total_tokens:long>>").json(root)
    tokens = F.aggregate("api_metadata", F.lit(0).cast("long"), lambda a, m: a + m["total_tokens"])
    return got.select("item_id", F.array_join("generations", ",").alias("generations"), F.array_join("finish_reasons", ",").alias("finish_reasons"), tokens.alias("tokens"))


@query("generation_stream", "SELECT item_id, 'A' || length(text) AS cot_content FROM benchmark WHERE item_id % 5 <> 0")
def _(tables):
    """The same over a stream of files, read twice under one checkpoint."""
    spark, root = _folder(tables, "stream")
    rows = tables("benchmark").filter("item_id % 5 <> 0").select("item_id", F.concat_ws("|", "item_id", "text").alias("prompt"))
    rows.write.parquet(f"{root}/in")
    for _ in range(2):
        source = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        generation.stream(source, f"{root}/out", f"{root}/checkpoint", _call).awaitTermination()
    return spark.read.parquet(f"{root}/out").select("item_id", "cot_content")


@query("layout_detection", "SELECT * FROM (VALUES ('conversations', 'ready'), ('chats', 'sharegpt'), ('questions', 'cot'), ('documents', 'text')) v(name, layout)")
def _(tables):
    chats = tables("conversations").groupBy("conv_id").agg(F.collect_list("text").alias("conversations"))
    made = {
        "conversations": chats.withColumnRenamed("conversations", "messages"), "chats": chats, "documents": tables("documents"),
        "questions": tables("documents").selectExpr("source AS question", "text AS output"),
    }
    rows = [(name, chat.detect(df.columns) or "ready") for name, df in made.items()]
    return tables("region").sparkSession.createDataFrame(rows, "name string, layout string")
