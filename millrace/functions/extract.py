"""Question-answer layouts to the unified chat record. Missing columns read as null."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as t

NO_REASONING = "I solve this step by step and focus on correctness."


def column(df: DataFrame, *names: str) -> Column:
    """The first of the named columns that is filled in the row."""
    found = [F.col(n).cast("string") for n in names if n in df.columns]
    return t.first_filled(*found) if found else F.lit(None).cast("string")


def final_answer(text: Column) -> Column:
    """The last boxed expression, else the last line without its conjunction."""
    boxed = t.strip(t.last(F.regexp_extract_all(text, F.lit(r"\\boxed\{([^{}]+)\}"), F.lit(1))))
    line = F.regexp_replace(t.last(t.tail_lines(text)), rf"(?i)\A{t.SPACE}*(therefore|thus|so|hence)[,:]?{t.SPACE}*", "")
    return F.coalesce(boxed, t.strip(line), F.lit(""))


def _literal(text: Column) -> Column:
    """text as a pattern that matches itself."""
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def _ascii_lower(text: Column) -> Column:
    """Lower case as patterns have it that ignore case."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def trim_tail(reasoning: Column, answer: Column) -> Column:
    """reasoning without a closing repetition of the answer, with or without its conjunction.

    A pattern made from the answer is compiled for each row, so it runs only where the text ends in the answer, and only over the part it can reach.
    """

    def cut(text: Column, answer: Column, head: str, dot: str, reach: int) -> Column:
        low, end = _ascii_lower(text), _ascii_lower(answer)
        ends = F.endswith(low, end) | F.endswith(low, F.concat(end, F.lit(".")))
        size = F.greatest(F.length(text) - F.length(answer) - reach, F.lit(0))
        pattern = F.concat(F.lit(head), _literal(answer), F.lit(rf"{dot}\z"))
        shorter = F.concat(F.substr(text, F.lit(1), size), F.regexp_replace(F.substr(text, size + 1), pattern, F.lit("")))
        return F.when(ends, t.strip(shorter)).otherwise(text)

    def both(pair: Column) -> Column:
        once = cut(pair["r"], pair["a"], r"(?isd)(Thus|Therefore|Hence|So).{0,30}", r"\.?", 42)
        return t.let(once, lambda r: cut(r, pair["a"], "(?isd)", "", 1))

    trimmed = t.let(F.struct(t.strip(reasoning).alias("r"), answer.alias("a")), both)
    return F.when((reasoning != "") & (answer != ""), trimmed).otherwise(reasoning)


def assistant(reasoning: Column, answer: Column) -> Column:
    filled = lambda c, other: F.coalesce(F.nullif(t.safe(c), F.lit("")), F.lit(other))
    return F.concat(F.lit("<think>\n"), filled(reasoning, NO_REASONING), F.lit("\n</think>\n<answer>\n"), filled(answer, "N/A"), F.lit("\n</answer>"))


def messages(prompt: Column, reply: Column) -> Column:
    return F.array(*[F.struct(F.lit(role).alias("role"), text.alias("content")) for role, text in (("user", prompt), ("assistant", reply))])


def build_id(source: Column, prompt: Column, solution: Column) -> Column:
    return F.concat(F.element_at(F.split(source, "/"), -1), F.lit("-"), F.substring(F.sha1(F.concat_ws("\n", source, prompt, solution).cast("binary")), 1, 16))


def route_hint(domain: Column, verifiable: Column) -> Column:
    domain = F.lower(t.safe(domain))
    return F.when(domain.isin("math", "code") & verifiable, "router->solver->tool->critic->refiner").when(domain.contains("qa"), "router->solver->critic->refiner").otherwise("router->solver->refiner")


def unified(df: DataFrame, prompt: Column, solution: Column, reasoning: Column, source: str, domain: str, verifiable: bool, difficulty: Column | None = None, include_assistant: bool = False, keep_rejects: bool = False) -> DataFrame:
    """The unified record of rows whose prompt and solution are filled; with keep_rejects, a blank record for each other row."""
    rows = df.select(prompt.alias("prompt"), solution.alias("solution"), reasoning.alias("reasoning"), (t.safe(difficulty) if difficulty is not None else F.lit("")).alias("difficulty"))
    filled = (F.col("prompt") != "") & (F.col("solution") != "")
    if not keep_rejects:
        # a filter would be pushed below what makes the columns, with a copy of all of it; a generator is not
        rows = rows.select(F.explode(F.when(filled, F.array(F.struct("*")))).alias("row")).select("row.*")
    rows = rows.withColumn("assistant", assistant(F.col("reasoning"), F.col("solution")))
    out = rows.select(
        build_id(F.lit(source), F.col("prompt"), F.col("solution")).alias("id"), F.lit(source).alias("source"), F.lit(domain).alias("domain"), F.lit("en").alias("language"), F.lit(verifiable).alias("verifiable"),
        "difficulty", "prompt", "solution", messages(F.col("prompt"), F.col("assistant")).alias("messages"), route_hint(F.lit(domain), F.lit(verifiable)).alias("carl_moa_route_hint"),
        F.lit(verifiable or domain == "code").alias("carl_moa_needs_tools"), "assistant",
    )
    if keep_rejects:
        empty = {"boolean": F.lit(False), "array": F.array().cast(out.schema["messages"].dataType)}
        good = F.col("prompt").isNotNull() & (F.col("prompt") != "") & (F.col("solution") != "")
        out = out.select(*[F.when(good, F.col(f.name)).otherwise(empty.get(f.dataType.typeName(), F.lit(""))).alias(f.name) for f in out.schema])
    return out if include_assistant else out.drop("assistant")


def numina(df: DataFrame, source: str, domain: str = "math", verifiable: bool = True, **k: bool) -> DataFrame:
    prompt = t.safe(column(df, "problem", "question", "prompt"))
    solution, cot = t.safe(column(df, "solution", "answer", "final_answer")), t.safe(column(df, "cot", "cot_content", "reasoning", "explanation"))
    rows = df.select(prompt.alias("p"), solution.alias("s"), F.when(cot != "", cot).otherwise(solution).alias("r"), column(df, "difficulty").alias("d"))
    found = t.first_filled(final_answer(F.col("s")), final_answer(F.col("r")), F.col("s"))
    rows = rows.withColumn("a", F.when((F.col("p") != "") & (F.col("s") != ""), found).otherwise(""))
    rows = rows.withColumn("r", t.first_filled(trim_tail(F.col("r"), F.col("a")), F.col("s")))
    return unified(rows, F.col("p"), F.col("a"), F.col("r"), source, domain, verifiable, F.col("d"), **k)


def role_content(chat: Column, role: str) -> Column:
    """What the first message of a role says."""
    own = F.filter(chat, lambda m: F.lower(t.safe(m["role"])) == role.lower())
    return t.safe(F.try_element_at(own, F.lit(1))["content"])


def cpp_block(text: Column) -> Column:
    return t.strip(F.regexp_extract(text, rf"(?is)```(?:cpp|c\+\+|cxx)?{t.SPACE}*(.*?)```", 1))


def codeforces(df: DataFrame, source: str, domain: str = "code", verifiable: bool = True, **k: bool) -> DataFrame:
    chat = "messages" in df.columns
    empty = F.lit("")
    said = role_content(F.col("messages"), "assistant") if chat else empty
    asked = role_content(F.col("messages"), "user") if chat else empty
    labelled = lambda name, label: F.when(t.safe(column(df, name)) != "", F.concat(F.lit(label), t.safe(column(df, name)))).otherwise(empty)
    parts = F.array(t.safe(column(df, "title", "name")), F.coalesce(F.nullif(t.safe(column(df, "statement")), empty), t.safe(column(df, "description"))), labelled("input", "Input: "), labelled("output", "Output: "))
    built = F.array_join(F.filter(parts, lambda x: x != ""), "\n\n")
    rows = df.select(
        F.coalesce(t.first_filled(asked, t.safe(column(df, "prompt", "question", "problem")), built), empty).alias("p"), said.alias("m"),
        t.safe(column(df, "cot", "cot_content", "reasoning", "explanation", "editorial", "tutorial")).alias("r"), t.safe(column(df, "code", "completion", "program")).alias("c"),
        t.safe(column(df, "answer", "final_answer", "solution")).alias("a"), column(df, "difficulty").alias("d"),
    )
    rows = rows.select("p", "d", F.coalesce(t.first_filled(F.col("r"), F.col("m")), empty).alias("r"), F.coalesce(t.first_filled(F.col("c"), cpp_block(F.col("m"))), empty).alias("c"), F.coalesce(t.first_filled(F.col("a"), final_answer(F.col("m"))), empty).alias("a"))
    rows = rows.withColumn("a", t.first_filled(F.col("a"), F.col("c"), F.lit("Implementation provided in reasoning.")))
    rows = rows.withColumn("r", F.when(F.col("c") != "", t.strip(F.concat("r", F.lit("\n\nReference implementation:\n```cpp\n"), "c", F.lit("\n```")))).otherwise(F.col("r")))
    return unified(rows, F.col("p"), F.col("a"), F.col("r"), source, domain, verifiable, F.col("d"), **k)


def hotpot_reasoning(context: Column, supporting: Column) -> Column:
    """The cited sentences with their titles; else the first two sentences of the first two titles."""
    empty = F.array().cast("array<string>")
    docs = F.transform(
        F.arrays_zip(F.coalesce(context["title"], empty).alias("title"), F.coalesce(context["sentences"], F.array().cast("array<array<string>>")).alias("sentences")),
        lambda d: F.struct(t.safe(d["title"]).alias("title"), F.filter(F.transform(F.coalesce(d["sentences"], empty), t.safe), lambda s: s != "").alias("sentences")),
    )
    docs = F.slice(docs, 1, F.least(F.size(F.coalesce(context["title"], empty)), F.size(F.coalesce(context["sentences"], F.array().cast("array<array<string>>")))))
    docs = F.filter(docs, lambda d: d["title"] != "")
    return t.let(docs, lambda known: _evidence(known, supporting))


def _evidence(docs: Column, supporting: Column) -> Column:
    empty = F.array().cast("array<string>")
    cited = F.slice(
        F.arrays_zip(F.coalesce(supporting["title"], empty).alias("title"), F.coalesce(supporting["sent_id"].cast("array<int>"), F.array().cast("array<int>")).alias("at")),
        1, F.least(F.size(F.coalesce(supporting["title"], empty)), F.size(F.coalesce(supporting["sent_id"].cast("array<int>"), F.array().cast("array<int>")))),
    )

    def evidence(c: Column) -> Column:
        sentences = t.last(F.filter(docs, lambda d: d["title"] == t.safe(c["title"])))["sentences"]
        said = F.coalesce(F.when(c["at"] >= 0, F.get(sentences, c["at"])), F.get(sentences, F.lit(0)))
        return F.concat(t.safe(c["title"]), F.lit(": "), said)

    found = F.filter(F.transform(cited, evidence), lambda x: x.isNotNull())
    # a title's last sentences count, in the place of its first
    titles = F.array_distinct(F.transform(docs, lambda d: d["title"]))
    snippets = F.filter(
        F.transform(titles, lambda name: F.struct(name.alias("title"), F.array_join(F.slice(t.last(F.filter(docs, lambda d: d["title"] == name))["sentences"], 1, 2), " ").alias("text"))), lambda s: s["text"] != ""
    )
    fallback = F.slice(F.transform(snippets, lambda s: F.concat(s["title"], F.lit(": "), s["text"])), 1, 2)
    whole = t.strip(F.array_join(F.when(F.size(found) > 0, found).otherwise(fallback), " "))
    return F.coalesce(F.nullif(whole, F.lit("")), F.lit("I identify the relevant facts and connect them to answer the question."))


def hotpot(df: DataFrame, source: str, domain: str = "multihop_qa", verifiable: bool = False, **k: bool) -> DataFrame:
    context = F.col("context") if "context" in df.columns else F.lit(None).cast("struct<title:array<string>,sentences:array<array<string>>>")
    supporting = F.col("supporting_facts") if "supporting_facts" in df.columns else F.lit(None).cast("struct<title:array<string>,sent_id:array<int>>")
    return unified(df, t.safe(column(df, "question")), t.safe(column(df, "answer")), hotpot_reasoning(context, supporting), source, domain, verifiable, **k)


def openbook(df: DataFrame, source: str, domain: str = "science_qa", verifiable: bool = False, **k: bool) -> DataFrame:
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    stems = [F.col("question_stem")] if kinds.get("question_stem") == "string" else []
    stems += [F.col("question.stem")] if kinds.get("question") == "struct" else [F.col("question")] if kinds.get("question") == "string" else []
    stem = F.coalesce(t.first_filled(*[t.safe(s) for s in stems]), F.lit("")) if stems else F.lit("")
    pairs = F.array().cast("array<struct<label:string,text:string>>")
    if kinds.get("choices") == "struct":
        zipped = F.slice(F.arrays_zip(F.col("choices.label").alias("label"), F.col("choices.text").alias("text")), 1, F.least(F.size("choices.label"), F.size("choices.text")))
        pairs = F.coalesce(F.filter(F.transform(zipped, lambda c: F.struct(t.safe(c["label"]).alias("label"), t.safe(c["text"]).alias("text"))), lambda c: (c["label"] != "") & (c["text"] != "")), pairs)
    answer = F.coalesce(t.first_filled(t.safe(column(df, "answerKey")), t.safe(column(df, "answer"))), F.lit(""))
    fact = t.safe(column(df, "fact1", "fact"))
    rows = df.select(stem.alias("q"), pairs.alias("pairs"), F.when(stem != "", answer).otherwise("").alias("a"), fact.alias("f"))
    solution = F.coalesce(t.last(F.filter("pairs", lambda c: c["label"] == F.col("a")))["text"], F.col("a"))
    options = F.array_join(F.transform("pairs", lambda c: F.concat(c["label"], F.lit(". "), c["text"])), "\n")
    solution = F.when(F.col("a") != "", solution).otherwise("")
    prompt = F.when((options == "") | (F.col("q") == ""), F.col("q")).otherwise(F.concat("q", F.lit("\n\nOptions:\n"), options))
    reasoning = F.when(F.col("f") != "", F.concat(F.lit("I use the given science fact and option elimination.\nFact: "), "f")).otherwise("I use science facts and option elimination to choose the best answer.")
    return unified(rows, prompt, solution, reasoning, source, domain, verifiable, **k)


EXTRACTORS = {"numina": numina, "codeforces": codeforces, "hotpotqa": hotpot, "openbookqa": openbook}


def map_record(df: DataFrame, kind: str, source: str, **k: bool) -> DataFrame:
    """Unified records of a table of that kind, a blank one (with an empty id) for each row that gives none."""
    if kind not in EXTRACTORS:
        raise ValueError(f"no extractor for {kind}; there are {sorted(EXTRACTORS)}")
    return EXTRACTORS[kind](df, source, keep_rejects=True, **k)
