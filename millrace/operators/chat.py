"""Chat layouts: to messages, to one text, and which of them a table has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as t
from millrace.functions.extract import messages


def conversation(prompt: Column, system: str | None = None) -> Column:
    one = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(*([one("system", F.lit(system))] if system else []), one("user", prompt))


def make_conversation(df: DataFrame, prompt_column: str, system: str | None = None) -> DataFrame:
    if prompt_column not in df.columns:
        raise ValueError(f"Dataset Question Field Error: {prompt_column} is not supported.")
    return df.withColumn("prompt", conversation(F.col(prompt_column), system))


def from_sharegpt(turns: Column) -> Column:
    """from and value as role and content; unknown speakers are users."""
    speaker = lambda m: F.lower(t.safe(m["from"]))
    role = lambda m: F.when(speaker(m).isin("gpt", "assistant", "model"), "assistant").when(speaker(m) == "system", "system").otherwise("user")
    return F.transform(turns, lambda m: F.struct(role(m).alias("role"), F.coalesce(m["value"].cast("string"), F.lit("")).alias("content")))


def with_options(question: Column, options: Column) -> Column:
    own = t.safe(options)
    return F.when(own != "", F.concat(t.safe(question), F.lit("\n\nOptions:\n"), own)).otherwise(t.safe(question))


def from_template(template: str, **values: Column) -> Column:
    """template with {name} replaced by the text of each value; null counts as empty. Other braces stay."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def choice_prompt(question: Column, options: Column, answer: Column, instructions: str) -> Column:
    """What asks a model to explain the answer to a question with options."""
    labelled = [F.concat(F.lit(f"{label}: "), F.coalesce(value.cast("string"), F.lit(""))) for label, value in (("Question", question), ("Options", options), ("Correct answer", answer))]
    return F.concat_ws("\n", F.lit(instructions), *labelled, F.lit("Write the output in the exact format (one paragraph):"))


def from_cot(df: DataFrame) -> DataFrame:
    """messages of rows with a question (or prompt), options and a chain of thought."""
    asked = next((c for c in ("question", "prompt") if c in df.columns), None)
    if asked is None:
        raise ValueError("Expected `question` or `prompt` in example")
    other = next((F.col(c) for c in ("response", "output", "completion") if c in df.columns), F.lit(""))
    cot = F.col("cot_content") if "cot_content" in df.columns else F.lit(None).cast("string")
    options = F.col("options") if "options" in df.columns else F.lit(None).cast("string")
    return df.withColumn("messages", messages(with_options(F.col(asked), options), t.safe(F.when(t.safe(cot) != "", cot).otherwise(other))))


def chatml(chat: Column) -> Column:
    line = lambda m: F.concat(F.lit("<|im_start|>"), F.coalesce(m["role"], F.lit("user")), F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit("<|im_end|>"))
    return F.array_join(F.transform(chat, line), "\n")


def detect(columns: list[str]) -> str | None:
    """Which conversion a table needs to become messages; None when it is ready."""
    have = set(columns)
    if "messages" in have:
        return None
    if "conversations" in have:
        return "sharegpt"
    if ("question" in have or "prompt" in have) and have & {"cot_content", "response", "output", "completion"}:
        return "cot"
    return "text"


def to_text(df: DataFrame) -> DataFrame:
    """One text column of any layout, chosen by the table's columns."""
    have, text = df.columns, lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = lambda chat: F.array_join(F.transform(chat, lambda m: F.concat(F.coalesce(m["role"], F.lit("user")), F.lit(": "), F.coalesce(m["content"], F.lit("")))), "\n")
    pair = lambda a, b: F.concat(F.lit("user: "), a, F.lit("\nassistant: "), b)
    if "messages" in have:
        out = turns(F.col("messages"))
    elif "conversations" in have:
        out = turns(from_sharegpt(F.col("conversations")))
    elif {"instruction", "output"} <= set(have):
        more = text("input") if "input" in have else F.lit("")
        out = pair(F.when(more == "", text("instruction")).otherwise(F.concat(text("instruction"), F.lit("\n"), more)), text("output"))
    elif "prompt" in have and {"response", "completion"} & set(have):
        out = pair(text("prompt"), text("response" if "response" in have else "completion"))
    elif {"question", "answer"} <= set(have):
        out = pair(text("question"), text("answer"))
    elif "text" in have:
        out = text("text")
    else:
        strings = [F.nullif(F.col(f.name), F.lit("")) for f in df.schema if f.dataType.typeName() == "string"]
        out = F.coalesce(*strings, F.to_json(F.struct("*")))
    return df.select(out.alias("text"))
