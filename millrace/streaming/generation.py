"""Generation that can be resumed: a stream of inputs, a service called for each, results appended."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StringType, StructType

from millrace.operators.resume import left_to_do
from millrace.sources import files


def with_retries(call: Callable[[str], str], attempts: int = 3, backoff: float = 2.0) -> Callable[[str], str]:
    """call, tried again after backoff * 2**n seconds; after the last failure its message as __ERROR__ text."""

    def run(prompt: str) -> str:
        for attempt in range(attempts):
            try:
                return call(prompt)
            except Exception as error:  # noqa: BLE001 - whatever the service raises becomes the row's result
                last = error
                if attempt + 1 < attempts:
                    time.sleep(backoff * 2**attempt)
        return f"__ERROR__ {type(last).__name__}: {last}"

    return run


def generate(rows: DataFrame, call: Callable[[str], str], prompt: str = "prompt", out: str = "cot_content", n: int = 1, concurrency: int = 16) -> DataFrame:
    """rows with n generations each (a string for one, else an array); each task keeps `concurrency` calls in flight."""
    schema = StructType([f for f in rows.schema if f.name != out]).add(out, StringType() if n == 1 else ArrayType(StringType()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                said = list(pool.map(call, [p for p in batch[prompt] for _ in range(n)]))
                batch[out] = said if n == 1 else [said[i : i + n] for i in range(0, len(said), n)]
                yield batch[schema.names]

    return rows.mapInPandas(run, schema)


def complete(rows: DataFrame, call: Callable[[str], dict | None], prompt: str = "prompt", n: int = 1, concurrency: int = 16, attempts: int = 10, backoff: float = 1.0) -> DataFrame:
    """rows with generations, finish_reasons and api_metadata, n entries each, of a service that answers {text, finish_reason, usage}.

    A call that fails or answers nothing is tried again; a row of which a generation is missing after that is dropped, to be resumed later.
    """
    extra = "generations array<string>, finish_reasons array<string>, api_metadata array<map<string, bigint>>"
    names = ["generations", "finish_reasons", "api_metadata"]
    schema = StructType([f for f in rows.schema if f.name not in names] + list(StructType.fromDDL(extra)))

    def answered(text: str) -> dict | None:
        for attempt in range(attempts):
            try:
                if (said := call(text)) is not None:
                    return said
            except Exception:  # noqa: BLE001 - whatever the service raises is tried again
                pass
            if attempt + 1 < attempts:
                time.sleep(backoff)
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                said = list(pool.map(answered, [p for p in batch[prompt] for _ in range(n)]))
                groups = [said[i : i + n] for i in range(0, len(said), n)]
                whole = [all(g is not None for g in group) for group in groups]
                out = batch[whole].copy()
                for name, field in zip(names, ("text", "finish_reason", "usage")):
                    out[name] = [[g.get(field) for g in group] for group, ok in zip(groups, whole) if ok]
                yield out[schema.names]

    return rows.mapInPandas(run, schema)


def resume(spark: SparkSession, rows: DataFrame, target: str, call: Callable[[str], str], key: str, kind: str = "parquet", make: Callable[..., DataFrame] = generate, **k: object) -> int:
    """Generate what target doesn't hold yet and append it there, as Parquet or as JSON lines; how many rows were to do.

    make is generate or complete. Files appear whole, so a run that breaks off leaves no half rows and needs no lock.
    """
    todo = left_to_do(rows, spark.read.format(kind).load(target), key) if files.exists(target) else rows
    n = todo.count()
    if n:
        make(todo, call, **k).write.mode("append").format(kind).save(target)
    return n


def stream(source: DataFrame, target: str, checkpoint: str, call: Callable[[str], str], **k: object) -> StreamingQuery:
    """As resume, over a stream: the checkpoint knows what is done, each batch's files appear whole."""
    return generate(source, call, **k).writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", target).trigger(availableNow=True).start()
