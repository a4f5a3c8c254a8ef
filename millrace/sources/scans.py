"""Finding and reading Parquet: files, directories, globs, aliases, mixed schemas, per-contest files."""

from __future__ import annotations

import json
import os
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.chat import to_text
from millrace.operators.mixture import row_slice
from millrace.sources import files
from millrace.sources.files import parquet_files

ALIASES = {"data": "data", "local_parquet": "data", "data_subsets": "data/subsets", "subsets": "data/subsets", "subsets_parquet": "data/subsets"}


def expand_paths(spec: str) -> list[str]:
    """Paths of a comma-separated list with quotes and patterns, in order and once each; what matches nothing stays."""
    out: dict[str, str] = {}
    for part in (p.strip().strip("\"'") for p in spec.split(",")):
        for path in (files.matching(part) if files.is_pattern(part) else []) or [part]:
            if path:
                out.setdefault(os.path.normpath(path), path)
    return list(out.values())


def expand_existing(patterns: list[str], root: str = ".") -> list[str]:
    """Files of patterns below root, sorted, once each."""
    return sorted({os.path.normpath(p) for pattern in patterns for p in files.matching(f"{root.rstrip('/')}/{pattern}")})


def resolve(name: str | None, mixture: object = None, root: str = ".", catalog: dict[str, str] | None = None, local: tuple[str, ...] = ()) -> str | None:
    """Where a named dataset lies: a local path, an alias, the data folder for names that end as one of `local`, or the catalog's entry. A mixture wins (None)."""
    if mixture is not None:
        return None
    if not name:
        raise ValueError("Either `dataset_name` or `dataset_mixture` must be provided")
    if name in ALIASES:
        return os.path.join(root, ALIASES[name])
    if parquet_files(name):
        return name
    if local and name.endswith(local) and files.matching(f"{root}/data/*.parquet"):
        return os.path.join(root, "data", "*.parquet")
    if catalog and name in catalog:
        return catalog[name]
    raise FileNotFoundError(name)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet behind a file name, a folder or a pattern; a folder is listed by Spark in one go, however many files it holds."""
    if not files.is_pattern(path) and files.is_folder(path):
        if not files.holds_parquet(path):
            raise FileNotFoundError(path)
        return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[pP][aA][rR][qQ][uU][eE][tT]").parquet(path)
    found = parquet_files(path)
    if not found:
        raise FileNotFoundError(path)
    return spark.read.parquet(*found)


def parse_split(spec: str) -> tuple[str, str | None, str | None]:
    """name, from and to of `train`, `train[:10]`, `train[5:10]`, `test[10%:]` or `train[-10:]`."""
    found = re.fullmatch(r"(\w+)(?:\[(-?\d+%?)?:(-?\d+%?)?\])?", spec.strip())
    if not found:
        raise ValueError(f"not a split: {spec}")
    return found.groups()


def read_split(spark: SparkSession, splits: dict[str, str], spec: str, key: str) -> DataFrame:
    """The rows of a named split that a slice keeps, in the order of key; bounds as Python has them, or per cent of the rows, rounded, halves away from 0."""
    name, start, end = parse_split(spec)
    if name not in splits:
        raise ValueError(f"no split {name}; there are {sorted(splits)}")
    df = read(spark, splits[name])
    if start is None and end is None:
        return df
    total = df.count()

    def place(bound: str | None, default: int) -> int:
        if bound is None:
            return default
        at = int(bound.removesuffix("%"))
        if bound.endswith("%"):
            at = (2 * total * abs(at) + 100) // 200 * (-1 if at < 0 else 1)
        return min(max(at + total if at < 0 else at, 0), total)

    low, high = place(start, 0), place(end, total)
    return row_slice(df, key, low, max(low, high))


def schema_groups(spark: SparkSession, paths: list[str]) -> list[tuple[tuple[str, ...], list[str]]]:
    """Files by their ordered column names, largest group first, then by their first file; tasks read the footers, which is all that is read."""

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs
        import pyarrow.parquet as pq

        for batch in batches:
            names = []
            for path in batch["path"]:
                store, at = pyarrow.fs.FileSystem.from_uri(path) if ":/" in path else (pyarrow.fs.LocalFileSystem(), path)
                with store.open_input_file(at) as file:
                    names.append(json.dumps(pq.read_schema(file).names))
            yield pd.DataFrame({"path": batch["path"], "names": names})

    rows = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(max(1, len(paths)), 1000))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for row in rows.mapInPandas(footers, "path string, names string").orderBy("path").toLocalIterator():
        groups[tuple(json.loads(row.names))].append(row.path)
    return sorted(groups.items(), key=lambda g: (-len(g[1]), g[1]))


def read_largest_group(spark: SparkSession, path: str, warn: Callable[[str], None] = print) -> DataFrame:
    groups = schema_groups(spark, parquet_files(path))
    if len(groups) > 1:
        warn(f"{len(groups)} schemas under {path}; reading the {len(groups[0][1])} files of the most common one")
    return spark.read.parquet(*groups[0][1])


def read_mixed(spark: SparkSession, path: str) -> DataFrame:
    """All groups, each made one text column."""
    frames = [to_text(spark.read.parquet(*found)) for _, found in schema_groups(spark, parquet_files(path))]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def read_union(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several files one after the other, with the union of their columns; all must exist."""
    missing = [p for p in paths if not files.exists(p)]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    out = spark.read.parquet(paths[0])
    for path in paths[1:]:
        out = out.unionByName(spark.read.parquet(path), allowMissingColumns=True)
    return out


def contest_tests(spark: SparkSession, folder: str, contests: list[int]) -> DataFrame:
    """(problem_id, input, output) of the contests that have a file of tests."""
    found = [p for c in sorted(set(contests)) if files.exists(p := f"{folder}/test_cases_{c:04d}.parquet")]
    return spark.read.parquet(*found) if found else spark.createDataFrame([], "problem_id string, input string, output string")


def olympiad_tests(spark: SparkSession, folder: str, years: list[int]) -> DataFrame:
    """(year, problem_id, test_name, test_input, test_output) of the years that have a folder of tests, named by the year."""
    out = spark.createDataFrame([], "year int, problem_id string, test_name string, test_input string, test_output string")
    for year in sorted(set(years)):
        found = parquet_files(f"{folder}/{year}")
        if found:
            out = out.unionByName(spark.read.parquet(*found).select(F.lit(year).alias("year"), "problem_id", "test_name", "test_input", "test_output"))
    return out


def read_upload(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All .json, all .jsonl, or else Parquet."""
    if all(p.endswith(".json") for p in paths):
        return spark.read.option("multiLine", "true").json(paths)
    return spark.read.json(paths) if all(p.endswith(".jsonl") for p in paths) else spark.read.parquet(*paths)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its files give fewer splits than half of them (a small file of one row group); else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df
