"""Deterministic sampling, mixing and splitting: the order is that of md5(seed:key), ties by key.

No task sees more than a range of the order: ranks are counted by ranges of the digest, and a sample takes whole
ranges and the first rows of one more.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Up to this many rows a sample is a top-n, which holds them in one task; beyond it, ranges of the order.
TOP_ROWS, RANGES = 10_000, 65_536

DEFAULT_RATIOS = {"numina": 0.60, "codeforces": 0.20, "hotpotqa": 0.12, "openbookqa": 0.08}


def order(key: str, seed: int) -> list[Column]:
    return [F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), F.col(key)]


def _range(digest: Column) -> Column:
    """The digest's range: its first 16 bits."""
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("int")


def sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """The first n rows in hash order, all when there are fewer; rows aren't moved."""
    if n <= TOP_ROWS:
        return df.orderBy(*order(key, seed)).limit(n)
    at = _range(order(key, seed)[0])
    left = n
    for row in df.groupBy(at.alias("at")).agg(F.count("*").alias("n")).orderBy("at").collect():  # RANGES rows at most
        if row.n > left:
            return df.filter(at < row["at"]).unionByName(df.filter(at == row["at"]).orderBy(*order(key, seed)).limit(left))
        left -= row.n
    return df


def take_target(df: DataFrame, target: int, key: str, seed: int = 42, warn: Callable[[str], None] = print) -> DataFrame:
    """target rows in hash order; with a warning, all when there are fewer."""
    total = df.count()
    if total < target:
        warn(f"only {total} of {target} rows")
        return df
    return sample(df, target, key, seed)


def shuffle(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in hash order."""
    return df.orderBy(*order(key, seed))


def chunks(df: DataFrame, size: int, key: str, seed: int = 42, name: str = "chunk") -> DataFrame:
    """df with the number of each row's chunk of `size` rows in hash order, from 0."""
    numbered = ranked(df, key, seed, name)
    return numbered.withColumn(name, F.floor((F.col(name) - 1) / size))


def sample_exact(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    total = df.count()
    if n <= 0 or total == 0:
        raise ValueError("nothing to sample")
    if n > total:
        raise ValueError(f"requested {n} rows of {total}")
    return sample(df, n, key, seed)


def ranked(df: DataFrame, key: str, seed: int, name: str = "rank") -> DataFrame:
    """A global rank from 1 in hash order, by ranges: no single task sees all rows."""
    digest, id_ = order(key, seed)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])  # apart from the columns made here, whatever its columns are called
    rows = df.select(row.alias("row"), digest.alias("digest"), id_.alias("key"), _range(digest).alias("at"))
    counts = rows.groupBy("at").agg(F.count("*").alias("n"))  # RANGES rows at most
    before = F.coalesce(F.sum("n").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.join(F.broadcast(counts.select("at", before.alias("before"))), "at")
    own = F.row_number().over(Window.partitionBy("at").orderBy("digest", "key"))
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c != name]
    return rows.select(*kept, (F.col("before") + own).alias(name))


def sample_with_replacement(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows; every row once before any repeats when n is larger than the table."""
    if n <= 0:
        return df.limit(0)
    total = df.count()
    if n <= total:
        return sample(df, n, key, seed)
    rank = free_name(df)
    times = F.lit(n // total) + F.when(F.col(rank) <= n % total, 1).otherwise(0)
    return replicate(ranked(df, key, seed, rank), times).drop(rank)


def replicate(df: DataFrame, times: Column | int, name: str | None = None) -> DataFrame:
    """Each row so many times; name, if given, numbers the copies from 1. Rows of no times vanish."""
    times = (F.lit(times) if isinstance(times, int) else times).cast("int")
    copy = name or free_name(df)
    copied = df.withColumn(copy, F.explode(F.when(times > 0, F.sequence(F.lit(1), times))))
    return copied if name else copied.drop(copy)


def free_name(df: DataFrame) -> str:
    """A column name that df doesn't have."""
    name = "_rank"
    while name in df.columns:
        name += "_"
    return name


def expand(df: DataFrame, target: int, key: str, seed: int = 42) -> DataFrame:
    """df followed by target - count sampled rows; df itself when it is large enough."""
    missing = target - df.count()
    return df if missing <= 0 else df.unionByName(sample_with_replacement(df, missing, key, seed))


def targets(total: int, ratios: dict[str, float] | None = None) -> dict[str, int]:
    """Rows of each source: shares are cut to whole rows, the rest goes to the first source."""
    ratios = ratios or DEFAULT_RATIOS
    whole = sum(ratios.values())
    if whole <= 0:
        raise ValueError("ratios must add up to more than 0")
    out = {name: int(total * ratio / whole) for name, ratio in ratios.items()}
    out[next(iter(out))] += total - sum(out.values())
    return out


def working_set(available: int, target: int) -> int:
    return min(available, max(3 * target, target + 5000))


def validate_columns(columns: list[list[str] | None]) -> None:
    named = [set(c) for c in columns if c is not None]
    if any(c != named[0] for c in named[1:]):
        raise ValueError("Column names must be consistent across all dataset configurations in a mixture")


def mixture(parts: list[tuple[DataFrame, float]], key: str, seed: int = 42) -> DataFrame:
    """Of each part the share of its weight, in hash order, all together."""
    return reduce(DataFrame.unionByName, [sample(df, int(df.count() * weight), key, seed) for df, weight in parts])


def exact_split(df: DataFrame, test_share: float, key: str, seed: int = 42) -> DataFrame:
    """df with a column split; exactly ceil(share * rows) rows are test."""
    n = math.ceil(test_share * df.count())
    rank = free_name(df)
    return ranked(df, key, seed, rank).withColumn("split", F.when(F.col(rank) <= n, "test").otherwise("train")).drop(rank)


def row_slice(df: DataFrame, key: str, start: int, end: int) -> DataFrame:
    """Rows start to end - 1 in the key's order."""
    return df.orderBy(key).offset(start).limit(end - start)
