"""Files through Hadoop's file system, so that any store that Spark reads will do. Paths come back as they were given."""

from __future__ import annotations

import fnmatch
import re

from pyspark.sql import SparkSession


def _fs(path: str):
    spark = SparkSession.active()
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark._jsc.hadoopConfiguration()), made


def _named(status, like: str) -> str:
    """The path of a status, without a scheme where the given path has none."""
    found = status.getPath()
    return found.toString() if "://" in like or like.startswith("file:") else found.toUri().getPath()


def exists(path: str) -> bool:
    fs, made = _fs(path)
    return fs.exists(made)


def is_folder(path: str) -> bool:
    fs, made = _fs(path)
    return fs.exists(made) and fs.getFileStatus(made).isDirectory()


def is_pattern(path: str) -> bool:
    return any(c in path for c in "*?[")


def below(path: str) -> list[str]:
    """All files under a folder, without hidden ones, sorted."""
    fs, made = _fs(path)
    found, out = fs.listFiles(made, True), []
    while found.hasNext():
        name = _named(found.next(), path)
        if not any(part.startswith((".", "_")) for part in name[len(path.rstrip("/")) :].split("/")):
            out.append(name)
    return sorted(out)


def matching(pattern: str) -> list[str]:
    """Files and folders that a pattern matches, sorted; ** stands for folders of any depth."""
    if "**" in pattern:
        root = re.split(r"[*?\[]", pattern, maxsplit=1)[0].rpartition("/")[0] or "."
        rule = re.compile("".join(r"(?:.*/)?" if p == "**/" else fnmatch.translate(p)[len("(?s:") : -len(r")\z")].replace(".*", "[^/]*") for p in re.split(r"(\*\*/)", pattern)) + r"\Z", re.DOTALL)
        return [p for p in below(root) if rule.match(p)] if is_folder(root) else []
    fs, made = _fs(pattern)
    return sorted(_named(s, pattern) for s in fs.globStatus(made) or [])


def parquet_files(path: str) -> list[str]:
    """Files behind a file name, a folder (recursively) or a pattern; sorted, existing, Parquet only."""
    if is_pattern(path):
        found = [f for p in matching(path) for f in (below(p) if is_folder(p) else [p])]
    elif is_folder(path):
        found = below(path)
    else:
        found = [path] if exists(path) else []
    return sorted({p for p in found if p.lower().endswith(".parquet")})


def holds_parquet(folder: str) -> bool:
    """Whether a Parquet file lies below a folder; what is listed up to it is all that is looked at."""
    fs, made = _fs(folder)
    found = fs.listFiles(made, True)
    while found.hasNext():
        name = _named(found.next(), folder)[len(folder.rstrip("/")) :]
        if name.lower().endswith(".parquet") and not any(part.startswith((".", "_")) for part in name.split("/")):
            return True
    return False


def move(source: str, target: str) -> None:
    fs, made = _fs(source)
    if not fs.rename(made, _fs(target)[1]):
        raise OSError(f"{source} could not be moved to {target}")


def remove(path: str) -> None:
    fs, made = _fs(path)
    fs.delete(made, True)


def make_folder(path: str) -> None:
    fs, made = _fs(path)
    fs.mkdirs(made)


def write_text(path: str, text: str) -> None:
    fs, made = _fs(path)
    out = fs.create(made, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
