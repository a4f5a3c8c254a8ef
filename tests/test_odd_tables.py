"""Queries against their DuckDB SQL on tables with blank texts and uneven sizes."""

import shutil

import duckdb
import pytest
from oracle import differences

from millrace.plans.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def tables(tmp_path, documents: str) -> str:
    """sf0.001 with other documents."""
    folder = str(tmp_path / "sf")
    shutil.copytree(SF, folder)
    duckdb.execute(f"COPY ({documents.format(documents=f"'{SF}/documents.parquet'")}) TO '{tmp_path}/documents.parquet' (FORMAT parquet)")
    (tmp_path / "sf" / "documents.parquet").unlink()
    shutil.move(tmp_path / "documents.parquet", f"{folder}/documents.parquet")
    return folder


BLANK = "SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 13 = 0 THEN '  ' WHEN doc_id % 17 = 0 THEN '__ERROR__ ' || text ELSE text END AS text, lang, source, n_chars FROM {documents}"


@pytest.mark.parametrize("name", ["mixed_schema_text", "error_rows", "resume_pending"])
def test_blank_texts(spark, tmp_path, name):
    folder = tables(tmp_path, BLANK)
    assert differences(QUERIES[name](spark, folder), ORACLE[name], folder) == ""


def test_half_a_row_of_a_share(spark, tmp_path):
    """A quarter of 10 rows is 3, one of 14 is 4."""
    for n in (10, 14):
        (tmp_path / str(n)).mkdir()
        folder = tables(tmp_path / str(n), f"SELECT * FROM {{documents}} ORDER BY doc_id LIMIT {n}")
        assert differences(QUERIES["split_slice"](spark, folder), ORACLE["split_slice"], folder) == ""
