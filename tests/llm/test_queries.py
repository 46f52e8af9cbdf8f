"""The registered queries of the subpackage: SQL twins, and what the entry module offers."""

import hashlib
import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from segmart.llm.queries import ORACLE, QUERIES


def test_thirteen_operators_and_the_pipeline():
    names = entry_points.queries()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(QUERIES) <= set(names)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    wanted = connection.sql(ORACLE[name])
    got = QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    assert sorted(wanted.columns) == columns
    places = [wanted.columns.index(c) for c in columns]
    expected = sorted(repr(tuple(row[i] for i in places)) for row in wanted.fetchall())
    assert sorted(repr(tuple(row[c] for c in columns)) for row in got.collect()) == expected


def test_exact_query_has_each_row_once_whatever_its_id(spark, odd_docs, tmp_path):
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op8_exact_dedup"](spark, str(tmp_path)).collect()
    rows = [(r.doc_id, re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")) for r in odd_docs.collect()]
    wanted = []
    for doc_id, norm in rows:
        group = [i for i, other in rows if other == norm]
        keep = min((i for i in group if i is not None), default=None)
        wanted.append((doc_id, keep, len(group), doc_id == keep, hashlib.sha256(norm.encode()).hexdigest()))
    assert sorted(map(repr, wanted)) == sorted(
        repr((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)) for r in got
    )
