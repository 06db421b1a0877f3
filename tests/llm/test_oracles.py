"""Registered queries against their SQL, and on empty tables."""

import pytest
from oracle import compare, duck

from velotide.llm.queries import ORACLE, QUERIES

TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name, sf):
    con = duck(f"/root/testdata/{sf}")
    difference, count = compare(QUERIES[name](spark, f"/root/testdata/{sf}"), con, ORACLE[name])
    assert difference == ""
    assert count > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, name, tmp_path):
    for table, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []


def test_a_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
