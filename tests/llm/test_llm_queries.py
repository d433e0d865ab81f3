from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from lectern.llm import queries

COLUMNS = {
    "p1_found": ["id", "span_start", "span_end"], "p2_found": ["id", "line_no"], "p3_found": ["group_id", "survivor_id", "source_book"], "p4_found": ["id_a", "id_b"], "p5_found": ["id", "field"],
    "p6_found": ["cache_key", "defect"], "p7_found": ["id"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query(spark, data, name):
    assert __spark_entry__.queries()[name] is queries.queries()[name]
    df = queries.queries()[name](spark, data)
    assert df.columns == COLUMNS.get(name, df.columns)
    rows = [tuple(map(str, r)) for r in df.collect()]
    assert rows and len(rows) == len(set(rows))
    if sql := queries.oracle_sql().get(name):
        con = duckdb.connect()
        for path in Path(data).iterdir():
            con.execute(f"create view {path.stem} as select * from '{path}'")
        assert sorted(rows) == sorted(tuple(map(str, r)) for r in con.execute(f"select {', '.join(df.columns)} from ({sql})").fetchall())
