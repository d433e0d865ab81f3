import ast
from pathlib import Path

import duckdb
import pytest

from lectern.queries import catalogue

ROOT = Path(__file__).resolve().parent.parent


def plain(value):
    if value is None or value != value:
        return None
    return round(float(value), 6) if isinstance(value, float) or hasattr(value, "as_integer_ratio") and not isinstance(value, int) else value


@pytest.fixture(scope="module")
def engine(data):
    con = duckdb.connect()
    for path in Path(data).iterdir():
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, data, engine, name):
    df = catalogue.queries()[name](spark, data)
    columns = sorted(df.columns)
    rows = [tuple(plain(v) for v in r) for r in df.select(columns).collect()]
    sql = catalogue.oracle_sql().get(name)
    if sql:
        want = [tuple(plain(v) for v in r) for r in engine.execute(f"select {', '.join(columns)} from ({sql})").fetchall()]
        assert sorted(rows, key=str) == sorted(want, key=str)
    else:
        assert len(set(map(str, rows))) == len(rows) and (rows or name == "dominant_stem_pair")  # the smallest tables have no such pair


def test_core_stands_alone():
    for path in (ROOT / "lectern").rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(n.startswith("lectern.llm") for n in names), path


def test_entry(spark, data):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["content_hash", "members", "canonical"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
