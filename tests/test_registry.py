import math
from pathlib import Path

import duckdb
import pytest

from siltworks.plans import round_trips as registry


@pytest.fixture(scope="session")
def other(sf):
    con = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(clean(r[i]) for i in order) for r in data), key=str)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_same_rows_as_sql(spark, sf, other, name):
    df = registry.QUERIES[name](spark, sf)
    expected = other.sql(registry.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert rows(df.columns, df.collect()) == rows(expected.columns, expected.fetchall())


def test_entry_works_without_the_training_data_operators(spark):
    import __spark_entry__

    assert {*registry.QUERIES} <= {*__spark_entry__.queries()}
    assert __spark_entry__.entry(spark).columns == ["rule_id", "n"]
