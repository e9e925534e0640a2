"""Runs a query's SQL in DuckDB and compares it with Spark's rows, order aside."""

import duckdb

TABLES = "documents pages benchmark labels conversations"


def oracle(sf_dir: str, sql: str):
    db = duckdb.connect()
    for t in TABLES.split():
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db.sql(sql).df()


def assert_same(spark_df, expected) -> None:
    got = spark_df.toPandas()
    names = sorted(got.columns)
    assert names == sorted(expected.columns)
    got, expected = (x[names].sort_values(names).reset_index(drop=True) for x in (got, expected))
    assert len(got) == len(expected)
    for c in names:
        same = (got[c] == expected[c]) | (got[c].isna() & expected[c].isna())
        assert same.all(), (c, got[~same].head(3), expected[~same].head(3))
