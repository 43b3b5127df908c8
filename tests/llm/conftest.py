"""Query results against SQL, shared by the tests of this folder."""

import duckdb
import pandas as pd
import pytest


@pytest.fixture
def same_as_sql(spark, sf):
    def check(name):
        from panelflow.llm.queries import ORACLES, QUERIES

        got = QUERIES[name](spark, sf).toPandas()
        db = duckdb.connect()
        for t in ("documents", "pages", "benchmark", "labels"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        want = db.execute(ORACLES[name]).df()
        names = sorted(want.columns)
        assert names == sorted(got.columns)

        def ordered(df):
            return df[names].astype(object).where(df[names].notna(), None).sort_values(names, key=lambda c: c.astype(str)).reset_index(drop=True)

        pd.testing.assert_frame_equal(ordered(got), ordered(want), check_dtype=False)
        return got

    return check
