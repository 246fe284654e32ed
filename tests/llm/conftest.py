import duckdb
import pytest


@pytest.fixture()
def against_sql(spark):
    """Checks a frame against DuckDB SQL over small tables given as frames."""

    def check(frame, sql, **tables):
        con = duckdb.connect()
        for name, df in tables.items():
            con.register(f"raw_{name}", df.toArrow())
            con.execute(f"CREATE TABLE {name} AS SELECT * FROM raw_{name}")
        want = con.execute(sql)
        names = [c[0] for c in want.description]
        assert sorted(names) == sorted(frame.columns)
        rows = sorted(want.fetchall(), key=str)
        assert sorted((tuple(r[c] for c in names) for r in frame.collect()), key=str) == rows

    return check
