"""Every query with an oracle gives its rows on the smallest tables; the rest run."""

import duckdb
import pytest

from tandemsift.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return f"{value:.6f}"
    return [plain(v) for v in value] if isinstance(value, (list, tuple)) else str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_agrees_with_its_oracle(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    got = sorted(str([plain(r[c]) for c in sorted(df.columns)]) for r in df.collect())
    if name not in registry.oracle_sql():
        return
    found = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    want = sorted(str([plain(r[i]) for i in order]) for r in found.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert got == want


@pytest.mark.parametrize("name", ["splice_blocks", "interval_inner_join", "repeat_events", "sequence_complexity", "locus_region_flags"])
def test_no_python_in_plans(spark, name):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
