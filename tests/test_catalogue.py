"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import json
from collections import defaultdict

import duckdb
import pytest

from factlake.plans import catalogue, evidence, facts, frames, media, plans, records, rules  # noqa: F401

from .conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(x):
    return round(x, 9) if isinstance(x, float) else [plain(y) for y in x] if isinstance(x, list | tuple) else x


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA)
    want = duck.sql(catalogue.ORACLE[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    ours = sorted(repr([plain(r[c]) for c in columns]) for r in got.collect())
    at = [want.columns.index(c) for c in columns]
    assert ours == sorted(repr([plain(r[i]) for i in at]) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE)))
def test_query_without_sql_runs(spark, name):
    assert catalogue.QUERIES[name](spark, DATA).count() > 0


def test_clusters_of_all_events(spark):
    values, want = defaultdict(list), set()
    for r in spark.read.parquet(f"{DATA}/events.parquet").select("user_id", "props").collect():
        values[r["user_id"]].append(int(json.loads(r["props"])["k"]))
    for user, ks in values.items():
        found = []
        for k in sorted(ks):
            if found and abs(found[-1][0] - k * found[-1][1]) <= 5 * found[-1][1]:
                found[-1] = found[-1][0] + k, found[-1][1] + 1
            else:
                found.append((k, 1))
        want |= {(user, i, total, n) for i, (total, n) in enumerate(found)}
    got = catalogue.QUERIES["cluster_1d_whole"](spark, DATA).collect()
    assert {(r["user_id"], r["cluster"], r["total"], r["n"]) for r in got} == want
    assert sum(r["n"] for r in got) == sum(map(len, values.values())) > 0
