"""Every registered query with SQL gives the same rows in DuckDB."""

import datetime
import math

import duckdb
import pytest

from pickspark import queries, registry
from pickspark.plans import planning

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str([plain(x) for x in v]) if isinstance(v, list | tuple) else str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_as_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    found = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    rows = [dict(zip(names, r)) for r in found.fetchall()]
    assert mine == sorted(tuple(plain(r[c]) for c in columns) for r in rows)


def test_queries_without_sql_have_a_plain_version():
    """The classification chain is compared with plain steps in test_signal_chain.py."""
    assert registry.QUERIES.keys() - registry.ORACLES.keys() == {"j03_classification_job"}


def test_listings_are_whole(spark):
    rows = lambda name: [tuple(r) for r in registry.QUERIES[name](spark, SF).collect()]
    v = queries.Views(spark, SF)
    units = planning.plan(v.stations, queries.DAY0, queries.DAY1).collect()
    days = {(p.tid, p.peak.strftime("%Y.%j")) for p in v.picks.select("tid", "peak").collect()}
    covered = {(tid, day, u.shard_id) for tid, day in days for u in units if tid in u.stations and u.start <= day < u.end}
    found = rows("c07_covering_units")
    assert len(found) == len(covered) > 0 and set(found) == covered
    first, listing = rows("f02_time_ordered"), rows("f02_time_ordered_all")
    assert len(listing) > len(first) == 100 and listing == sorted(listing, key=lambda r: (r[2], r[0])) and listing[:100] == sorted(first, key=lambda r: (r[2], r[0]))
