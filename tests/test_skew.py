"""The chains on tables where single keys hold a third of all rows."""

from __future__ import annotations

import duckdb
import pytest

from compare import TABLES, connect, rows_of
from footfall import registry
from footfall.job import Job

SOURCE = "/root/testdata/sf0.001"
HOT = {
    "orders": "CASE WHEN hash(o_orderkey) % 3 = 0 THEN 8 ELSE o_custkey END AS o_custkey",
    "lineitem": """
        CASE WHEN hash(l_orderkey + l_extendedprice) % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey,
        CASE WHEN hash(l_orderkey * 3 + l_extendedprice) % 3 = 0 THEN 7 ELSE l_suppkey END
          AS l_suppkey""",
    "events": "CASE WHEN hash(event_id) % 3 = 0 THEN 8 ELSE user_id END AS user_id",
    "documents": "CASE WHEN hash(doc_id) % 3 = 0 THEN 'src7' ELSE source END AS source",
}
KEYS = [
    "identity_main_user", "device_region_breadth", "user_similarity", "cf_recommend", "rec_top200",
    "rec_top50", "state_replace_groups", "tag_union", "tag_union_mobile", "dish_mentions",
    "keyword_cooccurrence", "keyword_rec_final", "keyword_hot_top15",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        change = f" REPLACE ({HOT[name]})" if name in HOT else ""
        con.execute(
            f"COPY (SELECT *{change} FROM '{SOURCE}/{name}.parquet') TO '{out}/{name}.parquet'"
        )
    return str(out)


@pytest.fixture(scope="module")
def job(spark, skewed):
    return Job(spark, skewed)


@pytest.mark.parametrize("key", KEYS)
def test_matches_sql(job, skewed, key):
    result = registry.present(getattr(job, key), registry.OUTPUTS[key])
    cur = connect(skewed).execute(registry.oracle(key))
    expected = rows_of([d[0] for d in cur.description], cur.fetchall())
    got = rows_of(result.columns, [tuple(r) for r in result.collect()])
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        for x, y in zip(g, e):
            assert x == (pytest.approx(y, rel=1e-9, abs=2e-3) if isinstance(y, float) else y)
