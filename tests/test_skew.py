"""A third of all rows on one driver: results stay exact and AQE splits the hot join key."""

import random
from collections import Counter

import pytest

from stintwise.operators import careers
from stintwise.schemas import APPEARANCES
from tests.test_operators import _brute_breaks
from tests.test_plans import plan_text

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed_rows(n=30000, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        rows.append((2000 if hot else rnd.randint(1990, 2020), "e", f"c{rnd.randint(0, 40)}",
                     "hot" if hot else f"d{rnd.randint(0, 3000)}", rnd.random() < 0.8, False))
    return rows


def test_hot_driver_debuts_split_and_exact(spark, skew_conf):
    rows = _skewed_rows()
    a = spark.createDataFrame(rows, APPEARANCES).repartition(8)
    df = careers.debuts(a)
    got = Counter(tuple(r) for r in df.collect())
    first = {}
    for y, _, c, d, took, _ in rows:
        if took:
            first[d] = min(first.get(d, y), y)
    want = Counter((d, c, y) for y, _, c, d, _, _ in rows if d in first and first[d] == y)
    assert got == want
    assert "skew=true" in plan_text(df)  # the final adaptive plan, after the action


def test_hot_driver_breaks_exact(spark):
    rnd = random.Random(11)
    rows = [(rnd.randint(1990, 2020), "e", f"c{rnd.randint(0, 60)}",
             "hot" if i % 3 == 0 else f"d{rnd.randint(0, 200)}", rnd.random() < 0.85, False)
            for i in range(6000)]
    a = spark.createDataFrame(rows, APPEARANCES)
    _, want = _brute_breaks(rows, midseason=True)
    assert {tuple(r) for r in careers.breaks(a, midseason=True).collect()} == want
