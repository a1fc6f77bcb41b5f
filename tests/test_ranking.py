import random

import pytest

from tallyboard.operators.ranking import _splitters, with_rank


@pytest.mark.parametrize("count, values, parts", [(0, 1, 64), (1, 1, 64), (700, 1, 5), (3000, 3, 64), (5000, 4000, 16)])
def test_rank_is_the_row_number(spark, count, values, parts):
    rng = random.Random(count)
    rows = [(rng.choice(["a", "b"]), f"U{k}é" * rng.choice([1, 30]), rng.randrange(values) / 7, k) for k in range(count)]
    frame = spark.createDataFrame(rows, "report string, unit_code string, attainment double, n int").repartition(3)
    if count >= 700:
        assert len(_splitters(frame, "attainment", "unit_code", parts)) > 3  # ties are cut too
    for keys in ((), ("report",)):
        found = {r.n: r.rank for r in with_rank(frame, "attainment", "unit_code", keys, parts).collect()}
        expected, last = {}, {}
        for report, unit, value, n in sorted(rows, key=lambda r: (-r[2], r[1])):
            key = report if keys else None
            expected[n] = last[key] = last.get(key, 0) + 1
        assert found == expected


def test_infinite_values(spark):
    frame = spark.createDataFrame([("a", float("inf")), ("b", 0.0), ("c", -1.0)], "u string, v double")
    assert [(r.u, r.rank) for r in with_rank(frame, "v", "u").orderBy("rank").collect()] == [("a", 1), ("b", 2), ("c", 3)]
