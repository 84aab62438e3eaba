import datetime
import decimal
import random

import pytest
from pyspark.sql import functions as F

from rowlake.sources.rdbms import identifier
from rowlake.sources.splits import atoms, equi_depth, interval, literal, packed


def sizes(frame, predicates):
    """Rows of each part; every row must be in exactly one."""
    each = [F.count_if(F.coalesce(F.expr(p), F.lit(False))).alias(f"n{i}") for i, p in enumerate(predicates)]
    met = sum((F.when(F.coalesce(F.expr(p), F.lit(False)), 1).otherwise(0) for p in predicates), F.lit(0))
    found = frame.agg(*each, F.count_if(met != 1).alias("odd")).first()
    assert found["odd"] == 0
    return [found[f"n{i}"] for i in range(len(predicates))]


def frame_of(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(4)


CASES = {
    "even": lambda rng, i: (i, i),
    "one value holds half": lambda rng, i: (5 if rng.random() < 0.5 else i, i),
    "few values": lambda rng, i: (rng.choice([1, 1, 1, 2, 3]), i),
    "one value": lambda rng, i: (9, i),
    "exponential": lambda rng, i: (int(rng.paretovariate(0.5)) % 10**9, i),
    "mostly null": lambda rng, i: (None if rng.random() < 0.7 else i, i),
    "null and one value": lambda rng, i: (None if rng.random() < 0.4 else 3, i),
    "all null": lambda rng, i: (None, i),
}


@pytest.mark.parametrize("case", list(CASES))
def test_no_part_is_above_twice_the_mean(spark, case):
    rng = random.Random(1)
    frame = frame_of(spark, [CASES[case](rng, i) for i in range(4000)], "a bigint, b bigint")
    for parts in (2, 7, 16):
        found = sizes(frame, equi_depth(frame, ["a", "b"], parts, identifier))
        assert max(found) <= 2 * 4000 / len(found) and 0.5 * parts <= len(found) <= 2 * parts + 2


@pytest.mark.parametrize(
    "kind, value",
    [
        ("date", lambda i: datetime.date(2020, 1, 1) + datetime.timedelta(days=i)),
        ("timestamp_ntz", lambda i: datetime.datetime(2020, 1, 1) + datetime.timedelta(milliseconds=i * 7)),
        ("decimal(20,5)", lambda i: decimal.Decimal(i) / 7), ("double", lambda i: i / 3 - 100), ("int", lambda i: -i),
    ],
)
def test_types_and_odd_names(spark, kind, value):
    frame = frame_of(spark, [(value(i % 1000),) for i in range(2000)], f"`a``b c` {kind}")
    found = sizes(frame, equi_depth(frame, ["a`b c"], 8, identifier))
    assert len(found) >= 4 and max(found) <= 2 * 2000 / len(found)


def test_small_inputs(spark):
    frame = frame_of(spark, [(1, 1), (2, 2), (None, None)], "a bigint, b bigint")
    assert sum(sizes(frame, equi_depth(frame, ["a", "b"], 8, identifier))) == 3
    assert equi_depth(frame.where("false"), ["a"], 8, identifier) == ["1 = 1"]
    assert equi_depth(frame, [], 8, identifier) == equi_depth(frame, ["a"], 1, identifier) == ["1 = 1"]
    found = packed(atoms([1, 1, 1, 2, 5, 5], 1, 9), 3)
    assert [interval("a", g[0], g[-1]) for g in found] == ["a <= 1", "a > 1 AND a < 5", "a >= 5"]
    assert [interval("a", g[0], g[-1]) for g in packed(atoms([1, 1, 3, 3], 0, 3), 2)] == ["a < 1", "a = 1", "a > 1 AND a < 3", "a >= 3"]
    assert literal(datetime.date(2024, 1, 2)) == "DATE '2024-01-02'" and literal(decimal.Decimal("1E+3")) == "1000"
