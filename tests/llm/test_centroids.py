import hashlib
import math
import random

import pytest

from rowlake.llm import centroids
from rowlake.llm.common import table


def brute(rows, dimensions, clusters, rounds, seed=centroids.SEED):
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == dimensions and all(e is not None and math.isfinite(e) for e in x):
            kept.append((vec_id, [math.floor(1024 * e) for e in x]))
    def first(r):
        return (r[0] is None, "" if r[0] is None else hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])

    middle = [v for _, v in sorted(kept, key=first)[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(middle))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for i in range(len(middle)):
            own = [v for (_, v), c in zip(kept, of, strict=True) if c == i]
            if own:
                middle[i] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = [(vec_id, *reversed(nearest(v))) for vec_id, v in kept]
    total = {}
    for _, c, d in found:
        total[c] = total.get(c, 0) + d
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(((i, c, d, total[c], sum(total.values()), prints[c]) for i, c, d in found), key=str)


def got(spark, rows, **options):
    frame = spark.createDataFrame([(i, x, "a", 1) for i, x in rows], "vec_id bigint, embedding array<double>, best string, v int")
    return sorted((tuple(r) for r in centroids.report(frame, **options).collect()), key=str)


def test_odd_vectors(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(i % 3, 0.4) for _ in range(4)]) for i in range(60)]
    rows += [(0, rows[0][1]), (3, rows[0][1]), (None, [1.0, 1.0, 1.0, 1.0]), (None, [-0.0004, -0.5, 0.0, 1e-9])]
    rows += [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 2.0, 3.0]), (104, [float("nan")] * 4)]
    rows += [(105, [float("-inf"), 0.0, 0.0, 0.0]), (106, [9.0] * 5), (107, [99999.0, -99999.0, 0.25, -0.25])]
    for clusters, rounds in ((3, 4), (8, 10), (1, 2), (5, 0)):
        expected = brute(rows, 4, clusters, rounds)
        assert got(spark, rows, dimensions=4, clusters=clusters, rounds=rounds) == expected


def test_few_equal_and_no_vectors(spark):
    same = [(i, [0.5, -0.5]) for i in range(6)] + [(6, [2.0, 2.0])]
    assert got(spark, same, dimensions=2, clusters=4) == brute(same, 2, 4, 10)
    assert got(spark, same[:2], dimensions=2) == brute(same[:2], 2, 8, 10)
    assert got(spark, [(1, [1.0])], dimensions=2) == [] and got(spark, [], dimensions=2) == []


def test_values_that_do_not_fit_are_an_error(spark):
    with pytest.raises(Exception, match="too large to cluster"):
        got(spark, [(1, [1e30, 0.0])], dimensions=2)


def test_given_table_against_brute_force(spark, sf_dir):
    frame = table(spark, sf_dir, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in frame.select("vec_id", "embedding").collect()]
    found = sorted((tuple(r) for r in centroids.report(frame).collect()), key=str)
    assert found == brute(rows, 64, 8, 10) and len({r[1] for r in found}) > 1


def test_no_python_in_a_round(spark, sf_dir, capsys):
    whole = centroids.whole_vectors(table(spark, sf_dir, "embeddings"))
    centroids.assigned(whole, [[1] * 64, [2] * 64]).groupBy("cluster").count().explain()
    plan = capsys.readouterr().out
    assert "zip_with" in plan or "zipwith" in plan
    assert "Python" not in plan and "Arrow" not in plan
