import random
from hashlib import md5, sha256
from zlib import crc32

import pytest

from rowlake.llm import ctph
from rowlake.llm.common import table


def brute_print(text):
    data = text.encode()
    if not data:
        return "1::"
    hashes = []
    for i in range(len(data)):
        value = sum(data[i - j] * pow(0x01000193, j, 2**32) for j in range(min(7, i + 1))) % 2**32
        value ^= value >> 15
        hashes.append((value * 0x9E3779B1 % 2**32) >> 7)

    def letters(size):
        out, start = "", 0
        for i, h in enumerate(hashes):
            if h % size == size - 1 and len(out) < 63:
                out += ctph.LETTERS[crc32(data[max(0, start - 6) : i + 1]) % 64]
                start = i + 1
        return out + (ctph.LETTERS[crc32(data[max(0, start - 6) :]) % 64] if start < len(data) else "")

    size = 1
    while size * 64 < len(data):
        size *= 2
    while size > 1 and sum(h % size == size - 1 for h in hashes) < 32:
        size //= 2
    return f"{size}:{letters(size)}:{letters(2 * size)}"


def brute_kept(a, b):
    run = min(5, len(a), len(b))
    if not run or not any(a[i : i + run] in b for i in range(len(a) - run + 1)):
        return 0.0
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return 2 * row[-1] / (len(a) + len(b))


def brute_rows(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, md5((r[1] or "").encode()).hexdigest()))
    out = []
    for (doc_id, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, following = text or "", following or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, other = brute_print(text), brute_print(changed)
        out.append((doc_id, len(text), sha256(changed.encode()).hexdigest(), own, other, ctph.likeness(own, other), ctph.likeness(own, brute_print(following))))
    return sorted(out, key=str)


def test_likeness_against_table():
    rng = random.Random(4)
    for _ in range(300):
        a = "".join(rng.choices("ABCDE", k=rng.randint(0, 64)))
        b = "".join(x for x in a if rng.random() > 0.2) + "".join(rng.choices("ABCDE", k=rng.randint(0, 9)))
        assert ctph._kept(a, b) == brute_kept(a, b)
    assert ctph.likeness("4:ABCDEF:ABC", "8:ABCDEF:ABC") == ctph._kept("ABC", "ABCDEF")
    assert ctph.likeness("4:ABCDEF:ABC", "16:ABCDEF:ABC") == 0
    assert ctph.likeness("1::", "1::") == 1 and ctph.likeness("1::", "1:A:A") == 0


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    wanted = brute_rows([(r.doc_id, r.text) for r in docs.collect()])
    got = sorted(map(tuple, ctph.compare_with_next(docs).collect()), key=str)
    assert got == wanted
    near = [(r[5], r[6]) for r in got if r[1] > 20]
    assert sum(e > n for e, n in near) > 0.9 * len(near)
    assert {r.doc_id: r.fingerprint for r in ctph.fingerprints(docs).collect()} == {r[0]: r[3] for r in wanted}


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_odd_rows(spark, partitions):
    long = "".join(chr(97 + i * i % 23) for i in range(1_100_000))
    rows = [(5, None), (5, None), (5, "five"), (None, "no id"), (None, None), (1, "x"), (2, "é" * 99), (-7, long[:60_000]), (9, "a" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as bucket", "'z' as k", "true as ahead")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        assert sorted(map(tuple, ctph.compare_with_next(docs).collect()), key=str) == brute_rows(rows)
        alone = ctph.compare_with_next(docs.where("doc_id = 1")).collect()
        assert len(alone) == 1 and alone[0].near_next == 1.0
        assert ctph.compare_with_next(docs.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert ctph.fingerprint(long) != ctph.fingerprint(long[1:]) and len(ctph.rolled(long.encode())) == len(long)
    assert (ctph.rolled(long.encode())[-9:] == ctph.rolled(long[-15:].encode())[-9:]).all()


def test_ids_of_text_and_ranges_in_partitions_of_their_own(spark):
    rows = [(f"it's \"{i:03d}\" \\ `", f"text {i} " * (i % 7)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(5)
    got = {r.doc_id: r for r in ctph.compare_with_next(docs).collect()}
    order = sorted(rows)
    for (i, text), (_, following) in zip(order, [*order[1:], order[0]]):
        assert got[i].edited_sha256 == sha256(ctph.edited(text, following).encode()).hexdigest()
    from pyspark.sql import functions as F

    from rowlake.llm.common import in_order

    parts = in_order(docs).withColumn("p", F.spark_partition_id()).select("p", "bucket").distinct().collect()
    assert len({r.p for r in parts}) == len({r.bucket for r in parts}) == len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
