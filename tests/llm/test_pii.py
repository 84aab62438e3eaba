import hashlib
import random
import re

import pyarrow as pa
import pytest

from rowlake.llm import pii
from rowlake.llm.common import table

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    """The contract's patterns as they are written."""
    spans = [(m.start(), i, m.end()) for i, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text) if passes(k, m.group())]
    return sorted(spans)


def added(text):
    base, every = pii.found(text, pii.with_signs(pa.array([text]))[0])
    assert base == brute(text) and set(base) <= set(every)
    return [(pii.KINDS[k], text[s:e]) for s, k, e in every if (s, k, e) not in base]


ODD = [
    "", "@", "a@b", "a@b.c_d@e.f@g.h", "x@@y.z a@b..c a@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 00000000256.1.1.1", "+1 +12345678 +1(2)3-4.5 6789 +",
    "4111 1111 1111 1111-1", "4111-1111-1111-1111 4111  1111", "9" * 3000, "1." * 900, "a" * 9000 + "@" + "b" * 9000, "+1" + "(" * 5000,
    "a@b.c" * 700, "é a@b.cé ١@b.c ٤111 1111 1111 1111", "😀 x@y.zz 😀 +1 (988) 555-2485\n", "a.@.b c%+-@d.e-", "@" * 4000, "0 " * 3000,
]

DISGUISED = {
    "write to jane.doe (at) example (dot) com now": ("email", "jane.doe (at) example (dot) com"),
    "jane dot doe at mail3 dot example dot com.": ("email", "jane dot doe at mail3 dot example dot com"),
    "(jane[AT]example[DOT]org)": ("email", "jane[AT]example[DOT]org"),
    "to а@bсd.com!": ("email", "а@bсd.com"),
    "ｊane＠example．com": ("email", "ｊane＠example．com"),
    "joe@exam​ple.com": ("email", "joe@exam​ple.com"),
    "x a@b (dot) com y": ("email", "a@b (dot) com"),
    "joe42 at example.com": ("email", "joe42 at example.com"),
    "jane&#64;example.com": ("email", "jane&#64;example.com"),
    "call plus four nine one five two three four five six seven eight now": (
        "phone", "plus four nine one five two three four five six seven eight",
    ),
    "+1 (five five five) nine eight seven six five four three": ("phone", "+1 (five five five) nine eight seven six five four three"),
    "＋1 (988) 555‑2485": ("phone", "＋1 (988) 555‑2485"),
    "x 4O41 8949 7460 8795 x": ("card", "4O41 8949 7460 8795"),
    "four zero four one eight nine four nine seven four six zero eight seven nine five": (
        "card", "four zero four one eight nine four nine seven four six zero eight seven nine five",
    ),
    "card double four zero one eight nine four nine seven four six zero eight seven nine nine.": (  # 44041894974608799
        "card", "double four zero one eight nine four nine seven four six zero eight seven nine nine",
    ),
    "card double four zero one eight nine four nine seven four six zero eight seven nine eight.": None,
    "４０４１８９４９７４６０８７９５": (
        "card", "４０４１８９４９７４６０８７９５",
    ),
    "at 192 dot 168 dot 1 dot 10 it is": ("ip", "192 dot 168 dot 1 dot 10"),
    "one nine two dot one six eight dot one dot one zero": ("ip", "one nine two dot one six eight dot one dot one zero"),
    "192[.]168[.]1[.]10": ("ip", "192[.]168[.]1[.]10"),
    "look at the polka dot dresses": None, "meet me at example.com": None, "one of two at three": None, "version 1 point 2": None,
    "Er war null und eins. Un deux trois!": None, "we sat at home. The dot on it": None, "": None,
}


@pytest.mark.parametrize("text", ODD)
def test_plain_spans_are_those_of_the_patterns(text):
    assert pii.found(text)[0] == brute(text)


@pytest.mark.parametrize("text", list(DISGUISED))
def test_disguises_at_their_source_places(text):
    assert added(text) == ([DISGUISED[text]] if DISGUISED[text] else [])
    padded = "😀 Größe\n" + text + "\n​end"
    assert added(padded) == ([DISGUISED[text]] if DISGUISED[text] else [])


def test_random_texts():
    rng = random.Random(11)
    parts = ["a@b.co", " at ", "(dot)", "dot ", "1", "22", ".", " ", "-", "+4", "five ", "six-", "double two ", "O", "x", "é", "а", "​", "com", "@", "[at]", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 30)))
        base, every = pii.found(text)
        assert base == brute(text) and set(base) <= set(every) and every == sorted(every)
        assert pii.found(text, pii.with_signs(pa.array([text]))[0]) == (base, every)
        for step in pii.TRANSDUCERS:
            edits = step(text)
            assert all(a[1] <= b[0] for a, b in zip(edits, edits[1:]))
            whole = pii.Edited(text, edits)
            kept = [i for i in range(len(whole.text)) if whole._char(i)[1] - whole._char(i)[0] == 1]
            places = [whole._char(i)[0] for i in range(len(whole.text))]
            assert places == sorted(places) and kept is not None


def test_long_texts_take_linear_time():
    for text in ("five " * 60_000, "a (at) " * 40_000, "a at b dot " * 30_000, "1O" * 90_000, "а" * 300_000, "x dot " * 50_000 + "at y dot com"):
        pii.found(text)


def expected(doc_id, text):
    base, every = pii.found(text or "")
    assert base == brute(text or "")
    counts = [sum(k == i for _, k, _ in base) for i in range(4)]
    digest = hashlib.sha256(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest()
    return (doc_id, *counts, digest, pii.written(every), len(every) - len(base))


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir.replace("0.001", "0.01"), "documents")
    found = {tuple(r) for r in pii.report(docs).collect()}
    wanted = {expected(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    assert found == wanted and sum(sum(r[1:5]) for r in wanted) > 10


def test_rows_spans_and_masks(spark):
    text = "é jane (at) example (dot) com, 1.2.3.4"
    rows = [(1, text, 3, "x"), (1, text, 3, "x"), (None, None, None, None), (2, "", 0, "é"), (3, "clean", 5, "e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans int, `a``b` string")
    found = [tuple(r) for r in pii.report(docs).collect()]
    assert sorted(found, key=str) == sorted((expected(r[0], r[1]) for r in rows), key=str)
    assert pii.report(docs.limit(0)).count() == 0 and pii.spans(docs.limit(0)).count() == 0
    each = [(1, "email", 2, 29, "jane (at) example (dot) com", True), (1, "ip", 31, 38, "1.2.3.4", False)]
    assert sorted(tuple(r) for r in pii.spans(docs).collect()) == sorted(each * 2)
    masked = pii.mask(docs)
    assert masked.columns == docs.columns
    assert sorted((tuple(r) for r in masked.collect()), key=str) == sorted(
        [(1, "é [EMAIL], [IP]", 3, "x")] * 2 + [(None, None, None, None), (2, "", 0, "é"), (3, "clean", 5, "e")], key=str
    )
    named = spark.createDataFrame([("a'b", "x@y.zz")], "doc_id string, text string")
    assert pii.report(named).first()[:2] == ("a'b", 1)
