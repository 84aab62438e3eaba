import hashlib
import re

from rowlake.llm import decontaminate
from rowlake.llm.common import table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    grams = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9)) if w else []:
            grams.setdefault(tuple(w[i : i + 10]), set()).add(str(item) if item is not None else "")
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if of := grams.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= of
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


ITEMS = [
    (10, "One two three four five six seven eight nine ten eleven twelve."), (9, "short item"), (2, None), (3, " ,. "),
    (4, "ten words here a b c d e f g"), (5, "TEN WORDS here a b c d e f g"), (6, "née à la carte"), (None, "solo"),
]
DOCS = [
    (1, None), (2, ""), (3, "... !!"), (4, "one, two; three four five six seven eight nine ten - eleven twelve"),
    (5, "x one two three four five six seven eight nine ten y short ITEM short item"), (6, "item short"),
    (7, "ten words here a b c d e f g h " * 40), (8, "Née à LA carte, NÉE à la carte"), (None, "solo"), (9, "solo"), (9, "solo"),
    (10, "one two three four five six seven eight nine " * 3000),
]


def test_odd_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").selectExpr("*", "1 as doc_id")
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string").selectExpr("*", "'x' as item_id", "0 as words")
    wanted = brute(DOCS, ITEMS)
    assert sorted(map(tuple, decontaminate.report(docs, items).collect()), key=str) == wanted
    assert [r[2] for r in wanted if r[0] == 7] == [400]
    kept = decontaminate.remove_documents(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(
        d for d, r in ((d, brute([d], ITEMS)[0]) for d in DOCS) if not r[5]
    )
    assert decontaminate.report(docs.limit(0), items).count() == 0
    assert decontaminate.report(docs, items.limit(0)).where("contaminated or n_hit > 0").count() == 0


def test_whole_table_and_without_broadcast(spark, sf_dir, monkeypatch):
    folder = sf_dir.replace("0.001", "0.01")
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    wanted = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert sorted(map(tuple, decontaminate.report(docs, items).collect()), key=str) == wanted
    assert sum(r[5] for r in wanted) > 0
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, decontaminate.report(docs, items).collect()), key=str) == wanted
    # Beyond the bound a window takes its own words to the join, not its document's.
    plan = decontaminate._hits(docs, items)._jdf.queryExecution().optimizedPlan().toString()
    (join,) = [line for line in plan.split("\n") if "Join Inner" in line]
    assert "(own#" in join and "words#" not in join.replace("set_words#", "")


def test_no_python_in_the_plan(spark, sf_dir, capsys):
    decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
