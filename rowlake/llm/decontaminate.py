r"""Benchmark passages in documents: normalised n-grams in a broadcast hash set.

Texts are lower-cased (A-Z only) and cut into words of ASCII digits, letters
and all characters from U+0080 on. The windows of the benchmark (ten words; a
shorter item is one window of its own length) become one 64-bit hash each.
Every window of a document is hashed inside its row and looked up; a hit counts
only if its words are the window's words. Beyond ``BROADCAST_BYTES`` of windows
the lookup is a shuffled join, to which each window takes its own words and no
more; the result is the same. Python is not used.

A document without words (null, empty, punctuation) has no hits; an item
without words has no windows. Rows that agree in id and text get the same
result, one row each. A null ``doc_id`` is a value like any other. Items with a
null id count, under the empty name. Other columns are not read. No documents:
no rows; no items: no hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowlake.llm.common import cut

WINDOW = 10
#: Windows are broadcast while hash, words and item ids together stay below this.
BROADCAST_BYTES = 64 << 20
GAP = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WORDS = (
    "filter(split(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    f" '{GAP}'), w -> w <> '')"
)
#: The place of the row that carries a document's word count through the lookup.
COUNT_ROW = -1


def _hash(words: str, at: str, n: int) -> str:
    return "xxhash64(" + ", ".join(f"{words}[{at} + {k}]" for k in range(n)) + ")"


def windows(benchmark: DataFrame) -> DataFrame:
    """``gram, n, words, items``: each distinct window, its hash, and the distinct ids of the items that have it."""
    items = benchmark.selectExpr("coalesce(cast(item_id as string), '') as item", f"{WORDS.format(text='text')} as words")
    placed = items.where("size(words) > 0").selectExpr(
        "item", f"least(size(words), {WINDOW}) as n", "words as all",
        f"explode(sequence(0, greatest(size(words) - {WINDOW}, 0))) as at",
    ).selectExpr("item", "n", "slice(all, at + 1, n) as words")
    by_n = "case n " + " ".join(f"when {n} then {_hash('words', '0', n)}" for n in range(1, WINDOW + 1)) + " end"
    return placed.groupBy("n", "words").agg(F.sort_array(F.collect_set("item")).alias("items")).selectExpr(
        f"{by_n} as gram", "n", "words", "items"
    )


def _hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, text_key, at, n, items``: all windows that occur, and for each row of a document one with ``at`` = -1
    and its word count as ``n``."""
    grams = cut(windows(benchmark))
    lengths, size = grams.agg(
        F.sort_array(F.collect_set("n")), F.sum(F.expr("64 + length(concat_ws(' ', words)) + 16 * size(items)"))
    ).first()
    words = docs.selectExpr("doc_id", "md5(coalesce(text, '')) as text_key", f"{WORDS.format(text='text')} as words")
    # A row that is shuffled takes its own words along; one that stays where it is can look them up in its document.
    stays = (size or 0) <= BROADCAST_BYTES
    own = "" if stays else ", slice(words, {at}, {n}) as own"
    # ``words`` is used many times, so Spark computes it once. Hashes of each window length, then the row of the count.
    per_length = [
        f"if(size(words) < {n}, array(), transform(sequence(0, greatest(size(words) - {n}, 0)),"
        f" i -> struct(i as at, {n} as n, {_hash('words', 'i', n)} as gram{own.format(at='i + 1', n=n)})))"
        for n in lengths
    ]
    count = f"array(struct({COUNT_ROW} as at, size(words) as n, cast(0 as bigint) as gram{own.format(at=1, n=0)}))"
    kept = ["words"] if stays else []
    placed = words.selectExpr("doc_id", "text_key", *kept, f"inline(concat({', '.join([*per_length, count])}))")
    marks = grams.selectExpr("n as set_n", "gram as set_gram", "words as set_words", "items").unionByName(
        docs.sparkSession.sql(
            f"select {COUNT_ROW} as set_n, cast(0 as bigint) as set_gram, cast(array() as array<string>) as set_words,"
            " cast(array() as array<string>) as items"
        )
    )
    if stays:
        marks = F.broadcast(marks)
    its_words = "slice(words, at + 1, n)" if stays else "own"
    same = F.expr(
        f"gram = set_gram and if(at = {COUNT_ROW}, {COUNT_ROW}, n) = set_n and (at = {COUNT_ROW} or {its_words} = set_words)"
    )
    return placed.join(marks, same).select("doc_id", "text_key", "at", "n", "items")


#: Words inside any of the sorted (at, n) windows.
COVERED = (
    "aggregate(hits, struct(0 as words, 0 as stop), (a, x) -> struct("
    "a.words + greatest(x.at + x.n - greatest(x.at, a.stop), 0) as words, greatest(a.stop, x.at + x.n) as stop),"
    " a -> a.words)"
)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, text_key, n_words, n_hit, n_items, items, hits`` for every distinct pair of id and text; ``rows`` counts its rows."""
    found = _hits(docs, benchmark).groupBy("doc_id", "text_key").agg(
        F.count_if(F.col("at") == COUNT_ROW).alias("rows"),
        F.max(F.when(F.col("at") == COUNT_ROW, F.col("n"))).cast("bigint").alias("n_words"),
        F.sort_array(F.collect_set(F.when(F.col("at") != COUNT_ROW, F.struct("at", "n")))).alias("hits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return found.selectExpr(
        "doc_id", "text_key", "rows", "n_words", f"cast({COVERED} as bigint) as n_hit",
        "cast(size(items) as bigint) as n_items", "items", "hits",
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, words hit, items with occurring windows, a digest of their ids, contaminated or not."""
    return contamination(docs, benchmark).selectExpr(
        "explode(array_repeat(struct(doc_id, n_words, n_hit, n_items, sha2(concat_ws(',', items), 256) as items_sha256,"
        " n_hit > 0 as contaminated), cast(rows as int))) as r"
    ).select("r.*")


def remove_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All columns of the rows in which no window occurs."""
    hit = contamination(docs, benchmark).where("n_hit > 0").selectExpr("doc_id as __hit_id", "text_key as __hit_key")
    met = docs["doc_id"].eqNullSafe(hit["__hit_id"]) & (F.md5(F.coalesce(docs["text"], F.lit(""))) == hit["__hit_key"])
    return docs.join(hit, met, "left_anti")


ORACLE_SQL = r"""
with words as (
  select 'd' as kind, doc_id as id, null as item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
  union all
  select 'b', null, item_id::varchar,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
grams as (
  select distinct item, least(len(w), 10) as n, w[i : i + least(len(w), 10) - 1] as g from (
    select item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as i from words where kind = 'b' and len(w) > 0)),
sizes as (select distinct n from grams),
placed as (
  select id, n, i, w[i : i + n - 1] as g from (
    select id, w, n, unnest(range(1, len(w) - n + 2)) as i from words, sizes where kind = 'd' and len(w) >= n)),
hits as (select id, i, n, item from placed join grams using (n, g)),
covered as (
  select id, count(distinct p) as n_hit from (select id, unnest(range(i, i + n)) as p from hits) group by id),
items as (
  select id, count(*) as n_items, string_agg(item, ',' order by item) as joined
  from (select distinct id, item from hits) group by id)
select d.id as doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(joined, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from words d left join covered using (id) left join items using (id) where kind = 'd'
"""
