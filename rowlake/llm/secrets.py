r"""Secrets in text: fixed patterns, and windows of high entropy, as SQL expressions alone.

Patterns give spans by position: a text is split at the matches of a kind, and
the lengths of what lies between and of the matches add up to their places.
Entropy looks at candidate strings (long runs of a character class). A window
slides over each; its character counts change by the one that enters and the
one that leaves, and with them the sum of c·log2(c), which gives the entropy.
Windows at or above the class's threshold make spans, joined where they touch.
A candidate that an allow-list pattern matches whole makes none. The allow-list
never removes a span of the fixed patterns.

All work is inside the row: no shuffle, no Python. Places are code points, ends
exclusive. A null text is an empty one and has no spans; repeated rows and rows
without an id are scanned like any other; columns of the input stay as they are
(names that start with ``__secret_`` are ours); no rows give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# The kinds in their order, their patterns, the group that holds the secret and its least length.
ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])" r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
PATTERNS = {"assign": (ASSIGN, 2, 8), "access": ("(AKIA[A-Z0-9]+)", 1, 16), "hex": ("([0-9a-f]+)", 1, 32)}

#: Per class: the characters that are counted, the run that is a candidate, and the bits from which a window is one.
CLASSES = {
    "entropy_hex": ("0123456789abcdefABCDEF", "[0-9A-Fa-f]{24,}", 3.1),
    "entropy_base64": (
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", "[A-Za-z0-9+/=_-]{20,}", 3.85,
    ),
}
WINDOW = 20
#: A candidate that one of these matches whole is no secret.
ALLOWED = (
    "[0-9-]+",  # numbers and dates
    "[a-z_-]+", "[A-Z_-]+", "[A-Z]?[a-z]+([-_/][A-Z]?[a-z]+)*",  # words, paths of words
    "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",  # UUID
    ".*([Ee]xample|EXAMPLE|[Pp]laceholder|[Xx]{6,}|abcdefghij|ABCDEFGHIJ|0123456789).*",  # stand-ins
)
KINDS = (*PATTERNS, *CLASSES)
REDACTED = "[SECRET]"
#: Entries whose lengths are added up at once; only the cost depends on it.
BLOCK = 64
SPANS = "array<struct<start:int,kind:int,stop:int>>"


def _named(column: str) -> Column:
    """The column of exactly this name."""
    return F.col("`" + column.replace("`", "``") + "`")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _located(frame: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """Adds ``<name>_at`` and ``<name>_len``: first places and lengths of the matches of each pattern."""
    names = list(patterns)
    # Each column is used more than once further up, so Spark computes it once.
    out = frame.withColumns({f"{n}_any": F.expr(f"{text} rlike {_quoted(p)}") for n, p in patterns.items()})
    out = out.withColumns({
        f"{n}_{what}": F.expr(f"if({n}_any, transform({found}, x -> char_length(x)), array())")
        for n, p in patterns.items()
        for what, found in (
            ("len", f"regexp_extract_all({text}, {_quoted(p)}, 0)"), ("gap", f"split({text}, {_quoted(p)}, -1)"),
        )
    })
    out = out.withColumns({
        f"{n}_step": F.expr(f"zip_with(slice({n}_gap, 1, size({n}_len)), {n}_len, (g, l) -> g + l)") for n in names
    })
    out = out.withColumns({
        f"{n}_sum": F.expr(
            f"filter(transform({n}_step, (x, i) -> if(i % {BLOCK} = 0,"
            f" aggregate(slice({n}_step, i + 1, {BLOCK}), 0, (a, y) -> a + y), null)), x -> x is not null)"
        )
        for n in names
    })
    return out.withColumns({
        f"{n}_at": F.expr(
            f"if(size({n}_sum) = 0, array(), transform({n}_step, (x, i) -> {n}_gap[i]"
            f" + aggregate(slice({n}_sum, 1, cast(i / {BLOCK} as int)), 0, (a, y) -> a + y)"
            f" + aggregate(slice({n}_step, i - i % {BLOCK} + 1, i % {BLOCK}), 0, (a, y) -> a + y)))"
        )
        for n in names
    })


def _windows(cand: str, alphabet: str, bits: float) -> str:
    """SQL for the spans, within a candidate, of windows at or above the threshold."""
    logs = "array(" + ", ".join(f"{c * math.log2(c) if c else 0.0!r}D" for c in range(WINDOW + 2)) + ")"
    codes = f"transform(split({cand}, ''), c -> instr('{alphabet}', c))"
    # One step of the fold over (entering, leaving) codes; 0 leaves until the window is full.
    came, went = "a.n[x.enters]", "a.n[x.leaves]"
    total = (
        f"if(x.enters = x.leaves, a.total, a.total + logs[{came} + 1] - logs[{came}]"
        f" + if(x.leaves = 0, 0D, logs[{went} - 1] - logs[{went}]))"
    )
    hot = f"x.stop >= {WINDOW} and {math.log2(WINDOW)!r}D - {total} / {WINDOW} >= {bits!r}D"
    closes = f"({hot}) and a.stop < x.stop - {WINDOW}"
    step = (
        "named_struct('n', if(x.enters = x.leaves, a.n, transform(a.n, (c, k) ->"
        " c + if(k = x.enters, 1, 0) - if(k = x.leaves and k > 0, 1, 0))),"
        f" 'total', {total},"
        f" 'start', if({closes}, x.stop - {WINDOW}, a.start), 'stop', if({hot}, x.stop, a.stop),"
        f" 'done', if({closes} and a.start >= 0, concat(a.done, array(struct(a.start as start, a.stop as stop))), a.done))"
    ).replace("logs[", f"{logs}[")
    moves = (
        f"transform({codes}, (c, i) -> struct(c as enters, if(i < {WINDOW}, 0,"
        f" instr('{alphabet}', substring({cand}, i - {WINDOW} + 1, 1))) as leaves, i + 1 as stop))"
    )
    start = (
        f"named_struct('n', array_repeat(0, {len(alphabet) + 1}), 'total', 0D, 'start', -1, 'stop', -{WINDOW} - 1,"
        " 'done', cast(array() as array<struct<start:int,stop:int>>))"
    )
    finish = "a -> if(a.start < 0, a.done, concat(a.done, array(struct(a.start as start, a.stop as stop))))"
    return f"aggregate({moves}, {start}, (a, x) -> {step}, {finish})"


def spans(docs: DataFrame) -> DataFrame:
    """The rows with ``__secret_base`` and ``__secret_all``: sorted structs of start, kind (its place in ``KINDS``), stop."""
    own = docs.withColumn("__secret_text", F.coalesce("text", F.lit("")))
    names = {k: f"__secret_{k}" for k in KINDS}
    runs = {names[k]: p for k, (p, _, _) in PATTERNS.items()} | {names[k]: p for k, (_, p, _) in CLASSES.items()}
    # The long form of the hex pattern has the same long runs and splits at no other place.
    runs[names["hex"]] = f"[0-9a-f]{{{PATTERNS['hex'][2]},}}"
    out = _located(own, "__secret_text", runs)
    group = _quoted(ASSIGN) + f", {PATTERNS['assign'][1]}"
    out = out.withColumn(
        "__secret_assign_key",
        F.expr(
            f"if({names['assign']}_any, transform(regexp_extract_all(__secret_text, {group}), x -> char_length(x)), array())"
        ),
    )
    base = ", ".join(
        f"filter(transform({n}_at, (s, i) -> struct(s as start, {KINDS.index(k)} as kind, s + {n}_len[i] as stop)),"
        f" (x, i) -> {f'{n}_key' if k == 'assign' else f'{n}_len'}[i] >= {PATTERNS[k][2]})"
        for k, n in names.items() if k in PATTERNS
    )
    allowed = " or ".join(f"word rlike {_quoted(f'^({p})$')}" for p in ALLOWED)
    added = ", ".join(
        f"flatten(zip_with({n}_at, if({n}_any, regexp_extract_all(__secret_text, {_quoted(CLASSES[k][1])}, 0), array()),"
        f" (s, word) -> if({allowed}, array(), transform({_windows('word', CLASSES[k][0], CLASSES[k][2])},"
        f" w -> struct(s + w.start as start, {KINDS.index(k)} as kind, s + w.stop as stop)))))"
        for k, n in names.items() if k in CLASSES
    )
    out = out.withColumns({
        "__secret_base": F.expr(f"cast(array_sort(concat({base})) as {SPANS})"),
        "__secret_more": F.expr(f"cast(concat({added}) as {SPANS})"),
    })
    out = out.withColumn("__secret_all", F.expr("array_sort(concat(__secret_base, __secret_more))"))
    return out.select(*map(_named, docs.columns), "__secret_base", "__secret_all")


def written(column: str) -> str:
    """SQL for ``kind:start:stop`` of each span, joined by commas."""
    kinds = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"concat_ws(',', transform({column}, x -> concat({kinds}[x.kind], ':', x.start, ':', x.stop)))"


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, the number of spans of each pattern, the digest of those and the text of all spans, for every row."""
    counts = [f"cast(size(filter(__secret_base, x -> x.kind = {i})) as bigint) as n_{k}" for i, k in enumerate(PATTERNS)]
    return spans(docs.select("doc_id", "text")).selectExpr(
        "doc_id", *counts, f"sha2({written('__secret_base')}, 256) as base_sha256", f"{written('__secret_all')} as spans"
    )


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns, with every span of ``text`` (overlapping ones as one) replaced by ``[SECRET]``.

    ``n_chars``, where there is one, follows. Rows without a span are not changed.
    """
    joined = (
        "aggregate(__secret_all, cast(array() as array<struct<start:int,stop:int>>), (a, x) ->"
        " if(size(a) > 0 and x.start <= element_at(a, -1).stop,"
        " concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).start as start, greatest(element_at(a, -1).stop, x.stop) as stop))),"
        " concat(a, array(struct(x.start as start, x.stop as stop)))))"
    )
    found = spans(docs).withColumn("__secret_cuts", F.expr(joined))
    kept = (
        "concat(transform(__secret_cuts, (x, i) -> substring(text, if(i = 0, 0, __secret_cuts[i - 1].stop) + 1,"
        " x.start - if(i = 0, 0, __secret_cuts[i - 1].stop))),"
        " array(substring(text, element_at(__secret_cuts, -1).stop + 1)))"
    )
    found = found.withColumn("text", F.expr(f"if(size(__secret_cuts) = 0, text, array_join({kept}, '{REDACTED}'))"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.char_length("text").cast(kind)
        found = found.withColumn("n_chars", F.when(F.size("__secret_cuts") > 0, length).otherwise(F.col("n_chars")))
    return found.select(*map(_named, docs.columns))


def oracle_sql() -> str:
    """The same report for DuckDB, from the same patterns; entropy from the characters of each window."""

    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def matches(kind: str, pattern: str, group: int) -> str:
        return (
            f"select doc_id, {KINDS.index(kind)} as kind, string_split_regex(x, {text(pattern)}) as gaps,"
            f" regexp_extract_all(x, {text(pattern)}, 0) as found, regexp_extract_all(x, {text(pattern)}, {group}) as secrets from t"
        )

    every = [matches(k, p, g) for k, (p, g, _) in PATTERNS.items()] + [matches(k, p, 0) for k, (_, p, _) in CLASSES.items()]
    least = " ".join(f"when {KINDS.index(k)} then {n}" for k, (_, _, n) in PATTERNS.items())
    bits = " ".join(f"when {KINDS.index(k)} then {b!r}" for k, (_, _, b) in CLASSES.items())
    names = " ".join(f"when {i} then '{k}'" for i, k in enumerate(KINDS))
    allowed = " or ".join(f"regexp_full_match(secret, {text(p)})" for p in ALLOWED)
    n_base = len(PATTERNS)
    written = "string_agg(name || ':' || start || ':' || stop, ',' order by start, kind, stop)"
    return f"""
with t as (select doc_id, coalesce(text, '') as x from documents),
m as ({" union all ".join(every)}),
p as (
  select doc_id, kind, found[i] as whole, secrets[i] as secret,
    list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda f: length(f))), 0) as start
  from (select *, unnest(range(1, len(found) + 1)) as i from m)),
base as (
  select doc_id, kind, start::bigint as start, (start + length(whole))::bigint as stop from p
  where kind < {n_base} and length(secret) >= case kind {least} end),
w as (
  select doc_id, kind, start as candidate, start + j as place, list_aggregate(string_split(secret[j + 1 : j + {WINDOW}], ''), 'entropy') as bits
  from (select *, unnest(range(0, length(secret) - {WINDOW} + 1)) as j from p where kind >= {n_base} and not ({allowed}))),
hot as (
  select *, coalesce(place > lag(place) over (partition by doc_id, kind, candidate order by place) + {WINDOW}, true) as fresh
  from w where bits >= case kind {bits} end),
runs as (select *, sum(fresh::int) over (partition by doc_id, kind, candidate order by place) as run from hot),
more as (
  select doc_id, kind, min(place)::bigint as start, (max(place) + {WINDOW})::bigint as stop from runs group by doc_id, kind, candidate, run),
spans as (select *, case kind {names} end as name from (select * from base union all select * from more))
select t.doc_id, {", ".join(f"count(*) filter (kind = {i}) as n_{k}" for i, k in enumerate(PATTERNS))},
  sha256(coalesce({written} filter (kind < {n_base}), '')) as base_sha256, coalesce({written}, '') as spans
from t left join spans using (doc_id) group by t.doc_id
"""
