"""Predicates that cut a table into parts of about equal numbers of rows.

A scan that is cut by equal strides of a column reads most rows in one part
where the values are skewed. Here the cuts are quantiles, so parts are of equal
depth, and a value that alone holds more than a part is cut further by the next
column. The predicates are disjoint and hold for every row, nulls included.
"""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F, types as T

from rowlake.functions.naming import quoted

#: Quantiles that are looked at per part: a value found at two of them is cut off from its neighbours.
STEPS = 8
ACCURACY = 10_000
SPLITTABLE = (T.IntegerType, T.LongType, T.ShortType, T.DecimalType, T.DoubleType, T.FloatType, T.DateType, T.TimestampNTZType)


def literal(value) -> str:
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    return repr(value)


@dataclass(frozen=True)
class Atom:
    """What is not cut any more: a value, or what lies between two. Bounds are (value, whether it belongs), None for none."""

    low: tuple | None
    high: tuple | None
    value: object  # the one value it holds, None for a range
    weight: int  # in steps


def atoms(quantiles: Sequence, least, most) -> list[Atom]:
    """The values of a column by its quantiles, in order. A value at several quantiles stands alone.

    Beyond the least and the largest value, and between whole numbers that follow
    each other, there is nothing to read, so there is no atom; the outer ones are open.
    """
    out: list[Atom] = []
    low = None
    at = 0
    while at < len(quantiles):
        value, n = quantiles[at], 1
        while at + n < len(quantiles) and quantiles[at + n] == value:
            n += 1
        whole = low is not None and isinstance(value, int) and value - low == 1
        begin = None if low is None else (low, False)
        if n == 1:
            out.append(Atom(begin, (value, True), None, 1))
        else:
            nothing = value == least if low is None else whole
            if not nothing:
                out.append(Atom(begin, (value, False), None, 1))
            out.append(Atom(None if low is None and nothing else (value, True), (value, True), value, n))
        low, at = value, at + n
    if out and low == most:
        return [*out[:-1], replace(out[-1], high=None)]
    return [*out, Atom(None if low is None else (low, False), None, None, 1)]


def packed(found: Sequence[Atom], most: int) -> list[list[Atom]]:
    """Neighbours together up to a weight; a heavier one alone."""
    out: list[list[Atom]] = []
    weight = 0
    for atom in found:
        if out and weight + atom.weight <= most:
            out[-1].append(atom)
            weight += atom.weight
        else:
            out.append([atom])
            weight = atom.weight
    return out


def interval(column: str, first: Atom, last: Atom) -> str:
    """The values from the first atom to the last one."""
    if first.low and first.low == last.high:
        return f"{column} = {literal(first.low[0])}"
    bounds = []
    if first.low:
        bounds.append(f"{column} {'>=' if first.low[1] else '>'} {literal(first.low[0])}")
    if last.high:
        bounds.append(f"{column} {'<=' if last.high[1] else '<'} {literal(last.high[0])}")
    return " AND ".join(bounds) or f"{column} IS NOT NULL"


def _quantiles(column: str, steps: int):
    at = F.array(*[F.lit(i / steps) for i in range(1, steps)])
    return F.percentile_approx(quoted(column), at, ACCURACY)


def equi_depth(frame: DataFrame, columns: Sequence[str], parts: int, quote: Callable[[str], str]) -> list[str]:
    """About ``parts`` predicates over the columns, each for about as many rows of the frame as any other.

    Each column after the first costs one more aggregate, and only if values of
    those before it are heavier than a part. What the columns cannot tell apart
    stays together. Only quantiles reach the driver.
    """
    if parts < 2 or not columns:
        return ["1 = 1"]
    steps = parts * STEPS
    name = quote(columns[0])
    own = quoted(columns[0])
    n, nulls, least, largest, found = frame.agg(
        F.count(F.lit(1)), F.count_if(own.isNull()), F.min(own), F.max(own), _quantiles(columns[0], steps)
    ).first()
    if not n:
        return ["1 = 1"]
    # Weights are steps of the rows that have a value; a part is as many steps as make one part of all rows.
    valued = n - nulls
    most = max(1, round(STEPS * n / valued)) if valued else STEPS
    groups = packed(atoms(found, least, largest), most) if valued else []
    heavy = [g[0] for g in groups if len(g) == 1 and g[0].value is not None and g[0].weight > most]
    null_steps = round(nulls * steps / n)
    inner = _inner(frame, columns, heavy, most, null_steps, quote) if len(columns) > 1 else {}
    out = []
    for group in groups:
        whole = interval(name, group[0], group[-1])
        parts_of = inner.get(group[0].value) if group[0] in heavy else None
        out += [f"{whole} AND {p}" for p in parts_of] if parts_of else [whole]
    if nulls:
        out += [f"{name} IS NULL AND {p}" for p in inner[None]] if None in inner else [f"{name} IS NULL"]
    return out


def _inner(frame: DataFrame, columns: Sequence[str], heavy: Sequence[Atom], most: int, null_steps: int, quote) -> dict:
    """Predicates of the next column for each heavy value of the first, ``None`` for the nulls, by one grouped aggregate."""
    wanted = {a.value: -(-a.weight // most) for a in heavy}
    first = quoted(columns[0])
    met = first.isin(list(wanted)) if wanted else F.lit(False)
    if null_steps > STEPS:
        wanted[None] = -(-null_steps // STEPS)
        met = met | first.isNull()
    if not wanted:
        return {}
    # Parts of all heavy values by the finest quantiles that any of them needs.
    finest = max(wanted.values()) * STEPS
    second, name = quoted(columns[1]), quote(columns[1])
    rows = frame.where(met).groupBy(first.alias("value")).agg(
        F.count_if(second.isNull()).alias("nulls"), F.min(second).alias("least"), F.max(second).alias("largest"),
        _quantiles(columns[1], finest).alias("found"),
    )
    out = {}
    for row in rows.collect():
        each = -(-finest // wanted[row["value"]])
        groups = packed(atoms(row["found"], row["least"], row["largest"]), each) if row["found"] else []
        out[row["value"]] = [interval(name, g[0], g[-1]) for g in groups] + ([f"{name} IS NULL"] if row["nulls"] else [])
    return {value: predicates for value, predicates in out.items() if len(predicates) > 1}
