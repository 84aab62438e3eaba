r"""Personal data in text, plain or disguised, found where it stands in the source.

Plain identifiers are matched in the text itself (``base``). Then transducers
rewrite the text step by step, and each step keeps the places it has changed:

1. ``glyphs``: letters, digits and marks that look like ASCII ones become these, one for one;
2. ``hidden``: characters without width go;
3. ``digits``: spelled digits (four languages, ``double five``, ``plus``) and letters that stand for digits
   in a number become digits, in runs of numbers only;
4. ``marks``: ``(at)``, ``[dot]``, ``at`` and ``dot`` between the parts of an address become ``@`` and ``.``.

The same matchers run over what comes out, and each match goes back through the
steps to the source characters it was made of. One that lies within a plain
span of its kind adds nothing. Bare words are rewritten only where a mailbox
stands before and a domain of ``ENDINGS`` after them, so prose is left alone.

All work is inside the row, in time linear in the text: no shuffle, nothing
gathered. Places are code points, ends exclusive. A null text is an empty one
and has no spans; repeated rows and rows without an id are scanned like any
other; no rows give no rows; further columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from rowlake.llm.common import per_batch, texts

# The kinds in their order; the characters of a mailbox; digits of a card and of a phone number.
KINDS = ("email", "ip", "card", "phone")
MAILBOX = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (12, 19), (9, 15)

#: Digits as they are spelled, by language.
SPELLED = (
    "zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun",
    "cero uno dos tres cuatro cinco seis siete ocho nueve", "zéro un deux trois quatre cinq six sept huit neuf",
)
DIGIT = {word: str(i) for words in SPELLED for i, word in enumerate(words.split())} | {"oh": "0", "zwo": "2"}
TIMES = {"double": 2, "triple": 3}
#: Spelled digits in a run of numbers from which it is rewritten.
LEAST_SPELLED = 2
#: Letters that stand for digits inside a number.
AS_DIGIT = str.maketrans("OoIl", "0011")
#: Last parts of a domain after bare words; words that prose has after "at" are not among them.
ENDINGS = frozenset("com org net edu gov mil info biz io ai dev app co uk de es fr eu us ca ch nl pl ru jp cn br example test".split())

# What looks like ASCII, by the ASCII that it looks like.
ALIKE = {
    "a": "аɑα", "A": "АΑ", "B": "ВΒ", "c": "сϲ", "C": "СϹ", "d": "ԁ", "e": "еҽ", "E": "ЕΕ", "g": "ɡ", "h": "һ", "H": "НΗ",
    "i": "іıι", "I": "ІΙ", "j": "јϳ", "J": "Ј", "k": "κ", "K": "КΚ", "l": "ӏ", "M": "МΜ", "n": "ո", "N": "Ν", "o": "оοօ",
    "O": "ОΟ", "p": "рρ", "P": "РΡ", "q": "ԛ", "s": "ѕ", "S": "Ѕ", "T": "ТΤ", "u": "υս", "v": "ѵν", "w": "ԝѡ", "W": "Ԝ",
    "x": "хχ", "X": "ХΧ", "y": "уγ", "Y": "УΥ", "z": "ᴢ", "Z": "Ζ", "@": "\ufe6b", ".": "\u2024\u3002\uff61", "+": "\ufb29", "_": "\u2017",
    "-": "\u2010\u2011\u2012\u2013\u2014\u2015\u2212\ufe63",
    " ": "\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000",
}
HIDDEN = re.compile("[\\u00ad\\u034f\\u061c\\u180e\\u200b-\\u200f\\u202a-\\u202e\\u2060-\\u2064\\ufe00-\\ufe0f\\ufeff]+")


def _glyphs() -> dict[int, str]:
    """Characters to ASCII, one for one: by look, by value as a digit, and by compatible form."""
    out = {ord(c): to for to, alike in ALIKE.items() for c in alike}
    for code in (*range(0x80, 0x3100), *range(0xA600, 0xAC00), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200)):
        c = chr(code)
        digit = unicodedata.decimal(c, None)
        plain = str(digit) if digit is not None else unicodedata.normalize("NFKC", c)
        if code not in out and len(plain) == 1 and "!" <= plain <= "~" and c not in "ªº¹²³´¸":
            out[code] = plain
    return out


GLYPHS = _glyphs()

_WORD = "(?:(?:double|triple)[ -])?(?:" + "|".join(sorted(DIGIT, key=len, reverse=True)) + ")"
SPELLED_DIGIT = re.compile(rf"\b{_WORD}\b", re.IGNORECASE)
#: What may stand between two parts of one number.
BETWEEN = re.compile(r"[ \t().,-]{0,4}(?:\b(?:dot|point|punkt|punto)\b[ \t().,-]{0,4})?", re.IGNORECASE)
NUMBER = re.compile(rf"(?P<word>\b{_WORD}\b)|(?P<digits>[0-9]+)", re.IGNORECASE)
PLUS = re.compile(r"\bplus[ \t]{1,3}\Z", re.IGNORECASE)
LETTERED = re.compile(r"(?<![A-Za-z0-9])(?=[OoIl]{0,40}[0-9])(?=[0-9]{0,40}[OoIl])[0-9OoIl]{2,40}(?![A-Za-z0-9])")

_OPEN, _SHUT, _GAP = r"[\[({<]", r"[\])}>]", r"[ \t\n]{0,3}"
AT = re.compile(
    rf"(?P<sure>{_GAP}(?:{_OPEN}{_GAP}(?:at|arroba|@){_GAP}{_SHUT}|&#64;|&#x40;|&commat;){_GAP})"
    r"|(?P<bare>[ \t\n]{1,3}(?:at|arroba|@)[ \t\n]{1,3})|@",
    re.IGNORECASE,
)
_DOT = (
    rf"(?:{_GAP}(?:{_OPEN}{_GAP}(?:dot|point|punkt|punto|\.){_GAP}{_SHUT}|&#46;|&#x2e;|&period;){_GAP}"
    r"|[ \t\n]{1,3}(?:dot|point|punkt|punto)[ \t\n]{1,3})"
)
DOT = re.compile(_DOT, re.IGNORECASE)
DOT_BEFORE = re.compile(rf"{_DOT}\Z", re.IGNORECASE)
#: The longest a disguised dot can be.
DOT_LENGTH = 24
DISGUISED_DOMAIN = re.compile(rf"[A-Za-z0-9-]+(?:(?:{_DOT}|\.)[A-Za-z0-9-]+)+", re.IGNORECASE)
DIGIT_DOT = re.compile(rf"(?<=[0-9]){_DOT}(?=[0-9])", re.IGNORECASE)

#: RE2 patterns, one of which every text with a disguise matches; the others need not be rewritten at all.
_SPELLED_TWICE = rf"\b{_WORD}(?:[ \t().,0-9-]|dot|point|punkt|punto)+(?:(?:double|triple)[ -])?(?:{'|'.join(DIGIT)})\b"
SIGNS = (
    "[" + "".join(f"\\x{{{code:x}}}" for code in sorted(GLYPHS)) + "]",
    "[\\x{ad}\\x{34f}\\x{61c}\\x{180e}\\x{200b}-\\x{200f}\\x{202a}-\\x{202e}\\x{2060}-\\x{2064}\\x{fe00}-\\x{fe0f}\\x{feff}]",
    f"(?i){_SPELLED_TWICE}", "[OoIl][0-9]|[0-9][OoIl]",
    r"(?i)[\[({<][ \t\n]{0,3}(?:at|arroba|@|dot|point|punkt|punto|\.)[ \t\n]{0,3}[\])}>]|&(?:#64|#x40|commat|#46|#x2e|period);",
    r"(?i)[ \t\n](?:at|arroba|@)[ \t\n]{1,3}[a-z0-9-]+\.[a-z0-9-]", r"(?i)[ \t\n](?:dot|point|punkt|punto)[ \t\n]",
)

Span = tuple[int, int, int]  # start, kind, stop


# -- matchers ------------------------------------------------------------------


def _emails(text: str) -> Iterator[tuple[int, int]]:
    low = 0  # no mailbox begins before it: the end of the last match, or beyond the last @
    at = text.find("@")
    while at >= 0:
        own = text[low:at]
        start = low + len(own.rstrip(MAILBOX))
        found = DOMAIN.match(text, at + 1) if start < at else None
        low = at + 1
        if found:
            yield start, found.end()
            low = found.end()
        at = text.find("@", low)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def matches(text: str) -> list[Span]:
    """All identifiers of a text, as they stand there; leftmost ones of each kind, without overlaps."""
    out = [(s, 0, e) for s, e in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p) < 4 or not p[:-3].strip("0") for p in m.group().split(".")) and all(
            int(p[-3:]) <= 255 for p in m.group().split(".")
        ):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = m.group().replace(" ", "").replace("-", "")
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= sum(map(m.group().count, "0123456789")) <= PHONE_DIGITS[1]:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# -- transducers ---------------------------------------------------------------

Edit = tuple[int, int, str]  # source start, source stop, what stands there instead


class Edited:
    """A text after edits, in order and apart from each other, that knows where its characters come from."""

    def __init__(self, text: str, edits: list[Edit]):
        parts, self.begins, self.sources = [], [], []
        at = place = 0
        for start, stop, new in edits:
            for own, source in ((text[at:start], (at, None)), (new, (start, stop))):
                if own:
                    parts.append(own)
                    self.begins.append(place)
                    self.sources.append(source)
                    place += len(own)
            at = stop
        parts.append(text[at:])
        self.begins.append(place)
        self.sources.append((at, None))
        self.text = "".join(parts)

    def _char(self, place: int) -> tuple[int, int]:
        """The source of one character: its place, or the whole of the edit it belongs to."""
        i = bisect_right(self.begins, place) - 1
        start, stop = self.sources[i]
        return (start + place - self.begins[i], start + place - self.begins[i] + 1) if stop is None else (start, stop)

    def source(self, start: int, stop: int) -> tuple[int, int]:
        return self._char(start)[0], self._char(stop - 1)[1]


def hidden(text: str) -> list[Edit]:
    return [] if text.isascii() else [(m.start(), m.end(), "") for m in HIDDEN.finditer(text)]


def _value(word: str) -> str:
    *times, digit = re.split("[ -]", word.lower())
    return DIGIT[digit] * (TIMES[times[0]] if times else 1)


def digits(text: str) -> list[Edit]:
    """Spelled digits in runs of numbers, and letters for digits. Blanks between two spelled digits go."""
    edits: list[Edit] = []
    done = 0
    for first in SPELLED_DIGIT.finditer(text):
        if first.start() < done:
            continue
        # The run of numbers around the word: numerals before it, then words and numerals after it.
        parts = [(first.start(), first.end(), _value(first.group()))]
        while (gap := BETWEEN.match(text, parts[-1][1])) and (m := NUMBER.match(text, gap.end())) and gap.end() - gap.start() > 0:
            parts.append((m.start(), m.end(), _value(m.group()) if m["word"] else ""))
        done = parts[-1][1]
        if sum(1 for p in parts if p[2]) < LEAST_SPELLED:
            continue
        if plus := PLUS.search(text, max(0, first.start() - 8), first.start()):
            edits.append((plus.start(), plus.end(), "+"))
        for i, (start, stop, value) in enumerate(parts):
            if not value:
                continue
            if i and parts[i - 1][2] and not text[parts[i - 1][1] : start].strip(" \t,-"):
                edits.append((parts[i - 1][1], start, ""))
            edits.append((start, stop, value))
    lettered = [(m.start(), m.end(), m.group().translate(AS_DIGIT)) for m in LETTERED.finditer(text)]
    if not lettered:
        return edits
    out: list[Edit] = []
    for edit in sorted(edits + lettered):
        if not out or edit[0] >= out[-1][1]:
            out.append(edit)
    return out


def _mailbox(text: str, low: int, stop: int) -> tuple[int, list[Edit]]:
    """Where the mailbox that ends at ``stop`` begins, not before ``low``, and its disguised dots."""
    edits: list[Edit] = []
    start = low + len(text[low:stop].rstrip(MAILBOX))
    while start < stop and (dot := DOT_BEFORE.search(text, max(low, start - DOT_LENGTH), start)):
        before = low + len(text[low : dot.start()].rstrip(MAILBOX))
        if before == dot.start():
            break
        edits.append((dot.start(), dot.end(), "."))
        start = before
    return start, edits[::-1]


def marks(text: str) -> list[Edit]:
    """Disguised signs of addresses, and dots between digits."""
    edits: list[Edit] = []
    low = 0
    for at in AT.finditer(text):
        if at.start() < low:
            continue
        domain = DISGUISED_DOMAIN.match(text, at.end())
        if not domain:
            continue
        dots = [(m.start(), m.end(), ".") for m in DOT.finditer(text, at.end(), domain.end())]
        plain = at.group() == "@"
        if plain and not dots:
            continue
        start, own = _mailbox(text, low, at.start())
        if start == at.start():
            continue
        box, ending = text[start : at.start()], re.split(r"[^A-Za-z0-9-]+", domain.group())[-1].lower()
        if at["bare"]:
            # Words alone: the domain must end as domains do, and without a disguised dot the mailbox must look like one.
            if ending not in ENDINGS or not (dots or own or "@" in at.group() or re.search(r"[0-9._%+-]", box)):
                continue
        elif not re.fullmatch("[a-z]{2,}", ending):
            continue
        edits += own if not plain or not own else []
        if not plain:
            edits.append((at.start(), at.end(), "@"))
        edits += dots
        low = domain.end()
    between = [(m.start(), m.end(), ".") for m in DIGIT_DOT.finditer(text)]
    if not between:
        return edits
    out: list[Edit] = []
    for edit in sorted(edits + between):
        if not out or edit[0] >= out[-1][1]:
            out.append(edit)
    return out


TRANSDUCERS: tuple[Callable[[str], list[Edit]], ...] = (hidden, digits, marks)


def disguised(text: str) -> list[Span]:
    """Identifiers of the rewritten text, at their places in the source."""
    now = text
    if not text.isascii():
        now = text.translate(GLYPHS)
    steps = []
    for transducer in TRANSDUCERS:
        if edits := transducer(now):
            steps.append(Edited(now, edits))
            now = steps[-1].text
    out = []
    for start, kind, stop in matches(now):
        for step in reversed(steps):
            start, stop = step.source(start, stop)
        out.append((start, kind, stop))
    return out


def found(text: str, signs: bool = True) -> tuple[list[Span], list[Span]]:
    """The plain spans, and those with what disguises add, in order of start, kind and end; without ``signs`` of any, none are sought."""
    base = matches(text)
    if not signs:
        return base, base
    of_kind: list[list[Span]] = [[s for s in base if s[1] == k] for k in range(len(KINDS))]

    def held(span: Span) -> bool:
        # Plain spans of a kind do not overlap, so only the last that begins at or before it can hold it.
        own = of_kind[span[1]]
        i = bisect_right(own, (span[0], span[1], len(text))) - 1
        return i >= 0 and own[i][2] >= span[2]

    return base, sorted({*base, *(s for s in disguised(text) if not held(s))})


def with_signs(column: pa.Array) -> list[bool]:
    """Whether a text matches a pattern that every disguise matches."""
    out = pa.array([False] * len(column))
    for pattern in SIGNS:
        out = pc.or_(out, pc.match_substring_regex(column, pattern))
    return out.to_pylist()


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# -- operators -----------------------------------------------------------------


def _report(batch: pa.RecordBatch) -> pa.RecordBatch:
    column = batch.column("text")
    base, every = zip(*map(found, column.to_pylist(), with_signs(column)), strict=True)
    counts = [pa.array([sum(s[1] == k for s in own) for own in base], pa.int64()) for k in range(len(KINDS))]
    digests = pa.array([hashlib.sha256(written(own).encode()).hexdigest() for own in base])
    added = pa.array([len(e) - len(b) for b, e in zip(base, every, strict=True)], pa.int64())
    columns = [batch.column("doc_id"), *counts, digests, pa.array(map(written, every), pa.string()), added]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])


def report(docs: DataFrame) -> DataFrame:
    """For every row: ``doc_id``, plain spans of each kind, their digest, all spans as text, and how many are disguised."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return per_batch(texts(docs), _report, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added bigint")


def _spans(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    column = batch.column("text")
    for doc_id, text, signs in zip(batch.column("doc_id").to_pylist(), column.to_pylist(), with_signs(column), strict=True):
        base, every = found(text, signs)
        plain = set(base)
        rows += [(doc_id, KINDS[k], s, e, text[s:e], (s, k, e) not in plain) for s, k, e in every]
    columns = list(zip(*rows, strict=True)) or [()] * 6
    kinds = [batch.schema.field("doc_id").type, pa.string(), pa.int32(), pa.int32(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "kind", "start", "stop", "found", "disguised"]
    )


def spans(docs: DataFrame) -> DataFrame:
    """One row per identifier: where it stands, its source text, and whether only the rewritten text shows it."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(
        texts(docs), _spans, f"doc_id {kind}, kind string, start int, stop int, found string, disguised boolean"
    )


def masked(text: str | None) -> str | None:
    """The text with every identifier replaced by its kind; overlapping ones by that of the first."""
    if not text:
        return text
    out, last = [], 0
    for start, kind, stop in found(text)[1]:
        if start >= last:
            out += [text[last:start], f"[{KINDS[kind].upper()}]"]
        last = max(last, stop)
    return "".join([*out, text[last:]])


def mask(docs: DataFrame) -> DataFrame:
    """All rows and columns, identifiers of ``text`` masked; null texts stay null."""
    own = F.pandas_udf(lambda column: column.map(masked, na_action="ignore"), "string")
    return docs.select(*[own("text").alias("text") if c == "text" else docs["`" + c.replace("`", "``") + "`"] for c in docs.columns])
