"""Byte-pair encoding and decoding of whole texts with a tokenizer file of the ``tokenizers`` format.

Speculate and verify. For each distinct word of a batch, greedy longest match
proposes tokens. A sequence of tokens is what the merges make of a word exactly
if each token is what the merges make of its own characters and each adjacent
pair is compatible: merging the two side by side leaves both whole. All
adjacent pairs of a batch are tested at once, with arrays: along the right edge
of the left token and the left edge of the right one, no merge across may come
before the merge that closes over its parts. Words with an incompatible pair,
or without a full match, are merged exactly, rank by rank.

The file's path is a parameter; its vocabulary is read by each task and cached
for the worker. Supported are files as ``word_bpe_49k.json``: special tokens
cut out first, then NFC, blanks to one space, lower case, a split pattern, the
byte alphabet and a suffix for word ends. Anything else is refused by name.

A null text is an empty one, with no tokens. Repeated rows and rows without an
id are encoded like any other; other columns are not read; no rows, no rows.
Texts of any length are encoded whole; memory goes with one batch of rows.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, pre_tokenizers

from rowlake.llm.common import per_batch, texts

#: Distinct words a worker remembers before it starts anew; a bound of memory that does not change results.
REMEMBERED = 400_000
NEVER = np.int64(1) << 40


def byte_alphabet() -> list[str]:
    """The printable character of each byte, as byte-level vocabularies write it."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class Codec:
    """The vocabulary of one file, with the tables for proposing, testing and merging."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._supported(spec)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.ids | self.special).items()}
        self.special_pattern = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.split = regex.compile(steps[0]["pattern"]["Regex"])
        # For texts with characters on which versions of Unicode differ, the library's own steps.
        library = Tokenizer.from_str(json.dumps({**spec, "model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []}))
        self.normalizer = library.normalizer
        self.splitter = pre_tokenizers.Split(Regex(steps[0]["pattern"]["Regex"]), "removed", invert=True)
        self.settled: set[str] = set()
        self.alphabet = byte_alphabet()
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.rank = {m: r for r, m in enumerate(merges)}
        self._edges(merges)
        self.longest = max(map(len, self.proposable), default=1)
        self.words: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def _supported(spec: dict) -> None:
        model, steps = spec["model"], (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        ok = (
            model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
            and kinds == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and not steps[1]["add_prefix_space"]
            and not steps[1]["use_regex"] and spec["decoder"] is None
            and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not ok:
            raise ValueError("this tokenizer file has parts that are not supported")

    def _edges(self, merges: list[tuple[str, str]]) -> None:
        """Per token: the rank of the merge that makes it and its two parts (-1: a single character)."""
        size = max(self.ids.values()) + 1
        self.made = np.full(size, -1, dtype=np.int64)
        self.left = np.full(size, -1, dtype=np.int64)
        self.right = np.full(size, -1, dtype=np.int64)
        keys, ranks = [], []
        for r, (a, b) in enumerate(merges):
            x, y, z = self.ids[a], self.ids[b], self.ids[a + b]
            if self.made[z] < 0:
                self.made[z], self.left[z], self.right[z] = r, x, y
            keys.append(x * size + y)
            ranks.append(r)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.size = size
        self.pair_keys = np.array(keys, dtype=np.int64)[order]
        self.pair_ranks = np.array(ranks, dtype=np.int64)[order]
        # Only tokens that merging makes of their own characters may be proposed.
        self.proposable = {t: i for t, i in self.ids.items() if self.exact(self._letters(t)) == (i,)}

    def _letters(self, token: str) -> list[str]:
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[: -len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(token)

    def exact(self, letters: list[str]) -> tuple[int, ...]:
        """The merges of lowest rank first, leftmost first among equals."""
        parts: list[str | None] = list(letters)
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        waiting = [(self.rank[p], i, p) for i, p in enumerate(zip(letters, letters[1:])) if p in self.rank]
        heapq.heapify(waiting)
        while waiting:
            _, i, pair = heapq.heappop(waiting)
            j = after[i]
            if j < 0 or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j] = pair[0] + pair[1], None
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            after[j] = -1
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (new := (parts[x], parts[y])) in self.rank:
                    heapq.heappush(waiting, (self.rank[new], x, new))
        return tuple(self.ids[p] for p in parts if p is not None)

    def propose(self, word: str) -> list[int] | None:
        """Greedy longest match over a word of alphabet characters, its end marked."""
        out, at, n = [], 0, len(word)
        while at < n:
            for stop in range(min(n, at + self.longest), at, -1):
                piece = word[at:stop] + (self.suffix if stop == n else "")
                if (found := self.proposable.get(piece)) is not None:
                    out.append(found)
                    at = stop
                    break
            else:
                return None
        return out

    def _across(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, ``NEVER`` where there is none."""
        keys = x * self.size + y
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def compatible(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For each pair of tokens side by side, whether merging leaves both whole.

        Walks back in time: the later made of the two edge tokens is replaced by
        its part at the border. Two parts that stand side by side until one is
        closed over (at ``closes``) must have no merge before that. Equal ranks
        go to the left first: the left token closes before a merge across, a
        merge across before the right token.
        """
        x, y = x.astype(np.int64), y.astype(np.int64)
        good = np.ones(len(x), dtype=bool)
        live = np.arange(len(x))
        closes = np.full(len(x), NEVER, dtype=np.int64)  # twice the rank, plus one for the right side
        while len(live):
            a, b, limit = x[live], y[live], closes[live]
            across = self._across(a, b)
            bad = (across < NEVER) & (2 * across < limit)
            good[live[bad]] = False
            made_a, made_b = 2 * self.made[a], 2 * self.made[b] + 1
            on_left = made_a > made_b
            done = bad | ((self.made[a] < 0) & (self.made[b] < 0))
            x[live] = np.where(on_left, self.right[a], a)
            y[live] = np.where(on_left, b, self.left[b])
            closes[live] = np.where(on_left, made_a, made_b)
            live = live[~done]
        return good

    def learn(self, new: list[str]) -> None:
        """Adds the tokens of words to the memory: propose, test all pairs at once, merge the rest exactly."""
        shown = ["".join(self.alphabet[b] for b in w.encode()) for w in new]
        proposals = [self.propose(s) for s in shown]
        flat = np.array([t for p in proposals if p for t in p], dtype=np.int64)
        owner = np.repeat(np.arange(len(new)), [len(p or ()) for p in proposals])
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        keys, which = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        fits = self.compatible(keys // self.size, keys % self.size)[which]
        failing = set(owner[inside[~fits]].tolist())
        for i, (word, letters, proposal) in enumerate(zip(new, shown, proposals, strict=True)):
            if proposal is None or i in failing:
                self.words[word] = self.exact([*letters[:-1], letters[-1] + self.suffix])
            else:
                self.words[word] = tuple(proposal)

    def pieces(self, text: str) -> list[str | int]:
        """The words of a text, and the ids of special tokens between them."""
        out: list[str | int] = []
        at = 0
        for m in self.special_pattern.finditer(text):
            out += self._plain(text[at : m.start()])
            out.append(self.special[m.group()])
            at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            if not self._settled(text):
                text = self.normalizer.normalize_str(text)
                return [word for word, _ in self.splitter.pre_tokenize_str(text)]
            text = unicodedata.normalize("NFC", text)
            # Lower case goes character by character, without the rule for a final sigma.
            text = "σ".join(t.lower() for t in text.split("Σ"))
        else:
            text = text.lower()
        return self.split.findall(text)

    def _settled(self, text: str) -> bool:
        """Whether all characters are assigned in Python's Unicode tables: versions of Unicode agree on those."""
        new = set(text) - self.settled
        if any(unicodedata.category(c) == "Cn" for c in new):
            return False
        self.settled |= new
        return True

    def encode(self, batch: list[str]) -> list[list[int]]:
        split = [self.pieces(t) for t in batch]
        known = self.words
        fresh = list({p for pieces in split for p in pieces if type(p) is str and p not in known})
        if len(known) + len(fresh) > REMEMBERED:
            self.words = known = {}
            fresh = list({p for pieces in split for p in pieces if type(p) is str})
        if fresh:
            self.learn(fresh)
        out = []
        for pieces in split:
            ids: list[int] = []
            for p in pieces:
                if type(p) is str:
                    ids += known[p]
                else:
                    ids.append(p)
            out.append(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        """The tokens as the vocabulary writes them, one space between them; a file without decoder says no more."""
        names = self.names
        return " ".join([names[i] for i in ids if i in names])


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


#: Characters encoded at once; a longer text is a step of its own.
STEP_CHARS = 2_000_000


def _steps(all_texts: list[str]):
    at = 0
    while at < len(all_texts):
        stop, size = at, 0
        while stop < len(all_texts) and (stop == at or size + len(all_texts[stop]) <= STEP_CHARS):
            size += len(all_texts[stop])
            stop += 1
        yield all_texts[at:stop]
        at = stop


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, counts, id_digests, text_digests = codec(path), [], [], []
        for step in _steps(batch.column("text").to_pylist()):
            for ids in own.encode(step):
                counts.append(len(ids))
                id_digests.append(sha256(" ".join(map(str, ids)).encode()).hexdigest())
                text_digests.append(sha256(own.decode(ids).encode()).hexdigest())
        columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return per_batch(texts(docs), of, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [x for step in _steps(batch.column("text").to_pylist()) for x in codec(path).encode(step)]
        columns = [batch.column("doc_id"), pa.array(map(len, ids), pa.int64()), pa.array(ids, pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids"])

    return per_batch(texts(docs), of, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids array<int>")


def coded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256`` of every row: its tokens, and a digest of the text that these decode to."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, parts, digests_of = codec(path), [], []
        for step in _steps(batch.column("text").to_pylist()):
            ids = own.encode(step)
            digests_of += [sha256(own.decode(x).encode()).hexdigest() for x in ids]
            parts.append(pa.array(ids, pa.list_(pa.int32())))  # four bytes a token, not a list
        ids = pa.concat_arrays(parts)
        columns = [batch.column("doc_id"), pc.list_value_length(ids).cast(pa.int64()), ids, pa.array(digests_of, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(texts(docs), of, f"doc_id {kind}, n_tokens bigint, ids array<int>, decoded_sha256 string")


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """``doc_id, text``: the ids of every row as the vocabulary writes them; null ids are none, unknown ids are left out."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [codec(path).decode(ids or []) for ids in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return per_batch(tokens.select("doc_id", "ids"), of, f"doc_id {tokens.schema['doc_id'].dataType.simpleString()}, text string")
