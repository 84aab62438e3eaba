from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from rowlake.llm import bpe
from rowlake.llm.common import table

PATH = public_tokenizers.path("word_bpe_49k.json")
THEIRS = Tokenizer.from_file(PATH)


def ids(text):
    return THEIRS.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def own():
    return bpe.Codec(PATH)


ODD = [
    "", " ", "Hello  WORLD, it's 123 <|endoftext|> ça ΑΣ ΣΑΣ ﬁ x\x00y   ", "don't we'll I'VE 'S 's 'tis", "a" * 500, "ab" * 300 + "!" * 99,
    "<|startoftext|><|startoftext|>", "<|END|> <|endoftext|", "é é İstanbul ǅ ß ẞ", "日本語テキスト 한국어 العربية 😀👩‍👩‍👧", "  　﻿​", "١٢٣ ½ Ⅷ",
    "퟿\U0010ffff", "don’t — “quoted”", "e%%% This*** the&&& ea%%%", "ſ K Å",
]


def test_odd_texts(own):
    for text, got in zip(ODD, own.encode(ODD), strict=True):
        assert got == ids(text), text
        assert own.decode(got) == THEIRS.decode(got, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="abcdeghinorst'", max_size=40))
def test_any_text(text):
    assert bpe.codec(PATH).encode([text])[0] == ids(text)


def test_pairs_against_merging(own):
    rng = np.random.default_rng(5)
    inner = [i for t, i in own.proposable.items() if not t.endswith("</w>")]
    ends = [i for t, i in own.proposable.items() if t.endswith("</w>")]
    x, y = rng.choice(inner, 6000), np.concatenate([rng.choice(inner, 3000), rng.choice(ends, 3000)])
    got = own.compatible(x, y)
    for a, b, ok in zip(x.tolist(), y.tolist(), got.tolist(), strict=True):
        merged = own.exact(own._letters(own.names[a]) + own._letters(own.names[b]))
        assert (merged == (a, b)) == ok, (own.names[a], own.names[b])
    assert 0 < got.sum() < len(got)


def test_memory_bound_does_not_change_results(own, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    assert [own.encode([t])[0] for t in ODD] == [ids(t) for t in ODD]


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir.replace("0.001", "0.01"), "documents")
    got = {r.doc_id: tuple(r)[1:] for r in bpe.digests(docs, PATH).collect()}
    for r in docs.select("doc_id", "text").collect():
        want = ids(r.text)
        back = THEIRS.decode(want, skip_special_tokens=False)
        assert got[r.doc_id] == (len(want), sha256(" ".join(map(str, want)).encode()).hexdigest(), sha256(back.encode()).hexdigest())


def test_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "Hi", 6), (2, "x " * 400_000, 7)], "doc_id bigint, text string, ids int")
    got = sorted((r.doc_id or 0, r.n_tokens) for r in bpe.digests(docs, PATH).collect())
    assert got == [(0, 1), (1, 0), (1, 0), (2, 400_000)]
    tokens = bpe.encoded(docs, PATH)
    assert [r.text for r in bpe.decoded(tokens.where("doc_id is null"), PATH).collect()] == ["hi</w>"]
    assert bpe.digests(docs.limit(0), PATH).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Codec(public_tokenizers.path("byte_bpe_50k.json"))
