"""Op 3 against the tokenizers library, and its streaming against one-window merging."""

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelspark.llm import op3_bpe
from llm_fixtures import docs_of  # noqa: F401

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
REF = Tokenizer.from_file(PATH)
MINE = op3_bpe.Transducer(op3_bpe.read_vocabulary(open(PATH, encoding="utf-8").read()))
PARTS = [" ", "\n", "  ", "\t", "a", "the", "<|endoftext|>", "<|endof", "'s", "'LL", "é", "ß", "日本", "🙂", " ", "　", "\x1c", "\x85", "123", "²", "Ⅷ", "_", "aaaa", "́", "﻿", "\x00", "\r\n", "Ġ"]


@given(st.lists(st.sampled_from(PARTS), max_size=40))
@settings(max_examples=400, deadline=None)
def test_ids_and_text_equal_the_library(parts):
    text = "".join(parts)
    want = REF.encode(text, add_special_tokens=False).ids
    assert MINE.encode(text) == want
    assert MINE.decode(want) == REF.decode(want, skip_special_tokens=False)


def test_lookahead_is_sufficient():
    rnd = random.Random(4)
    tokens = [b.decode() for b in MINE.raw.values() if b.isalpha() and len(b) > 1]
    texts = ["".join(rnd.choice(tokens) for _ in range(900)) for _ in range(15)] + ["a" * 9000, "ab" * 5000, "=-" * 4000]
    for t in texts:
        data = t.encode()
        assert len(data) > MINE.window
        assert MINE.piece(data) == MINE.merged(data)


def test_lookahead_of_a_small_list():
    """aa needs one byte: whether the last a of a run stays alone depends on the next."""
    size = {0: 1, 1: 1, 2: 2, 3: 2}
    assert op3_bpe.sufficient_lookahead([], size) == 0
    assert op3_bpe.sufficient_lookahead([(0, 0, 2)], size) == 1
    assert op3_bpe.sufficient_lookahead([(0, 0, 2), (1, 0, 3)], size) == 2


def test_decoder_replaces_malformed_bytes():
    ids = MINE.encode("é")
    parts = [i for b in "é".encode() for i in [MINE.first[b]]]
    assert MINE.decode(parts[:1]) == "�"
    assert MINE.decode(parts, step=1) == "é" and MINE.decode(ids) == "é"


def test_rows(docs_of):
    long = "word " * 60_000 + "x" * 5000
    rows = [(1, "Hello <|endoftext|> wörld"), (2, None), (3, ""), (None, "no id"), (1, "Hello <|endoftext|> wörld"), (5, long)]
    out = op3_bpe.encode(docs_of(rows), PATH, decoded=True)
    assert "Decoded" not in out.columns and "kept" in out.columns
    got = out.select("doc_id", "text", "ids", "decoded", *op3_bpe.digests()).collect()
    assert len(got) == len(rows)
    for r in got:
        want = REF.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want) and r.decoded == (r.text or "")
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
    back = op3_bpe.decode(out.select("doc_id", "text", "ids"), PATH).collect()
    assert all(r.decoded == (r.text or "") for r in back)
    assert op3_bpe.encode(docs_of([]), PATH).count() == 0


def test_query_equals_the_library(spark):
    from panelspark.llm.queries import QUERIES, table
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op3_bpe_codec"](spark, d).collect()}
    for r in table(spark, d, "documents").collect():
        want = REF.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(want)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


@pytest.mark.parametrize("cp", [0x1C, 0x1F, 0x85, 0xA0, 0xAA, 0xB2, 0xBC, 0xD7, 0xF7, 0x130, 0x23F, 0x250, 0x2028])
def test_engines_agree_or_the_exact_one_is_used(cp):
    import numpy as np
    text = f"a{chr(cp)}b 1{chr(cp)}{chr(cp)} {chr(cp)}"
    data = np.frombuffer(text.encode(), np.uint8)
    plain = op3_bpe.plain_rows(data, np.array([0, len(data)]))
    assert MINE.encode_all([text], plain)[0] == REF.encode(text, add_special_tokens=False).ids
