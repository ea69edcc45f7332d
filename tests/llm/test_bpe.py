import hashlib

import numpy as np
import pytest
import public_tokenizers
import tokenizers
from pyspark.sql import functions as F

import messy
from conftest import SF_SMALL
from tastemap.llm import bpe

ODD = ["", "a", "don't can't we'll 's ''s  'tis", "x\n\n y", "  lead", "trail   ", "\t\tz", "a\x1c\x1db \x85c d　e", "aaaaaaaaaaaaaaa aaaa",
       "日本語テスト", "😀😀 👩‍👩‍👧", "<|endoftext|> a<|endoftext|>b", "½ ² Ⅷ 123", "a" * 3000, " " * 1000 + "x", "\r\n\r\n   x", "\0added"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_encode_and_decode_match_the_library(library):
    tok = bpe.Tokenizer(bpe.default_tokenizer())
    rng = np.random.default_rng(1)
    noise = ["".join(chr(c) for c in rng.choice([32, 39, 10, 9, *range(33, 127), *range(0xC0, 0x250), 0x4E2D, 0x1F600], 120)) for _ in range(200)]
    texts = ODD + noise
    ids, count = tok.encode(texts)
    end = np.append(0, np.cumsum(count))
    want = library.encode_batch(texts, add_special_tokens=False)
    for t, a, b, w in zip(texts, end[:-1], end[1:], want):
        assert ids[a:b].tolist() == w.ids, t
    assert tok.decode(ids, count) == [library.decode(w.ids, skip_special_tokens=False) for w in want]


def test_small_word_store_gives_the_same_ids(library, monkeypatch):
    monkeypatch.setattr(bpe, "STORE_WORDS", 3)
    tok = bpe.Tokenizer(bpe.default_tokenizer())
    for text in ["a b c d e", "f g h i", "a f z", "one two"]:
        assert tok.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_broken_utf8_is_replaced(library):
    tok = bpe.Tokenizer(bpe.default_tokenizer())
    one = library.encode("日", add_special_tokens=False).ids[:1]
    assert tok.decode(np.array(one), np.array([1])) == [library.decode(one, skip_special_tokens=False)]
    with pytest.raises(ValueError):
        tok.decode(np.array([10 ** 6]), np.array([1]))


def test_awkward_rows(spark, library):
    blob = bpe.default_tokenizer()
    out = bpe.decode(bpe.encode(messy.docs(spark), blob), blob, keep_ids=True).collect()
    want = [(i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, _, _ in messy.TEXTS]
    assert messy.by_row(out, "doc_id", "ids", "text") == sorted(want, key=str)


def test_empty_table(spark):
    blob = bpe.default_tokenizer()
    assert bpe.decode(bpe.encode(messy.docs(spark, []), blob), blob).count() == 0


def test_query_matches_the_library(spark, library):
    got = {r.doc_id: r for r in bpe.op1(spark, SF_SMALL).collect()}
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).collect()
    assert len(rows) == len(got)
    for i, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
