import random
import re

import pyarrow as pa
import pytest

import messy
from conftest import SF_SMALL
from tastemap.llm import textkit as tk, wordpiece
from tastemap.llm.bpe import default_tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTES = {bytes([b]) for b in range(256)} - {b" "}


def greedy(word, begin, inner):
    n = i = 0
    while i < len(word):
        for pieces in ((begin, inner) if i == 0 else (inner,)):
            ends = [j for j in range(len(word), i, -1) if word[i:j] in pieces]
            if ends:
                break
        n, i = n + 1, ends[0]
    return n


def counts(auto, words):
    data, off = tk.text_buffers(pa.array(words, pa.string()))
    w = tk.Words(data, off)
    return auto.counts(w.data, w.start, w.end).tolist()


def test_random_vocabularies():
    r = random.Random(1)
    make = lambda n: {"".join(r.choices("abc", k=r.randrange(1, 7))).encode() for _ in range(n)}
    for _ in range(200):
        begin, inner = make(r.randrange(0, 12)), BYTES | make(r.randrange(0, 15))
        auto = wordpiece.Automaton(begin, inner)
        words = ["".join(r.choices("abcd", k=r.randrange(1, 16))) for _ in range(80)]
        assert counts(auto, words) == [greedy(w.encode(), begin, inner) for w in words]


def test_missing_byte_is_an_error():
    with pytest.raises(ValueError):
        wordpiece.Automaton(set(), {b"a"})


def check(got, rows):
    begin, inner = wordpiece.pieces(default_tokenizer())
    want = [(i, len(w), sum(greedy(x.encode(), begin, inner) for x in w)) for i, w in ((i, WORD.findall(t or "")) for i, t in rows)]
    assert messy.by_row(got, "doc_id", "n_words", "n_tokens") == sorted(want, key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check(wordpiece.op9(spark, SF_SMALL).collect(), rows)


def test_awkward_rows(spark):
    rows = [r for r in messy.TEXTS if r[0] != 11]
    check(wordpiece.token_counts(messy.docs(spark, rows), default_tokenizer()).collect(), [r[:2] for r in rows])


def test_empty_table(spark):
    assert wordpiece.token_counts(messy.docs(spark, []), default_tokenizer()).count() == 0
