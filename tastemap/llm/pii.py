"""Personal data by fixed patterns and a character BiLSTM-CRF.

Patterns give the base spans (e-mail, IP address, card, phone), which always stay.
A character-level bidirectional LSTM with CRF transitions is trained on windows labelled by
the base spans and adds what looks alike. Every label it knows holds a digit or an
``@``, so texts are cut into overlapping windows of ``LENGTH`` characters that cover
``REACH`` characters around each digit and ``@``; text farther away holds no such span by
definition. All windows of a document are decoded and then reconciled over the
whole document: pieces of one kind that overlap are joined, better scored spans
win over those they overlap, and base spans win over all. An added span must have what
its kind cannot lack (an ``@`` and a dot, or digits enough and no letter).

The tagger is fitted on a sample of at most ``SAMPLE`` windows (half with and half
without a span), chosen by a hash of the id and place, so the sample does not depend
on partitioning. That is the only bounded part; every text is scanned whole.

Defined results: null and empty texts have no spans; null ids are carried; repeated
rows are scanned one by one; extra columns are not read by ``find`` and carried by ``redact``.
Without any labelled window (empty table) there is no model and the base spans are all.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import textkit as tk
from .frames import arrow_map, saved, table
from .tagger import Tagger

KINDS = ["email", "ip", "card", "phone"]
LENGTH, STRIDE, REACH = 64, 32, 24
SAMPLE, STEPS = 1600, 500
MIN_SCORE = 0.9
BATCH = 1024

_LOCAL = np.zeros(128, bool)
_LOCAL[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"]] = True
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")

CODE = np.full(128, 97, np.uint8)
CODE[32:127] = np.arange(95) + 1
CODE[[9, 10, 11, 12, 13]] = 96
N_CODES, PAD = 99, 0
N_TAGS = 1 + 2 * len(KINDS)
TRIGGER = np.zeros(256, bool)
TRIGGER[48:58] = TRIGGER[64] = True


def allowed_transitions() -> np.ndarray:
    """Tag 0 is outside, 2k+1 begins and 2k+2 continues kind k."""
    ok = np.ones((N_TAGS, N_TAGS), bool)
    for k in range(len(KINDS)):
        ok[:, 2 * k + 2] = False
        ok[[2 * k + 1, 2 * k + 2], 2 * k + 2] = True
    return ok


def luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Sorted (start, kind, end) of the fixed patterns."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        s = at
        while s > last and ord(text[s - 1]) < 128 and _LOCAL[ord(text[s - 1])]:
            s -= 1
        m = _DOMAIN.match(text, at) if s < at else None
        if m:
            out.append((s, 0, m.end()))
            last = m.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", last)
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = _DIGITS.sub("", m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_DIGITS.sub("", m[0])) <= 15]
    return sorted(out)


def codes_of(text: str) -> np.ndarray:
    u = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(u < 128, CODE[np.minimum(u, 127)], 98).astype(np.uint8)


def window_starts(code: np.ndarray) -> np.ndarray:
    """Starts of the windows that cover the reach of every digit and ``@``."""
    at = np.flatnonzero(((code >= CODE[48]) & (code <= CODE[57])) | (code == CODE[64]))
    if not len(at):
        return at
    lo, hi = np.maximum(at - REACH, 0), np.minimum(at + REACH + 1, len(code))
    new = np.append(True, lo[1:] > hi[:-1])
    first = np.flatnonzero(new)
    a, b = lo[first], hi[np.append(first[1:] - 1, len(hi) - 1)]
    n = np.maximum(-(-(b - a - LENGTH) // STRIDE), 0) + 1
    return np.repeat(a, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * STRIDE


def cut(code: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.append(code, np.zeros(LENGTH, np.uint8))
    return padded[starts[:, None] + np.arange(LENGTH)]


def tags_of(n: int, spans) -> np.ndarray:
    tags = np.zeros(n, np.uint8)
    for s, k, e in sorted(spans, key=lambda x: x[1], reverse=True):  # an earlier kind wins where kinds overlap
        tags[s] = 2 * k + 1
        tags[s + 1:e] = 2 * k + 2
    for i in np.flatnonzero(tags):  # what is left of an overlapped span starts anew
        if tags[i] % 2 == 0 and (i == 0 or tags[i - 1] not in (tags[i], tags[i] - 1)):
            tags[i] -= 1
    return tags


def _trigger_rows(column):
    """Rows that hold a digit or an ``@``."""
    data, off = tk.text_buffers(column)
    hits = np.append(0, np.cumsum(np.bincount(np.searchsorted(off, np.flatnonzero(TRIGGER[data]), "right") - 1, minlength=len(off) - 1)))
    return np.flatnonzero(np.diff(hits))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> dict | None:
    """Parameters of a tagger fitted on a bounded sample of windows labelled by the base spans."""
    def run(batches):
        for batch in batches:
            rows, texts = batch.column(0).to_numpy().view(np.uint64), batch.column(1)
            key, has, code, tag = [], [], [], []
            for r in _trigger_rows(texts):
                text = texts[int(r)].as_py()
                c = codes_of(text)
                t = np.append(tags_of(len(c), base_spans(text)), np.zeros(LENGTH, np.uint8))
                for s in window_starts(c):
                    w = t[s:s + LENGTH]
                    if w[0] and w[0] % 2 == 0:
                        continue  # begins inside a span
                    key.append(int(tk.mix(rows[r:r + 1] + tk.GRAM_CODE[:1] * np.uint64(s + 1))[0] >> np.uint64(1)))
                    has.append(bool(w.any()))
                    code.append(cut(c, np.array([s]))[0].tobytes())
                    tag.append(w.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(has, pa.bool_()), pa.array(code, pa.binary()),
                                              pa.array(tag, pa.binary())], names=["key", "has", "code", "tag"])

    # windows are ordered by a hash of id, text and place, which rows without an id have too
    src = docs.select(F.xxhash64(id_col, text_col), F.col(text_col).cast("string"))
    windows = saved(arrow_map(src, run, "key long, has boolean, code binary, tag binary"), "pii-windows")
    rows = []
    for has, n in windows.groupBy("has").count().collect():
        # keys are spread evenly: a cut that leaves some times the wanted number, so that tasks send few rows
        limit = min(2 ** 63 - 1, 8 * sample * 2 ** 63 // n)
        rows += windows.filter((F.col("has") == has) & (F.col("key") <= limit)).orderBy("key", "code", "tag").limit(sample // 2).select(
            "code", "tag").collect()
    if not rows:
        return None
    rows.sort()
    code = np.frombuffer(b"".join(bytes(r[0]) for r in rows), np.uint8).reshape(-1, LENGTH).astype(np.int64)
    tag = np.frombuffer(b"".join(bytes(r[1]) for r in rows), np.uint8).reshape(-1, LENGTH).astype(np.int64)
    model = Tagger(N_CODES, N_TAGS, allowed_transitions())
    return model.fit(code, tag, steps=STEPS).p


def load(params: dict) -> Tagger:
    model = Tagger(N_CODES, N_TAGS, allowed_transitions())
    model.p = params
    return model


def window_spans(path: np.ndarray, sure: np.ndarray):
    """(window, start, end, kind, score) of the spans of decoded windows."""
    w, s = np.nonzero((path > 0) & (path % 2 == 1))
    out = []
    for i, a in zip(w.tolist(), s.tolist()):
        inside = path[i, a] + 1
        b = a + 1
        while b < path.shape[1] and path[i, b] == inside:
            b += 1
        out.append((i, a, b, int(path[i, a] - 1) // 2, float(sure[i, a:b].mean())))
    return out


def plausible(kind: int, piece: str) -> bool:
    """Whether a piece has what every value of its kind has: an ``@`` and a dot, or digits enough and no letter."""
    if kind == 0:
        return "@" in piece and "." in piece
    return sum(map(str.isdigit, piece)) >= (0, 4, 12, 7)[kind] and not any(map(str.isalpha, piece))


def reconcile(found: list[tuple[int, int, int, float]], base, text: str) -> list[tuple[int, int, int]]:
    """Spans (start, end, kind, score) of all windows of a document to (start, kind, end) beside ``base``."""
    joined: list[list] = []
    for s, e, k, p in sorted(found, key=lambda x: (x[2], x[0], x[1])):
        if joined and joined[-1][2] == k and s < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], e)
            joined[-1][3] = max(joined[-1][3], p)
        else:
            joined.append([s, e, k, p])
    taken = [(s, e) for s, _, e in base]
    out = []
    for s, e, k, p in sorted(joined, key=lambda x: (-x[3], x[0], x[2])):
        if p >= MIN_SCORE and plausible(k, text[s:e]) and all(e <= a or b <= s for a, b in taken):
            taken.append((s, e))
            out.append((s, k, e))
    return out


def spans_of(texts: list[str], model: Tagger | None):
    """(base, all) spans of each text."""
    base = [base_spans(t) for t in texts]
    if model is None:
        return base, base
    codes = [codes_of(t) for t in texts]
    starts = [window_starts(c) for c in codes]
    owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
    place = np.concatenate(starts) if len(starts) else np.zeros(0, int)
    found: list[list] = [[] for _ in texts]
    for i in range(0, len(owner), BATCH):
        o, p = owner[i:i + BATCH], place[i:i + BATCH]
        window = np.concatenate([cut(codes[r], p[o == r]) for r in np.unique(o)])
        path, sure = model.decode(window.astype(np.int64))
        for w, a, b, k, score in window_spans(path, sure):
            r = int(o[w])
            end = min(int(p[w]) + b, len(codes[r]))
            if end > p[w] + a:
                found[r].append((int(p[w]) + a, end, k, score))
    return base, [sorted(b + reconcile(f, b, t)) if f else b for b, f, t in zip(base, found, texts)]


def _scan(batch_texts, model):
    """(row, base, all) of the rows that can hold a span, some at a time."""
    rows = _trigger_rows(batch_texts)
    for i in range(0, len(rows), 256):
        part = rows[i:i + 256]
        base, every = spans_of([batch_texts[int(r)].as_py() for r in part], model)
        yield from zip(part.tolist(), base, every)


_STRUCT = pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())])


def _span_lists(rows) -> pa.Array:
    return pa.array([[{"s": s, "k": k, "e": e} for s, k, e in r] for r in rows], pa.list_(_STRUCT))


def find(docs: DataFrame, params: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``base`` and ``all_spans`` (arrays of start, kind number, end) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(params)

    def run(batches):
        model = load(shared.value) if shared.value else None
        for batch in batches:
            base, every = [[]] * batch.num_rows, [[]] * batch.num_rows
            for r, b, e in _scan(batch.column(1), model):
                base[r], every[r] = b, e
            yield pa.RecordBatch.from_arrays([batch.column(0), _span_lists(base), _span_lists(every)], names=[id_col, "base", "all_spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    span = "array<struct<s:int,k:int,e:int>>"
    return arrow_map(docs.select(F.col(id_col), F.col(text_col).cast("string")), run, f"`{id_col}` {kind}, base {span}, all_spans {span}")


def redact(docs: DataFrame, params: dict | None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets."""
    shared = docs.sparkSession.sparkContext.broadcast(params)
    at = docs.columns.index(text_col)

    def run(batches):
        model = load(shared.value) if shared.value else None
        for batch in batches:
            texts, changed = batch.column(at), {}
            for r, _, every in _scan(texts, model):
                if every:
                    text, out, last = texts[r].as_py(), [], 0
                    for s, k, e in every:
                        if s >= last:
                            out += [text[last:s], f"<{KINDS[k].upper()}>"]
                        last = max(last, e)
                    changed[r] = "".join(out) + text[last:]
            if changed:
                rows = sorted(changed)
                spot = np.zeros(len(texts), bool)
                spot[rows] = True
                texts = pa.compute.replace_with_mask(texts, pa.array(spot), pa.array([changed[r] for r in rows], texts.type))
                batch = batch.set_column(at, batch.schema.field(at), texts)
            yield batch

    return arrow_map(docs, run, docs.schema)


def spans_text(col: str):
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(col, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    d = find(docs, train(docs))

    def count(k: int):
        return F.size(F.filter("base", lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return d.select("doc_id", *map(count, range(4)), F.sha2(spans_text("base"), 256).alias("base_sha256"),
                    spans_text("all_spans").alias("spans"), (F.size("all_spans") - F.size("base")).cast("long").alias("n_added"))
