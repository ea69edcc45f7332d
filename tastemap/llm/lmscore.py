"""Language-model scores of whole documents.

Tokens are the words of a text (A-Z lower-cased) and one end. Word counts cover all
training tokens and are a table: a token's share in it is a join, never a driver-side
dictionary. The ``COMMON`` most frequent words (a fixed bound, 1 MB) are broadcast with their
counts; only the others, the tail, are shuffled.

The model is a gated recurrent network. Its output is factored into classes: the
most frequent words fill 16 classes of 64, every other word belongs to one of
48 classes by its last two bytes and gets the add-one share of its count in
that class. Every text is turned into token ids (two bytes each) once and written; training
and scoring read those.

Before training the biases equal the unigram shares; training is data-parallel. The training
documents are dealt by a hash of id and text to shards of about ``SHARD_TOKENS`` tokens, whose
number follows the number of training tokens alone. In each of ``ROUNDS`` rounds truncated
backpropagation runs over every shard of the round from the common parameters, a shard's
documents in the order of their hash, and the results are averaged, weighted by tokens, on the
executors. So the parameters follow the rows and not their partitions, and every training
document, also one without an id, is trained on once. Equal rows are counted first and dealt
evenly over all shards, so no group of copies fills one. Scoring carries the state across
windows, so a document's likelihood is that of its whole token sequence.

Defined results: a null text is empty and has the end token only; null ids are carried and count as
remainder 0; repeated rows are scored one by one and all count in training; only the
named columns are read. With no training document N is 0 and all shares come from the add-one rule.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import gru, textkit as tk
from .frames import arrow_map, crc_mod, saved, table

COMMON = 65_536
ROUNDS = 2
RATE = 0.03
SHARD_TOKENS = 1 << 20  # training tokens of a shard, about
MAX_TASKS = 8192  # tasks of a round; each takes its shards one by one
PASS_TOKENS = 2 << 20  # tokens a task trains on at a time
END = 1 << 40  # the end token's number among the word hashes
SCORE_TOKENS = 1 << 21  # tokens scored side by side, a whole document at least
SCORE_ROWS = 1 << 13  # documents of them at most
_U = np.uint64
_CLASS = np.int64(63)


def _word_class(words: tk.Words) -> np.ndarray:
    """Rare class of each word: a hash of its last two bytes."""
    last = words.data[words.end - 1].astype(np.uint64)
    before = np.where(words.end - words.start > 1, words.data[words.end - 2], 0).astype(np.uint64)
    return (tk.mix(last * _U(257) + before + _U(1)) % _U(gru.RARE)).astype(np.int64)


def _blocks(column):
    """(first row, rows, words, word numbers) of the blocks of a text column."""
    data, off = tk.text_buffers(column)
    for i, j in tk.blocks(off):
        words = tk.Words(tk.LOWER[data[off[i]:off[j]]], off[i:j + 1] - off[i])
        # the low six bits are the class, so that a word's number tells it
        yield i, j, words, (words.hashes().view(np.int64) & ~_CLASS) | _word_class(words)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word hash, rare class, count) over all tokens, the end included."""
    def run(batches):
        for batch in batches:
            found, times, ends = [np.array([END])], [np.array([0])], 0
            for i, j, words, hashes in _blocks(batch.column(0)):
                word, n = np.unique(hashes, return_counts=True)
                found.append(word)
                times.append(n)
                ends += j - i
            times[0][0] = ends
            word, at = np.unique(np.concatenate(found), return_inverse=True)
            n = np.bincount(at, np.concatenate(times)).astype(np.int64)
            cls = np.where(word == END, -1, word & _CLASS)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(cls), pa.array(n)], names=["word", "class", "n"])

    part = arrow_map(docs.select(F.col(text_col).cast("string")), run, "word long, class long, n long")
    return part.groupBy("word").agg(F.min("class").alias("class"), F.sum("n").alias("n")).filter("n > 0")


class Vocabulary:
    """The common words: token id, count, and the fixed shares of the rare classes."""

    def __init__(self, rows, total: int, distinct: int, class_n, class_v):
        ends = [r for r in rows if r[0] == END]
        rest = sorted((r for r in rows if r[0] != END), key=lambda r: (-r[2], r[0]))
        ranked = (ends or [(END, -1, 0)]) + rest
        word = np.array([r[0] for r in ranked], np.int64)
        cls, n = np.array([r[1] for r in ranked], np.int64), np.array([r[2] for r in ranked], np.int64)
        ident = np.where(np.arange(len(word)) < gru.FREQ, np.arange(len(word)), gru.FREQ + cls)
        self.counts = np.append(n[:gru.FREQ], np.zeros(max(0, gru.FREQ - len(n)), np.int64))
        order = np.argsort(word)
        self.word, self.ident, self.n = word[order], ident[order], n[order]
        self.total, self.distinct = total, distinct
        # frequent words leave their rare class
        mine = np.arange(len(word)) < gru.FREQ
        mine &= cls >= 0
        self.class_n = class_n - np.bincount(cls[mine], n[mine], minlength=gru.RARE)
        self.class_v = class_v - np.bincount(cls[mine], minlength=gru.RARE)
        self.rare_cost = np.log10(self.class_n + self.class_v + 1)
        self.base_cost = np.log10(total + distinct + 1.0)

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the table, found)."""
        at = np.searchsorted(self.word, h)
        at[at == len(self.word)] = 0
        return at, self.word[at] == h

    def tokens(self, words: tk.Words, h: np.ndarray):
        """Token ids with an end after each row, the ids' row bounds, table places and what was found."""
        at, found = self.look_up(h)
        ident = np.where(found, self.ident[at], gru.FREQ + (h & _CLASS))
        bound = words.bound + np.arange(len(words.bound))
        out = np.zeros(bound[-1], np.int64)  # id 0 is the end
        out[np.arange(len(h)) + words.row] = ident
        return out, bound, at, found


def vocabulary(counts: DataFrame) -> Vocabulary:
    total = counts.agg(F.sum("n"), F.count("*")).first()
    by = counts.filter("class >= 0").groupBy("class").agg(F.sum("n"), F.count("*")).collect()
    class_n, class_v = np.zeros(gru.RARE), np.zeros(gru.RARE)
    for c, n, v in by:
        class_n[c], class_v[c] = n, v
    # a cut near the wanted number first, so that tasks do not each send as many rows to the driver
    level = F.floor(F.log2("n") * 16).cast("long")
    cut, have = 0, 0
    for lv, m in counts.groupBy(level.alias("lv")).count().orderBy(F.desc("lv")).collect():
        cut, have = lv, have + m
        if have > COMMON:
            break
    rows = counts.filter((F.col("word") != END) & (level >= cut)).orderBy(F.desc("n"), "word").limit(COMMON).collect()
    rows += counts.filter(F.col("word") == END).collect()
    return Vocabulary([tuple(r) for r in rows], int(total[0] or 0), int(total[1]), class_n, class_v)


def encode(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text_col: str = "text", learn=None) -> DataFrame:
    """A written row per document: ``id``, ``rid`` (its number), ``key`` (hash of id and text), ``learn``, token ids, known
    tokens, base score, fixed part of the model's score, and the words that are not in ``vocab``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        v = shared.value
        rid = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        log_n = np.log10(v.n + 1.0)
        end_at, end_found = v.look_up(np.array([END]))
        for batch in batches:
            for i, j, words, h in _blocks(batch.column(3)):
                m = j - i
                token, bound, at, found = v.tokens(words, h)
                add = lambda x, w=words.row: np.bincount(w, x, minlength=m)
                known = add((found & (v.n[at] > 0)).astype(float)) + float(v.n[end_at[0]] > 0)
                common = np.where(found, log_n[at], 0.0)
                mine = token[np.arange(len(h)) + words.row]
                rare = mine >= gru.FREQ
                base = add(common) + log_n[end_at[0]] - (words.per_row + 1) * v.base_cost
                fixed = add(np.where(rare, common - v.rare_cost[np.where(rare, mine - gru.FREQ, 0)], 0.0))
                tail = ~found
                ends = np.append(0, np.cumsum(np.bincount(words.row[tail], minlength=m)))
                ids = pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer((bound * 2).astype(np.int32).tobytes()),
                                                             pa.py_buffer(token.astype("<i2").tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(i, m) for k in range(3)), pa.array(rid + np.arange(m)), pa.array(known.astype(np.int64)),
                     pa.array(base), pa.array(fixed), ids, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(h[tail]))],
                    names=["id", "key", "learn", "rid", "known", "base", "fixed", "ids", "tail"])
                rid += m

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("key"),
                      (F.lit(True) if learn is None else learn).alias("learn"), text.alias("text"))
    return saved(arrow_map(src, run, f"id {kind}, key long, learn boolean, rid long, known long, base double, fixed double, "
                                     "ids binary, tail array<long>"), "lm-tokens")


def _token_rows(column) -> tuple[np.ndarray, np.ndarray]:
    """All token ids of a binary column and the rows' bounds in them."""
    data, off = tk.text_buffers(column)
    return np.frombuffer(data.tobytes(), "<i2").astype(np.int64), off // 2


def train(encoded: DataFrame, vocab: Vocabulary) -> dict:
    """Network parameters after ``ROUNDS`` rounds over the shards of ``encoded``'s learning rows (see the module)."""
    spark = encoded.sparkSession
    params = gru.new(vocab.counts, vocab.class_n + vocab.class_v + 1)
    each = max(1, -(-vocab.total // (ROUNDS * SHARD_TOKENS)))  # shards of a round
    slots = each * ROUNDS
    # equal rows are one row with a number, spread over at most all slots
    same = encoded.filter("learn").groupBy("key", "ids").agg(F.count("*").alias("n"))
    dealt = saved(same.select("key", "ids", "n", F.explode(F.sequence(F.lit(0), F.least(F.col("n"), F.lit(slots)).cast("int") - 1)).alias("s"))
                  .select("key", "ids", F.pmod(F.pmod(F.col("key"), F.lit(slots)) + F.col("s"), F.lit(slots)).cast("long").alias("slot"),
                          (F.floor(F.col("n") / slots) + (F.col("s") < F.col("n") % slots).cast("long")).cast("long").alias("times")), "lm-dealt")
    tasks = min(each, MAX_TASKS)
    for k in range(ROUNDS):
        shared = spark.sparkContext.broadcast(params)
        rate = RATE / (1 + k)

        def run(batches, shared=shared, rate=rate):
            state = {"p": shared.value, "held": 0, "weight": 0, "ids": [], "first": []}
            total, weight = np.zeros(len(gru.pack(shared.value))), 0

            def learn():
                if state["held"]:
                    state["p"] = gru.train(state["p"], np.concatenate(state["ids"]), np.concatenate(state["first"]), rate)
                    state.update(held=0, weight=state["weight"] + state["held"], ids=[], first=[])

            now = None
            for batch in batches:
                slot, times = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                token, bound = _token_rows(batch.column(1))
                for i in range(len(slot)):
                    if slot[i] != now:
                        learn()
                        total += state["weight"] * gru.pack(state["p"]).astype(float)
                        weight += state["weight"]
                        now = slot[i]
                        state.update(p=shared.value, weight=0)
                    one = token[bound[i]:bound[i + 1]]
                    begin = np.zeros(len(one), bool)
                    begin[:1] = True
                    for _ in range(times[i]):
                        state["ids"].append(one)
                        state["first"].append(begin)
                        state["held"] += len(one)
                        if state["held"] >= PASS_TOKENS:
                            learn()
            learn()
            total += state["weight"] * gru.pack(state["p"]).astype(float)
            weight += state["weight"]
            if weight:
                yield pa.RecordBatch.from_arrays([pa.array([weight], pa.int64()), pa.array([total], pa.list_(pa.float64()))], names=["weight", "p"])

        def add(batches):
            weight, total = 0, 0.0
            for batch in batches:
                for w, p in zip(batch.column(0).to_pylist(), batch.column(1)):
                    weight, total = weight + w, total + p.values.to_numpy()
            if weight:
                yield pa.RecordBatch.from_arrays([pa.array([weight], pa.int64()), pa.array([total], pa.list_(pa.float64()))], names=["weight", "p"])

        kind = "weight long, p array<double>"
        mine = dealt.filter(F.col("slot") % ROUNDS == k).select(
            F.expr(f"slot div {ROUNDS}").alias("shard"), "ids", "times", "key").repartitionById(tasks, (F.col("shard") % tasks).cast("int"))
        rows = arrow_map(mine.sortWithinPartitions("shard", "key", "ids").select("shard", "ids", "times"), run, kind)
        rows = arrow_map(rows.repartition(int(np.ceil(np.sqrt(tasks)))), add, kind)
        sums = rows.select("weight", F.posexplode("p").alias("i", "v")).groupBy("i").agg((F.sum("v") / F.sum("weight")).alias("v")).collect()
        if sums:
            flat = np.zeros(len(sums), np.float32)
            flat[[r[0] for r in sums]] = [r[1] for r in sums]
            params = gru.unpack(flat, params)
        shared.unpersist()
    return params


def fit(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Network parameters after training on all of ``docs``."""
    return train(encode(docs, vocab, id_col, text_col), vocab)


def rate_encoded(encoded: DataFrame, counts: DataFrame, vocab: Vocabulary, params: dict, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every encoded text."""
    shared = encoded.sparkSession.sparkContext.broadcast(params)

    def run(batches):
        for batch in batches:
            token, bound = _token_rows(batch.column(5))
            got = np.empty(batch.num_rows)
            for i, j in tk.blocks(bound, SCORE_TOKENS, SCORE_ROWS):
                got[i:j] = gru.log_likelihood(shared.value, token[bound[i]:bound[j]], bound[i:j + 1] - bound[i]) / np.log(10.0)
            model = got + batch.column(4).to_numpy()
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.array(model), pa.array(np.diff(bound))],
                                             names=["id", "rid", "known", "base", "model", "n_tokens"])

    kind = encoded.schema["id"].dataType.simpleString()
    parts = arrow_map(encoded.select("id", "rid", "known", "base", "fixed", "ids"), run,
                      f"id {kind}, rid long, known long, base double, model double, n_tokens long")
    tail = encoded.select("rid", F.explode("tail").alias("word")).join(counts.select("word", "n"), "word").groupBy("rid").agg(
        F.sum(F.log10(F.col("n") + 1.0)).alias("more"), F.count("*").alias("seen"))
    both = parts.join(tail, "rid", "left")
    more = F.coalesce("more", F.lit(0.0))
    return both.select(F.col("id").alias(id_col), "n_tokens", (F.col("known") + F.coalesce("seen", F.lit(0))).cast("long").alias("n_known"),
                       F.lit(vocab.total).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
                       (F.col("model") + more).alias("score"))


def score(docs: DataFrame, counts: DataFrame, vocab: Vocabulary, params: dict, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``rate_encoded`` of every whole text of ``docs``."""
    return rate_encoded(encode(docs, vocab, id_col, text_col), counts, vocab, params, id_col)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = crc_mod("doc_id", 7) != 2
    counts = saved(word_counts(docs.filter(learn)), "lm-counts")
    vocab = vocabulary(counts)
    encoded = encode(docs, vocab, learn=learn)
    out = rate_encoded(encoded, counts, vocab, train(encoded, vocab))
    return out.select("doc_id", (crc_mod("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
