"""Chat formatting with cumulative-snapshot collapse, in DataFrame functions only.

Chat logs often hold every state of a conversation: the first turns, then the same with one
turn more, and so on. Only conversations that no longer one continues are kept.
Each turn gets two 64-bit hashes of (place, role, text); their running exclusive-or over
the conversation is a rolling hash of the prefix that ends there. A conversation whose
last hash is found among the proper prefixes of the same length is dropped by an
anti-join; of equal conversations the smallest id stays. The rest is rendered.

No conversation is gathered in one task: turns are numbered and hashed in blocks of
``BLOCK`` turn numbers, and a block's offset and hash come from running totals over the
much shorter table of blocks. Rendered text comes in parts of at most ``BLOCK`` turns.
Prefixes are made distinct (with partial aggregation) before they meet anything, so a first turn
that many conversations share is one row.

Defined results: one row per kept conversation and part: ``conv_id``, ``part`` (from 0),
``n_turns`` (of the conversation), ``text``. Turns are ordered by (turn, role, text), a null turn first;
exactly repeated rows count once; a null role or text is empty; rows with a null id are one
conversation; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .frames import saved, table

BLOCK = 256
# fixed values: the markers of the rendered turns
TURN_START, ROLE_END, TURN_END = "<|im_start|>", "\n", "<|im_end|>\n"


def prefixes(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """Each distinct turn with its ``place`` (from 1), its conversation's ``size`` and the prefix hashes ``h1``, ``h2``."""
    t = turns.select(F.col(id_col).cast("long").alias("id"), F.col(turn_col).cast("long").alias("turn"),
                     F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    # a key without nulls, so that plain equi-joins serve rows without an id too
    t = t.select("*", F.coalesce(F.col("id").cast("string"), F.lit("none")).alias("key"),
                 F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))).cast("long").alias("block"))
    inner = W.partitionBy("key", "block").orderBy("turn", "role", "text")
    t = saved(t.withColumn("nth", F.row_number().over(inner)), "turns")
    upto = W.partitionBy("key").orderBy("block")
    before = upto.rowsBetween(W.unboundedPreceding, -1)
    sizes = t.groupBy("key", "block").agg(F.count("*").alias("n")).select(
        "key", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(W.partitionBy("key")).alias("size"))
    t = t.join(sizes, ["key", "block"]).withColumn("place", F.col("offset") + F.col("nth"))
    for h, salt in (("h1", 1), ("h2", 2)):
        t = t.withColumn("t" + h, F.xxhash64(F.lit(salt), "place", "role", "text"))
    sums = t.groupBy("key", "block").agg(F.bit_xor("th1").alias("b1"), F.bit_xor("th2").alias("b2")).select(
        "key", "block", *[F.coalesce(F.bit_xor(b).over(before), F.lit(0)).alias("p" + b) for b in ("b1", "b2")])
    run = inner.rowsBetween(W.unboundedPreceding, 0)
    rolled = t.select("*", F.bit_xor("th1").over(run).alias("r1"), F.bit_xor("th2").over(run).alias("r2")).join(sums, ["key", "block"])
    return rolled.select("key", "id", "place", "size", "role", "text", F.col("r1").bitwiseXOR(F.col("pb1")).alias("h1"),
                         F.col("r2").bitwiseXOR(F.col("pb2")).alias("h2"))


def maximal(rows: DataFrame) -> DataFrame:
    """``key`` of the conversations that no longer one continues, the smallest id of equal ones."""
    whole = rows.filter("place = size").select("key", "id", "size", "h1", "h2")
    part = rows.filter("place < size").select(F.col("place").alias("size"), "h1", "h2").distinct()
    kept = whole.join(part, ["size", "h1", "h2"], "left_anti")
    return kept.groupBy("size", "h1", "h2").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key"))["key"].alias("key")).select("key")


def render(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Kept conversations as text: ``id_col``, ``part``, ``n_turns``, ``text``."""
    rows = saved(prefixes(turns, id_col, turn_col, role_col, text_col), "prefixes")
    kept = rows.join(maximal(rows), "key", "left_semi")
    piece = F.concat(F.lit(TURN_START), "role", F.lit(ROLE_END), "text", F.lit(TURN_END))
    parts = kept.groupBy("key", "id", F.floor((F.col("place") - 1) / BLOCK).cast("long").alias("part"), "size").agg(
        F.sort_array(F.collect_list(F.struct("place", piece.alias("piece")))).alias("pieces"))
    return parts.select(F.col("id").alias(id_col), "part", F.col("size").alias("n_turns"), F.array_join("pieces.piece", "").alias("text"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(table(spark, sf_dir, "conversations"))


OP2_SQL = f"""
with t as (select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations),
n as (select *, row_number() over w as place, count(*) over (partition by conv_id) as size,
  string_agg(length(role) || ':' || role || length(text) || ':' || text, '') over (w rows between unbounded preceding and current row) as prefix
  from t window w as (partition by conv_id order by turn nulls first, role, text)),
whole as (select * from n where place = size),
kept as (select min(conv_id) as conv_id from whole a
  where not exists (select 1 from n b where b.place = a.size and b.size > a.size and b.prefix = a.prefix) group by size, prefix)
select n.conv_id, ((place - 1) // {BLOCK})::bigint as part, size as n_turns,
  string_agg('{TURN_START}' || role || chr(10) || text || '<|im_end|>' || chr(10), '' order by place) as text
from n join kept on n.conv_id is not distinct from kept.conv_id group by n.conv_id, part, size"""
