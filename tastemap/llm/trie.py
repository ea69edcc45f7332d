"""Trie of conversation prefixes, built as a burst trie.

A conversation is a sequence of turn ids (a digest of role and text, with the text's byte length).
All conversations start in one container, a set of suffixes below one trie node. A container
of more than ``LIMIT`` turn ids bursts: its common prefix becomes a trie head, and its suffixes are dealt to one
container per next turn id. The common prefix is that of the smallest and the largest suffix,
so a round goes straight to the next branching. Containers that are left are sorted and swept, one
after the other, into nodes; a task holds one container at a time.

Long conversations are cut into pieces of ``BLOCK`` turns. A piece lies in the container of its
prefix (a running hash over the earlier pieces), so no conversation is ever one row and a
conversation with a third of all turns spreads over its pieces. Equal pieces below one prefix are one suffix with a
count, however many conversations have them.

What lies below a head is added up from the containers below it. What lies below the end of a piece is
summed by conversations instead of walking up the tree: each node is owned by its smallest member,
whose owned nodes are the end of its path, so running totals over a conversation's later pieces,
added up over the conversations that pass, give the sums.

The numbers of the conversations that end at a node are sorted across tasks and joined
in stretches of ``STRETCH``; only the digest over these stretches, which SHA-256 can but take in
order, is one task's work per node, streamed.

Defined results: turns are ordered by (turn, role, text), a null turn first; a null role or text is
empty; every repeated row is a turn of its own; rows without a conversation number belong to none and
are left out; a table without numbered rows gives no nodes; only the named columns are read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .frames import arrow_map, saved, table

BLOCK = 256              # turns of a piece
LIMIT = 1 << 14          # turn ids of a container that is swept in one go
STRETCH = 1 << 12        # numbers joined before they meet the digest
FEW = 1024               # heads of a round that are broadcast; more are joined
TOKEN = 40               # letters of a turn id: 32 of the digest, 8 of the text's length in bytes
NONE = hashlib.sha256(b"").hexdigest()


def rebuilt(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv, place, token): the first h turns of conversation c - c % 5, then the own turns after the first h, with
    h = crc32(c) % 9, numbered from 0. A turnless conversation is one row without a place."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    token = F.concat(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)), F.lpad(F.hex(F.octet_length(text)), 8, "0"))
    t = conversations.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"),
                             text.alias("text"), token.alias("token")).filter("conv is not null")
    # equal rows are interchangeable: a last random key lets the range partitioner split them
    order = ["conv", "turn", "role", "text", "any"]
    t = t.withColumn("any", F.rand(1)).repartitionByRange(*order).sortWithinPartitions(*order)
    t = saved(t.select("conv", "token", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "turns")
    # places from counts by conversation and part: no join key holds more rows than a part of the sorted table
    upto = W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    heads = t.groupBy("conv", "part").agg(F.count("*").alias("n"), F.min("at").alias("low"))
    heads = saved(heads.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))), "turn-counts")
    sizes = heads.groupBy("conv").agg(F.sum("n").alias("size"))
    convs = sizes.select("conv", "size", (F.crc32(F.col("conv").cast("string")) % 9).alias("h"), (F.col("conv") - F.col("conv") % 5).alias("base"))
    convs = convs.join(sizes.select(F.col("conv").alias("base"), F.col("size").alias("there")), "base", "left")
    convs = saved(convs.withColumn("lent", F.least("h", F.coalesce("there", F.lit(0)))), "conversations")
    heads = heads.join(convs.select("conv", "h", "lent"), "conv")
    rows = saved(t.join(heads, ["conv", "part"]).select(
        "conv", "token", "h", "lent", (F.col("at") - F.col("low") + F.col("before")).alias("place")), "places")
    own = rows.filter("place >= h").select("conv", (F.col("place") - F.col("h") + F.col("lent")).alias("place"), "token")
    first = rows.filter("place < 8").select(F.col("conv").alias("base"), "place", "token")
    lent = first.join(convs.select("conv", "base", "h"), "base").filter("place < h").select("conv", "place", "token")
    bare = convs.filter("lent = 0 and size <= h").select("conv", F.lit(None).cast("long").alias("place"), F.lit(None).cast("string").alias("token"))
    return own.unionByName(lent).unionByName(bare)


def pieces(turns: DataFrame) -> DataFrame:
    """(conv, block, piece, key, last, after): pieces of ``BLOCK`` turns below their prefix ``key``; ``after`` is the
    prefix including the piece, ``last`` says that the conversation ends with it."""
    turn = F.when(F.col("place").isNotNull(), F.struct("place", "token"))
    p = turns.groupBy("conv", F.coalesce(F.floor(F.col("place") / BLOCK), F.lit(0)).cast("long").alias("block")).agg(
        F.sort_array(F.collect_list(turn)).alias("t")).select("conv", "block", F.array_join("t.token", "").alias("piece"))
    p = saved(p.select("*", *[F.xxhash64(F.lit(s), "block", "piece").alias(f"x{s}") for s in (1, 2)]), "pieces")
    many = p.filter("block > 0").select("conv").distinct()
    # running hashes only of conversations with several pieces, over one short row a piece
    upto = W.partitionBy("conv").orderBy("block")
    named = lambda c: F.concat(F.col("block").cast("string"), F.lit("/"), *c[:1], F.lit(":"), *c[1:])
    run = p.select("conv", "block", "x1", "x2").join(many, "conv", "left_semi").select(
        "conv", "block", named([F.bit_xor(x).over(upto).cast("string") for x in ("x1", "x2")]).alias("after"), F.lead("block").over(upto).isNull().alias("last"))
    run = run.withColumn("key", F.coalesce(F.lag("after").over(upto), F.lit("")))
    one = p.join(many, "conv", "left_anti").select("conv", "block", "piece", F.lit("").alias("key"), F.lit(True).alias("last"),
                                                  named([F.col(x).cast("string") for x in ("x1", "x2")]).alias("after"))
    return saved(one.unionByName(p.join(run, ["conv", "block"]).select(one.columns)), "prefixed-pieces")


def end_digests(ends: DataFrame) -> DataFrame:
    """(after, ends): SHA-256 of the ascending, comma-joined numbers of the conversations that end at a prefix."""
    shape = pa.schema([("after", pa.string()), ("low", pa.int64()), ("joined", pa.string())])
    digest = pa.schema([("after", pa.string()), ("ends", pa.string())])

    def batch(rows, schema):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    def stretches(batches):
        at, low, parts = None, None, []
        for b in batches:
            rows = []
            for key, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if parts and (key != at or len(parts) >= STRETCH):
                    rows.append((at, low, ",".join(parts)))
                    parts = []
                if not parts:
                    at, low = key, conv
                parts.append(str(conv))
            yield batch(rows, shape)
        if parts:
            yield batch([(at, low, ",".join(parts))], shape)

    def digests(batches):
        at, sha = None, None
        for b in batches:
            rows = []
            for key, joined in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if sha and key == at:
                    sha.update(b"," + joined.encode())
                    continue
                if sha:
                    rows.append((at, sha.hexdigest()))
                at, sha = key, hashlib.sha256(joined.encode())
            yield batch(rows, digest)
        if sha:
            yield batch([(at, sha.hexdigest())], digest)

    ordered = ends.select("after", "conv").repartitionByRange("after", "conv").sortWithinPartitions("after", "conv")
    joined = saved(arrow_map(ordered, stretches, "after string, low long, joined string"), "end-stretches")
    one = joined.repartition("after").sortWithinPartitions("after", "low").select("after", "joined")
    return arrow_map(one, digests, "after string, ends string")


def suffixes(p: DataFrame) -> DataFrame:
    """Equal pieces below one prefix as one row: ``n`` members, smallest number ``conv``, ``ends`` (null: none ends here),
    ``up`` the owner of the node above the prefix and ``children`` the nodes right below the piece's end, in the next piece."""
    t = saved(p.groupBy("key", "block", "piece", "after").agg(F.count("*").alias("n"), F.min("conv").alias("conv")).join(
        end_digests(p.filter("last")), "after", "left"), "suffixes")
    up = t.select(F.col("after").alias("key"), F.col("conv").alias("up"))
    first = t.filter("block > 0").select("key", F.substring("piece", 1, TOKEN)).distinct().groupBy(F.col("key").alias("after")).agg(F.count("*").alias("children"))
    deeper = t.filter("block > 0").join(up, "key")
    t = t.filter("block = 0").withColumn("up", F.lit(None).cast("long")).unionByName(deeper)
    return saved(t.join(first, "after", "left").withColumn("children", F.coalesce("children", F.lit(0))), "linked-suffixes")


class _Node:
    __slots__ = ("conv", "depth", "up", "bytes", "n", "children", "leaves", "saved", "ends")

    def __init__(self, depth: int, up: _Node | None, size: int):
        self.conv, self.depth, self.up, self.bytes = None, depth, up, size
        self.n = self.children = self.leaves = self.saved = 0
        self.ends = NONE


def _bytes(path: str) -> int:
    """Bytes of the last turn's text of a path."""
    return int(path[-8:], 16) if path else 0


def sweep(path: str, rows: list[tuple]) -> list[_Node]:
    """Nodes of a container, its top node (the end of ``path``) first.

    ``rows`` are (piece, n, conv, ends, children, leaves, saved) in ascending order of piece, all of which begin with
    ``path``; the last three are what lies below a piece's end.
    """
    depth = len(path) // TOKEN
    stack = [_Node(depth, None, _bytes(path))]
    nodes, last = list(stack), path
    for piece, n, conv, ends, children, leaves, below in rows:
        size = len(piece) // TOKEN
        common = depth
        while common < min(size, len(last) // TOKEN) and last[common * TOKEN:(common + 1) * TOKEN] == piece[common * TOKEN:(common + 1) * TOKEN]:
            common += 1
        del stack[common - depth + 1:]
        for d in range(common + 1, size + 1):
            node = _Node(d, stack[-1], _bytes(piece[:d * TOKEN]))
            stack[-1].children += 1
            stack.append(node)
            nodes.append(node)
        for node in stack:
            node.n += n
            node.conv = conv if node.conv is None else min(conv, node.conv)
        end = stack[-1]
        end.ends = ends or NONE
        end.children += children
        end.leaves += leaves
        end.saved += below
        last = piece
    for node in reversed(nodes):  # children stand after their parents
        node.leaves += node.children == 0
        node.saved += (node.n - 1) * node.bytes
        if node.up is not None:
            node.up.leaves += node.leaves
            node.up.saved += node.saved
    return nodes


NODE = [("conv", "long"), ("depth", "long"), ("parent", "long"), ("n", "long"), ("children", "long"), ("leaves", "long"), ("saved", "long"),
        ("ends", "string"), ("weight", "long"), ("over", "string")]


def _swept(rows: DataFrame) -> DataFrame:
    """Nodes of all containers of ``rows``; ``over`` (the heads above) stands with a container's top node only."""
    kinds = {"long": pa.int64(), "string": pa.string()}

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[k]) for i, (_, k) in enumerate(NODE)], names=[c for c, _ in NODE])

    def container(head, held):
        _, path, block, up, over = head
        nodes = sweep(path, held)
        for node in nodes:
            top = node.up is None
            if top and block and not path:
                continue  # the end of the piece before: a node of that piece's container
            above = up if top or (node.up.up is None and block and not path) else node.up.conv
            yield (node.conv, block * BLOCK + node.depth, above, node.n, node.children, node.leaves, node.saved, node.ends,
                   (node.n - 1) * node.bytes, over if top else None)

    def run(batches):
        head, held, out = None, [], []
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if r[:5] != head:
                    out.extend(container(head, held) if held else ())
                    head, held = r[:5], []
                    if len(out) >= 1 << 14:
                        yield batch(out)
                        out = []
                held.append(r[5:])
        out.extend(container(head, held) if held else ())
        yield batch(out)

    t = rows.select("key", "path", "block", "up", "over", "piece", "n", "conv", "ends", "children", "leaves", "saved")
    return arrow_map(t.repartition("key", "path").sortWithinPartitions("key", "path", "piece"), run, ", ".join(map(" ".join, NODE)))


def _common(a: str, b: str):
    """Turn ids that two pieces share at their start."""
    return F.size(F.filter(F.sequence(F.lit(0), F.greatest(F.least(F.length(a), F.length(b)) / TOKEN, F.lit(0)).cast("int")),
                           lambda i: F.substring(F.col(a), F.lit(1), i * TOKEN) == F.substring(F.col(b), F.lit(1), i * TOKEN))) - 1


def nodes(rows: DataFrame) -> DataFrame:
    """All nodes of the containers that ``rows`` (suffixes with ``leaves`` and ``saved`` below their ends) form, after bursting."""
    cur = rows.select("key", "block", "piece", "n", "conv", "ends", "up", "children", "leaves", "saved",
                      F.lit("").alias("path"), F.lit("").alias("over"))
    small, heads, number = [], [], 0
    while True:
        turns = F.sum(F.length("piece") - F.length("path")) / TOKEN
        big = cur.groupBy("key", "block", "path", "over").agg(
            turns.alias("turns"), F.count("*").alias("rows"), F.min("piece").alias("low"), F.max("piece").alias("high"),
            F.sum("n").alias("all"), F.min("conv").alias("owner"), F.max("up").alias("above")).filter(f"turns > {LIMIT} and rows > 1")
        big = big.withColumn("common", _common("low", "high")).select(
            "key", "block", "path", "over", "all", "owner", "above", "common", F.expr(f"substring(low, 1, common * {TOKEN})").alias("stem"),
            F.concat(F.lit(f"{number}."), F.monotonically_increasing_id().cast("string")).alias("head"))
        big = saved(big, "heads")
        count = big.count()
        if not count:
            small.append(cur)
            break
        mark = big.select("key", "path", "head", "owner", "common")
        there = cur.join(F.broadcast(mark) if count <= FEW else mark, ["key", "path"], "left")
        there = saved(there, "burst")
        small.append(there.filter("head is null").select(cur.columns))
        burst = there.filter("head is not null")
        ended = burst.filter(f"length(piece) = common * {TOKEN}").select("head", "ends", "children", "leaves", "saved")
        over = F.when(F.col("over") == "", F.col("head")).otherwise(F.concat("over", F.lit(","), "head"))
        # at the start of a later piece the branching node is the end of the piece before
        branch = F.when((F.col("block") > 0) & (F.col("common") == 0), F.col("up")).otherwise(F.col("owner"))
        on = burst.filter(f"length(piece) > common * {TOKEN}").select(
            "key", "block", "piece", "n", "conv", "ends", branch.alias("up"), "children", "leaves", "saved",
            F.expr(f"substring(piece, 1, (common + 1) * {TOKEN})").alias("path"), over.alias("over"), "head")
        kids = on.select("head", "path").distinct().groupBy("head").agg(F.count("*").alias("kids"))
        heads.append(big.join(ended, "head", "left").join(kids, "head", "left"))
        cur = on.drop("head")
        number += 1
    every = small[0]
    for s in small[1:]:
        every = every.unionByName(s)
    swept = saved(_swept(every), "nodes")
    if not heads:
        return swept.drop("over")
    head = heads[0]
    for h in heads[1:]:
        head = head.unionByName(h)
    # bytes of the head's turns from the container's top node down to the branching
    size = lambda d: F.when(d == 0, F.lit(0)).otherwise(F.conv(F.substring(F.col("stem"), d * TOKEN - 7, F.lit(8)), 16, 10).cast("long"))
    weight = lambda d: (F.col("all") - 1) * size(d)
    depths = F.sequence((F.length("path") / TOKEN).cast("int"), F.col("common"))
    head = saved(head.withColumn("weights", F.transform(depths, lambda d: weight(d))).withColumn("depths", depths), "head-nodes")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    own = head.select("over", zero("leaves").alias("leaves"), (zero("saved") + total("weights")).alias("saved"))
    below = swept.filter("over <> ''").select("over", "leaves", "saved").unionByName(own.filter("over <> ''"))
    below = below.select(F.explode(F.split("over", ",")).alias("head"), "leaves", "saved").groupBy("head").agg(
        F.sum("leaves").alias("leaves_below"), F.sum("saved").alias("saved_below"))
    full = head.join(below, "head", "left").select("*", F.posexplode("depths").alias("i", "d")).filter("d > 0 or block = 0")
    bottom = F.col("d") == F.col("common")
    return swept.drop("over").unionByName(full.select(
        F.col("owner").alias("conv"), (F.col("block") * BLOCK + F.col("d")).alias("depth"),
        F.when((F.col("i") > 0) & ~((F.col("i") == 1) & (F.col("block") > 0) & (F.col("path") == "")), F.col("owner")).otherwise(F.col("above")).alias("parent"),
        F.col("all").alias("n"), F.when(bottom, zero("kids") + zero("children")).otherwise(F.lit(1)).cast("long").alias("children"),
        (zero("leaves_below") + zero("leaves")).alias("leaves"),
        (zero("saved_below") + zero("saved") + total(F.expr("slice(weights, i + 1, size(weights))"))).alias("saved"),
        F.when(bottom, F.coalesce("ends", F.lit(NONE))).otherwise(F.lit(NONE)).alias("ends"),
        F.element_at("weights", F.col("i") + 1).alias("weight")))


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per trie node of the rebuilt conversations."""
    p = pieces(rebuilt(conversations, conv_col, turn_col, role_col, text_col))
    rows = suffixes(p)
    nothing = [F.lit(0).cast("long").alias(c) for c in ("leaves", "saved")]
    if rows.filter("block > 0").isEmpty():
        out = nodes(rows.select("*", *nothing))
    else:
        deep = nodes(rows.filter("block > 0").select("*", *nothing))
        owned = deep.groupBy("conv", F.floor((F.col("depth") - 1) / BLOCK).cast("long").alias("block")).agg(
            F.sum("weight").alias("w"), F.sum((F.col("children") == 0).cast("long")).alias("l"))
        later = W.partitionBy("conv").orderBy(F.col("block").desc()).rowsBetween(W.unboundedPreceding, 0)
        below = p.filter("block > 0").select("conv", "block", "key").join(owned, ["conv", "block"], "left").select(
            F.col("key").alias("after"), F.sum(F.coalesce("l", F.lit(0))).over(later).alias("leaves"), F.sum(F.coalesce("w", F.lit(0))).over(later).alias("saved"))
        below = below.groupBy("after").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        out = nodes(saved(rows.join(below, "after", "left").fillna(0, ["leaves", "saved"]), "summed-suffixes"))
    return out.select(F.col("conv").alias(conv_col), "depth", F.col("parent").alias(f"parent_{conv_col}"), F.col("n").alias("n_convs"),
                      F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.col("ends").alias("ends_sha256"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


# crc32 of the decimal number, one bit at a time: each character is followed by seven zeros
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(c::varchar, ''),
  lambda x: [ascii(x)::bigint, 0, 0, 0, 0, 0, 0, 0]))), lambda a, x: xor(xor(a, x) >> 1, 3988292384::bigint * (xor(a, x) & 1))), 4294967295::bigint)"""

OP12_SQL = f"""
with t as (select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as place,
  coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
h as (select c, {_CRC} % 9 as h from (select distinct c from t)),
r as (select h.c, place, role, text from h join t on t.c = h.c - h.c % 5 where place < h
  union all select t.c, place, role, text from t join h on t.c = h.c where place >= h),
n as (select c, row_number() over (partition by c order by place) as d, strlen(text) as bytes,
  length(role) || ':' || role || length(text) || ':' || text as tok from r),
p as (select c, 0 as d, 0 as bytes, '' as prefix from h union all
  select c, d, bytes, string_agg(tok, '') over (partition by c order by d rows between unbounded preceding and current row) from n),
q as (select *, lag(prefix) over (partition by c order by d) as up, d = max(d) over (partition by c) as ending from p),
m as (select d, prefix, any_value(up) as up, min(c) as conv_id, count(*) as n, any_value(bytes) as bytes,
  sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ending), '')) as ends from q group by d, prefix),
k as (select m.*, (select count(*) from m x where x.d = m.d + 1 and x.up = m.prefix) as kids from m),
s as (select q.d, q.prefix, sum((k.kids = 0)::int) as leaves, sum((k.n - 1) * k.bytes) as saved
  from k join q on q.c = k.conv_id and q.d <= k.d group by q.d, q.prefix)
select k.conv_id, k.d::bigint as depth, u.conv_id as parent_conv_id, k.n::bigint as n_convs, k.kids::bigint as n_children,
  s.leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, k.ends as ends_sha256
from k join s on s.d = k.d and s.prefix = k.prefix left join m u on u.d = k.d - 1 and u.prefix = k.up"""
