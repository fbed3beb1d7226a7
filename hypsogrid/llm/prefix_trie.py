"""Trie of conversations: a node for each distinct beginning, with what could be saved by computing it once.

A conversation is the array of its turns' digests, packed into bytes that sort as the array does. The arrays are
range-sorted as a whole; in each range one sweep compares neighbours and keeps the nodes on the current array's path
open on a stack: a node that the next array does not share is closed, with all that its subtree adds up to. Nodes on
the path of a range's first or last array may go on in the ranges beside it, so they leave the sweep open; FAN
neighbouring ranges at a time are swept again over these open nodes alone, until one sweep closes all.

Nothing that grows with a node's subtree is held: a node's children wait for its smallest member in memory only up to
PENDING nodes of the sweep; others are joined with those few nodes that have such children, in SALTS parts. Members that
end in one node are hashed in the order of their numbers, as SHA-256 allows no other way; beyond CHUNK bytes their
numbers become rows of that size, which one task hashes as they stream by.

A conversation has to fit a row of Spark (2 GB at 40 bytes a turn: 50 million turns).

Edge cases: NULL role or text is empty; a NULL turn comes first; turns that tie, and repeated rows, are all kept, in the
order of their digests; rows with NULL conv_id belong to no conversation and are left out; a conversation may be left
without turns by rebuilding, it is then a member of the root alone; an empty table has no root and gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ranks, shared

#: Bytes of a turn's digest. Of 10**12 distinct turns, two share one with a chance of 10**-15.
DIGEST = 16
#: Neighbouring ranges whose open nodes one task sweeps.
FAN = 64
PENDING, CHUNK, SALTS = 20_000, 1 << 20, 32
#: Conversations of which the first one lends its beginning, and the number of lengths that it may have.
FAMILY, HEADS = 20, 4

OUT = (
    "kind string, segment long, seq long, on_left boolean, id binary, parent_id binary, depth long, words long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, waited_for boolean, in_rows boolean, ends_sha256 string, ends string"
)
_NAMES = [x.split()[0] for x in OUT.split(", ")]
NOBODY = (1 << 63) - 1  # the smallest member so far of a node without members


class _Node:
    __slots__ = ("ends", "id", "words", "conv", "convs", "children", "leaves", "saved", "left", "waited_for", "in_rows", "pending", "turn")

    def __init__(self, id: bytes, turn: bytes, words: int, left: bool) -> None:
        self.id, self.turn, self.words, self.left = id, turn, words, left
        self.conv, self.convs, self.children, self.leaves, self.saved = NOBODY, 0, 0, 0, 0
        self.waited_for = self.in_rows = False
        self.ends, self.pending = [], []


class Sweep:
    """Open nodes of a range, by depth, and the rows that it has made. In the last sweep of all nothing stays open."""

    def __init__(self, segment: int, last: bool = False) -> None:
        self.segment, self.last = segment, last
        self.stack: list[_Node] = []
        self.rows: list[tuple] = []
        self.kept_open: list[tuple[int, _Node]] = []
        self.n_pending = self.n_chunks = self.ends_bytes = 0

    # members

    def member(self, conv: int, key: bytes, words: np.ndarray) -> None:
        """The next conversation in the order of (key, conv)."""
        first, stack, depth = not self.stack, self.stack, len(key) // DIGEST
        if first:
            stack.append(_Node(b"", b"", 0, not self.last))
        shared_ = 0
        while shared_ < depth and shared_ + 1 < len(stack) and stack[shared_ + 1].turn == key[DIGEST * shared_ : DIGEST * (shared_ + 1)]:
            shared_ += 1
        self._close_below(shared_)
        for d in range(shared_, depth):
            turn = key[DIGEST * d : DIGEST * (d + 1)]
            stack.append(_Node(hashlib.blake2b(stack[-1].id + turn, digest_size=DIGEST).digest(), turn, int(words[d]), first and not self.last))
        node = stack[-1]
        node.conv, node.convs = min(node.conv, conv), node.convs + 1
        text = str(conv)
        node.ends.append(text)
        self.ends_bytes += len(text) + 1
        if self.ends_bytes > CHUNK:
            for n in stack:
                self._ends_to_rows(n)
            self.ends_bytes = 0

    # open nodes of earlier sweeps

    def node(self, r, first_segment: bool) -> None:
        """The next open node of the ranges, each range's in the order of its tree."""
        d, stack = r.depth, self.stack
        if d < len(stack) and stack[d].id == r.id:
            n = stack[d]
        else:
            self._close_below(d - 1)
            n = _Node(r.id, b"", r.words, first_segment and r.on_left and not self.last)
            stack.append(n)
        n.conv = min(n.conv, r.conv_id)
        n.convs, n.children, n.leaves, n.saved = n.convs + r.n_convs, n.children + r.n_children, n.leaves + r.n_leaves, n.saved + r.saved_tokens
        n.waited_for, n.in_rows = n.waited_for or r.waited_for, n.in_rows or r.in_rows

    def finish(self) -> None:
        if self.last:
            self._close_below(-1)
        else:
            self.kept_open += [(d, n) for d, n in enumerate(self.stack) if n.left]
            self.kept_open.sort(key=lambda x: x[0])
            self.kept_open += [(d, n) for d, n in enumerate(self.stack) if not n.left]
        for seq, (d, n) in enumerate(self.kept_open):
            self._let_go(n)
            self._ends_to_rows(n)
            self.rows.append(("open", self.segment, seq, n.left, n.id, None, d, n.words, n.conv, None, n.convs, n.children, n.leaves, n.saved, n.waited_for, n.in_rows, None, None))
        self.stack, self.kept_open = [], []

    # closing

    def _close_below(self, depth: int) -> None:
        stack = self.stack
        while len(stack) - 1 > depth:
            n = stack.pop()
            if n.left:
                self.kept_open.append((len(stack), n))
                continue
            leaves, saved = n.leaves or 1, n.saved + (n.convs - 1) * n.words
            if n.ends and n.in_rows:
                self._ends_to_rows(n)
            digest = None if n.in_rows else hashlib.sha256(",".join(n.ends).encode()).hexdigest()
            parent = stack[-1] if stack else None
            row = ("node", None, None, None, n.id, parent and parent.id, len(stack), n.words, n.conv, None, n.convs, n.children, leaves, saved, n.waited_for, n.in_rows, digest, None)
            for child in n.pending:
                self.rows.append((*child[:5], None, *child[6:9], n.conv, *child[10:]))
            self.n_pending -= len(n.pending)
            if parent is None:
                self.rows.append(row)
                continue
            parent.conv, parent.convs, parent.children = min(parent.conv, n.conv), parent.convs + n.convs, parent.children + 1
            parent.leaves, parent.saved = parent.leaves + leaves, parent.saved + saved
            parent.pending.append(row)
            self.n_pending += 1
            if self.n_pending > PENDING:
                for x in stack:
                    self._let_go(x)

    def _let_go(self, n: _Node) -> None:
        """Its closed children do not wait for its smallest member any longer."""
        self.rows += n.pending
        self.n_pending -= len(n.pending)
        n.waited_for |= bool(n.pending)
        n.pending = []

    def _ends_to_rows(self, n: _Node) -> None:
        if n.ends:
            row = dict.fromkeys(_NAMES) | {"kind": "ends", "segment": self.segment, "seq": self.n_chunks, "id": n.id, "ends": ",".join(n.ends)}
            self.rows.append(tuple(row.values()))
            self.n_chunks += 1
            n.ends, n.in_rows = [], True

    def taken(self) -> pd.DataFrame:
        rows, self.rows = self.rows, []
        return pd.DataFrame(rows, columns=_NAMES, dtype=object)


def _sweep_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sweep = None
    for batch in batches:
        sweep = sweep or (Sweep(int(batch["segment"].iloc[0])) if len(batch) else None)
        for conv, key, words in zip(batch["conv_id"].tolist(), batch["key"], batch["words"]):
            sweep.member(conv, bytes(key), words)
            if len(sweep.rows) >= 8192:
                yield sweep.taken()
        if sweep and sweep.rows:
            yield sweep.taken()
    if sweep:
        sweep.finish()
        yield sweep.taken()


def _sweep_open(last: bool, fan: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["segment", "seq"])
        first = frame["segment"].iloc[0]
        sweep = Sweep(int(first) // fan, last)
        for r in frame.itertuples(index=False):
            sweep.node(r, r.segment == first)
        sweep.finish()
        return sweep.taken()

    return run


def _hash_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now, digest = None, None
    for batch in batches:
        done = []
        for id_, text in zip(batch["id"], batch["ends"]):
            if id_ != now:
                if digest:
                    done.append((now, digest.hexdigest()))
                now, digest = id_, hashlib.sha256()
                digest.update(text.encode())
            else:
                digest.update(b"," + text.encode())
        yield pd.DataFrame(done, columns=["id", "_ends"])
    if digest:
        yield pd.DataFrame([(now, digest.hexdigest())], columns=["id", "_ends"])


def turn_arrays(conversations: DataFrame) -> DataFrame:
    """conv_id and said: its turns in order, as structs of turn, digest (hexadecimal) and words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * DIGEST)
    said = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", digest.alias("digest"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words")).alias("s"))
    return said.groupBy("conv_id").agg(F.sort_array(F.collect_list("s")).alias("said"))


def rebuilt(talks: DataFrame) -> DataFrame:
    """Conversations whose beginning is that of the first one of their family: the first h turns are replaced, h by a
    hash of the conversation's number. At most FAMILY conversations meet one beginning."""
    heads = talks.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("_family"), F.slice("said", 1, HEADS - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    joined = talks.withColumns({"_family": F.col("conv_id") - F.col("conv_id") % FAMILY, "_h": h}).join(heads, "_family", "left")
    head = F.coalesce(F.slice("_head", F.lit(1), F.col("_h")), F.filter("said", lambda s: F.lit(False)))
    tail = F.slice("said", F.col("_h") + 1, F.greatest(F.size("said") - F.col("_h"), F.lit(0)))
    return joined.select("conv_id", F.concat(head, tail).alias("said"))


def nodes(talks: DataFrame, fan: int = FAN) -> DataFrame:
    """talks (conv_id, said) -> the trie's nodes: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. A node is told by depth and conv_id."""
    spark = talks.sparkSession
    shared.bounded_batches(spark)
    key = F.unhex(F.array_join(F.transform("said", lambda s: s["digest"]), ""))
    packed = talks.select("conv_id", key.alias("key"), F.transform("said", lambda s: s["words"]).alias("words"))
    ranged = ranks.sorted_ranges(shared.keep(packed, "turn-arrays"), ["key", "conv_id"]).withColumn("segment", F.spark_partition_id())
    swept = shared.keep(ranged.mapInPandas(_sweep_members, OUT), "trie")
    segments, found, now = ranks.partitions(talks), [swept], swept
    while True:
        last = segments <= fan
        open_ = now.where("kind = 'open'")
        now = shared.keep(open_.groupBy(F.floor(F.col("segment") / fan)).applyInPandas(_sweep_open(last, fan), OUT), "trie")
        found.append(now)
        if last:
            break
        segments = -(-segments // fan)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    closed = every.where("kind = 'node'")
    wanted = closed.where("waited_for").select(F.col("id").alias("parent_id"), F.col("conv_id").alias("_conv"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    late = closed.where("parent_id is not null").withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    late = late.join(wanted, ["parent_id", "_salt"]).withColumn("parent_conv_id", F.col("_conv"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "in_rows", "id"]
    whole = closed.where("parent_id is null").select(*out).unionByName(late.select(*out))
    ends = every.where("kind = 'ends'").select("id", "segment", "seq", "ends").repartition("id").sortWithinPartitions("id", "segment", "seq")
    hashed = ends.mapInPandas(_hash_ends, "id binary, _ends string")
    long_ = whole.where("in_rows").join(hashed, "id").withColumn("ends_sha256", F.col("_ends"))
    return whole.where("not in_rows").select(*out[:-2]).unionByName(long_.select(*out[:-2]))


def with_last_turn(trie: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes of not rebuilt conversations with role and text of their last turn, NULL for the root; one join by member
    and place."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turns = conversations.where("conv_id is not null").select("conv_id", F.struct("turn", F.substring(digest, 1, 2 * DIGEST).alias("digest"), role.alias("role"), text.alias("text")).alias("s"))
    said = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("s")).alias("said")).select("conv_id", F.posexplode("said").alias("at", "s"))
    return trie.join(said.select("conv_id", (F.col("at") + 1).cast("long").alias("depth"), "s.role", "s.text"), ["conv_id", "depth"], "left")


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    return nodes(rebuilt(shared.keep(turn_arrays(conversations), "talks")))


_CRC = """xor(list_reduce([4294967295::bigint] || list_transform(string_split(cast(conv_id as varchar), ''), lambda x: ascii(x)::bigint),
  lambda c, b: list_reduce([xor(c, b)] || range(8), lambda v, i: case when v & 1 = 1 then xor(v >> 1, 3988292384::bigint) else v >> 1 end)), 4294967295::bigint)"""
ORACLE = f"""with t as (select conv_id, list({{'d': octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''),
    'w': len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))}} order by turn nulls first, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) as said
  from conversations where conv_id is not null group by conv_id),
h as (select *, {_CRC} % {HEADS} as h from t),
r as (select h.conv_id, coalesce(b.said[1:h], []) || h.said[h + 1:] as said from h left join t b on b.conv_id = h.conv_id - h.conv_id % {FAMILY}),
p as (select conv_id, len(said) as n, unnest(range(len(said) + 1)) as depth, said from r),
n as (select depth, list_transform(said[1:depth], lambda x: x.d) as k, any_value(case when depth > 0 then said[depth].w else 0 end) as w, min(conv_id) as conv_id, count(*) as n_convs,
  sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (n = depth), '')) as ends_sha256 from p group by depth, k),
c as (select depth - 1 as depth, k[1:depth - 1] as k, count(*) as n_children from n where depth > 0 group by all),
a as (select unnest(range(depth + 1)) as up, n.*, c.k is null as leaf from n left join c using (depth, k)),
s as (select up as depth, k[1:up] as k, count(*) filter (leaf) as n_leaves, sum((n_convs - 1) * w)::bigint as saved_tokens from a group by all)
select n.conv_id, n.depth, u.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves, saved_tokens, n.ends_sha256
from n join s using (depth, k) left join c using (depth, k) left join n u on u.depth = n.depth - 1 and u.k = n.k[1:n.depth - 1]"""
