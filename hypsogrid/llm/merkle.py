"""Merkle manifest of a dataset: a digest for each row, a tree for each group of rows, a tree over the groups, and for
each row the path of digests that leads from it to the root.

Leaves are placed in a global order first (`ranks`). Aligned blocks of 2**LEVELS nodes of one level go to tasks; in
each, treehash stacks run ahead of the current leaf and hand over the next nodes of its path just when they are
needed (Szydlo's schedule: the stack with the lowest tail goes first, two steps a level and leaf), so a task holds the
block's leaves and some three digests a level. The blocks' roots are the leaves of the next, 2**LEVELS times smaller
table, until one block is left of each group; the groups' roots make a last tree. Paths of upper blocks are joined to
the nodes below them: at most 2**LEVELS rows meet one of them, however large a group is.

A node without a partner is hashed alone. A path has an entry for each level, NULL where there is no partner.

Edge cases: NULL columns are written as `-`, so NULL and empty differ; a NULL group is a group of its own and the first;
a NULL doc_id comes before all others; rows of one doc_id are ordered by their leaves, and equal rows have paths
of their own, dealt to them in some order; one leaf is its own root; an empty table has no tree and gives no rows;
columns other than those of `FIELDS` are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from . import ranks, shared

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A block has 2**LEVELS nodes.
LEVELS = 10
#: One document in so many has another n_chars in the tampered copy.
TAMPERED_OF = 7


def _parent(a: str | None, b: str | None) -> str | None:
    return None if a is None else hashlib.sha256((a + (b or "")).encode()).hexdigest()


class Treehash:
    """Computes one node from the leaves below it, a step at a time."""

    def __init__(self, leaves: list[str], height: int) -> None:
        self.leaves, self.height, self.at, self.stack = leaves, height, 0, []
        self.low = math.inf  # idle

    def start(self, first: int) -> None:
        self.at, self.stack = first, []
        if first >= len(self.leaves):
            self.stack, self.low = [(self.height, None)], math.inf  # nothing there
        else:
            self.low = self.height

    def step(self) -> None:
        """Merges the two last nodes if they are of one height, else takes the next leaf."""
        stack = self.stack
        if len(stack) > 1 and stack[-1][0] == stack[-2][0]:
            height, right = stack.pop()
            stack[-1] = (height + 1, _parent(stack[-1][1], right))
        else:
            stack.append((0, self.leaves[self.at] if self.at < len(self.leaves) else None))
            self.at += 1
        self.low = math.inf if stack[0][0] == self.height else stack[-1][0]

    @property
    def node(self) -> str | None:
        return self.stack[0][1]


def paths(leaves: list[str], height: int) -> Iterator[list[str | None]]:
    """The partners of each leaf at each level of a tree of at most 2**height leaves, leaf by leaf."""
    stacks = [Treehash(leaves, h) for h in range(height)]
    path: list[str | None] = []
    for h, ahead in enumerate(stacks):  # of the first leaf: the second node of each level; the first one comes next
        second = Treehash(leaves, h)
        for tree, first in ((second, 1 << h), (ahead, 0)):
            tree.start(first)
            while tree.low < math.inf:
                tree.step()
        path.append(second.node)
    for leaf in range(len(leaves)):
        yield list(path)
        for h in range(height):
            if (leaf + 1) % (1 << h):
                break
            path[h] = stacks[h].node
            stacks[h].start((leaf + 1 + (1 << h)) ^ (1 << h))
        for _ in range(2 * height - 1):
            lowest = min(stacks, key=lambda s: s.low)
            if lowest.low == math.inf:
                break
            lowest.step()


def root(leaves: list[str], height: int) -> str:
    tree = Treehash(leaves, height)
    tree.start(0)
    while tree.low < math.inf:
        tree.step()
    return tree.node


def _block_paths(frame: pd.DataFrame, levels: int) -> pd.DataFrame:
    """siblings of each node of a block; block_root in the row of its first node."""
    frame = frame.sort_values("position", ignore_index=True)
    leaves, n = frame["digest"].tolist(), int(frame["n_group"].iloc[0])
    height = min(levels, (n - 1).bit_length())
    frame["siblings"] = list(paths(leaves, height))
    frame["block_root"] = [root(leaves, height), *[None] * (len(leaves) - 1)]
    return frame


def _climb(nodes: DataFrame, finish: Callable[[DataFrame], DataFrame] | None, levels: int) -> DataFrame:
    """nodes (group, position, n_group, digest, and more) with path, subroot and `height` of the group's tree, and with
    what `finish` gives for each group from (group, subroot): group, above (a path), root, place."""
    from_pandas = StructType([*nodes.schema.fields, StructField("siblings", ArrayType(StringType())), StructField("block_root", StringType())])
    blocks = nodes.groupBy("group", F.shiftright("position", levels)).applyInPandas(lambda f: _block_paths(f, levels), from_pandas)
    kept = shared.keep(blocks, "merkle")
    up = F.shiftright("position", levels)
    roots = kept.where("block_root is not null").select(
        "group", up.alias("position"), (F.shiftright(F.col("n_group") - 1, levels) + 1).alias("n_group"), F.col("block_root").alias("digest"))
    largest = roots.agg(F.max("n_group")).first()[0]
    if largest is not None and largest > 1:
        over = _climb(roots, finish, levels).select("group", F.col("position").alias("_block"), F.col("path").alias("_path"), "subroot", F.col("height").alias("_height"), "above", "root", "place")
    else:
        tops = roots.select("group", F.lit(0).cast("long").alias("_block"), F.array().cast("array<string>").alias("_path"), F.col("digest").alias("subroot"), F.lit(0).alias("_height"))
        over = tops.join(finish(tops.select("group", "subroot")), "group") if finish else tops.select(
            "*", F.array().cast("array<string>").alias("above"), F.col("subroot").alias("root"), F.lit(0).cast("long").alias("place"))
    joined = kept.withColumn("_block", up).join(over, ["group", "_block"])
    return joined.withColumns({"path": F.concat("siblings", "_path"), "height": F.col("_height") + F.size("siblings")}).drop("_block", "_path", "_height", "siblings", "block_root")


def _tree_of_groups(roots: DataFrame, levels: int) -> DataFrame:
    """group, subroot -> group, above, root, place: the tree whose leaves are the groups' roots, in the groups' order."""
    leaves = ranks.numbered(roots.select(F.lit("").alias("_all"), "group", "subroot"), "_all", ["group"])
    nodes = leaves.select(F.lit("").alias("group"), "position", "n_group", F.col("subroot").alias("digest"), F.col("group").alias("own"))
    return _climb(nodes, None, levels).select(F.col("own").alias("group"), F.col("path").alias("above"), F.col("subroot").alias("root"), F.col("position").alias("place"))


def prove(leaves: DataFrame, group: str, order: list[str], digest: str, levels: int = LEVELS) -> DataFrame:
    """leaves with subroot, root, path (partners from the leaf to the root), and index: bit k tells whether the
    partner of level k stands on the left. `group` (text, may be NULL) parts the leaves into trees."""
    # NULL before all others, as the encoding is empty for it alone
    keyed = leaves.withColumnRenamed(digest, "digest").withColumn("group", F.coalesce(F.concat(F.lit("+"), group), F.lit("")))
    nodes = ranks.numbered(keyed, "group", [*order, "digest"])
    climbed = _climb(nodes, lambda roots: _tree_of_groups(roots, levels), levels)
    index = F.col("position") + F.call_function("shiftleft", F.col("place"), F.col("height"))
    return climbed.select(
        *[F.col("digest").alias(c) if c == digest else F.col(c) for c in leaves.columns], "subroot", "root", F.concat("path", "above").alias("path"), index.alias("index"))


def fold(leaf: Column, path: Column, index: Column) -> Column:
    """The root that a leaf and its path lead to."""
    steps = F.transform(path, lambda d, k: F.struct(d.alias("d"), (F.call_function("shiftright", index, k) % 2 == 1).alias("left")))
    up = lambda a, s: F.sha2(F.when(s["left"], F.concat(F.coalesce(s["d"], F.lit("")), a)).otherwise(F.concat(a, F.coalesce(s["d"], F.lit("")))).cast("binary"), 256)
    return F.aggregate(steps, leaf, up)


def leaf(**changed: Column) -> Column:
    """Digest of a row: each field with its length before it, so that no two rows run together."""

    def written(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(written, FIELDS)).cast("binary"), 256)


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf, subroot (of its language), root, path and index of each document."""
    return prove(shared.keep(docs.select("doc_id", "lang", leaf().alias("leaf")), "leaves"), "lang", ["doc_id"], "leaf")


def verify(proofs: DataFrame) -> DataFrame:
    """proofs (leaf, path, index, root) with folded_root and verified, which is false for a changed leaf or path."""
    folded = proofs.withColumn("folded_root", fold(F.col("leaf"), F.col("path"), F.col("index")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def prove_documents(docs: DataFrame, tampered_of: int = TAMPERED_OF, levels: int = LEVELS) -> DataFrame:
    """Each document's place in the manifest, and the root that it leads to once n_chars of some have been changed."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % tampered_of == 0, F.lit(False))
    more = F.col("n_chars").cast("decimal(20,0)") + 1  # the largest long has a successor, too
    rows = docs.select("doc_id", "lang", leaf().alias("leaf"), F.when(hit & F.col("n_chars").isNotNull(), leaf(n_chars=more)).alias("tampered"))
    proofs = prove(shared.keep(rows, "leaves"), "lang", ["doc_id"], "leaf", levels)
    proof = F.sha2(F.array_join("path", "").cast("binary"), 256)
    now = verify(proofs.withColumnsRenamed({"leaf": "original"}).withColumn("leaf", F.coalesce("tampered", "original")))
    return now.select("doc_id", F.col("original").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"), "folded_root", "verified")


def _written(name: str) -> str:
    return f"coalesce(octet_length(encode(cast({name} as varchar))) || ':' || {name}, '-')"


_LEAF = " || ".join(map(_written, FIELDS))
_TAMPERED = " || ".join(map(_written, (*FIELDS[:3], "(cast(n_chars as decimal(20, 0)) + 1)", *FIELDS[4:])))
_CRC = """xor(list_reduce([4294967295::bigint] || list_transform(string_split(cast(doc_id as varchar), ''), lambda x: ascii(x)::bigint),
  lambda c, b: list_reduce([xor(c, b)] || range(8), lambda v, i: case when v & 1 = 1 then xor(v >> 1, 3988292384::bigint) else v >> 1 end)), 4294967295::bigint)"""
ORACLE = f"""with recursive l as (select doc_id, dense_rank() over (order by lang nulls first) - 1 as g, sha256({_LEAF}) as leaf,
  case when {_CRC} % {TAMPERED_OF} = 0 and n_chars is not null then sha256({_TAMPERED}) end as tampered from documents),
p as (select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as pos, row_number() over () as id from l),
hs as (select g, cast(ceil(log2(count(*))) as bigint) as height from p group by g),
tree as (select g, 0::bigint as level, pos, leaf as h from p union all
  select g, level + 1, pos // 2, sha256(string_agg(h, '' order by pos)) from tree join hs using (g) where level < height group by g, level, pos // 2),
tops as (select g, h as subroot from tree join hs using (g) where level = height),
top_height as (select cast(ceil(log2(count(*))) as bigint) as th from tops),
upper as (select 0::bigint as level, cast(g as bigint) as pos, subroot as h from tops union all
  select level + 1, pos // 2, sha256(string_agg(h, '' order by pos)) from upper, top_height where level < th group by level, pos // 2),
steps as (select id, k.level, t.h, (p.pos >> k.level) & 1 = 1 as l from p join hs using (g), lateral (select unnest(range(height)) as level) k
    left join tree t on t.g = p.g and t.level = k.level and t.pos = xor(p.pos >> k.level, 1::bigint)
  union all select id, height + k.level, t.h, (p.g >> k.level) & 1 = 1 from p join hs using (g), top_height, lateral (select unnest(range(th)) as level) k
    left join upper t on t.level = k.level and t.pos = xor(p.g >> k.level, 1::bigint)),
proofs as (select id, string_agg(h, '' order by level) as siblings, list(case when l then 'L' else 'R' end || coalesce(h, '') order by level) as steps from steps group by id),
root as (select h as root from upper, top_height where level = th),
f as (select p.doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) as proof_sha256,
  list_reduce([coalesce(tampered, leaf)] || coalesce(steps, []), lambda a, e: sha256(case when e[1] = 'L' then e[2:] || a else a || e[2:] end)) as folded_root
  from p join tops using (g) cross join root left join proofs using (id))
select *, folded_root = root as verified from f"""
