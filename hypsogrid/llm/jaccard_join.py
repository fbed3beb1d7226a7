"""N-gram Jaccard join by chosen paths: sets of five-word shingles, similarity 0.8 or more.

Texts with equal shingle sets form a class and go on as one. A class carries COORDINATES min-hash values, an
embedding in which two sets agree on each coordinate with the probability of their similarity. Every node of
the path tree chooses each coordinate with probability 1 / (similarity * COORDINATES), the same for all its
sets, and splits its sets by their value there; so a pair at the threshold is expected in one child. Nodes are
split again until they hold at most LEAF sets or more than half of their parent's, as sets that are nearly equal
never part, or LEVELS times; then they are compared by brute force, larger ones in cells of two blocks each,
spread over tasks. Runs are repeated until a pair at the threshold is met with TARGET_RECALL, were all its nodes
split LEVELS times.

Sets that meet are compared by one byte of each coordinate first; pairs clearly above SKETCH_LEAST of the
threshold tie candidate groups together, and within a group, again in cells of two blocks, all pairs are
counted exactly. Counts and a spanning tree leave a cell, never its pairs.

Words are runs of bytes other than space and \\x09-\\x0D, A-Z lowered. A text of one to four words has one
shingle, all of it.

Edge cases: NULL texts and texts without words are like nothing and stay alone; equal rows count as links of
each other; doc_id may be of any type that has an order, NULL is a row like any other, and class_id is NULL where a group has no other; texts of any
length take part whole; an empty table gives no rows; clashing names among other columns are kept apart.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .components import components
from .words import _MULTIPLIER, mix, pieces, words

SHINGLE = 5
SIMILARITY = 0.8
COORDINATES = 128
LEVELS = 4
LEAF = 256
#: Rows of a block where sketches are compared, and where whole sets are.
SKETCH_BLOCK, SET_BLOCK = 1024, 256
TARGET_RECALL = 0.9999
#: Share of the threshold below which a sketch rules a pair out: 4.5 standard deviations at 128 coordinates.
SKETCH_LEAST = 0.8
#: Rows of (doc_id, text digest, class) that are broadcast at most, some 100 bytes each.
BROADCAST_CLASSES = 500_000

_random = np.random.RandomState(11)
_A = (_random.randint(0, 1 << 31, COORDINATES).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _random.randint(0, 1 << 31, COORDINATES).astype(np.uint32)


def shingle_sets(texts, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    w = words(texts, lower=True)
    n = len(w.hash)
    with np.errstate(over="ignore"):
        h = np.full(n, size, np.uint64)
        for k in range(size):
            h = h * np.uint64(_MULTIPLIER)
            h[: max(n - k, 0)] += w.hash[k:]
        h = mix(h)
        for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
            if b - a >= size:
                yield np.unique(h[a : b - size + 1])
            elif b > a:
                short = np.uint64(b - a)
                for x in w.hash[a:b]:
                    short = short * np.uint64(_MULTIPLIER) + x
                yield mix(np.array([short], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """COORDINATES min-hash values of each set; no set is empty."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), COORDINATES), np.uint32)
    buffer = np.empty_like(flat)
    for i in range(COORDINATES):
        np.multiply(flat, _A[i], out=buffer)
        np.add(buffer, _B[i], out=buffer)
        out[:, i] = np.minimum.reduceat(buffer, starts)
    return out


def _embed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """The digest of each text's shingle set and its min-hash values; NULL without words."""
    for batch in batches:
        texts = batch.tolist()
        keys: list = [None] * len(texts)
        signs: list = [None] * len(texts)
        for a, b in pieces(texts):
            sets = list(shingle_sets(texts[a:b]))
            some = [i for i, s in enumerate(sets) if len(s)]
            if some:
                for i, s in zip(some, _signatures([sets[i] for i in some])):
                    keys[a + i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    signs[a + i] = s.tobytes()
        yield pd.DataFrame({"key": keys, "sign": signs})


def runs_for(recall: float, levels: int = LEVELS) -> int:
    """Runs after which a pair at the threshold has met with that probability: with one child expected to hold
    both, a path of k levels survives with q(k) = 1 - exp(-q(k - 1))."""
    q = 1.0
    for _ in range(levels):
        q = 1 - math.exp(-q)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def _mixed(*parts) -> np.ndarray:
    h = np.uint64(0x51ED270B)
    with np.errstate(over="ignore"):
        for p in parts:
            h = mix((h ^ np.asarray(p, np.uint64)) * np.uint64(_MULTIPLIER) + np.uint64(1))
    return h


def _children(node: np.ndarray, signs: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child node) for every coordinate that a row's node chooses."""
    bound = np.uint64(int((1 << 64) / (similarity * COORDINATES)))
    rows, out = [], []
    for c in range(COORDINATES):
        at = np.flatnonzero(_mixed(node, c) < bound)
        rows.append(at)
        out.append(_mixed(node[at], c + 1000, signs[at, c]))
    return np.concatenate(rows), np.concatenate(out)


def _signs(column: pd.Series, kind=np.uint32) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest row reached from each of n rows by the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if (label == before).all():
            return label


def _whole_cells(frames: Iterator[pd.DataFrame], names: list[str]) -> Iterator[pd.DataFrame]:
    """Rows sorted by `names`, cut anew so that no cell is parted; a cell holds two blocks at most."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        same = np.ones(len(frame), bool)
        for c in names:
            same &= (frame[c] == frame[c].iloc[-1]).to_numpy()
        cut = len(frame) - int(same[::-1].argmin() if not same.all() else len(frame))
        if cut:
            yield pd.concat([*held, frame.iloc[:cut]], ignore_index=True) if held else frame.iloc[:cut].reset_index(drop=True)
            held = []
        elif held and any(held[-1][c].iloc[-1] != frame[c].iloc[0] for c in names):
            yield pd.concat(held, ignore_index=True)
            held = []
        held.append(frame.iloc[cut:])
    if held:
        yield pd.concat(held, ignore_index=True)


def _cells(df: DataFrame, group: str, block: int) -> DataFrame:
    """df (with `group`, its size `_n`, and `key`) with cells `_i`, `_j` and the row's block `_own`: each pair of blocks is one cell."""
    blocks = F.ceil(F.col("_n") / block).cast("int")
    own = F.pmod(F.xxhash64("key", group), blocks).cast("int")
    cut = df.withColumns({"_own": own, "_other": F.explode(F.sequence(F.lit(0), blocks - 1))})
    cut = cut.withColumns({"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other")}).drop("_other", "_n")
    return cut.repartition(group, "_i", "_j").sortWithinPartitions(group, "_i", "_j")


def _tie(least: float):
    """Links between rows of a cell whose sketches agree on `least` of the coordinates, as a spanning forest of all
    cells of a task: sets that meet in many runs are linked once."""
    need = math.floor(least * COORDINATES)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        above: dict[bytes, bytes] = {}

        def top(k: bytes) -> bytes:
            while (up := above.get(k, k)) != k:
                above[k] = above.get(up, up)
                k = up
            return k

        def joins(a: bytes, b: bytes) -> bool:
            a, b = top(a), top(b)
            if a != b:
                above[max(a, b)] = min(a, b)
            return a != b

        for frame in _whole_cells(frames, ["node", "_i", "_j"]):
            n = len(frame)
            cell = np.concatenate([[0], np.cumsum(np.any([frame[c].to_numpy()[1:] != frame[c].to_numpy()[:-1] for c in ("node", "_i", "_j")], axis=0))])
            signs, own = _signs(frame["sketch"], np.uint8), frame["_own"].to_numpy()
            cross = frame["_i"].to_numpy() != frame["_j"].to_numpy()
            end = np.searchsorted(cell, cell, side="right")
            a, b = [], []
            left = np.arange(n)
            d = 1
            while len(left := left[left + d < end[left]]):  # rows that have a d-th row after them in their cell
                for k in range(0, len(left), 65536):
                    i = left[k : k + 65536]
                    i = i[~cross[i] | (own[i] != own[i + d])]
                    if len(i):
                        i = i[np.count_nonzero(signs[i] == signs[i + d], axis=1) >= need]
                        a.append(i)
                        b.append(i + d)
                d += 1
            a, b = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (a, b))
            root = _roots(a, b, n)
            at = np.flatnonzero(root != np.arange(n))
            keys = frame["key"].to_numpy()
            links = [(x, y) for x, y in zip(keys[at], keys[root[at]]) if joins(x, y)]
            yield pd.DataFrame(links, columns=["a", "b"])

    return run


def _overlaps(sets: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 matrices over the elements that two sets or more share."""
    n = len(sets)
    lengths = np.array([len(s) for s in sets])
    element, index = np.unique(np.concatenate(sets), return_inverse=True)
    rows = np.repeat(np.arange(n), lengths)
    shared_ = np.bincount(index, minlength=len(element)) > 1
    place = np.cumsum(shared_) - 1
    keep = shared_[index]
    rows, index = rows[keep], place[index[keep]]
    order = np.argsort(index, kind="stable")
    rows, index = rows[order], index[order]
    out = np.zeros((n, n), np.float64)
    for at in range(0, int(shared_.sum()), width):
        lo, hi = np.searchsorted(index, [at, at + width])
        m = np.zeros((n, width), np.float32)
        m[rows[lo:hi], index[lo:hi] - at] = 1
        out += m @ m.T
    return out


def _count(similarity: float):
    """For each row of a cell: links within it, documents behind them, and the root of its spanning tree."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _whole_cells(frames, ["component", "_i", "_j"]):
            out = []
            for (_, i, j), cell in frame.groupby(["component", "_i", "_j"], sort=False):
                sets = [np.frombuffer(x, np.uint64) for x in cell["set"]]
                size = np.array([len(s) for s in sets], np.float64)
                both = _overlaps(sets)
                linked = both >= similarity * (size[:, None] + size[None, :] - both) - 1e-9
                np.fill_diagonal(linked, False)
                if i != j:
                    own = cell["_own"].to_numpy()
                    linked &= own[:, None] != own[None, :]
                copies, keys = cell["copies"].to_numpy(), cell["key"].to_numpy()
                root = _roots(*np.nonzero(linked), len(cell))
                out.append(pd.DataFrame({"key": keys, "root": keys[root], "texts": linked.sum(1), "linked": linked @ copies}))
            yield pd.concat(out)

    return run


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = frame["text"].tolist()
        for a, b in pieces(texts):
            part = frame.iloc[a:b].drop(columns="text")
            yield part.assign(set=[s.tobytes() for s in shingle_sets(texts[a:b])])


def join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = TARGET_RECALL, leaf: int = LEAF, levels: int = LEVELS,
         broadcast_classes: int = BROADCAST_CLASSES) -> tuple[DataFrame, DataFrame]:
    """(rows, classes). rows: doc_id, digest (MD5 of the text), key (the class of equal shingle sets, NULL without
    words). classes: key, copies, first_id, component, group_id (smallest doc_id of all texts linked, however indirectly),
    n_texts (other classes linked), n_linked (documents in those)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    shared.bounded_batches(docs.sparkSession)
    taken = docs.select("doc_id", text.alias("text"), F.md5(text).alias("digest"))
    embed = F.pandas_udf(_embed, "key binary, sign binary")
    rows = shared.keep(taken.select("doc_id", "digest", embed("text").alias("_e")).select("doc_id", "digest", "_e.key", "_e.sign"), "jaccard-rows")
    by_key = rows.where("key is not null").groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("r"), F.first("sign").alias("sign")
    )
    classes = shared.keep(by_key.select("key", "copies", F.col("r.doc_id").alias("first_id"), F.col("r.digest").alias("digest"), "sign"), "jaccard-classes")

    runs = runs_for(recall, levels)

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            signs, keys = _signs(frame["sign"]), frame["key"].to_numpy()
            for r in range(runs):
                row, node = _children(np.full(len(frame), _mixed(r)), signs, similarity)
                yield pd.DataFrame({"node": node.view(np.int64), "key": keys[row]})

    def deeper(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            row, node = _children(frame["node"].to_numpy().view(np.uint64), _signs(frame["sign"]), similarity)
            yield pd.DataFrame({"node": node.view(np.int64), "key": frame["key"].to_numpy()[row], "parent_n": frame["_n"].to_numpy()[row]})

    signs = classes.select("key", "sign")
    leaves = None
    at = signs.mapInPandas(first, "node long, key binary").withColumn("parent_n", F.lit(1 << 62))
    for level in range(1, levels + 1):
        at = shared.keep(at, "jaccard-paths")
        sizes = at.groupBy("node").agg(F.count(F.lit(1)).alias("_n"), F.first("parent_n").alias("parent_n")).where("_n > 1")
        split = (F.col("_n") > leaf) & (2 * F.col("_n") <= F.col("parent_n")) & F.lit(level < levels)
        sizes = shared.keep(sizes.select("node", "_n", split.alias("split")), "jaccard-nodes")
        met = at.drop("parent_n").join(sizes, "node")
        small = met.where("not split").drop("split")
        leaves = small if leaves is None else leaves.unionByName(small)
        if sizes.where("split").isEmpty():
            break
        at = met.where("split").join(signs, "key").select("node", "key", "_n", "sign").mapInPandas(deeper, "node long, key binary, parent_n long")

    def sketched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"key": frame["key"], "sketch": [x.tobytes() for x in (_signs(frame["sign"]) >> np.uint32(13)).astype(np.uint8)]})

    sketches = signs.mapInPandas(sketched, "key binary, sketch binary")
    cells = _cells(leaves.join(sketches, "key"), "node", SKETCH_BLOCK)
    candidates = components(cells.mapInPandas(_tie(SKETCH_LEAST * similarity), "a binary, b binary"))

    candidates = shared.keep(candidates, "jaccard-groups")
    sizes = candidates.groupBy("component").agg(F.count(F.lit(1)).alias("_n"))
    members = candidates.select(F.col("node").alias("key"), "component").join(classes.drop("sign"), "key").join(sizes, "component")
    members = shared.keep(members, "jaccard-members")
    # one text of each class, fetched where the documents lie if the classes are few
    few = F.broadcast(members) if members.count() <= broadcast_classes else members
    fetched = taken.withColumnRenamed("doc_id", "_id").join(few, "digest").where(F.col("_id").eqNullSafe(F.col("first_id"))).select("component", "key", "copies", "_n", "text")
    sets = fetched.mapInPandas(_sets, "component binary, key binary, copies long, _n long, set binary")
    sets = sets.dropDuplicates(["key"])  # rows that are equal in doc_id and text
    counted = _cells(sets, "component", SET_BLOCK).mapInPandas(_count(similarity), "key binary, root binary, texts long, linked long")
    counted = shared.keep(counted, "jaccard-links")
    groups = shared.keep(components(counted.select(F.col("key").alias("a"), F.col("root").alias("b"))), "jaccard-final")
    links = counted.groupBy("key").agg(F.sum("texts").alias("n_texts"), F.sum("linked").alias("n_linked"))
    named = classes.select("key", "copies", "first_id").join(groups.withColumnRenamed("node", "key"), "key", "left").join(links, "key", "left")
    lowest = named.where("component is not null").groupBy("component").agg(F.min("first_id").alias("_least"))
    out = named.join(lowest, "component", "left").select(
        "key", "copies", "first_id", F.coalesce("component", "key").alias("component"), F.when(F.col("component").isNull(), F.col("first_id")).otherwise(F.col("_least")).alias("group_id"),
        F.coalesce("n_texts", F.lit(0)).cast("long").alias("n_texts"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
    )
    return rows.select("doc_id", "digest", "key"), out


def link_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its group), n_links (documents of similarity 0.8 or more, copies
    included) and n_texts (different texts among them) for every document."""
    rows, classes = join(docs.select("doc_id", "text"), **options)
    joined = rows.select("doc_id", "key").join(classes, "key", "left")
    none = F.col("key").isNull()
    return joined.select(
        "doc_id",
        F.when(none, F.col("doc_id")).otherwise(F.col("group_id")).alias("class_id"),
        F.when(none, F.lit(0)).otherwise(F.col("copies") - 1 + F.col("n_linked")).cast("long").alias("n_links"),
        F.when(none, F.lit(0)).otherwise(F.col("n_texts")).cast("long").alias("n_texts"),
    )


def keep_one(docs: DataFrame, broadcast_rows: int = BROADCAST_CLASSES, **options) -> DataFrame:
    """docs with one document of each group: that of the smallest doc_id (NULL last), then the smallest digest of
    the text; of rows equal in both, any one. Documents without words all stay."""
    rows, classes = join(docs.select("doc_id", "text"), **options)
    grouped = rows.where("key is not null").join(classes.select("key", "component"), "key")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("digest").alias("digest"))
    first = grouped.groupBy("component").agg(F.min(order).alias("r"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = grouped.groupBy("component", "doc_id", "digest").agg(F.count(F.lit(1)).alias("rows"))
    pairs = pairs.join(first.select("component", "r"), "component")
    chosen = F.col("doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("digest") == F.col("r.digest"))
    judged = shared.keep(pairs.select("doc_id", "digest", chosen.alias("chosen"), "rows").where("not chosen or rows > 1"), "jaccard-drops")
    few = (lambda df: F.broadcast(df)) if judged.count() <= broadcast_rows else (lambda df: df)
    held = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.md5(F.coalesce("text", F.lit(""))).alias("_digest"))
    same = lambda df: held["_id"].eqNullSafe(df["doc_id"]) & (held["_digest"] == df["digest"])
    out = held.join(few(judged), same(judged), "left_anti").select("_row.*")
    repeated = judged.where("chosen")
    if not repeated.isEmpty():
        once = held.join(few(repeated), same(repeated), "left_semi").dropDuplicates(["_id", "_digest"])
        out = out.unionByName(once.select("_row.*"))
    return out
