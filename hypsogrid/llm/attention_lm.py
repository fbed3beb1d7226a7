"""LM scoring: a causal self-attention model on subword ids, trained in numpy, scores whole texts.

A text is its words (runs of bytes other than space and \\x09-\\x0D, A-Z lowered) and an end; each word becomes
the ids of a public byte-level vocabulary. Counts of ids over all training texts give each of the HEAD most
frequent ids a class of its own and put the others into BINS classes, half of them for ids that begin a word. The
network gives the probability that the next id begins a word (the end counts as one) and, given that, its class;
the counts give the id within its class. So the network alone gives a word its first id, given that a word
begins, and then the rest, given the first: by spelling, id after id and the begin of another word. The rest is
interpolated with counts of whole words after their first id (Witten-Bell), of all words of the training texts. A
text's score is a proper log-probability.

Inputs are cut into blocks of BLOCK ids. A window is two blocks, and windows overlap by one: every id of the
second block is predicted once, from itself and what lies before it in the window, by masked attention over
many windows at once.

Training: every window of all training texts, once. One pass over the texts counts words and ids and writes the ids
of each text, in rows of at most PART ids; equal rows are one, with their number as weight. Rows are dealt to
ROUNDS rounds and to tasks by their hashes; in each round every task trains on the windows of its rows from the
common weights, and the weights are averaged in Spark.

The counts of the MODEL_WORDS most frequent words at most are broadcast; occurrences of all other words leave the
scorer with the logarithm of what their spelling gives them and are joined with the sharded counts, which
completes the base and the score. The result does not depend on MODEL_WORDS.

Edge cases: NULL and empty texts are the end alone; a NULL doc_id is held out; with nothing to learn from the
counts are 0 and the network is as drawn; equal texts get equal scores but for the rounding of sums; texts of any
length are scored whole; an empty table gives no rows; other columns are not read, and doc_id is of any type.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared
from .words import pieces, words

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
END = 50256
HEAD, BINS = 160, 32
CLASSES = HEAD + BINS
BLOCK = 16
NONE = 255  # no id: before the start or after the end of a text
KEY, WIDTH = 16, 32
PART = 256 * BLOCK
_LEAD = BLOCK + 1  # ids before a row that is not a text's first: a block of inputs
ROUNDS, BLOCKS_PER_TASK, LEAST_TASKS = 6, 50_000, 4
MODEL_WORDS = 3_000_000
_SIDE = 64
_END_WORD = 1
_CACHED, _SLOTS = 1_000_000, 1 << 21
_ODD_SPACES = re.compile(r"[^\S ] [^\S ]")


@functools.lru_cache(1)
def _encoding(name: str) -> tiktoken.Encoding:
    with open(public_tokenizers.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("subwords", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(1)
def _begins(name: str) -> np.ndarray:
    """Whether an id begins a word; the end counts as one."""
    encoding = _encoding(name)
    return np.array([encoding.decode_single_token_bytes(i)[:1] == b" " for i in range(END)] + [True])


class _Subwords:
    """Ids of words seen, in one flat array, found by the slots of their hashes; a word takes the slot of another one,
    which is then encoded again when it comes. Begun anew when it holds _CACHED words."""

    def __init__(self, name: str):
        self.encode, self.begins = _encoding(name).encode_ordinary, _begins(name)
        self.clear()

    def clear(self) -> None:
        self.flat, self.used, self.words = np.empty(1 << 16, np.uint16), 0, 0
        self.key, self.start, self.size = (np.zeros(_SLOTS, kind) for kind in (np.uint64, np.int64, np.int64))

    def _encoded(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of words, each after a space, and how many each has. All are encoded as one text: a match of the
        pattern holds no space but at its start, unless white space other than a space stands on both its sides."""
        size = end - start + 1
        first = np.cumsum(size) - size
        joined = raw[np.repeat(start - 1 - first, size) + np.arange(int(size.sum()))]
        joined[first] = 0x20
        text = joined.tobytes().decode("utf-8", "replace")
        if _ODD_SPACES.search(text):
            each = [self.encode(" " + x) for x in text[1:].split(" ")]
            return np.array([i for x in each for i in x], np.uint16), np.array([len(x) for x in each], np.int64)
        ids = np.array(self.encode(text), np.uint16)
        return ids, np.diff(np.flatnonzero(self.begins[ids]), append=len(ids))

    def of(self, w, distinct: np.ndarray, first_at: np.ndarray, inverse: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all words of a batch, how many each word has, and each text."""
        if self.words > _CACHED:
            self.clear()
        slot = (distinct % np.uint64(_SLOTS)).astype(np.int64)
        start, size = self.start[slot], self.size[slot]
        new = np.flatnonzero((self.key[slot] != distinct) | (size == 0))
        if len(new):
            ids, size[new] = self._encoded(w.bytes, w.start[first_at[new]], w.end[first_at[new]])
            start[new] = self.used + np.cumsum(size[new]) - size[new]
            if self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.empty(len(self.flat) + len(ids), np.uint16)])
            self.flat[self.used : self.used + len(ids)] = ids
            self.used, self.words = self.used + len(ids), self.words + len(new)
            self.key[slot[new]], self.start[slot[new]], self.size[slot[new]] = distinct[new], start[new], size[new]
        each, size = start[inverse], size[inverse]
        after = np.cumsum(size)
        ids = self.flat[np.repeat(each - after + size, size) + np.arange(int(after[-1]) if len(after) else 0)]
        bounds = np.concatenate([[0], after])[w.first]
        return ids, size, np.diff(bounds)


@functools.lru_cache(1)
def _subwords(name: str) -> _Subwords:
    return _Subwords(name)


def _tokens(texts, vocabulary: str):
    """(words, distinct hashes, inverse, ids with an END after each text, ids per text, where words and ends begin)."""
    w = words(texts, lower=True)
    distinct, first_at, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
    flat, of_word, size = _subwords(vocabulary).of(w, distinct, first_at, inverse)
    ids = np.full(len(flat) + len(size), END, np.int64)
    ends = np.cumsum(size + 1) - 1
    inner = np.ones(len(ids), bool)
    inner[ends] = False
    ids[inner] = flat
    at = np.flatnonzero(inner)
    begins = at[np.cumsum(of_word) - of_word] if len(at) else at
    return w, distinct, inverse, ids, size + 1, np.sort(np.concatenate([begins, ends]))


def _blocks(classes: np.ndarray, size: np.ndarray, end_class: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs and targets by blocks, and where each target lies: a text is a block of NONE and then its blocks;
    the input of a target is what stands before it, at the start the end of the text before."""
    count = 1 + -(-size // BLOCK)
    first = (np.cumsum(count) - count) * BLOCK
    offset = np.cumsum(size) - size
    at = np.repeat(first + BLOCK - offset, size) + np.arange(len(classes))
    inputs, targets = (np.full(int(count.sum()) * BLOCK, NONE, np.uint8) for _ in "ab")
    targets[at] = classes
    before = np.concatenate([[end_class], classes[:-1]])
    inputs[at] = before
    inputs[first + BLOCK] = end_class
    return inputs.reshape(-1, BLOCK), targets.reshape(-1, BLOCK), at


def _sums(classes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of rows by class, 8 bits each; a row for each of 256."""
    order = np.argsort(classes, kind="stable")
    count, out = np.bincount(classes, minlength=256), np.zeros((256, rows.shape[1]), rows.dtype)
    seen = np.flatnonzero(count)
    out[seen] = np.add.reduceat(rows.take(order, 0), (np.cumsum(count) - count)[seen], 0)
    return out


def _reuse_memory() -> None:
    """glibc hands arrays above 128 KB back to the system until a larger one was freed, and each new one costs page
    faults, a third of the time of a step here. Once an array of 16 MB was freed, it keeps those up to that size."""
    np.empty(16 << 20, np.uint8)


class Attention:
    """One layer: queries, keys and values are looked up by class, a bias by distance; then a hidden layer and the classes."""

    def __init__(self, frequency: np.ndarray | None = None, begins: int = CLASSES // 2, seed: int = 0, p: dict | None = None):
        """begins: so many classes, the first ones, hold ids that begin a word."""
        if p is None:
            rng = np.random.default_rng(seed)
            draw = lambda scale, *shape: (scale * rng.standard_normal(shape)).astype(np.float32)
            p = {"q": draw(0.5, 256, KEY), "k": draw(0.5, 256, KEY), "v": draw(0.3, 256, KEY), "e": draw(0.3, 256, WIDTH),
                 "near": draw(0.1, 2 * BLOCK), "o": draw(0.2, KEY, WIDTH), "w": draw(0.15, WIDTH, CLASSES), "b": np.log(frequency).astype(np.float32),
                 "z": draw(0.15, WIDTH), "y": np.zeros(1, np.float32)}
        self.p, self.begins = p, begins
        i, j = np.arange(BLOCK)[:, None] + BLOCK, np.arange(2 * BLOCK)[None, :]
        self.distance = np.clip(i - j, 0, None)
        self.ahead = np.where(j > i, np.float32(-1e9), np.float32(0))

    def _kinds(self, targets: np.ndarray):
        """The targets in order of kind: those that begin a word, the others, and no targets. Then, for both kinds, the
        range of places and the range of classes."""
        first, none = targets < self.begins, targets == NONE
        parts = np.flatnonzero(first), np.flatnonzero(~(first | none)), np.flatnonzero(none)
        n, m = len(parts[0]), len(parts[0]) + len(parts[1])
        return np.concatenate(parts), [x for x in ((slice(0, n), 0, self.begins), (slice(n, m), self.begins, CLASSES)) if x[0].start < x[0].stop]

    def _scores_of_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Exponents of scores: by query and key, and by place in the window, where what lies ahead has 0. Scores are
        small numbers, so their exponents are taken as they are; if any overflows, the result is not finite and `log_p` says so."""
        p = self.p
        table = np.zeros((256, 256), p["q"].dtype)  # NONE has 0: the first block of a text; ends of texts lie ahead of all queries
        table[:CLASSES, :CLASSES] = np.exp(p["q"][:CLASSES] @ p["k"][:CLASSES].T)
        return table.ravel(), np.exp(p["near"][self.distance] + self.ahead)

    def _hidden(self, keys: np.ndarray, order: np.ndarray, of_pairs: tuple[np.ndarray, np.ndarray]):
        """Pairs of classes, values, weights of attention, their outcome and, in the given order of targets, inputs, outcome
        and the hidden layer. Queries and keys are of classes, so exponents of their scores are looked up in a table of pairs."""
        p, of_keys = self.p, keys.astype(np.int64)
        now = of_keys[:, BLOCK:]
        pairs = (now << 8)[:, :, None] + of_keys[:, None, :]
        a = of_pairs[0].take(pairs)
        a *= of_pairs[1]
        total = a.reshape(-1, 2 * BLOCK) @ np.ones(2 * BLOCK, a.dtype) + np.float32(1e-30)
        a *= (1 / total).reshape(-1, BLOCK, 1)
        v = p["v"].take(of_keys, 0)
        o = a @ v
        ordered, own = o.reshape(-1, KEY).take(order, 0), keys[:, BLOCK:].ravel()[order]
        h = ordered @ p["o"]
        h += p["e"].take(own, 0)
        np.maximum(h, 0, out=h)
        return pairs, v, a, o, own, ordered, h

    def log_p(self, keys: np.ndarray, targets: np.ndarray, batch: int = 128) -> np.ndarray:
        """Natural log-probability of each target class, and of a word's begin in its place; 0 where there is no target.
        keys (n, 2 * BLOCK), targets (n, BLOCK)."""
        of_pairs, out = self._scores_of_pairs(), np.zeros((2, targets.size))
        exp_b = np.exp(self.p["b"])
        for k in range(0, len(keys), batch):
            self._log_p(keys[k : k + batch], targets[k : k + batch].ravel(), of_pairs, exp_b, out[:, k * BLOCK : (k + batch) * BLOCK])
        return out.reshape(2, *targets.shape)

    def _log_p(self, keys: np.ndarray, y: np.ndarray, of_pairs: tuple[np.ndarray, np.ndarray], exp_b: np.ndarray, out: np.ndarray) -> None:
        p = self.p
        order, kinds = self._kinds(y)
        h, y = self._hidden(keys, order, of_pairs)[-1], y[order].astype(np.int64)
        z = (h @ p["z"] + p["y"][0]).astype(np.float64)
        for at, low, high in kinds:
            logits, own = h[at] @ p["w"][:, low:high], y[at]
            of = (logits.ravel().take(np.arange(len(own)) * (high - low) + own - low) + p["b"][own]).astype(np.float64)
            np.exp(logits, out=logits)
            total = logits @ exp_b[low:high]
            if not np.isfinite(total).all():
                raise FloatingPointError("the network's scores are out of range")
            log_begin = -np.logaddexp(0, -z[at])
            out[0, order[at]] = of - np.log(total) + (log_begin if low == 0 else log_begin - z[at])
            out[1, order[at]] = log_begin

    def gradients(self, keys: np.ndarray, targets: np.ndarray, weight: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """Of the mean loss of an id, by the weights of the windows."""
        p = self.p
        order, kinds = self._kinds(targets.ravel())
        pairs, v, a, o, now, ordered, h = self._hidden(keys, order, self._scores_of_pairs())
        y, last = targets.ravel()[order].astype(np.int64), kinds[-1][0].stop if kinds else 0
        w = np.repeat(np.ones(len(keys)) if weight is None else weight, BLOCK)[order]
        w[last:] = 0
        w = (w / max(w.sum(), 1e-9)).astype(h.dtype)
        g, dh = {"w": np.zeros_like(p["w"]), "b": np.zeros_like(p["b"])}, np.zeros_like(h)
        for at, low, high in kinds:
            own, of, exp_b = h[at], w[at], np.exp(p["b"][low:high])
            e = own @ p["w"][:, low:high]
            np.exp(e, out=e)
            total = e @ exp_b
            e.ravel()[np.arange(len(e)) * (high - low) + y[at] - low] -= total / exp_b[y[at] - low]
            of = of / total  # rows of `e` times this and columns times exp_b are the losses' slopes
            g["w"][:, low:high], g["b"][low:high] = ((own * of[:, None]).T @ e) * exp_b, (of @ e) * exp_b
            np.matmul(e, (p["w"][:, low:high] * exp_b).T, out=dh[at])
            dh[at] *= of[:, None]
        dz = (1 / (1 + np.exp(-(h @ p["z"] + p["y"][0]))) - (y < self.begins)) * w
        g["z"], g["y"] = h.T @ dz, dz.sum(keepdims=True)
        dh += dz[:, None] * p["z"]
        dh *= h > 0
        g["o"], g["e"] = ordered.T @ dh, _sums(now, dh)
        do = np.empty_like(o)
        do.reshape(-1, KEY)[order] = dh @ p["o"].T
        da = do @ v.transpose(0, 2, 1)
        da -= np.einsum("ijk,ijk->ij", do, o)[:, :, None]
        da *= a
        g["near"] = np.bincount(self.distance.ravel(), np.where(self.ahead < 0, 0, da.sum(0)).ravel(), 2 * BLOCK).astype(h.dtype)
        of_pairs = np.bincount(pairs.ravel(), da.ravel(), 1 << 16).reshape(256, 256).astype(h.dtype)
        g["q"], g["k"] = of_pairs @ p["k"], of_pairs.T @ p["q"]
        g["v"] = _sums(keys.ravel(), (a.transpose(0, 2, 1) @ do).reshape(-1, KEY))
        return g

    def fit(self, keys: np.ndarray, targets: np.ndarray, weight: np.ndarray, rate: float, batch: int = 128, seed: int = 0) -> None:
        """One pass by Adam."""
        _reuse_memory()
        order, x = np.random.default_rng(seed).permutation(len(keys)), self.flat()
        m, v, names = np.zeros_like(x), np.zeros_like(x), sorted(self.p)
        for step, at in enumerate(range(0, len(order), batch), 1):
            pick = order[at : at + batch]
            found = self.gradients(keys[pick], targets[pick], weight[pick])
            g = np.concatenate([found[n].ravel() for n in names])
            m += np.float32(0.1) * (g - m)
            g *= g
            v += np.float32(0.01) * (g - v)
            np.sqrt(v, out=g)
            g *= np.float32(1 / np.sqrt(1 - 0.99**step))
            g += np.float32(1e-8)
            np.divide(m, g, out=g)
            g *= np.float32(min(1, step / 20) * rate / (1 - 0.9**step))
            x -= g
            self.load(x)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k in sorted(self.p):
            n = self.p[k].size
            self.p[k] = flat[at : at + n].reshape(self.p[k].shape).astype(np.float32, copy=False)
            at += n


class _Classes:
    """Class of each id, log of its share of the class, the classes' frequencies, and how many hold ids that begin a word."""

    def __init__(self, counts: np.ndarray, vocabulary: str = VOCABULARY):
        begins = _begins(vocabulary)
        order = np.argsort(-counts, kind="stable")
        smooth = counts + 0.5
        self.of = np.empty(len(counts), np.uint8)
        n = 0
        for kind in (True, False):
            of_kind = begins[order] == kind
            own, rest = order[:HEAD][of_kind[:HEAD]], order[HEAD:][of_kind[HEAD:]]
            self.of[own] = n + np.arange(len(own))
            mass = np.cumsum(smooth[rest])
            self.of[rest] = n + len(own) + np.minimum(mass / mass[-1] * (BINS // 2), BINS // 2 - 1).astype(int)
            n += len(own) + BINS // 2
            if kind:
                self.begins = n
        total = np.bincount(self.of, smooth, CLASSES)
        self.within = np.log(smooth / total[self.of])
        self.frequency = (total + 1e-9) / total.sum()


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(True))


def read(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """kind (w: word, s: subword, x: text), key (hash or id; of a text how many ids of its row come from the row before),
    c, a word's first id, and a text's ids, 16 bits each: partial counts, and all texts in rows of at most PART ids."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _reuse_memory()
        subwords, keys, counts, firsts, held = np.zeros(END + 1, np.int64), [], [], [], 0

        def flush() -> pd.DataFrame:
            k, at, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            c = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)
            return pd.DataFrame({"kind": "w", "key": k.view(np.int64), "c": c, "first": np.concatenate(firsts)[at], "ids": None})

        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in pieces(texts):
                _, distinct, inverse, ids, size, begins = _tokens(texts[a:b], vocabulary)
                first = np.zeros(len(distinct), np.int32)
                begun = ids[begins]
                first[inverse] = begun[begun != END]
                firsts.append(np.append(first, END))
                subwords += np.bincount(ids, minlength=END + 1)
                keys.append(np.append(distinct, np.uint64(_END_WORD)))
                counts.append(np.append(np.bincount(inverse, minlength=len(distinct)), b - a))
                held += len(distinct)
                if held > 1 << 21:
                    yield flush()
                    keys, counts, firsts, held = [], [], [], 0
                narrow, ends = ids.astype("<u2"), np.cumsum(size)
                cut = [(start, at, min(at + PART, end)) for start, end in zip((ends - size).tolist(), ends.tolist()) for at in range(start, end, PART)]
                lead = [0 if at == start else _LEAD for start, at, _ in cut]
                yield pd.DataFrame({"kind": "x", "key": np.array(lead, np.int64), "c": 1, "first": 0, "ids": [narrow[at - n : to].tobytes() for (_, at, to), n in zip(cut, lead)]})
        if keys:
            yield flush()
        at = np.flatnonzero(subwords)
        yield pd.DataFrame({"kind": "s", "key": at, "c": subwords[at], "first": at, "ids": None})

    return docs.select("text").mapInPandas(run, "kind string, key long, c long, first int, ids binary")


def count(read_: DataFrame) -> DataFrame:
    """kind, key, c and first of all words and subwords."""
    return read_.where("kind <> 'x'").groupBy("kind", "key").agg(F.sum("c").alias("c"), F.min("first").alias("first"))


def _windows(classes: np.ndarray, lead: int, end_class: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and targets of the windows of a row, whose first `lead` classes are the end of the row before."""
    n = len(classes) - lead
    blocks = -(-n // BLOCK)
    inputs, targets = np.full((blocks + 1) * BLOCK, NONE, np.uint8), np.full(blocks * BLOCK, NONE, np.uint8)
    inputs[BLOCK - lead + 1 : BLOCK + n] = classes[:-1]
    if not lead:
        inputs[BLOCK] = end_class
    targets[:n] = classes[lead:]
    inputs = inputs.reshape(-1, BLOCK)
    return np.concatenate([inputs[:-1], inputs[1:]], 1), targets.reshape(-1, BLOCK)


def _dealt(rows: DataFrame, r: int, rounds: int, tasks: int, narrow: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """ids, key and number of the rows of a round, dealt to tasks. narrow: makes ids, key and n of them first."""
    own = rows.where(F.pmod(F.xxhash64("ids"), F.lit(rounds)) == r)
    own = own.withColumn("n", F.lit(1).cast("long")) if narrow is None else narrow(own)
    return own.repartition(tasks, "ids", "key").groupBy("ids", "key").agg(F.sum("n").alias("n"))


def _narrow(rows: DataFrame, of) -> DataFrame:
    """ids, key -> classes in place of ids, 8 bits each, and n: equal rows of a batch are one, so that of many copies
    few are moved to the task that gets them all. of: the broadcast class of each id."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            seen: dict[tuple[bytes, int], int] = {}
            for row in zip(f["ids"], f["key"].tolist()):
                seen[row] = seen.get(row, 0) + 1
            yield pd.DataFrame({"ids": [of.value[np.frombuffer(ids, "<u2")].tobytes() for ids, _ in seen], "key": np.array([k for _, k in seen], np.int64), "n": np.array(list(seen.values()), np.int64)})

    return rows.mapInPandas(run, "ids binary, key long, n long")


def train(read_: DataFrame, classes: _Classes, rounds: int = ROUNDS) -> Attention:
    """The network after one pass over all windows of what `read` gave."""
    model, spark, begins = Attention(classes.frequency, classes.begins), read_.sparkSession, classes.begins
    rows = read_.where("kind = 'x'").select("ids", "key")
    blocks = rows.agg(F.coalesce(F.sum(F.octet_length("ids")), F.lit(0)).alias("n")).first()["n"] // (2 * BLOCK)
    tasks = max(LEAST_TASKS, blocks // (rounds * BLOCKS_PER_TASK))
    of, sums = spark.sparkContext.broadcast(classes.of), [f"x{k}" for k in range(_SIDE)]
    for r in range(rounds):
        held = spark.sparkContext.broadcast(model.flat())

        def run(frames: Iterator[pd.DataFrame], r: int = r, held=held) -> Iterator[pd.DataFrame]:
            found = sorted((t for f in frames for t in zip(f["ids"], f["key"].tolist(), f["n"].tolist())))  # in one order, however they come
            if not found:
                return
            end_class, parts = int(of.value[END]), []
            for ids, lead, n in found:
                keys, targets = _windows(np.frombuffer(ids, np.uint8), lead, end_class)
                parts.append((keys, targets, np.full(len(keys), float(n))))
            keys, targets, n = (np.concatenate(x) for x in zip(*parts))
            own = Attention(np.ones(CLASSES), begins)
            own.load(held.value)
            own.fit(keys, targets, n, 0.02 * 0.7**r, seed=r)
            flat = np.append(own.flat().astype(np.float64), 1) * len(keys)  # and the windows, after the weights
            flat = np.append(flat, np.zeros(-len(flat) % _SIDE)).reshape(-1, _SIDE)
            yield pd.DataFrame(flat, columns=sums).assign(i=np.arange(len(flat)))

        # _SIDE weights of a task are a row, so that their places are not moved with each; what comes to the driver is
        # their sums, once
        each = _dealt(rows, r, rounds, tasks, lambda own: _narrow(own, of)).mapInPandas(run, ", ".join([*(f"{x} double" for x in sums), "i int"]))
        found = each.groupBy("i").agg(*(F.sum(x).alias(x) for x in sums)).orderBy("i").toPandas()[sums].to_numpy().ravel()
        if len(found):
            n = len(model.flat())
            model.load(found[:n] / found[n])
    return model


class _Words:
    def __init__(self, keys: np.ndarray, counts: np.ndarray, n: int, v: int):
        order = np.argsort(keys)
        self.keys, self.counts, self.n, self.v = keys[order], counts[order], n, v

    def look(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)

    def log10(self, c):
        return np.log10((c + 0.5) / (self.n + 0.5 * (self.v + 1)))


class _Rest:
    """For each first id: what the count of a whole word is divided by, and the weight left to its spelling."""

    def __init__(self, first: np.ndarray, all_: np.ndarray, distinct: np.ndarray):
        self.below, self.left = np.ones(END + 1), np.ones(END + 1)
        self.below[first] = all_ + distinct + 1.0
        self.left[first] = 1 - all_ / self.below[first]

    def log_spelled(self, first: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """What is left to the spelling times the divisor: a word counted c times has log1p(c / exp(this)) more."""
        return np.log(self.below[first] * self.left[first]) + spelled


@dataclass
class Model:
    """What `fit` learns. counts: kind, key, c, first of all words and subwords, sharded; words: the most frequent
    ones; least: words counted less often are in `counts` alone, 1 if there are none."""

    net: Attention
    classes: _Classes
    rest: _Rest
    words: _Words
    least: int
    counts: DataFrame
    vocabulary: str


def fit(learned: DataFrame, vocabulary: str = VOCABULARY, model_words: int = MODEL_WORDS) -> Model:
    """learned: the training texts, in a column `text` without NULL."""
    shared.bounded_batches(learned.sparkSession)
    found = shared.keep(read(learned, vocabulary), "lm-texts", "zstd")
    counts = shared.keep(count(found), "lm-counts")
    all_words = counts.where("kind = 'w'").select("key", "c", "first")
    bounds = [1 << k for k in range(41)]
    stats = all_words.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"), *(F.count(F.when(F.col("c") >= b, 1)).alias(f"b{k}") for k, b in enumerate(bounds))
    ).first()
    least = next(b for k, b in enumerate(bounds) if stats[f"b{k}"] <= model_words)
    near = all_words.where((F.col("c") >= least) | (F.col("key") == _END_WORD)).select("key", "c").toArrow()  # model_words rows at most, and the end
    table = _Words(near.column("key").to_numpy().view(np.uint64), near.column("c").to_numpy(), stats["n"], stats["v"])
    ids = counts.where("kind = 's'").select("key", "c").toPandas()  # a row for each id of the vocabulary at most
    sub = np.zeros(END + 1)
    sub[ids["key"].to_numpy()] = ids["c"].to_numpy()
    classes = _Classes(sub, vocabulary)
    after = all_words.groupBy("first").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).toPandas()
    rest = _Rest(*(after[k].to_numpy() for k in ("first", "c", "v")))
    net = train(found, classes)
    shared.discard(found)
    return Model(net, classes, rest, table, least, counts, vocabulary)


_SCORES = "n_tokens long, n_known long, base double, score double, n_subwords long, rare array<long>, rare_x array<double>"


def _text_scores(net: Attention, cl: _Classes, rest: _Rest, ids: np.ndarray, size: np.ndarray, begins: np.ndarray, c: np.ndarray):
    """log10 probability of each text, c being the count of each word in their order; and `log_spelled` of each word."""
    inputs, targets, at = _blocks(cl.of[ids], size, int(cl.of[END]))
    keys = np.concatenate([inputs[:-1], inputs[1:]], 1)
    each, starts = (x.ravel()[at - BLOCK] for x in net.log_p(keys, targets[1:]))  # the first block has no targets
    each += cl.within[ids]
    total = each[begins] - starts[begins]
    word = ids[begins] != END
    first = ids[begins[word]]
    spelled = np.add.reduceat(each, begins) - each[begins]
    spelled = spelled[word] + starts[begins[np.flatnonzero(word) + 1]]  # another word or the end follows each word
    x = rest.log_spelled(first, spelled)
    total[word] += np.log(rest.left[first]) + spelled + np.log1p(c * np.exp(-x))
    text = np.searchsorted(np.cumsum(size), begins, side="right")
    return np.bincount(text, total, len(size)) / np.log(10), x


def _parts(x: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    return [x[i:j] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _scores(model: Model, text: Column) -> Column:
    """A struct of _SCORES for each text. Where the broadcast table lacks some words, `rare` has the occurrences of
    words that are not in it, `rare_x` what is left to their spelling, and base, n_known and score are without their counts."""
    spark = model.counts.sparkSession
    held = spark.sparkContext.broadcast((model.net.p, model.net.begins, model.classes, model.rest, model.words))
    vocabulary, whole = model.vocabulary, model.least == 1

    @F.pandas_udf(_SCORES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        _reuse_memory()
        p, first_classes, cl, rest, t = held.value
        net = Attention(begins=first_classes, p=p)
        for batch in batches:
            texts, parts = batch.tolist(), []
            for a, b in pieces(texts):
                w, distinct, inverse, ids, size, begins = _tokens(texts[a:b], vocabulary)
                text = np.repeat(np.arange(b - a), np.diff(w.first))
                c = t.look(distinct)
                known, base = c > 0, np.where((c > 0) | whole, t.log10(c), 0.0)
                c_end = int(t.look(np.array([_END_WORD], np.uint64))[0])
                score, x = _text_scores(net, cl, rest, ids, size, begins, c[inverse])
                rare = np.flatnonzero(~known[inverse]) if not whole else np.zeros(0, np.int64)
                keys, bounds = distinct[inverse[rare]].view(np.int64), np.searchsorted(text[rare], np.arange(b - a + 1))
                parts.append(pd.DataFrame({
                    "n_tokens": np.diff(w.first) + 1, "n_known": np.bincount(text, known[inverse], b - a).astype(np.int64) + (c_end > 0),
                    "base": np.bincount(text, base[inverse], b - a) + t.log10(c_end), "score": score, "n_subwords": size,
                    "rare": _parts(keys, bounds), "rare_x": _parts(x[rare], bounds),
                }))
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({k.split()[0]: [] for k in _SCORES.split(", ")})

    return run(text)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs (with a column `text` without NULL, which goes) with n_tokens, n_known, base, score and n_subwords."""
    rest = [c for c in docs.columns if c != "text"]
    numbers = ["n_tokens", "n_known", "base", "score", "n_subwords"]
    scored = docs.withColumn("_s", _scores(model, F.col("text"))).select(*rest, *(f"_s.{c}" for c in [*numbers, "rare", "rare_x"]))
    if model.least == 1:
        return scored.drop("rare", "rare_x")
    scored = shared.keep(scored.withColumn("_key", F.expr("uuid()")), "lm-scores")
    counts = model.counts.where((F.col("kind") == "w") & (F.col("c") < model.least)).select("key", "c")
    each = scored.select("_key", F.inline(F.arrays_zip(F.col("rare").alias("key"), F.col("rare_x").alias("x")))).join(counts, "key", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    sums = each.groupBy("_key").agg(
        F.sum(F.log10((F.col("c") + 0.5) / (model.words.n + 0.5 * (model.words.v + 1)))).alias("_base"),
        F.count(F.when(F.col("c") > 0, 1)).alias("_known"), (F.sum(F.log1p(F.col("c") * F.exp(-F.col("x")))) / float(np.log(10))).alias("_score"),
    )
    more = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
    return scored.join(sums, "_key", "left").select(*rest, "n_tokens", more("n_known", "_known"), more("base", "_base"), more("score", "_score"), "n_subwords")


def score_documents(docs: DataFrame, vocabulary: str = VOCABULARY, model_words: int = MODEL_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_subwords for every document."""
    docs = docs.select("doc_id", held_out().alias("held_out"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    model = fit(docs.where("not held_out"), vocabulary, model_words)
    return score(docs, model).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.words.n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score", "n_subwords"
    )
