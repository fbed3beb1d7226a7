"""Language identification: a bidirectional gated recurrent network over bytes, trained by backpropagation through time.

The network labels every byte of a text; a document's probabilities are the means over its bytes. Texts are read
whole, in chunks of CHUNK bytes that start CONTEXT bytes early in either direction, so chunks of many texts run
side by side as one matrix per step.

The model is fitted on a sample of at most ROWS_PER_LANGUAGE documents of each language (those with the smallest
hash of doc_id), two passages of CHUNK bytes from anywhere in each. Only text and lang are learned from, only
text is read for a prediction.

Edge cases: NULL texts and texts without a letter are `und` with score 0; with nothing to learn from, all are;
documents with NULL doc_id count as held out of training, as do those with NULL lang; equal texts get equal
labels; texts of any length are read whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import shared
from .words import pieces

ROWS_PER_LANGUAGE = 400
CHUNK, CONTEXT = 192, 16
HIDDEN = 8
#: Passes over the sample; more where they would be fewer steps of BATCH_CHUNKS chunks than LEAST_STEPS.
EPOCHS, LEAST_STEPS, BATCH_CHUNKS = 6, 250, 64
UNKNOWN = "und"
_BATCH = 2048


class ByteGRU:
    """For each direction: `table` (inputs of the three gates by byte) and `u` (recurrence); `w`, `c` give the labels."""

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.labels, self.h = labels, hidden
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(hidden)).astype(np.float32)
        self.p = {"w": draw(2 * hidden, len(labels)), "c": np.zeros(len(labels), np.float32)}
        for d in "fb":
            self.p["table" + d], self.p["u" + d] = draw(256, 3 * hidden), draw(hidden, 3 * hidden)

    def _states(self, d: str, bytes_: np.ndarray, keep: list | None = None) -> Iterator[np.ndarray]:
        """States (hidden, batch) after each step; bytes_ is (steps, batch), already in the direction's order.
        Rows are features, so that every operation runs over long contiguous rows."""
        h, table, u = self.h, np.ascontiguousarray(self.p["table" + d].T), np.ascontiguousarray(self.p["u" + d].T)
        batch = bytes_.shape[1]
        x, a = np.empty((3 * h, batch), np.float32), np.empty((3 * h, batch), np.float32)
        state = np.zeros((h, batch), np.float32)
        for now in bytes_:
            np.take(table, now, axis=1, out=x, mode="clip")
            np.matmul(u, state, out=a)
            gates = x[: 2 * h] + a[: 2 * h]  # half the argument: sigmoid(2 v) = (tanh(v) + 1) / 2
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, r = gates[:h], gates[h:]
            n = r * a[2 * h :]
            n += x[2 * h :]
            np.tanh(n, out=n)
            if keep is not None:
                keep.append((state, z, r, n, a[2 * h :].copy()))
            state = state - n
            state *= z
            state += n
            yield state

    def pooled(self, chunks: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Sums of the label probabilities over the `length` bytes of each chunk, which begin at row CONTEXT."""
        steps, chunks = CHUNK + CONTEXT, chunks.astype(np.intp)
        forth = np.empty((CHUNK, self.h, chunks.shape[1]), np.float32)
        for t, state in enumerate(self._states("f", chunks[:steps])):
            if t >= CONTEXT:
                forth[t - CONTEXT] = state
        w, c, h = np.ascontiguousarray(self.p["w"].T), self.p["c"][:, None], self.h
        out = np.zeros((len(self.labels), chunks.shape[1]), np.float32)
        for k, state in enumerate(self._states("b", chunks[CONTEXT:][::-1])):
            t = steps - 1 - k
            if t < CHUNK:
                e = w[:, :h] @ forth[t]
                e += w[:, h:] @ state
                e += c
                np.clip(e, -40, 40, out=e)
                np.exp(e, out=e)
                e *= (t < length) / e.sum(0)
                out += e
        return out.T

    def _backward(self, d: str, bytes_: np.ndarray, kept: list, dout: np.ndarray, grads: dict) -> None:
        h, u = self.h, self.p["u" + d]
        dstate, du, dx = np.zeros_like(dout[0]), np.zeros_like(u.T), np.empty((len(bytes_), 3 * h, bytes_.shape[1]), np.float32)
        for t in range(len(bytes_) - 1, -1, -1):
            state, z, r, n, an = kept[t]
            g = dout[t] + dstate
            dn = g * (1 - z) * (1 - n * n)
            da = dx[t]
            da[:h], da[h : 2 * h], da[2 * h :] = g * (state - n) * z * (1 - z) * 2, dn * an * r * (1 - r) * 2, dn
            da = da.copy()
            da[2 * h :] *= r
            du += da @ state.T
            dstate = g * z + u @ da
        at = bytes_.ravel()
        grads["u" + d] = np.ascontiguousarray(du.T)
        grads["table" + d] = np.stack([np.bincount(at, dx[:, k].ravel(), 256) for k in range(3 * h)], 1).astype(np.float32)

    def fit(self, chunks: np.ndarray, length: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH_CHUNKS, rate: float = 0.02, seed: int = 1) -> ByteGRU:
        """chunks (CHUNK + 2 * CONTEXT, n): each byte of a chunk is an example of its label. Adam, falling rate."""
        rng = np.random.default_rng(seed)
        m, v, step = {}, {}, 0
        total = epochs * -(-chunks.shape[1] // batch)
        for _ in range(epochs):
            order = rng.permutation(chunks.shape[1])
            for a in range(0, len(order), batch):
                pick = order[a : a + batch]
                x = chunks[CONTEXT : CONTEXT + CHUNK, pick].astype(np.intp)
                back = x[::-1]
                kept_f, kept_b = [], []
                both = [np.stack([s.T.copy() for s in self._states(d, b, k)]) for d, b, k in (("f", x, kept_f), ("b", back, kept_b))]
                states = np.concatenate([both[0], both[1][::-1]], 2)
                e = states @ self.p["w"] + self.p["c"]
                e = np.exp(e - e.max(2, keepdims=True))
                e /= e.sum(2, keepdims=True)
                e[:, np.arange(len(pick)), label[pick]] -= 1
                mask = np.arange(CHUNK)[:, None] < length[pick]
                e *= (mask / mask.sum())[:, :, None]
                e = e.astype(np.float32)
                grads = {"w": np.einsum("tbh,tbc->hc", states, e), "c": e.sum((0, 1))}
                dstates = (e @ self.p["w"].T).transpose(0, 2, 1)
                self._backward("f", x, kept_f, dstates[:, : self.h], grads)
                self._backward("b", back, kept_b, dstates[::-1, self.h :], grads)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                step += 1
                now = rate * (1 - (step - 1) / total)
                for k, g in grads.items():
                    g = g / max(1.0, norm)
                    m[k] = 0.9 * m.get(k, 0) + 0.1 * g
                    v[k] = 0.99 * v.get(k, 0) + 0.01 * g * g
                    self.p[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """Mean label probabilities of each text; rows of zeros for texts without bytes."""
        chunks, length, text = cut(texts)
        out = np.zeros((len(texts), len(self.labels)))
        for a in range(0, len(text), _BATCH):
            sums = self.pooled(chunks(a, a + _BATCH), length[a : a + _BATCH])
            np.add.at(out, text[a : a + _BATCH], sums)
        sizes = np.bincount(text, length, len(texts))
        return out / np.maximum(sizes, 1)[:, None]


def cut(texts: list[str]):
    """(function of a range of chunks -> their bytes by step, lengths, text of each chunk)."""
    before, after = b"\n" * CONTEXT, b"\n" * (CHUNK + CONTEXT)
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"".join(x for e in encoded for x in (before, e, after)), np.uint8)
    size = np.array([len(e) for e in encoded], np.int64)
    first = np.cumsum(size + CHUNK + 2 * CONTEXT) - (size + CHUNK + 2 * CONTEXT)
    count = -(-size // CHUNK)
    text = np.repeat(np.arange(len(texts)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = first[text] + nth * CHUNK
    length = np.minimum(size[text] - nth * CHUNK, CHUNK)
    steps = np.arange(CHUNK + 2 * CONTEXT)[:, None]
    return lambda a, b: raw[start[None, a:b] + steps], length, text


def _letters() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def in_training() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0, F.lit(False))


def sample(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """lang, passage: two passages of at most CHUNK characters from each document of the sample."""
    usable = docs.select("doc_id", "lang", "text").where(in_training() & F.col("lang").isNotNull() & _letters())
    # a language's share is cut by hash before it is ranked, so that no task sees more than some times its rows
    share = usable.groupBy("lang").agg((F.lit(4.0 * rows_per_language) / F.count(F.lit(1))).alias("_share"))
    hashed = usable.withColumn("_hash", F.xxhash64(F.col("doc_id"), F.lit(17)))
    part = hashed.join(F.broadcast(share), "lang").where((F.col("_hash") / F.lit(2.0**64) + 0.5) < F.col("_share"))
    ranked = part.withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy("_hash", "doc_id", "text")))
    at = lambda seed: F.substring("text", F.pmod(F.xxhash64("_hash", F.lit(seed)), F.greatest(F.length("text") - CHUNK, F.lit(1))).cast("int") + 1, F.lit(CHUNK))
    passages = ranked.where(F.col("_rank") <= rows_per_language).select("lang", F.explode(F.array(at(1), at(2))).alias("passage"))
    return passages.where(F.length("passage") > 0)


def train(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> ByteGRU | None:
    rows = sample(docs, rows_per_language).orderBy("lang", F.xxhash64("passage"), "passage").toPandas()
    if not len(rows):
        return None
    labels = sorted(rows["lang"].unique())
    chunks, length, text = cut(rows["passage"].tolist())
    label = np.searchsorted(labels, rows["lang"].to_numpy()[text])
    steps = -(-len(text) // BATCH_CHUNKS)  # of one pass
    return ByteGRU(labels).fit(chunks(0, len(text)), length, label, max(EPOCHS, -(-LEAST_STEPS // steps)))


def predict(docs: DataFrame, model: ByteGRU | None) -> DataFrame:
    """docs with lang_pred and score. Only texts go to Python."""
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]
    if model is None:
        return docs.select(*columns, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared.bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = held.value
        names = np.array(m.labels, object)
        for batch in batches:
            texts = batch.tolist()
            label, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            for a, b in pieces(texts, 1 << 20):
                p = m.probabilities([t or "" for t in texts[a:b]])
                best, ok = p.argmax(1), np.array([bool(t) for t in texts[a:b]])
                label[a:b][ok], score[a:b][ok] = names[best[ok]], p.max(1)[ok]
            yield pd.DataFrame({"lang_pred": label, "score": np.clip(score, 0, 1)})

    with_letters = F.when(_letters(), F.col("text"))
    return docs.select(*columns, run(with_letters).alias("_p")).select(*columns, "_p.lang_pred", "_p.score")


def identify(docs: DataFrame) -> DataFrame:
    model = train(docs)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")
