"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token's adjacent pairs wait in one bucket per merge rank, as positions in a linked list of pieces. Two
levels of bitmaps say which buckets hold anything: find-first-set gives the next rank at the cost of a few
word operations, whatever the length, so a pre-token of n bytes takes about n log n steps instead of n**2.
Entries whose pair has changed meanwhile are skipped when they come up.

Texts are split by the tokenizer's pattern and each match is encoded on its own; special tokens are ordinary
text. Each worker keeps the ids of short pre-tokens seen lately, in a cache of bounded size.

Edge cases: NULL text is the empty text, which has no ids; equal rows give equal ids; texts of any length
are encoded whole; an empty table gives an empty table; all other columns are kept as they are.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens of each of two generations that a worker keeps with their ids, some 200 bytes each, and the longest
#: one kept, in characters.
CACHED, CACHED_LENGTH = 300_000, 40


_WIDTH = 256  # bits of a bitmap word; Python's integers make find-first-set one operation
_BITS = [1 << k for k in range(_WIDTH)]


class RankQueue:
    """Positions by rank, lowest rank first, then lowest position. Each rank has a bucket; a bit of `words` says
    that a rank's bucket holds something, a bit of `summary` that a word does."""

    def __init__(self, ranks: int):
        self.words = [0] * (ranks // _WIDTH + 1)
        self.summary = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            w = rank >> 8
            word = self.words[w]
            if not word:
                self.summary |= 1 << w
            self.words[w] = word | _BITS[rank & 255]
        else:
            heapq.heappush(bucket, position)

    def pop(self) -> tuple[int, int] | None:
        summary = self.summary
        if not summary:
            return None
        w = (summary & -summary).bit_length() - 1
        word = self.words[w]
        low = word & -word
        rank = (w << 8) + low.bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heapq.heappop(bucket)
        del self.buckets[rank]
        self.words[w] = word = word ^ low
        if not word:
            self.summary = summary & (summary - 1)
        return rank, bucket[0]


class Encoder:
    """Ids of one vocabulary of ranks, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.queue = RankQueue(max(self.ranks.values()))
        self.of_bytes = [-1] * (1 << 16)  # rank of each pair of bytes
        for piece, rank in self.ranks.items():
            if len(piece) == 2:
                self.of_bytes[piece[0] << 8 | piece[1]] = rank
        self.split = _splitter(pattern)
        self.cache = _Cache(self)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        n, of_bytes = len(piece), self.of_bytes
        end = list(range(1, n + 1))  # of the piece that begins at a position
        before = list(range(-1, n - 1))  # where the piece before it begins
        pair = [of_bytes[a << 8 | b] for a, b in zip(piece, piece[1:])]  # rank of a piece with the next one, or -1
        pair.append(-1)
        ids = [-1] * n  # of merged pieces
        push, pop = self.queue.push, self.queue.pop
        for i, r in enumerate(pair):
            if r >= 0:
                push(r, i)
        while (entry := pop()) is not None:
            rank, i = entry
            if pair[i] != rank:
                continue  # stale: one of the two pieces has been merged into another
            ids[i] = rank
            j = end[i]
            e = end[i] = end[j]
            pair[j] = -1
            if e < n:
                before[e] = i
                r = pair[i] = rank_of(piece[i : end[e]], -1)
                if r >= 0:
                    push(r, i)
            else:
                pair[i] = -1
            p = before[i]
            if p >= 0:
                r = pair[p] = rank_of(piece[p:e], -1)
                if r >= 0:
                    push(r, p)
        out, i = [], 0
        while i < n:
            out.append(ids[i] if ids[i] >= 0 else rank_of(piece[i : i + 1]))
            i = end[i]
        return out

    def pack(self, token: str) -> bytes:
        ids = self.encode_piece(token.encode("utf-8", "surrogatepass"))
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.cache.__getitem__, self.split(text or "")))


class _Cache(dict):
    """Ids of pre-tokens seen lately, in two generations: when the young one is full it becomes the old one, and
    what is still in use comes back from there."""

    def __init__(self, encoder: Encoder):
        self.encoder, self.old = encoder, {}

    def __missing__(self, token: str) -> bytes:
        ids = self.old.get(token)
        if ids is None:
            ids = self.encoder.pack(token)
        if len(token) <= CACHED_LENGTH:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[token] = ids
        return ids


#: Up to here the standard library's classes are spelled out; texts beyond take the slower exact engine.
_PLAIN = 0x0250


def _splitter(pattern: str):
    r"""Splits as `pattern` does. \p{L} and \p{N} are only known to the regex package; for texts below
    U+0250 they are written out, which the standard library matches faster."""
    exact = regex.compile(pattern)
    of = lambda kind: "".join(re.escape(chr(c)) for c in range(_PLAIN) if unicodedata.category(chr(c))[0] == kind)
    # \s of the two engines differs in \x1c-\x1f below U+0250
    plain = re.compile(pattern.replace(r" ?\p{L}+", f" ?[{of('L')}]+").replace(r" ?\p{N}+", f" ?[{of('N')}]+")
                       .replace(r"\p{L}", of("L")).replace(r"\p{N}", of("N")))
    beyond = re.compile(f"[^\x00-\x1b\x20-{chr(_PLAIN - 1)}]")
    return lambda text: (exact if beyond.search(text) else plain).findall(text)


class Decoder:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.bytes = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(1)
def _encoder(path: str) -> Encoder:
    """One a worker process: its cache outlives a task."""
    return Encoder(path)


@functools.lru_cache(1)
def _decoder(path: str) -> Decoder:
    return Decoder(path)


def encode_column(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Ids as binary: little-endian unsigned 32-bit integers."""

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(public_tokenizers.path(vocabulary))
        for batch in batches:
            yield batch.map(encoder.encode)

    return encode(text)


def decode_column(ids: Column, vocabulary: str = VOCABULARY) -> Column:
    """Bytes of ids."""

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = _decoder(public_tokenizers.path(vocabulary))
        for batch in batches:
            yield batch.map(decoder.decode)

    return decode(ids)


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """docs with `ids` (binary)."""
    shared.bounded_batches(docs.sparkSession)
    return docs.withColumn("ids", encode_column(F.coalesce(F.col("text"), F.lit("")), vocabulary))


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Digests of each document's ids and of the bytes that they decode to. One worker encodes and decodes a text."""
    shared.bounded_batches(docs.sparkSession)

    @F.pandas_udf("ids binary, bytes binary")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        path = public_tokenizers.path(vocabulary)
        encoder, decoder = _encoder(path), _decoder(path)
        for batch in batches:
            ids = batch.map(encoder.encode)
            yield pd.DataFrame({"ids": ids, "bytes": ids.map(decoder.decode)})

    done = docs.select("doc_id", both(F.coalesce(F.col("text"), F.lit(""))).alias("_b")).select("doc_id", "_b.*")
    return done.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
