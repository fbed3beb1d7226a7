"""Benchmark decontamination by templates: numbers, names and units become typed placeholders.

Both sides are cut into words, canonicalised, and hashed in windows of WINDOW words, both as templates and as
they are. Windows are joined by hash, and those of a document and an item are put into alignments: about one distance between the
places in both (DRIFT words more or less, nearest first), or, for an item cut to pieces, any distance, the one
that covers most first. Each alignment is judged by itself and any may pass. Where it covers at least
MIN_COVERAGE of the item's words, the values in the slots are compared: a re-parameterised question maps each of
the item's values to one value of its own, so the document counts as contaminated if no slot differs or at
least MIN_CONSISTENT of them agree with a one-to-one mapping. VERBATIM words in a row that are the item's own,
or all of a shorter item, are contamination whatever the coverage. Reported is the alignment that passes with the
largest coverage, then with the fewest slots that differ.

Words are runs of bytes other than white space; ASCII punctuation is dropped, A-Z and À-Þ lowered. A word with a
digit is a number; a unit of UNITS after a number is a unit; a capitalised word that does not begin a
sentence or line, nor goes on with a capital, is a name. Templates with fewer than
LEAST_LITERAL words that are not placeholders are not used; such windows match word for word only. An item of
fewer than WINDOW words is one window; below LEAST_WORDS words it matches where it is a line of its own, word
for word, as one word inside a sentence tells nothing.

Items of at most BROADCAST_WINDOWS windows (some 100 bytes each) are broadcast and joined where the documents lie; more are joined
by shuffling the documents' windows, with equal results.

Edge cases: NULL and empty texts match nothing; NULL doc_id or item_id is reported as it is; equal documents
are each reported, equal items too; an empty table on either side gives no rows; other columns are not read.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared
from .words import _INVERSE, _MULTIPLIER, _VALUE, LOWER, SEPARATOR, _power, mix, pieces

WINDOW, LEAST_WORDS, LEAST_LITERAL = 8, 4, 4
MIN_COVERAGE, MIN_CONSISTENT = 0.5, 0.8
DRIFT, VERBATIM = 3, 13
BROADCAST_WINDOWS = 200_000
UNITS = (
    "kg g mg lb lbs oz t km m cm mm mi ft in yd l ml gal s ms min h hr hrs second seconds minute minutes hour hours day days "
    "week weeks month months year years meter meters metre metres kilometer kilometers mile miles gram grams kilogram kilograms "
    "liter liters litre litres dollar dollars euro euros cent cents percent degree degrees watt watts volt volts"
).split()

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[[ord(c) for c in ".!?:"]] = True
_SLOT = np.uint64(1)
_NUMBER, _NAME, _UNIT = (np.uint64(k * 0x1F3D5B79A2C4E6F1 & (1 << 64) - 1) for k in (3, 5, 7))


def _scan(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Template hashes and own hashes of all words (odd: a slot), where each text's words begin, and which words
    begin a line (one more for the end)."""
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join([*encoded, b""]), np.uint8)
    apart = SEPARATOR[raw]
    edge = np.flatnonzero(np.diff(~apart, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    kept = ~(apart | _PUNCTUATION[raw])
    before = np.concatenate([[0], np.cumsum(kept)])
    some = before[end] > before[start]
    start, end = start[some], end[some]
    offset = np.concatenate([[0], np.cumsum([len(x) + 1 for x in encoded])]).astype(np.int64)
    first = np.searchsorted(start, offset)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), first, np.ones(1, bool)
    at = before[start]
    low = LOWER[raw]
    low[1:][(raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)] += 32
    with np.errstate(over="ignore"):
        n = int(before[-1])
        h = mix(np.add.reduceat(_VALUE[low[kept]] * _power(_MULTIPLIER, n), at) * _power(_INVERSE, n)[at])
    number = np.add.reduceat(_DIGIT[raw].astype(np.int32), start) > 0
    a, b = raw[start], raw[np.minimum(start + 1, len(raw) - 1)]
    capital = (a >= 65) & (a <= 90) & ~((b >= 65) & (b <= 90)) | (a == 0xC3) & (b >= 0x80) & (b <= 0x9E)
    begins = np.ones(len(start), bool)
    begins[1:] = raw[start[1:] - 1] == 10
    for k in range(1, 5):  # the mark may stand before a quote, a bracket or other signs
        begins[1:] |= _SENTENCE_END[raw[np.maximum(end[:-1] - k, start[:-1])]]
    begins[first[:-1][first[:-1] < len(start)]] = True
    unit = np.zeros(len(start), bool)
    unit[1:] = number[:-1] & np.isin(h[1:], _unit_hashes())
    own = h & ~_SLOT
    name = capital & ~begins
    template = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, own)))
    breaks = np.cumsum((raw == 10) | (raw == 13))
    line = np.ones(len(start) + 1, bool)
    line[1:-1] = breaks[start[1:]] > breaks[end[:-1] - 1]
    return template, own | (number | unit | name).astype(np.uint64), first, line


_units: list[np.ndarray] = []


def _unit_hashes() -> np.ndarray:
    if not _units:
        raw = [u.encode() for u in UNITS]
        with np.errstate(over="ignore"):
            _units.append(mix(np.array([np.add.reduce(_VALUE[list(u)] * _power(_MULTIPLIER, len(u))) for u in raw], np.uint64)))
    return _units[0]


def _windows(template: np.ndarray, value: np.ndarray, first: np.ndarray, line: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the windows of `size` words that begin at each word, and which of them to use: as templates, where
    literal enough, and as they are. Without slots both hashes are equal, and one is used."""
    n = len(template) - size + 1
    if n <= 0:
        return []
    as_template, as_is = np.full(n, size, np.uint64), np.full(n, size, np.uint64)
    slots = np.zeros(n, np.int8)
    plain = value & ~_SLOT
    with np.errstate(over="ignore"):
        for k in range(size):
            as_template = as_template * np.uint64(_MULTIPLIER) + template[k : k + n]
            as_is = as_is * np.uint64(_MULTIPLIER) + plain[k : k + n]
            slots += value[k : k + n] & _SLOT == 1
    last = np.repeat(first[1:], np.diff(first))[:n]  # where the text of each word ends
    whole = np.arange(n) + size <= last
    if size < LEAST_WORDS:
        return [(mix(as_is), whole & line[:n] & line[size : size + n])]
    return [(mix(as_template), whole & (size - slots >= min(LEAST_LITERAL, size - 1))), (mix(as_is), whole & (slots > 0))]


def _item() -> Column:
    """A number of its own for each different row of the benchmark."""
    return F.xxhash64("item_id", "text")


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """hash, item, size, at, n_words and the window's words."""
    shared.bounded_batches(benchmark.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for item, text in zip(frame["item"], frame["text"]):
                template, value, first, line = _scan([text])
                n = len(template)
                size = min(WINDOW, n)
                for h, good in _windows(template, value, first, line, size) if n else []:
                    at = np.flatnonzero(good)
                    if len(at):
                        yield pd.DataFrame({
                            "hash": h[at].view(np.int64), "item": item, "size": np.int32(size), "at": at.astype(np.int32), "n_words": np.int32(n),
                            "slots": [value[i : i + size].view(np.int64).tolist() for i in at],
                        })

    once = benchmark.select(_item().alias("item"), "text").dropDuplicates(["item"])
    return once.mapInPandas(run, "hash long, item long, size int, at int, n_words int, slots array<long>")


def _agree(own: np.ndarray, theirs: np.ndarray) -> int:
    """Slots that agree with the best one-to-one mapping of the item's values to the document's."""
    forth: dict[int, Counter] = {}
    for a, b in zip(own.tolist(), theirs.tolist()):
        forth.setdefault(a, Counter())[b] += 1
    taken: dict[int, int] = {}
    agree = 0
    for a, seen in sorted(forth.items(), key=lambda x: (-max(x[1].values()), x[0])):
        b, n = min(seen.items(), key=lambda x: (-x[1], x[0]))
        if taken.setdefault(b, a) == a:  # two of the item's values may not share one
            agree += n
    return agree


def _alignments(at: np.ndarray, place: np.ndarray, size: int, n_words: int) -> Iterator[np.ndarray]:
    """For each alignment the place of each of the item's words in the document, -1 where no window covers it."""
    order = np.argsort(place - at, kind="stable")
    shifts, begin = np.unique((place - at)[order], return_index=True)
    covers = []
    for a in np.split(at[order], begin[1:]):
        edge = np.zeros(n_words + 1, np.int64)
        np.add.at(edge, a, 1)
        np.add.at(edge, a + size, -1)
        covers.append(np.cumsum(edge[:-1]) > 0)

    def laid(chosen) -> np.ndarray:
        where = np.full(n_words, -1, np.int64)
        for j in chosen:
            new = np.flatnonzero(covers[j] & (where < 0))
            where[new] = new + shifts[j]
        return where

    for d in shifts.tolist():
        near = range(*np.searchsorted(shifts, [d - DRIFT, d + DRIFT + 1]).tolist())
        yield laid(sorted(near, key=lambda j: abs(int(shifts[j]) - d)))
    if len(shifts) > 1:
        yield laid(sorted(range(len(shifts)), key=lambda j: -int(covers[j].sum())))


def _longest(same: np.ndarray, where: np.ndarray) -> int:
    """Most words in a row, in both texts, that are the same."""
    goes_on = same[1:] & same[:-1] & (where[1:] == where[:-1] + 1)
    run = np.cumsum(np.concatenate([[True], ~goes_on]))[same]
    return int(np.bincount(run).max()) if len(run) else 0


def judge(at: np.ndarray, place: np.ndarray, size: int, own: np.ndarray, theirs: np.ndarray) -> tuple[float, int, int, bool]:
    """From the places of all windows that match, in the item and in the document, and the words of both: coverage
    of the item, slots, slots whose value differs, and whether it is contamination, of the best alignment."""
    best = None
    for where in _alignments(at, place, size, len(own)):
        found = np.flatnonzero(where >= 0)
        a, b = own[found], theirs[where[found]] | _SLOT
        same = np.zeros(len(own), bool)
        same[found] = a | _SLOT == b
        a, b = a[a & _SLOT == 1], b[a & _SLOT == 1]
        coverage, changed = len(found) / len(own), int((a != b).sum())
        bad = coverage >= MIN_COVERAGE and (not changed or _agree(a, b) >= MIN_CONSISTENT * len(a))
        bad = bad or _longest(same, where) >= min(VERBATIM, len(own))
        if best is None or (bad, coverage, -changed) > (best[3], best[0], -best[2]):
            best = coverage, len(a), changed, bad
    return best


class _Items:
    """The benchmark's windows by hash, with a bitmap that sends most windows away."""

    def __init__(self, table):
        table = table.sort_by("hash")
        self.known, self.item, self.size, self.at = (table.column(c).to_numpy() for c in ("hash", "item", "size", "at"))
        self.sizes = sorted(set(self.size.tolist()))
        self.own: dict[int, np.ndarray] = {}
        words, n_words = table.column("slots").combine_chunks().flatten().to_numpy().view(np.uint64), table.column("n_words").to_numpy()
        begin = np.cumsum(self.size) - self.size
        for r, item in enumerate(self.item.tolist()):
            own = self.own.setdefault(item, np.zeros(n_words[r], np.uint64))
            own[self.at[r] : self.at[r] + self.size[r]] = words[begin[r] : begin[r] + self.size[r]]
        self.bits = np.zeros(1 << 22, bool)
        self.bits[self._bit(self.known)] = True

    @staticmethod
    def _bit(h: np.ndarray) -> np.ndarray:
        return (h.view(np.uint64) >> np.uint64(42)).astype(np.int64)

    def hits(self, texts) -> Iterator[tuple[int, int, float, int, int]]:
        """(text, item, coverage, slots, changed slots) for each item found in a text."""
        template, value, first, line = _scan(texts)
        found: dict[tuple[int, int], tuple[array, array, int]] = {}
        for size, (h, good) in ((size, x) for size in self.sizes for x in _windows(template, value, first, line, size)):
            h = h.view(np.int64)
            maybe = np.flatnonzero(good & self.bits[self._bit(h)])
            low, high = (np.searchsorted(self.known, h[maybe], side=side) for side in ("left", "right"))
            text = np.searchsorted(first, maybe, side="right") - 1
            some = np.flatnonzero(low < high)
            for d, i, j, k in zip(text[some].tolist(), maybe[some].tolist(), low[some].tolist(), high[some].tolist()):
                for r in range(j, k):
                    if self.size[r] == size:
                        at, place, _ = found.setdefault((d, int(self.item[r])), (array("q"), array("q"), size))
                        at.append(int(self.at[r]))
                        place.append(i)
        for (d, item), (at, place, size) in found.items():
            coverage, slots, changed, bad = judge(np.array(at), np.array(place), size, self.own[item], value)
            if bad:
                yield d, item, coverage, slots, changed


def _small(windows: DataFrame, bound: int):
    """The windows to broadcast, or None if there are more than `bound`."""
    if windows.count() > bound:
        return None
    return windows.sparkSession.sparkContext.broadcast(_Items(windows.toArrow()))


_FOUND = ["item", "coverage", "n_slots", "n_changed"]


def find(docs: DataFrame, benchmark: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """doc_id, item_id, coverage, n_slots, n_changed (slots whose value is another) for each item in a document."""
    windows = benchmark_windows(benchmark)
    items = _small(windows, broadcast_windows)
    if items is None:
        found = _find_by_join(_rows(docs.select("doc_id", "text")), windows)
    else:
        @F.pandas_udf("array<struct<item: long, coverage: double, n_slots: int, n_changed: int>>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                texts = batch.tolist()
                out: list[list[dict]] = [[] for _ in texts]
                for a, b in pieces(texts):
                    for d, *hit in items.value.hits(texts[a:b]):
                        out[a + d].append(dict(zip(_FOUND, hit)))
                yield pd.Series(out, dtype=object)

        found = docs.select("doc_id", F.explode(run("text")).alias("_f")).select("doc_id", "_f.*")
    ids = benchmark.select("item_id", _item().alias("item"))
    return found.join(ids, "item").select("doc_id", "item_id", "coverage", "n_slots", "n_changed")


def _rows(docs: DataFrame) -> DataFrame:
    """docs with a key of their own, which a task that runs again must not change."""
    return shared.keep(docs.withColumn("_row", F.expr("uuid()")), "template-rows")


def _find_by_join(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """As `find`, for any number of windows: documents' windows are shuffled by hash."""
    sizes = [r["size"] for r in windows.select("size").distinct().collect()]  # WINDOW sizes at most

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row, text in zip(frame["_row"], frame["text"]):
                template, value, first, line = _scan([text])
                for size, (h, good) in ((size, x) for size in sizes for x in _windows(template, value, first, line, size)):
                    at = np.flatnonzero(good)
                    if not len(at):
                        continue
                    yield pd.DataFrame({
                        "hash": h[at].view(np.int64), "_row": row, "place": at,
                        "theirs": [value[i : i + size].view(np.int64).tolist() for i in at],
                    })

    mine = rows.select("_row", "text").mapInPandas(cut, "hash long, _row string, place long, theirs array<long>")
    joined = mine.join(windows, "hash")
    grouped = joined.groupBy("_row", "item").agg(
        F.collect_list(F.struct("at", "place", "slots", "theirs")).alias("m"), F.first("n_words").alias("n_words"),
    )

    @F.pandas_udf("coverage double, n_slots int, n_changed int, bad boolean")
    def decide(m: pd.Series, n: pd.Series) -> pd.DataFrame:
        rows = []
        for matches, n_words in zip(m, n):
            at, place = (np.array([x[k] for x in matches], np.int64) for k in ("at", "place"))
            size, place = len(matches[0]["slots"]), place - place.min()
            own, theirs = np.zeros(n_words, np.uint64), np.zeros(int(place.max()) + size, np.uint64)
            for a, b, x in zip(at.tolist(), place.tolist(), matches):
                own[a : a + size], theirs[b : b + size] = (np.array(x[k], np.int64).view(np.uint64) for k in ("slots", "theirs"))
            rows.append(judge(at, place, size, own, theirs))
        return pd.DataFrame(rows, columns=["coverage", "n_slots", "n_changed", "bad"])

    found = grouped.withColumn("d", decide("m", "n_words")).where("d.bad").select("_row", "item", "d.coverage", "d.n_slots", "d.n_changed")
    return rows.drop("text").join(found, "_row")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """docs that hold no item of the benchmark."""
    windows = benchmark_windows(benchmark)
    items = _small(windows, broadcast_windows)
    held = docs.select(F.struct("*").alias("_doc"), "text")
    if items is None:
        rows = _rows(held)
        return rows.join(_find_by_join(rows, windows).select("_row").distinct(), "_row", "left_anti").select("_doc.*")

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = batch.tolist()
            out = np.ones(len(texts), bool)
            for a, b in pieces(texts):
                out[[a + hit[0] for hit in items.value.hits(texts[a:b])]] = False
            yield pd.Series(out)

    return held.where(clean("text")).select("_doc.*")
