"""Personal data in texts: spans that rules are sure of, and spans that boosted trees add.

The rules (`base_spans`) find e-mail addresses, IP addresses, card and phone numbers of the usual form, each kind by
itself. They miss what is written otherwise, or what runs into its neighbour (a card number right after a phone number
makes one match that fails as a whole, and a failing match is not tried again). So generators propose every window of up
to WINDOW groups of digits, and every address with `@` or a spelled-out at, as overlapping candidates; trees on
features of their form and of what stands around them score each; and of each kind those are taken, best first and
apart from all taken before, whose score reaches the kind's threshold.

Training needs no labels by hand. Of a bounded sample of documents, candidates that are base spans are examples, those
in no failed match are counterexamples. Base spans are also written in other ways, put side by side, and spoilt, so that
the trees see known spans where the rules fail. A quarter of the sample is kept out: on it scores are calibrated by
isotonic regression, and a kind's threshold is the least score whose calibrated probability reaches PROBABILITY; a kind
with fewer than LEAST examples there adds nothing.

Documents are independent, so nothing is shuffled; the model is a few kilobytes.

Edge cases: a NULL text is empty and has no spans; a NULL doc_id stays; repeated rows are each searched; ties of a score
go to the earlier and then to the longer candidate; without examples base spans alone remain; an empty table gives no
rows; other columns are not read. All scans are linear in a text's length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

KINDS = ("email", "ip", "card", "phone")
#: About so many documents make the sample, and at most so many candidates and base spans of them.
SAMPLE_DOCUMENTS, SAMPLE_CANDIDATES, SAMPLE_SPANS = 40_000, 40_000, 12_000
WINDOW, CONTEXT = 6, 32
PROBABILITY, LEAST = 0.95, 20
TREES, DEPTH, RATE, BINS = 80, 3, 0.2, 32

# base spans

# lengths are open, so alternatives that cannot match are cut off by looking back, and never tried from each place of a run
_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, passes) of each kind's matches."""
    last = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            last = m.end()
            yield 0, start, last, True
    for m in _IP.finditer(text):
        yield 1, *m.span(), all(map(_small, m[0].split(".")))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        yield 2, *m.span(), 14 <= len(digits) <= 19 and luhn(digits)
    for m in _PHONE.finditer(text):
        yield 3, *m.span(), 10 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in the order of start and kind."""
    return sorted((a, k, b) for k, a, b, passes in _matches(text) if passes)


# candidates

_JOINT = re.compile(r"[ ()./-]{1,3}|\[\.\]|\(\.\)| dot | \. ")
_DOT = re.compile(r"\.|\[\.\]|\(\.\)| dot | [\[(]dot[\])] ")
_SIGN = re.compile(r"@| @ | ?[\[(]at[\])] ?| at ")
_LABEL = re.compile(r"(?:\.| ?[\[(](?:\.|dot)[\])] ?| dot )?([A-Za-z0-9-]{1,63})")
_CUES = (
    re.compile(r"(?i)mail|write|contact|address|@"), re.compile(r"(?i)\bip\b|host|server|addr|ping"),
    re.compile(r"(?i)card|visa|master|credit|pay|account"), re.compile(r"(?i)phone|call|tel|mobile|fax|dial"),
)
_NUMBERS = re.compile(r"(?i)version|licen[sc]e|\bv\.?$|\bcc\b|\bby\b|sha|token|key|hash|id\b|no\.|page|isbn")


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), overlapping."""
    found = []
    groups = [m.span() for m in _DIGITS.finditer(text)]
    linked = [b - a <= 5 and bool(_JOINT.fullmatch(text, a, b)) for a, b in zip((g[1] for g in groups), (g[0] for g in groups[1:]))]
    dotted = [b - a <= 5 and bool(_DOT.fullmatch(text, a, b)) for a, b in zip((g[1] for g in groups), (g[0] for g in groups[1:]))]
    for i, (start, _) in enumerate(groups):
        digits = 0
        for j in range(i, min(i + WINDOW, len(groups))):
            if j > i and not linked[j - 1]:
                break
            a, b = groups[j]
            digits += b - a
            if digits > 19:
                break
            if 13 <= digits:
                found.append((2, start, b))
            if 9 <= digits <= 15:
                lead = start
                if lead and text[lead - 1] == "(":
                    lead -= 1
                if lead and text[lead - 1] == "+":
                    lead -= 1
                if lead < start or j > i:
                    found.append((3, lead, b))
            if j == i + 3 and all(dotted[i:j]) and all(y - x <= 3 for x, y in groups[i : j + 1]):
                found.append((1, start, b))
    for m in _SIGN.finditer(text):
        start = m.start()
        while start and m.start() - start < 64 and text[start - 1] in _LOCAL:
            start -= 1
        ends, at = [], m.end()
        while label := _LABEL.match(text, at):
            if ends and label.start(1) == at or not ends and label.start(1) != at:
                break
            ends.append(at := label.end())
        plain = m[0] == " at " and not re.search(r"dot|\[|\(", text[m.end() : at])  # as in "seen at example.com"
        if start < m.start() and not plain:
            found += [(0, start, e) for e in ends[-2:] if len(ends) > 1 and e != ends[0]]
    return found


FEATURES = 36


def _around(c: str) -> int:
    return 0 if c in ("", "\n") else 1 if c == " " else 2 if c.isalnum() else 3 if c in "\"'([{<|" else 4 if c in "=-_./+" else 5


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    span = text[start:end]
    groups = _DIGITS.findall(span)
    digits = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + 4]
    left, right = re.search(r"[0-9]+[ ().-]{0,2}$", before), re.match(r"[ ().-]{0,2}[0-9]+", after)
    run = max((len(m[0]) for m in re.finditer(r"(.)\1*", digits)), default=0)
    x = [0.0] * FEATURES
    x[kind] = 1
    x[4:12] = len(span), len(digits), len(groups), min(sizes), max(sizes), sizes[0], sizes[-1], span[:1] == "+"
    x[12:18] = "(" in span, len(set(re.sub(r"\w", "", span))), span.count(" "), span.count("-"), span.count("."), bool(digits) and luhn(digits)
    x[18:22] = max((min(int(g[:5]), 999) if len(g) < 6 else 999 for g in groups), default=0), len(set(digits)), run, sizes[0] == sizes[-1]
    if kind == 0:
        at = _SIGN.search(span)
        labels = re.findall(r"[A-Za-z0-9-]+", re.sub(r"[\[(]?\bdot\b[\])]?", ".", span[at.end() :]) if at else "")
        tld = labels[-1] if labels else ""
        x[22:28] = at.start() if at else 0, len(labels), len(tld), tld.isalpha() and tld.islower(), len(at[0]) if at else 0, " dot" in span or "dot)" in span or "dot]" in span
    x[28:32] = _around(before[-1:]), _around(after[:1]), bool(_CUES[kind].search(before)), bool(_NUMBERS.search(before[-16:]))
    x[32:36] = bool(left), bool(right), len(left[0]) if left else 0, digits[:1] == "0"
    return x


# trees


class Trees:
    """Gradient boosting of the logistic loss: full binary trees over binned features, grown level by level."""

    def __init__(self) -> None:
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.bias = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES) -> Trees:
        self.edges = [np.unique(np.quantile(np.unique(c), np.linspace(0, 1, BINS)[1:-1], method="lower")) for c in x.T]
        bins, leaves = self._binned(x), 1 << DEPTH
        rate = np.clip(np.average(y, weights=weight), 1e-6, 1 - 1e-6)
        self.bias = float(np.log(rate / (1 - rate)))
        score = np.full(len(y), self.bias)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = weight * (y - p), weight * p * (1 - p)
            feature, cut, place = np.zeros(leaves - 1, np.intp), np.full(leaves - 1, BINS), np.zeros(len(y), np.intp)
            for level in range(DEPTH):
                first, n = (1 << level) - 1, 1 << level
                best = np.zeros(n)
                for f in range(x.shape[1]):
                    at = (place - first) * BINS + bins[:, f]
                    left_g = np.bincount(at, g, n * BINS).reshape(n, BINS).cumsum(1)
                    left_h = np.bincount(at, h, n * BINS).reshape(n, BINS).cumsum(1)
                    all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                    gain = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
                    gain[(left_h < 1e-3) | (all_h - left_h < 1e-3)] = 0
                    k = gain.argmax(1)
                    better = gain[np.arange(n), k] > best + 1e-9
                    best[better] = gain[np.arange(n), k][better]
                    feature[first : first + n][better], cut[first : first + n][better] = f, k[better]
                place = 2 * place + 1 + (bins[np.arange(len(y)), feature[place]] > cut[place])
            leaf = place - (leaves - 1)
            value = RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + 1)
            self.trees.append((feature, cut, value))
            score += value[leaf]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        bins, rows = self._binned(x), np.arange(len(x))
        score = np.full(len(x), self.bias)
        for feature, cut, value in self.trees:
            place = np.zeros(len(x), np.intp)
            for _ in range(DEPTH):
                place = 2 * place + 1 + (bins[rows, feature[place]] > cut[place])
            score += value[place - len(feature)]
        return score


def calibrated(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression: scores at which the probability rises, and the probabilities."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # of score, sum, weight
    for s, t, w in zip(score[order], (y * weight)[order], weight[order]):
        if blocks and blocks[-1][0] == s:
            blocks[-1][1], blocks[-1][2] = blocks[-1][1] + t, blocks[-1][2] + w
        else:
            blocks.append([s, t, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, t2, w2 = blocks.pop()
            blocks[-1][1], blocks[-1][2] = blocks[-1][1] + t2, blocks[-1][2] + w2
    return np.array([b[0] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


class Model:
    """Trees, and each kind's threshold (infinite: adds nothing)."""

    def __init__(self, trees: Trees, thresholds: list[float]) -> None:
        self.trees, self.thresholds = trees, thresholds

    def added(self, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
        """Spans beyond the base ones, which keep clear of these and of each other."""
        rows, which = [], []
        for i, text in enumerate(texts):
            known = {(k, a, b) for a, k, b in base[i]}
            for c in candidates(text):
                if c not in known and self.thresholds[c[0]] < np.inf:
                    rows.append(features(text, *c))
                    which.append((i, *c))
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        if not rows:
            return out
        score = self.trees.score(np.array(rows))
        passing: dict[int, list] = {}
        for s, (i, k, a, b) in zip(score, which):
            if s >= self.thresholds[k]:
                passing.setdefault(i, []).append((-s, a, -b, k))
        for i, found in passing.items():
            taken = _Taken([(a, b) for a, _, b in base[i]])
            for _, a, b, k in sorted(found):
                if taken.add(a, -b):
                    out[i].append((a, k, -b))
        return out


class _Taken:
    """Disjoint spans by their starts; spans given at first may overlap and are merged."""

    def __init__(self, spans: list[tuple[int, int]]) -> None:
        import bisect

        self._bisect = bisect
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.starts.append(a)
                self.ends.append(b)

    def free(self, a: int, b: int) -> bool:
        i = self._bisect.bisect_right(self.starts, a)
        return not ((i and self.ends[i - 1] > a) or (i < len(self.starts) and self.starts[i] < b))

    def add(self, a: int, b: int) -> bool:
        if not self.free(a, b):
            return False
        i = self._bisect.bisect_right(self.starts, a)
        self.starts.insert(i, a)
        self.ends.insert(i, b)
        return True


# training


def _examples(text: str) -> tuple[list[tuple[list[float], bool]], list[tuple[int, str, str, str]]]:
    """Labelled candidates of a text, and its base spans with what stands around them."""
    matches = list(_matches(text))
    base = {(k, a, b) for k, a, b, passes in matches if passes}
    failed = sorted((a, b) for _, a, b, passes in matches if not passes)
    exact = {(k, a, b) for k, a, b, passes in matches if not passes}
    unknown = _Taken(failed)
    rows = []
    for c in candidates(text):
        # a part of a match that failed may well be what the rule missed: it teaches nothing
        if c in base or c in exact or unknown.free(c[1], c[2]):
            rows.append((features(text, *c), c in base))
    around = [(k, text[max(0, a - CONTEXT) : a], text[a:b], text[b : b + CONTEXT]) for k, a, b in sorted(base) if b - a < 200]
    return rows, around


def _rewritten(kind: int, value: str, rng: np.random.Generator) -> str:
    """The same datum in a form that the rules do not know."""
    pick = lambda *x: x[int(rng.integers(len(x)))]
    if kind == 0:
        local, _, domain = value.partition("@")
        if rng.random() < 0.5:
            return local + pick(" at ", " (at) ", "(at)", " [at] ") + domain.replace(".", pick(" dot ", "(dot)", " [dot] ", "[.]"))
        return local + pick(" (at) ", "(at)", " [at] ", " @ ") + domain
    if kind == 1:
        return value.replace(".", pick("[.]", "(.)", " . ", " dot "))
    digits = "".join(_DIGITS.findall(value))
    if kind == 2:
        return pick(".", "/", " - ").join(digits[i : i + 4] for i in range(0, len(digits), 4))
    body = value[1:] if value[:1] == "+" else value
    return pick(body, "00" + body, body.replace(" ", "."), body.partition(" ")[2] if len(digits) > 10 and " " in body else body)


def _spoilt(kind: int, value: str, rng: np.random.Generator) -> str:
    """No datum any more, in nearly its form."""
    if kind == 0:
        return re.sub(r"(\.[A-Za-z0-9-]+)+$", lambda m: m[0].rpartition(".")[0] + "." + str(int(rng.integers(10, 99))), value)
    at = [m.start() for m in _DIGITS.finditer(value)]
    if kind == 1:
        return value[: at[0]] + str(int(rng.integers(256, 999))) + value[at[0] :].lstrip("0123456789")
    if kind == 2:
        i = at[0]
        return value[:i] + str((int(value[i]) + int(rng.integers(1, 9))) % 10) + value[i + 1 :]
    return value[: max(4, len(value) // 3)].rstrip(" ().-")


def training_set(rows: list[tuple[list[float], bool]], around: list[tuple[int, str, str, str]], seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """features, label and kind: candidates as found, and those of base spans rewritten, side by side, and spoilt."""
    rng, out = np.random.default_rng(seed), list(rows)
    for kind, before, value, after in around:
        other_kind, _, other, _ = around[int(rng.integers(len(around)))]
        gap = " " if rng.random() < 0.7 else ", "
        new, bad = _rewritten(kind, value, rng), _spoilt(kind, value, rng)
        both = [(before + new + after, {(kind, len(before), len(before) + len(new))}), (before + bad + after, set())]
        b = len(before) + len(value) + len(gap)
        both.append((before + value + gap + other + after, {(kind, len(before), len(before) + len(value)), (other_kind, b, b + len(other))}))
        for text, right in both:
            for c in candidates(text):
                if c[1] < len(text) - len(after) and c[2] > len(before):  # of what was put in, not of its context
                    out.append((features(text, *c), c in right))
    if not out:
        return np.zeros((0, FEATURES)), np.zeros(0), np.zeros(0, np.intp)
    x = np.array([r[0] for r in out])
    return x, np.array([r[1] for r in out], float), x[:, : len(KINDS)].argmax(1)


def fit(train: tuple[list, list], held_out: tuple[list, list]) -> Model | None:
    x, y, kind = training_set(*train)
    if not y.any() or y.all():
        return None
    # each kind's examples and counterexamples count alike in sum
    weight = np.ones(len(y))
    for k in range(len(KINDS)):
        for v in (0, 1):
            own = (kind == k) & (y == v)
            weight[own] = len(y) / (2 * len(KINDS) * max(1, own.sum()))
    trees = Trees().fit(x, y, weight)
    cx, cy, ck = training_set(*held_out, seed=1)
    thresholds = [np.inf] * len(KINDS)
    for k in range(len(KINDS)):
        own = ck == k
        if cy[own].sum() >= LEAST:
            scores, p = calibrated(trees.score(cx[own]), cy[own], np.ones(own.sum()))
            if (p >= PROBABILITY).any():
                thresholds[k] = float(scores[p >= PROBABILITY][0])
    return Model(trees, thresholds)


def _text() -> Column:
    """The text where anything in it could be a candidate, else NULL; most texts stay in the JVM."""
    return F.when(F.col("text").rlike(r"[0-9@]| at |[\[(]at[\])]"), F.col("text"))


def train(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, most_candidates: int = SAMPLE_CANDIDATES, most_spans: int = SAMPLE_SPANS) -> Model | None:
    n = docs.count()
    place = F.xxhash64("doc_id", "text", F.lit(12))
    share = (place / F.lit(2.0**64) + 0.5) < documents / max(n, 1)
    some = docs.select(_text().alias("text"), place.alias("place")).where(share & F.col("text").isNotNull())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, at in zip(batch["text"], batch["place"].tolist()):
                rows, around = _examples(text)
                out += [(at, i, r, bool(y), None, None, None, None) for i, (r, y) in enumerate(rows)]
                out += [(at, i, None, None, *a) for i, a in enumerate(around)]
            yield pd.DataFrame(out, columns=["place", "nth", "x", "y", "kind", "before", "value", "after"], dtype=object)

    shared.bounded_batches(docs.sparkSession)
    made = shared.keep(some.mapInPandas(run, "place long, nth int, x array<double>, y boolean, kind int, before string, value string, after string"), "pii-sample")
    first = lambda df, most: df.orderBy("place", "nth", *[c for c in ("value", "before") if c in df.columns]).limit(most).collect()
    rows = first(made.where("x is not null").select("place", "nth", "x", "y"), most_candidates)
    around = first(made.where("x is null").select("place", "nth", "kind", "before", "value", "after"), most_spans)
    shared.discard(made)
    part = lambda keep: ([(r["x"], r["y"]) for r in rows if (r["place"] % 4 != 0) == keep], [(r["kind"], r["before"], r["value"], r["after"]) for r in around if (r["place"] % 4 != 0) == keep])
    return fit(part(True), part(False))


SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"


def find(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with pii: spans by start and kind, whether each is a base span; code points, end exclusive."""
    shared.bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(SPANS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = [t or "" for t in batch]
            base = [base_spans(t) for t in texts]
            more = held.value.added(texts, base) if held.value else [[] for _ in texts]
            yield pd.Series([[{"kind": KINDS[k], "start": a, "end": b, "base": own} for a, k, b, own in sorted([(*s, True) for s in one] + [(*s, False) for s in two])] for one, two in zip(base, more)])

    return docs.withColumn("pii", F.coalesce(run(_text()), F.array().cast(SPANS)))


def redact(found: DataFrame, mark: str = "[{}]") -> DataFrame:
    """found (text, pii) with `redacted`: each run of overlapping spans replaced by the kind of its first one."""
    cut = lambda a, n: F.substr(F.col("text"), a, n)
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    name = lambda s: F.concat(F.lit(mark.partition("{}")[0]), s["kind"], F.lit(mark.partition("{}")[2]))
    step = lambda a, s: F.when(s["start"] < a["at"], F.struct(a["done"].alias("done"), F.greatest(a["at"], s["end"]).alias("at"))).otherwise(
        F.struct(F.concat(a["done"], cut(a["at"] + 1, s["start"] - a["at"]), name(s)).alias("done"), s["end"].alias("at")))
    whole = F.aggregate("pii", start, step)
    return found.withColumn("_w", whole).withColumn("redacted", F.concat(F.col("_w.done"), cut(F.col("_w.at") + 1, F.length("text")))).drop("_w")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_documents(docs: DataFrame) -> DataFrame:
    """doc_id, numbers of base spans, the digest of these, and all spans."""
    rows = docs.select("doc_id", "text")
    base = F.filter("pii", lambda s: s["base"])
    # the Python column is a column of its own before it is used more than once
    found = find(rows, train(rows)).select("doc_id", "pii").withColumn("base", base)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans"))
