"""Answers to requests on a stream: each request's points, sampled one by one, put together again.

A request comes as rows (request_id, n_points, seq, u, v, time), in any order and in any micro-batches. Its answer is one
row, made as soon as all its points are there: heights and valid flags in the order of seq, and a message. A point that
comes twice counts once, the first time; rows that disagree on n_points, and a seq outside it, fail the request. What
is not complete when the watermark passes its last row is answered as it is, with a message, and points that come later
than the watermark are dropped by Spark before they get here. An answered request is remembered until the watermark has
passed, so that a late copy of one of its points starts no new one.

State is kept by bucket, and a bucket holds the requests whose number's hash falls into it: a call of Python costs
milliseconds, so it serves all requests of a bucket at once, by arrays. Each has its own time-out within its bucket's.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Groups of requests. A stream's state is by bucket, so a checkpoint goes with the number it was begun with.
BUCKETS = 1024
ANSWER = "request_id long, heights array<double>, valid array<boolean>, n_unavailable int, success boolean, message string"
#: Of each request the first five; of each point of a request without an answer the others, NaN for no height.
STATE = "ids array<long>, n_points array<int>, conflict array<boolean>, answered array<boolean>, expiry array<long>, owners array<long>, seqs array<int>, heights array<double>"
_REQUEST = {"n_points": np.int64, "conflict": bool, "answered": bool, "expiry": np.int64}
_POINT = {"request_id": np.int64, "seq": np.int64, "height": np.float64}


def _message(n: int, came: int, missing: int, conflict: bool) -> str:
    if conflict:
        return "the request's rows do not agree"
    if came < n:
        return f"{n - came} of {n} points did not come"
    return f"{missing} of {n} points have no height" if missing else ""


def _answers(known: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
    """The answers to requests (by number: n_points, conflict) from their points."""
    size = known["n_points"].clip(lower=0).to_numpy()
    at, first = known.index.get_indexer(points["request_id"]), np.cumsum(size) - size
    flat = np.full(int(size.sum()), np.nan)
    flat[first[at] + points["seq"].to_numpy()] = points["height"].to_numpy()
    valid, came = ~np.isnan(flat), np.bincount(at, minlength=len(known))
    heights = flat.astype(object)
    heights[~valid] = None
    ranges = list(zip(first.tolist(), (first + size).tolist()))
    missing = [b - a - int(valid[a:b].sum()) for a, b in ranges]
    conflict = known["conflict"].to_numpy()
    return pd.DataFrame({
        "request_id": known.index.to_numpy(), "heights": [heights[a:b].tolist() for a, b in ranges], "valid": [valid[a:b].tolist() for a, b in ranges],
        "n_unavailable": missing, "success": ~conflict & (came == known["n_points"].to_numpy()),
        "message": [_message(*x) for x in zip(known["n_points"].tolist(), came.tolist(), missing, conflict.tolist())],
    })


def _take(known: pd.DataFrame, points: pd.DataFrame, rows: pd.DataFrame, watermark: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Requests and points with the rows of a micro-batch."""
    rows = rows.sort_values(["request_id", "seq"], kind="stable")
    of = rows.groupby("request_id")
    new = pd.DataFrame({"n_points": of["n_points"].first(), "conflict": False, "answered": False, "expiry": 0}).astype(_REQUEST)
    known = pd.concat([known, new[~new.index.isin(known.index)]])
    n = known["n_points"].reindex(rows["request_id"]).to_numpy()
    good = (rows["n_points"].to_numpy() == n) & (rows["seq"].to_numpy() >= 0) & (rows["seq"].to_numpy() < n)
    known.loc[rows["request_id"].to_numpy()[~good], "conflict"] = True
    last = np.maximum(of["ms"].max(), watermark + 1)
    known.loc[last.index, "expiry"] = np.maximum(known.loc[last.index, "expiry"], last)
    points = pd.concat([points, rows.loc[good, list(_POINT)].astype(_POINT)]).drop_duplicates(["request_id", "seq"])
    return known, points


def _assemble(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    watermark = state.getCurrentWatermarkMs()
    ids, *of_requests, owners, seqs, heights = state.get if state.exists else [[]] * 8
    known = pd.DataFrame(dict(zip(_REQUEST, of_requests)), index=pd.Index(ids, dtype=np.int64)).astype(_REQUEST)
    points = pd.DataFrame(dict(zip(_POINT, (owners, seqs, heights)))).astype(_POINT)
    rows = [] if state.hasTimedOut else list(batches)
    if rows:
        known, points = _take(known, points, pd.concat(rows, ignore_index=True), watermark)
    came = np.bincount(known.index.get_indexer(points["request_id"]), minlength=len(known))[: len(known)] if len(points) else np.zeros(len(known), int)
    over = known["expiry"] < watermark
    done = ~known["answered"] & (known["conflict"] | (came == known["n_points"]) | over)
    if done.any():
        yield _answers(known[done], points[points["request_id"].isin(known.index[done])])
    known["answered"] |= done
    known = known[~over]
    points = points[points["request_id"].isin(known.index[~known["answered"]])]
    if not len(known):
        state.remove()
        return
    state.update((known.index.tolist(), *(known[c].tolist() for c in _REQUEST), *(points[c].tolist() for c in _POINT)))
    state.setTimeoutTimestamp(max(int(known["expiry"].min()), watermark + 1))


def answers(sampled: DataFrame, late: str = "30 minutes", buckets: int = BUCKETS) -> DataFrame:
    """sampled (request_id, n_points, seq, height, time), streaming or not -> one answer for each request. A request's
    points are in one group, with those of the other requests of its bucket."""
    rows = sampled.select("request_id", "n_points", "seq", "height", "time").where("request_id is not null and n_points is not null and seq is not null and time is not null")
    rows = rows.withWatermark("time", late).withColumn("ms", F.unix_millis("time")).withColumn("bucket", F.pmod(F.xxhash64("request_id"), F.lit(buckets)))
    return rows.groupBy("bucket").applyInPandasWithState(_assemble, ANSWER, STATE, "append", GroupStateTimeout.EventTimeTimeout)
