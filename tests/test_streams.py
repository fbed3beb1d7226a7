"""Requests on a stream: assembled over micro-batches, with copies, disagreement, points that never come, and windows of availability."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hypsogrid.operators import blocks, stored
from hypsogrid.options import SamplerOptions
from hypsogrid.streaming import requests, sampling

START = datetime(2024, 5, 1, 12, 0)


def feed(spark, folder, n, rows):
    """Each call adds a file, and so a micro-batch."""
    full = [(i, m, s, float(u), float(v), START + timedelta(minutes=t)) for i, m, s, u, v, t in rows]
    spark.createDataFrame(full, sampling.REQUESTS).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def test_requests_are_assembled(spark, tmp_path):
    px = spark.range(64).select((F.col("id") % 8).alias("col"), F.floor(F.col("id") / 8).alias("row"))
    halo = stored.with_halo(blocks.to_blocks(px.select("col", "row", (F.col("col") + 10 * F.col("row")).cast("float").alias("v")), 4), 4)
    options, folder = SamplerOptions("x", bytes_per_trigger=1), str(tmp_path)
    batches = [
        [(1, 3, 0, 0.5, 0, 0), (1, 3, 2, 2.5, 1, 0), (2, 2, 0, 1, 1, 0), (3, 2, 0, 1, 1, 1), (4, 2, 0, 50, 50, 1), (5, 1, 0, 1, 0, 1)],
        [(1, 3, 1, 1.5, 0, 2), (1, 3, 0, 7.9, 7.9, 2), (3, 4, 1, 1, 1, 2), (4, 2, 1, 6, 6, 2), (5, 1, 0, 2, 0, 2), (None, 1, 0, 0, 0, 2)],
        [(9, 1, 0, 3, 3, 100)], [(9, 1, 0, 3, 3, 101)], [(10, 1, 0, 3, 3, 102)],
    ]
    for n, rows in enumerate(batches):
        feed(spark, folder, n, rows)
        q = sampling.serve(sampling.read_requests(spark, f"{folder}/in", options), halo, 4, options, f"{folder}/state").trigger(availableNow=True).format("parquet").start(f"{folder}/out")
        q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == [
        (1, [0.5, 1.5, 12.5], [True] * 3, 0, True, ""),
        (2, [11.0, None], [True, False], 1, False, "1 of 2 points did not come"),  # the watermark has passed
        (3, [11.0, None], [True, False], 1, False, "the request's rows do not agree"),
        (4, [None, 66.0], [False, True], 1, True, "1 of 2 points have no height"),
        (5, [1.0], [True], 0, True, ""),
        (9, [33.0], [True], 0, True, ""),
        (10, [33.0], [True], 0, True, ""),
    ]


def test_availability(spark, tmp_path):
    rows = [(i, START + timedelta(minutes=i), None if i % 3 == 0 else 1.0) for i in range(60)] + [(99, START + timedelta(hours=5), 1.0)]
    spark.createDataFrame(rows, "id int, time timestamp, height double").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id int, time timestamp, height double").parquet(f"{tmp_path}/in")
    sampling.availability(stream, "time").writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    got = sorted((r["window"]["start"], r["n"], r["n_unavailable"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(START + timedelta(minutes=10 * k), 10, sum((10 * k + i) % 3 == 0 for i in range(10))) for k in range(6)]


class _State:
    """What Spark keeps of one group."""

    def __init__(self):
        self.value, self.timeout, self.watermark, self.hasTimedOut = None, None, 0, False

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentWatermarkMs(self):
        return self.watermark

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = self.timeout = None

    def setTimeoutTimestamp(self, ms):
        assert ms > self.watermark
        self.timeout = ms


def test_requests_of_a_bucket_are_answered_as_each_alone():
    rng = np.random.default_rng(3)
    for trial in range(15):
        rows = [(i, n if rng.random() > 0.02 else n + 1, s if rng.random() > 0.02 else n + 5, None if rng.random() < 0.2 else float(s + i), int(1000 * (i // 4) + rng.integers(0, 2500)))
                for i in range(40) for n in [int(rng.integers(1, 6))] for s in range(n) for _ in range(int(rng.integers(0, 3)) or 1) if rng.random() > 0.1]
        rows.sort(key=lambda r: r[4] + int(rng.integers(0, 1500)))
        batches = [rows[k : k + 25] for k in range(0, len(rows), 25)] + [[], []]
        columns, outcomes = ["request_id", "n_points", "seq", "height", "ms"], []
        for key in (lambda i: 0, lambda i: i):
            states, found, watermark = {key(i): _State() for i in range(40)}, [], 0
            for k, batch in enumerate(batches):
                alive = [r for r in batch if r[4] > watermark]
                for g, state in states.items():
                    own, state.watermark, state.hasTimedOut = [r for r in alive if key(r[0]) == g], watermark, False
                    if own:
                        found += [f for f in requests._assemble((g,), iter([pd.DataFrame(own, columns=columns)]), state)]
                for g, state in states.items():
                    if state.timeout is not None and state.timeout < watermark:
                        state.hasTimedOut = True
                        found += [f for f in requests._assemble((g,), iter([]), state)]
                watermark = max([watermark, *(r[4] - 1000 for r in batch)]) if batch else 10**6
            assert all(s.value is None for s in states.values())
            outcomes.append(sorted(map(repr, pd.concat(found).values.tolist())))
        assert outcomes[0] == outcomes[1] and len(outcomes[0]) > 30


def test_state_is_by_bucket(spark, tmp_path):
    """As many calls of Python as buckets, not as requests."""
    n = 300
    rows = spark.range(2 * n).select(F.floor(F.col("id") / 2).alias("request_id"), F.lit(2).alias("n_points"), (F.col("id") % 2).cast("int").alias("seq"), F.col("id").cast("double").alias("height"), F.lit(START).alias("time"))
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    q = requests.answers(stream, buckets=8).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) == 8
    got = {r["request_id"]: (r["heights"], r["success"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {i: ([2.0 * i, 2.0 * i + 1], True) for i in range(n)}
