"""Streams of points: sampled from blocks with a halo by one join with a static table, which keeps no state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from ..operators import stored
from ..operators.sampling import bilinear
from ..options import SamplerOptions
from .requests import answers


def sample_stream(points: DataFrame, pixels: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """points (streaming) with `height` from a table of pixels: four joins by pixel, for rasters that are not in blocks."""
    return bilinear(points, pixels, u, v)


def sample_blocks(points: DataFrame, halo: DataFrame, size: int, u: str = "u", v: str = "v") -> DataFrame:
    """points (streaming) with `height`: one join by block; each micro-batch moves its own points only where the blocks
    are in buckets."""
    return stored.bilinear(points, halo, size, u, v)


def availability(sampled: DataFrame, time: str, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Points and points without a height by window of event time, final once the watermark has passed."""
    return sampled.withWatermark(time, late).groupBy(F.window(time, width).alias("window")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("height").isNull()).alias("n_unavailable"))


REQUESTS = "request_id long, n_points int, seq int, u double, v double, time timestamp"


def read_requests(spark: SparkSession, folder: str, options: SamplerOptions) -> DataFrame:
    """Requests that arrive as Parquet files in a folder; a micro-batch takes about as many bytes as the options say."""
    return spark.readStream.schema(REQUESTS).option("maxBytesPerTrigger", str(options.bytes_per_trigger)).parquet(folder)


def serve(requests: DataFrame, halo: DataFrame, size: int, options: SamplerOptions, checkpoint: str) -> DataStreamWriter:
    """A writer of answers to requests (request_id, n_points, seq, u, v, time), with the trigger of the options; the
    caller says where to."""
    sampled = sample_blocks(requests, halo, size)
    return answers(sampled, options.late).writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(processingTime=options.trigger)
