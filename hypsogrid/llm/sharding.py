"""Shuffled sharding: a Feistel permutation of global row numbers gives each row its shard and slot.

Row numbers depend on the rows alone, not on files or partitions. Rows are counted by key first, so any
number of equal rows is one counted row, which is cut into parts of at most COPIES equal rows that go to different
buckets; parts are numbered inside hash buckets, and the buckets' totals, whose number is fixed by a parameter, are
summed up and broadcast.

Given the total N, the permutation is computable for any row number alone: shard = p mod shards and
slot = p div shards for p = permute(number), so shards differ by one row at most and slots have no gaps.

Edge cases: NULL text has 0 bytes and the CRC of the empty string; NULL doc_id is a key like any other;
equal rows get different numbers, and which gets which cannot be told apart; an empty table gives no rows.
Columns other than the keys are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Buckets in which keys are numbered; also the bound on the rows of the broadcast totals.
BUCKETS = 4096
#: Rounds of the Feistel network and the multipliers of its round function.
ROUNDS = 6
MULTIPLIERS = (1103515245, 69069, 1664525, 22695477, 134775813, 214013)
PRIME = 2147483647
#: At least half of the permutation's domain are row numbers, so each step of the walk ends it with
#: probability 1/2 or more: 192 steps fail for none of 2**63 rows but with probability 2**-129.
WALK = 192
#: Steps that each row walks; the few rows that are not there by then walk on.
FIRST_STEPS = 6
#: Equal rows that one row stands for at most while rows are numbered.
COPIES = 1 << 16


def number_rows(df: DataFrame, keys: list[str], buckets: int = BUCKETS, copies: int = COPIES) -> DataFrame:
    """One row per row of df: its keys, `row_number` (0 to N-1, in the order of bucket, keys and part) and `n_rows` (N)."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"))
    parts = counted.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_all") - 1) / copies))))
    counted = parts.withColumn("_copies", F.least(F.lit(copies).cast("long"), F.col("_all") - F.col("_part") * copies)).drop("_all")
    counted = counted.withColumn("_bucket", F.pmod(F.pmod(F.xxhash64(*keys), F.lit(buckets)) + F.col("_part"), F.lit(buckets)).cast("int"))
    totals = counted.groupBy("_bucket").agg(F.sum("_copies").alias("_in_bucket"))
    # At most `buckets` rows: they fit one task, and a broadcast, at any input size.
    totals = totals.select(
        "_bucket",
        (F.sum("_in_bucket").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_in_bucket")).alias("_before"),
        F.sum("_in_bucket").over(Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n_rows"),
    )
    inside = Window.partitionBy("_bucket").orderBy(*keys, "_part").rowsBetween(Window.unboundedPreceding, 0)
    first = F.col("_before") + F.sum("_copies").over(inside) - F.col("_copies")
    return (
        counted.join(F.broadcast(totals), "_bucket")
        .withColumn("_first", first)
        .select(*keys, "n_rows", F.explode(F.sequence("_first", F.col("_first") + F.col("_copies") - 1)).alias("row_number"))
    )


def _round_constants(rounds: int, seed: int) -> Column:
    """Each round's multipliers and addends, and whether it changes the low half."""
    return F.array(*(
        F.struct(
            F.lit(MULTIPLIERS[k % len(MULTIPLIERS)]).cast("long").alias("m"),
            F.lit((seed * 7919 + 104729 * (k + 1)) % PRIME).cast("long").alias("a"),
            F.lit(MULTIPLIERS[(k + 2) % len(MULTIPLIERS)]).cast("long").alias("n"),
            F.lit(k % 2 == 1).alias("low"),
        )
        for k in range(rounds)
    ))


def _mixed(half: Column, k: Column) -> Column:
    """Pseudo-random bits of a half. No product reaches 2**63."""
    return (((half % PRIME + k["a"]) % PRIME * k["m"] + 12345) % 4294967291 % PRIME * k["n"] + 54321) % PRIME


def feistel(value: Column, low_bits: Column, high_bits: Column, rounds: Column) -> Column:
    """A permutation of 0 .. 2**(low_bits + high_bits) - 1; the halves, whose widths may differ, change in turn."""
    left, right = (lambda v, n: F.call_function("shiftleft", v, n)), (lambda v, n: F.call_function("shiftright", v, n))
    mask = lambda n: left(F.lit(1).cast("long"), n) - 1

    def step(v: Column, k: Column) -> Column:
        from_high = _mixed(right(v, low_bits), k).bitwiseAND(mask(low_bits))
        from_low = left(_mixed(v.bitwiseAND(mask(low_bits)), k).bitwiseAND(mask(high_bits)), low_bits)
        return v.bitwiseXOR(F.when(k["low"], from_high).otherwise(from_low))

    return F.aggregate(rounds, value, step)


def permute(df: DataFrame, number: str, n_rows: str, out: str, seed: int = 0, walk: int = WALK) -> DataFrame:
    """Cycle walking: the network is applied until the value is a row number again."""
    df = df.withColumn("_bits", F.greatest(F.lit(2), F.length(F.bin(F.col(n_rows) - 1))))  # 2**bits < 2 * n_rows, or 4
    df = df.withColumns({"_low": F.floor(F.col("_bits") / 2).cast("int"), "_high": F.ceil(F.col("_bits") / 2).cast("int")})
    network = lambda v: feistel(v, F.col("_low"), F.col("_high"), _round_constants(ROUNDS, seed))
    steps = lambda first, n: F.aggregate(F.sequence(F.lit(1), F.lit(n)), first, lambda v, _: F.when(v < F.col(n_rows), v).otherwise(network(v)))
    df = df.withColumn("_near", steps(network(F.col(number)), min(walk, FIRST_STEPS)))
    further = steps(F.col("_near"), max(1, walk - FIRST_STEPS))
    df = df.withColumn(out, F.when(F.col("_near") < F.col(n_rows), F.col("_near")).otherwise(further)).drop("_near", "_bits", "_low", "_high")
    failed = F.raise_error(F.lit("the cycle walk did not end")).cast("long")
    return df.withColumn(out, F.when(F.col(out) < F.col(n_rows), F.col(out)).otherwise(failed))


def shard_rows(df: DataFrame, keys: list[str], shards: int, seed: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """The keys of each row with row_number, position (its place in the shuffle), shard and slot."""
    placed = permute(number_rows(df, keys, buckets), "row_number", "n_rows", "position", seed)
    return placed.withColumns({
        "shard": (F.col("position") % shards).cast("int"),
        "slot": F.expr(f"position div {shards}"),
    })


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """Documents dealt to shards of equal row counts; law `rows`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    return shard_rows(sized, ["doc_id", "size", "text_crc32"], shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
