import random
from datetime import datetime

from pyspark.sql import functions as F

from shardweave.functions import (
    MAX_HASH_KEY,
    decimal_to_hex,
    millis_between,
    plus_millis,
    seq_after,
    seq_at_or_after,
    seq_order,
    wall_clock,
)


def test_sequence_numbers_order_by_value(spark):
    df = spark.createDataFrame([("9",), ("10",), ("2",)], "s string")
    assert [r.s for r in df.orderBy(seq_order("s")).collect()] == ["2", "9", "10"]
    assert df.agg(F.max_by("s", seq_order("s"))).first()[0] == "10"


def test_seq_after_follows_integer_order(spark):
    rng = random.Random(1)
    numbers = [str(rng.randrange(10 ** rng.choice([1, 2, 56, 57]))) for _ in range(300)]
    pairs = [(a, b) for a, b in zip(numbers, reversed(numbers), strict=True)] + [("7", "7")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select(
        "a", "b", seq_after("a", "b").alias("gt"), seq_at_or_after("a", "b").alias("ge")
    ).collect():
        assert r.gt == (int(r.a) > int(r.b))
        assert r.ge == (int(r.a) >= int(r.b))


def test_decimal_to_hex(spark):
    rng = random.Random(2)
    numbers = [0, 1, 10**9, 2**32 - 1, 2**32, 2**64, 2**127, 2**128 - 1, 2**126 - 2]
    numbers += [rng.randrange(2 ** rng.randrange(1, 129)) for _ in range(300)]
    df = spark.createDataFrame([(str(n),) for n in numbers] + [(None,)], "n string")
    for r in df.withColumn("h", decimal_to_hex("n")).collect():
        assert r.h == (None if r.n is None else f"{int(r.n):032x}")
    assert MAX_HASH_KEY == "340282366920938463463374607431768211455"


def test_times(spark):
    a, b = datetime(2024, 3, 30, 23, 59, 59, 999_000), datetime(2024, 4, 2, 1, 0, 0, 500)
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    got = df.select(
        millis_between(F.col("a"), F.col("b")).alias("ms"),
        plus_millis(F.col("a"), 90_001).alias("later"),
        wall_clock(a).alias("w"),
    ).first()
    assert got.ms == 2 * 86_400_000 + 3_600_000 + 1
    assert got.later == datetime(2024, 3, 31, 0, 1, 30, 0)
    assert got.w == a
