"""Deterministic train/test split (L1).

``randomSplit`` depends on partitioning and row order; this split hashes a
stable key with the seed, so the same row lands in the same side on any
cluster size and in DuckDB (md5 is standard).  ``is_test`` cuts the hash at a
fixed value, so its test share is exact in expectation; ``exact_split`` takes
exactly ceil(test_size * n) rows, those of smallest hash.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..persist import materialize

SPLIT_BUCKETS = 10000


def split_bucket(key: Column | str, seed: int = 42) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(F.concat(k.cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(SPLIT_BUCKETS))


def is_test(key: Column | str, test_size: float = 0.2, seed: int = 42) -> Column:
    return split_bucket(key, seed) < F.lit(int(round(test_size * SPLIT_BUCKETS)))


def with_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    return df.withColumn("split", F.when(is_test(key, test_size, seed), "test").otherwise("train"))


def split_sql(key_sql: str, test_size: float = 0.2, seed: int = 42) -> str:
    """The same assignment in DuckDB SQL (oracle)."""
    return (f"CASE WHEN (('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || ':{seed}'), 1, 8))::BIGINT "
            f"% {SPLIT_BUCKETS}) < {int(round(test_size * SPLIT_BUCKETS))} THEN 'test' ELSE 'train' END")


# exact size ----------------------------------------------------------------------
HASH_BITS, DIGIT_BITS = 60, 12


def split_hash(key: Column | str, seed: int = 42) -> Column:
    """60 bits of the md5 of key and seed; a NULL key counts as empty text."""
    k = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(k, F.lit(f":{seed}"))), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def kth_smallest(df: DataFrame, value: str, k: int) -> tuple[int, int, int]:
    """The k-th smallest of the non-negative integers ``value`` (below 2**60): (it, number below it, number equal to it).

    A digit of ``DIGIT_BITS`` bits a round, the highest first: counts by digit among the values with the prefix found so
    far tell the next digit.  A round is one aggregate with at most 2**DIGIT_BITS groups.
    """
    prefix, below, equal = 0, 0, 0
    for shift in range(HASH_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        digits = (df.where(F.shiftright(value, shift + DIGIT_BITS) == prefix)
                  .groupBy(F.shiftright(value, shift).bitwiseAND((1 << DIGIT_BITS) - 1).alias("digit")).count().collect())
        for r in sorted(digits, key=lambda r: r["digit"]):
            if below + r["count"] >= k:
                prefix, equal = prefix << DIGIT_BITS | r["digit"], r["count"]
                break
            below += r["count"]
        else:
            raise ValueError("fewer values than k")
    return prefix, below, equal


def test_rows(n: int, test_size: float) -> int:
    """ceil(test_size * n), with the share taken as the decimal it is written as."""
    return math.ceil(Fraction(str(test_size)) * n)


def exact_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """The rows with ``split``: exactly ceil(test_size * n) of them "test", those of smallest hash of ``key``.

    Which rows these are depends on the keys alone, as long as no key repeats at the cut; of rows that repeat the key
    there (a hot key, or none), as many as are still wanted are taken in the order they are read.
    """
    name, number = "split_hash", "split_row"
    while {name, number} & set(df.columns):
        name, number = name + "_", number + "_"
    rows = materialize(df.withColumn(name, split_hash(key, seed)).withColumn(number, F.monotonically_increasing_id()), repartition=False)
    k = test_rows(rows.count(), test_size)
    if not k:
        return rows.drop(name, number).withColumn("split", F.lit("train"))
    cut, below, equal = kth_smallest(rows, name, k)
    chosen = F.col(name) < cut
    if below + equal == k:
        chosen = F.col(name) <= cut
    else:
        last, _, _ = kth_smallest(rows.where(F.col(name) == cut), number, k - below)
        chosen = chosen | (F.col(name) == cut) & (F.col(number) <= last)
    return rows.withColumn("split", F.when(chosen, "test").otherwise("train")).drop(name, number)


def exact_split_sql(table: str, key: str, test_size: float = 0.2, seed: int = 42) -> str:
    """The same assignment in DuckDB SQL (oracle), for keys that do not repeat."""
    share = Fraction(str(test_size))
    return (f"SELECT {key}, CASE WHEN row_number() OVER (ORDER BY ('0x' || substr(md5(coalesce(CAST({key} AS VARCHAR), '') || ':{seed}'), 1, {HASH_BITS // 4}))::BIGINT) "
            f"<= -(-{share.numerator} * count(*) OVER () // {share.denominator}) THEN 'test' ELSE 'train' END AS split FROM {table}")
