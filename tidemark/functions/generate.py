"""Repeatable record generators, as column expressions.

The reference jobs draw ids from a counter and values from a random source.
Here every value is a pure function of the id (an md5-derived integer), so a
generated table is the same on every run, on every partitioning, and can be
checked against an independent SQL engine. Works over any id column:
`spark.range` or a table's key in batch, `rate` source `value` in a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Generator vocabulary of the reference producers.
GENDERS = ("male", "female")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
NAME_LENGTH = 6
MAX_SCORE = 100          # scores are uniform over 0..100, both ends included
BOUNDED_ID = (1, 1000)   # bounded random table: id in 1..1000
BOUNDED_STRING_LENGTH = 9
BOUNDED_GENDER_LENGTH = 6


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_int(key: Column, salt: str = "", hex_digits: int = 6) -> Column:
    """Non-negative int from the first `hex_digits` hex digits of md5(salt || key)."""
    if not 1 <= hex_digits <= 7:
        raise ValueError("hex_digits must be 1..7 to fit a non-negative int")
    text = F.concat(F.lit(salt), key.cast("string")) if salt else key.cast("string")
    return F.conv(F.substring(F.md5(text), 1, hex_digits), 16, 10).cast("int")


def pick(alphabet: str, h: Column) -> Column:
    """The character of `alphabet` at position h mod len(alphabet)."""
    return F.substring(F.lit(alphabet), h % len(alphabet) + 1, 1)


def gender_col(id_col: str | Column) -> Column:
    return F.when(hash_int(_col(id_col), hex_digits=4) % 2 == 0, F.lit(GENDERS[0])) \
            .otherwise(F.lit(GENDERS[1]))


def name_col(id_col: str | Column, length: int = NAME_LENGTH) -> Column:
    """First letter upper case, the rest from both cases; one md5 per position."""
    key = _col(id_col).cast("string")
    chars = []
    for j in range(length):
        h = hash_int(F.concat(key, F.lit(f":{j}")), salt="n")
        chars.append(pick(UPPER if j == 0 else LETTERS, h))
    return F.concat(*chars)


def score_col(id_col: str | Column, max_score: int = MAX_SCORE) -> Column:
    return hash_int(_col(id_col), salt="s") % (max_score + 1)


def int_col(id_col: str | Column, lo: int, hi: int, salt: str = "b") -> Column:
    """Uniform-looking int in lo..hi inclusive."""
    if hi < lo:
        raise ValueError("hi < lo")
    return F.lit(lo) + hash_int(_col(id_col), salt=salt) % (hi - lo + 1)


def string_col(id_col: str | Column, length: int, salt: str = "g") -> Column:
    """Fixed-length string of hex digits, md5 blocks chained for long strings."""
    key = _col(id_col).cast("string")
    blocks = [F.md5(F.concat(F.lit(f"{salt}{i}:"), key)) for i in range((length + 31) // 32)]
    return F.substring(F.concat(*blocks), 1, length)


def gen_gender(df: DataFrame, id_col: str = "id") -> DataFrame:
    return df.select(F.col(id_col).alias("id"), gender_col(id_col).alias("gender"))


def gen_name(df: DataFrame, id_col: str = "id", length: int = NAME_LENGTH) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), name_col(id_col, length).alias("name"))


def gen_score(df: DataFrame, id_col: str = "id", max_score: int = MAX_SCORE) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), score_col(id_col, max_score).alias("score"))


def gen_bounded(df: DataFrame, id_col: str = "id", lo: int = BOUNDED_ID[0], hi: int = BOUNDED_ID[1],
                string_length: int = BOUNDED_STRING_LENGTH) -> DataFrame:
    """The bounded random table: (seq, id in lo..hi, name, gender) per input row."""
    return df.select(F.col(id_col).alias("seq"),
                     int_col(id_col, lo, hi).alias("id"),
                     string_col(id_col, string_length, salt="n").alias("name"),
                     string_col(id_col, BOUNDED_GENDER_LENGTH, salt="g").alias("gender"))


def rate_ids(spark, rows_per_second: int = 1, num_partitions: int | None = None) -> DataFrame:
    """Streaming id source 1, 2, 3, ... (the producers' counter) from the `rate` source."""
    r = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    if num_partitions:
        r = r.option("numPartitions", num_partitions)
    return r.load().select((F.col("value") + 1).alias("id"))
