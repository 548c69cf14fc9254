"""Digests of a table by bucket of its key, so that a comparison reads only what differs.

The bucket of a row comes from its key in the one way to write it, so 560, 560.0
and 0560 share a bucket whatever the column is later found to hold. The digest
of a bucket is a SHA-256 over the count and the sums of the rows' SHA-256
digests, piece by piece: the order of the rows does not matter, and repeated
rows count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewright.operators.profile import exact_number, number_text

BUCKET = "__bucket"
_PIECES = 8


def bucket_of(keys: Sequence[str], n: int) -> Column:
    written = []
    for key in keys:
        text = F.col(key).cast("string")
        # A null must take part: the hash would pass it over.
        written.append(F.coalesce(number_text(exact_number(text)), text, F.lit("\0")))
    return F.pmod(F.xxhash64(*written), F.lit(n)).cast("int")


def by_bucket(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Rows with their bucket, dealt so that a bucket makes few files; Spark may split a hot one."""
    return df.withColumn(BUCKET, bucket_of(keys, n)).hint("rebalance", BUCKET)


def bucket_digests(df: DataFrame) -> DataFrame:
    """``bucket, n_rows, digest`` of a table that has its buckets."""
    columns = sorted(c for c in df.columns if c != BUCKET)
    row = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    hashed = df.select(F.col(BUCKET).alias("bucket"), F.sha2(row, 256).alias("row"))
    # Pieces of 32 bits: two billion rows of a bucket fit into the sums.
    pieces = [
        F.sum(F.conv(F.substring("row", 8 * k + 1, 8), 16, 10).cast("bigint")).alias(f"p{k}")
        for k in range(_PIECES)
    ]
    sums = hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_rows"), *pieces)
    text = F.concat_ws(",", "n_rows", *[f"p{k}" for k in range(_PIECES)])
    return sums.select("bucket", "n_rows", F.sha2(text, 256).alias("digest"))


def differing_buckets(old: DataFrame, new: DataFrame) -> DataFrame:
    """``table_name, bucket`` whose digests differ, or which one side lacks."""
    a = old.select("table_name", "bucket", F.col("digest").alias("old_digest"))
    b = new.select("table_name", "bucket", F.col("digest").alias("new_digest"))
    both = a.join(b, ["table_name", "bucket"], "full")
    return both.filter(~F.col("old_digest").eqNullSafe(F.col("new_digest"))).select(
        "table_name", "bucket"
    )
