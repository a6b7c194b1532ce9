"""Sharding by extendible hashing.

A document's bucket is a prefix of the bits of its hash.  All start in the bucket
of no bits; a bucket over the byte limit, and only such a bucket, splits on its
next bit.  Since a bucket's bytes only fall as its prefix grows, the splits of a
stride of bits come from one grouped sum per prefix: a bucket is a shard where it
fits and its parent does not.  The first stride is 16 bits (at most 65,536
cells), the next ones 4 bits and over the documents of still oversized buckets
only.  The table read meanwhile holds ids, sizes and hashes, no texts.

A document over the limit is a shard of its own.  Rows with one hash (repeats of
one ``doc_id``) cannot be split by bits; beyond the limit they go to overflow
pages, numbered by the written partition and position of the row.

Defined results: a null text has 0 bytes; rows without a ``doc_id`` hash alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize, small_side

BITS = 60
STRIDES = [16] + [4] * 11
SHARD_BYTES = 16 << 20


def hash_bits(doc_id: Column) -> Column:
    """The first 60 bits of the MD5 of the id's text, as a long."""
    hexed = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, 15)
    return F.conv(hexed, 16, 10).cast("long")


def prefix(depth: Column | int) -> Column:
    d = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", F.col("h"), F.lit(BITS) - d)


def label(depth: Column, p: Column) -> Column:
    """A prefix written as its bits; the root's is empty."""
    return F.when(depth > 0, F.lpad(F.conv(p.cast("string"), 10, 2), depth, "0")).otherwise(F.lit(""))


def shard_documents(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """``doc_id, n_bytes, local_depth, shard, shard_bytes`` of every document."""
    rows = materialize(docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        hash_bits(F.col("doc_id")).alias("h"), F.monotonically_increasing_id().alias("row")), "shard_rows")
    done: DataFrame | None = None
    depth = 0
    for stride in STRIDES:
        top = depth + stride
        cells = rows.groupBy(prefix(top).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n"))
        first = 0 if depth == 0 else depth + 1
        levels = cells.select("cell", "bytes", "n", F.explode(F.sequence(F.lit(first), F.lit(top))).alias("d"))
        levels = levels.withColumn("p", F.expr(f"shiftright(cell, {top} - d)"))
        sums = levels.groupBy("d", "p").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        fits = materialize(sums.where((F.col("bytes") <= limit) | (F.col("n") == 1)), "buckets")
        # A cell's shard is the shortest of its prefixes that fits.
        place = levels.select("cell", "d", "p").join(fits, ["d", "p"]).groupBy("cell").agg(
            F.min(F.struct("d", "p", "bytes")).alias("s"))
        place = materialize(place.select("cell", F.col("s.d").alias("d"), F.col("s.p").alias("p"),
                                         F.col("s.bytes").alias("shard_bytes")), "directory")
        found = rows.withColumn("cell", prefix(top)).join(small_side(place), "cell", "left")
        settled = found.where("d is not null").select(
            "doc_id", "n_bytes", F.col("d").alias("local_depth"), label(F.col("d"), F.col("p")).alias("shard"), "shard_bytes")
        done = settled if done is None else done.unionByName(settled)
        open_rows = found.where("d is null").select("doc_id", "n_bytes", "h", "row")
        if not open_rows.head(1):
            return done
        rows, depth = materialize(open_rows, "shard_rows"), top
    # One hash, more bytes than a shard: pages of rows that stand together.
    size = F.max("n_bytes")
    same = rows.groupBy("h").agg(size.alias("largest"))
    per = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("largest"), F.lit(1)))).cast("long")
    paged = rows.join(same, "h").withColumn("page", F.floor((F.col("row") % F.lit(1 << 33)) / per)).withColumn(
        "part", F.call_function("shiftright", F.col("row"), F.lit(33)))
    pages = paged.groupBy("h", "part", "page").agg(F.sum("n_bytes").alias("shard_bytes"))
    paged = paged.join(pages, ["h", "part", "page"]).select(
        "doc_id", "n_bytes", F.lit(BITS).alias("local_depth"),
        F.concat_ws("/", label(F.lit(BITS), F.col("h")), F.col("part"), F.col("page")).alias("shard"), "shard_bytes")
    return done.unionByName(paged)
