"""Sharding by extendible hashing.

A document's key is hashed to 60 bits. A directory indexed by the leading bits points to buckets; a bucket over the byte
limit, and no other, is split on its next bit until every bucket fits. Each bucket is a shard, named by its bits.

Splits are worked out ``STEP`` bits at a time from sums of bytes by hash prefix, which are aggregated before they are
shuffled; only prefixes that are still too large go into the next round. The directory is a table and is never collected.
Rows with one key that together exceed the limit use up all bits; they are hashed anew by a row number that is written
down first, so even copies of one row are spread out. A single row over the limit is a shard by itself, as it cannot be
split.

Null keys hash as the empty text and null texts have 0 bytes. No rows make no shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.common import MAX_SENT_IDS, packed, written

SHARD_BYTES = 4 << 20
BITS = 60
STEP = 12


def hash_bits(key: Column) -> Column:
    """The leading 60 bits of the MD5 of a key's text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("bigint")


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("h", BITS - depth)


def _split(rows: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """For each round its bits and a table ``cell``, ``depth``, ``shard_bytes``: the bucket of every cell that is settled.

    Cells of the last round that are still too large are in none.
    """
    rounds, bits, open_rows = [], 0, rows
    while bits < BITS:
        low, bits = bits, min(BITS, bits + STEP)
        cells = open_rows.groupBy(_prefix(bits).alias("cell")).agg(F.sum("bytes").alias("bytes"))
        cells = written(cells, "cells")
        depths = F.explode(F.sequence(F.lit(low + (low > 0)), F.lit(bits))).alias("depth")
        above = cells.select("cell", "bytes", depths).withColumn("prefix", F.expr(f"shiftrightunsigned(cell, {bits} - depth)"))
        nodes = above.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes")).filter(F.col("shard_bytes") <= limit)
        # The bucket of a cell is the shallowest node over it that fits; nodes below a fitting node fit as well.
        settled = above.join(nodes, ["depth", "prefix"]).groupBy("cell")
        settled = written(settled.agg(F.min(F.struct("depth", "shard_bytes")).alias("b")).select("cell", "b.*"), "directory")
        rounds.append((bits, settled))
        rest = written(cells.join(settled, "cell", "left_anti").select("cell"), "oversized")
        if rest.isEmpty():
            break
        open_rows = open_rows.withColumn("cell", _prefix(bits)).join(_sent(rest), "cell", "left_semi").drop("cell")
    return rounds


def _sent(table: DataFrame) -> DataFrame:
    """A table of numbers, to be broadcast if it is small enough."""
    return F.broadcast(table) if table.limit(MAX_SENT_IDS // 4 + 1).count() <= MAX_SENT_IDS // 4 else table


def _assigned(rows: DataFrame, rounds: list[tuple[int, DataFrame]]) -> DataFrame:
    """Rows with ``shard``, null where the bits ran out, ``depth`` and ``shard_bytes``."""
    depth = size = F.lit(None)
    for i, (bits, settled) in enumerate(rounds):
        named = _sent(settled.select(F.col("cell").alias(f"c{i}"), F.col("depth").alias(f"d{i}"), F.col("shard_bytes").alias(f"s{i}")))
        rows = rows.join(named, _prefix(bits) == F.col(f"c{i}"), "left")
        depth, size = F.coalesce(depth, F.col(f"d{i}")), F.coalesce(size, F.col(f"s{i}"))
    bits = F.expr("CASE WHEN depth = 0 THEN '' ELSE lpad(bin(shiftrightunsigned(h, 60 - depth)), depth, '0') END")
    return rows.select("doc", "h", "bytes", depth.cast("int").alias("depth"), size.alias("shard_bytes")).withColumn("shard", bits)


def sharded(docs: DataFrame, key: str = "doc_id", limit: int = SHARD_BYTES) -> DataFrame:
    """``doc`` (all columns), ``shard``, ``depth``, ``bytes`` of the row and ``shard_bytes`` of each row."""
    size = F.coalesce(F.octet_length(F.col("text")), F.lit(0)).cast("long")
    rows = docs.select(packed(docs), hash_bits(F.col(key)).alias("h"), size.alias("bytes"))
    names = ["doc", "shard", "depth", "bytes", "shard_bytes"]
    rounds = _split(rows.select("h", "bytes"), limit)
    out = _assigned(rows, rounds)
    if rounds[-1][0] < BITS:
        return out.select(names)
    left = out.filter("shard IS NULL")
    if left.isEmpty():
        return out.select(names)
    numbered = written(left.select("doc", F.col("h").alias("old"), "bytes", F.monotonically_increasing_id().alias("row")), "overflow")
    again = numbered.select(F.struct("doc", "old").alias("doc"), hash_bits(F.concat_ws(":", "old", "row")).alias("h"), "bytes")
    # Rows of different keys are told apart by the old hash in the shard's name, so buckets only get smaller.
    spread = _assigned(again, _split(again.select("h", "bytes"), limit))
    shard = F.concat(F.lpad(F.bin("doc.old"), BITS, "0"), F.lit("+"), F.coalesce("shard", F.lpad(F.bin("h"), BITS, "0")))
    spread = spread.withColumn("shard", shard).withColumn("depth", F.coalesce("depth", F.lit(BITS)) + BITS)
    total = spread.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"))
    spread = spread.drop("shard_bytes").join(total, "shard").withColumn("doc", F.col("doc.doc")).select(names)
    return out.filter("shard IS NOT NULL").select(names).unionByName(spread)


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", limit: int = SHARD_BYTES) -> DataFrame:
    """Write each shard as a folder ``shard=...`` of Parquet files and return the directory: shard, depth, rows, bytes."""
    rows = sharded(docs, key, limit).withColumn("shard", F.concat(F.lit("s"), "shard"))
    rows.select("doc.*", "shard").repartition("shard").write.partitionBy("shard").parquet(path)
    return rows.groupBy("shard", "depth").agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"))


def shard_table(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """One row per document: its shard, the shard's depth and bytes, and its own bytes."""
    rows = sharded(docs.select("doc_id", "text"), "doc_id", limit)
    return rows.select("doc.doc_id", "shard", "depth", F.col("bytes").alias("n_bytes"), "shard_bytes")
