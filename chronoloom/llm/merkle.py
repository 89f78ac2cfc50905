"""Merkle manifest of a dataset: one root over all rows, and for every row the proof that it belongs to it.

A row's leaf is the SHA-256 of its columns. The leaves of a source, ascending by ``doc_id``, are folded three at a time
into a subroot, and the subroots, ordered by source, into the root.

Tree positions are the digits, to base three, of a leaf's rank in its source. They are columns, and grouping them away one
after another, the lowest first, nests child structs into parent structs. This is done within blocks of ``3 ** LEVELS``
leaves: rows are shuffled by block once, and all groupings of a block follow in the same task. Roots of blocks are leaves of
the next such turn until every source has one block, so a source of any size is never held whole. On the way back a
``transform`` of the nested structs hands every leaf its siblings and ``explode`` lets it out; the siblings above a block come
to it by a union and a grouping by block, not by a join.

Null columns make the part ``-``; an empty text makes ``0:``. Rows without ``doc_id`` come first in their source; rows that
share one are ordered by leaf, so equal rows have equal leaves and proofs of their own. An empty table gives no rows. Columns
beyond the five named ones are not part of a leaf and do not come back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.common import written
from chronoloom.llm.ranking import placed

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Digits of a rank that are grouped away within a block.
LEVELS = 6
STEP = "struct<before: string, after: string>"


def _digest(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf(columns: Sequence[str | Column]) -> Column:
    """Digest of values, each written as its number of UTF-8 bytes, a colon and the value, or as ``-`` if null."""
    parts = []
    for column in columns:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return _digest(F.concat(*parts))


def _rolled(nodes: DataFrame) -> DataFrame:
    """Blocks ``grp, group_size, block, node`` of nodes ``grp, rank, group_size, node``; a node has ``hash``.

    Levels above the group's own root hand its hash on as it is.
    """
    digits = [f"d{i}" for i in range(LEVELS)]
    keys = ["grp", "group_size", "block"]
    rank = F.col("rank")
    rows = nodes.select(
        "grp",
        "group_size",
        F.floor(rank / F.lit(3**LEVELS)).alias("block"),
        *[(F.floor(rank / F.lit(3**i)) % 3).cast("tinyint").alias(d) for i, d in enumerate(digits)],
        "node",
    ).repartition("grp", "block")
    for i, digit in enumerate(digits):
        found = F.array_sort(F.collect_list(F.struct(F.col(digit).alias("digit"), "node")))
        rows = rows.groupBy(*keys, *digits[i + 1 :]).agg(F.transform(found, lambda x: x["node"]).alias("kids"))
        joined = F.array_join(F.transform("kids", lambda k: k["hash"]), "")
        above = F.when(F.col("group_size") > 3**i, _digest(joined)).otherwise(F.get("kids", F.lit(0))["hash"])
        node = F.struct(above.alias("hash"), F.col("kids"))
        rows = rows.select(*keys, *digits[i + 1 :], node.alias("node"))
    return rows


def _climbed(nodes: DataFrame) -> list[DataFrame]:
    """Tables of blocks, the lowest first; a group ends in the first table where it has one block."""
    tables = []
    while True:
        tables.append(written(_rolled(nodes), "blocks"))
        largest = tables[-1].agg(F.max("group_size").alias("n")).first().n
        if largest is None or largest <= 3**LEVELS:
            return tables
        nodes = tables[-1].filter(F.col("group_size") > 3**LEVELS)
        nodes = nodes.select(
            "grp",
            F.col("block").alias("rank"),
            F.ceil(F.col("group_size") / F.lit(3**LEVELS)).alias("group_size"),
            F.struct(F.col("node.hash").alias("hash"), F.lit(None).cast("int").alias("item")).alias("node"),
        )


def _tops(tables: list[DataFrame]) -> DataFrame:
    """``grp``, its root ``top``, and the table in which it ends."""
    parts = [
        table.filter(F.col("group_size") <= 3**LEVELS).select("grp", F.col("node.hash").alias("top"), F.lit(i).alias("height"))
        for i, table in enumerate(tables)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _let_out(node: Column, path: Column, size: Column, level: int) -> Column:
    """Every leaf below a node with its path: the siblings before and after it, level by level, its own level first."""
    if level == 0:
        return F.array(F.struct(node["item"].alias("item"), node["hash"].alias("hash"), path.alias("path")))

    def of(kid: Column, i: Column) -> Column:
        hashes = F.transform(node["kids"], lambda k: k["hash"])
        before = F.array_join(F.slice(hashes, F.lit(1), i), "")
        after = F.array_join(F.slice(hashes, i + 2, F.lit(2)), "")
        step = F.array(F.struct(before.alias("before"), after.alias("after")))
        own = F.when(size > 3 ** (level - 1), step).otherwise(F.array().cast(f"array<{STEP}>"))
        return _let_out(kid, F.concat(own, path), size, level - 1)

    return F.flatten(F.transform(node["kids"], of))


def _descended(tables: list[DataFrame], tops: DataFrame, kept: Sequence[str]) -> DataFrame:
    """Leaves ``grp, item, hash, path`` and the columns ``kept`` of ``tops``, which are ``grp, height, path`` and those."""
    below = None
    for i in range(len(tables) - 1, -1, -1):
        paths = tops.filter(F.col("height") == i).select("grp", F.lit(0).cast("bigint").alias("block"), "path", *kept)
        if below is not None:
            paths = paths.unionByName(below.select("grp", F.col("rank").alias("block"), "path", *kept))
        both = tables[i].unionByName(paths, allowMissingColumns=True).groupBy("grp", "block")
        columns = ["group_size", "node", "path", *kept]
        met = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns]).filter(F.col("node").isNotNull())
        leaves = _let_out(F.col("node"), F.col("path"), F.col("group_size"), LEVELS)
        out = met.select("grp", "block", *kept, F.posexplode(leaves).alias("place", "leaf"))
        rank = F.col("block") * 3**LEVELS + F.col("place")
        below = out.select("grp", rank.alias("rank"), "leaf.item", "leaf.hash", "leaf.path", *kept)
        if i:
            below = written(below, "paths")
    return below


def manifest(leaves: DataFrame) -> DataFrame:
    """``item, hash, path, subroot, root`` of leaves ``grp, key, hash, item``.

    Groups are folded in the order of ``grp``, which has no nulls, and the leaves of a group in that of the struct ``key``.
    """
    node = F.struct("hash", "item").alias("node")
    tables = _climbed(placed(leaves, ["grp"], ["key"]).select("grp", "rank", "group_size", node))
    tops = written(_tops(tables), "subroots")
    ranked = placed(tops, [], ["grp"])
    sources = _climbed(
        ranked.select(
            F.lit("").alias("grp"), "rank", "group_size", F.struct(F.col("top").alias("hash"), F.struct("grp", "height").alias("item")).alias("node")
        )
    )
    empty = F.array().cast(f"array<{STEP}>")
    root = _tops(sources).select("grp", "height", F.col("top").alias("root"), empty.alias("path"))
    paths = _descended(sources, root, ["root"])
    paths = written(paths.select("item.grp", "item.height", F.col("hash").alias("subroot"), "path", "root"), "subroot-paths")
    return _descended(tables, paths, ["subroot", "root"]).drop("grp", "rank")


def folded(path: Column, start: Column) -> Column:
    """The root that a leaf and its siblings come to."""
    return F.aggregate(path, start, lambda h, s: _digest(F.concat(s["before"], h, s["after"])))


def siblings(path: Column) -> Column:
    """All siblings of a path, end to end."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def merkle_table(docs: DataFrame) -> DataFrame:
    """One row per document: its leaf, proof and roots, and whether its text, tampered with in half the rows, still verifies."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    cut = F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))
    first = leaf(COLUMNS)
    again = F.when(hit, leaf([*COLUMNS[:-1], cut])).otherwise(first)
    source = F.col("source").cast("string")
    leaves = docs.select(
        F.when(source.isNull(), "0").otherwise(F.concat(F.lit("1"), source)).alias("grp"),
        F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), first.alias("leaf")).alias("key"),
        again.alias("again"),
    )
    # Written first, as sorting by ranges reads its rows twice and texts should be hashed once.
    leaves = written(leaves, "leaves")
    leaves = leaves.select("grp", "key", F.col("key.leaf").alias("hash"), F.struct("key.doc_id", "again").alias("item"))
    rows = manifest(leaves).withColumn("folded_root", folded(F.col("path"), F.col("item.again")))
    return rows.select(
        "item.doc_id",
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        _digest(siblings(F.col("path"))).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
