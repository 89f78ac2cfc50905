"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

The documents of a source, in a seeded order, are one stream of words, cut into *blocks* of ``BLOCK_WORDS`` words (the last
block of a source may be shorter); ``SHARD_BLOCKS`` blocks in a row are a *shard*. The seats of the mix, one for each block it
takes, go to sources by the highest quotients ``target / (2 * seats + 1)``, and each source's seats go to its shards in the same way, by the words
of the shards. A block is taken at most ``MOST`` times, so a source or shard with all its blocks taken that often gets no
further seat. Within a shard every block is taken equally often but for one more time for those with the least seeded digests, until
the shard's quota is met. A document's share is the words of its blocks, with repeats; spans say which they are.

Seats are not dealt out one by one: rounding ``votes / divisor`` with a divisor that is a little too high gives seats that are sure,
one with a divisor a little too low bounds the rest, and only the few quotients between the two are ranked. Nothing grows with the
number of seats but the answer. Targets are found by refilling what stopped sources leave, one sum over sources a round.

Every order is by content (digests, ids, sizes), so runs agree however the input is split. Null and empty texts have size 0
and are never taken; a source of such texts has target 0. Sources without a name come last. Rows without ``doc_id`` take
part; rows that are equal in id and text are a document each, and which of them takes which place makes no difference to the result.
An empty table gives no rows. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.common import let, words_of, written
from chronoloom.llm.ranking import looked_up, placed

BLOCK_WORDS = 16
SHARD_BLOCKS = 1024
SEED = 20_240_501
#: Blocks whose draws are left to one task, about.
DRAWN_TOGETHER = 1 << 19
WHOLE = "decimal(38,0)"


@dataclass(frozen=True)
class Mix:
    """Weights of the sources, repeating in their order; the mix's share of all words; how often a word may be taken."""

    weights: Sequence[int] = (5, 2, 1)
    percent: int = 150
    most: int = 2


def targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """``target`` words of each source ``grp, size, weight``: shares by weight, at most ``most`` times a source's size.

    A source stops when its limit is under ``rest / weights``, the share of one weight; what it leaves raises that share for the others.
    Counted in hundredths of a word, so all of it is whole numbers.
    """
    limit = (F.lit(100 * mix.most).cast(WHOLE) * F.col("size")).cast(WHOLE)
    rows = sources.withColumn("_limit", limit)
    whole = rows.agg(F.sum(F.col("size").cast(WHOLE)).alias("size"), F.sum("weight").alias("weight")).first()
    if whole.weight is None:
        return sources.withColumn("target", F.lit(0.0))
    total, weights = mix.percent * int(whole["size"]), int(whole.weight)
    rest, open_weights = total, weights
    while True:
        stopped = F.col("_limit") * open_weights < F.col("weight").cast(WHOLE) * F.lit(rest).cast(WHOLE)
        sums = rows.filter(stopped).agg(F.sum("_limit").alias("limit"), F.sum("weight").alias("weight")).first()
        now = total - int(sums.limit or 0), weights - int(sums.weight or 0)
        if now[1] == 0 or now == (rest, open_weights):
            break
        rest, open_weights = now
    open_target = (F.col("weight").cast(WHOLE) * F.lit(rest).cast(WHOLE)).cast("double") / F.lit(float(100 * open_weights))
    target = F.when(stopped, F.col("size").cast("double") * mix.most).otherwise(open_target)
    return rows.withColumn("target", target).drop("_limit")


def apportioned(units: DataFrame, seats: DataFrame) -> DataFrame:
    """``quota`` of each unit ``grp, unit, votes, most`` by the Sainte-Laguë method; ``seats`` has ``grp, seats``.

    Ties go to the lesser unit. Where all units of a group are full, seats are left over.
    """
    sums = units.groupBy("grp").agg(F.sum("votes").alias("_votes"), F.count(F.lit(1)).alias("_units"), F.sum("most").alias("_most"))
    units = written(looked_up(units, sums.join(seats, "grp"), ["grp"]), "units")
    rounded = lambda divisor: F.floor(F.col("votes") / divisor + 0.5)
    wanted = F.least("seats", "_most")
    margin = 1.0
    while True:
        slack = F.col("_units") / 2 + 1
        fewer, more = F.col("seats") - slack, F.col("seats") + slack * margin
        low = F.when(fewer > 0, rounded(F.col("_votes") / fewer)).otherwise(0)
        high = rounded(F.col("_votes") / more) + 1
        bounds = units.withColumn("_low", F.when(F.col("votes") > 0, F.least(low, "most")).otherwise(0))
        bounds = bounds.withColumn("_high", F.when(F.col("votes") > 0, F.least(high, "most")).otherwise(0))
        found = bounds.groupBy("grp").agg(
            F.sum("_low").alias("sure"), F.sum("_high").alias("all"), F.first("seats").alias("seats"), F.first("_most").alias("_most")
        )
        # Full units may leave too few quotients between the bounds; the lower divisor is then lowered further.
        short = found.filter(F.col("all") < wanted)
        if margin > 1e6 or short.isEmpty():
            break
        margin *= 8
    chances = bounds.filter("_high > _low").select(
        "grp", "unit", "votes", F.explode(F.sequence(F.col("_low"), F.col("_high") - 1)).alias("_nth")
    )
    chances = chances.select("grp", "unit", (-F.col("votes") / (2 * F.col("_nth") + 1)).alias("_order"), "_nth")
    left = found.select("grp", (F.col("seats") - F.col("sure")).alias("_left"))
    ranked = looked_up(placed(chances, ["grp"], ["_order", "unit", "_nth"]), left, ["grp"])
    extra = ranked.filter(F.col("rank") < F.col("_left")).groupBy("grp", "unit").agg(F.count(F.lit(1)).alias("_extra"))
    rows = bounds.join(extra, ["grp", "unit"], "left")
    quota = F.col("_low") + F.coalesce("_extra", F.lit(0))
    return rows.select("grp", "unit", quota.cast("bigint").alias("quota"))


def _taken(shard: Column, blocks: Column, quota: Column, grp: Column) -> Column:
    """How often each block of a shard is taken."""
    places = F.sequence(F.lit(0).cast("bigint"), blocks - 1)
    number = lambda i: (shard * SHARD_BLOCKS + i).cast("string")
    drawn = F.transform(
        places, lambda i: F.struct(F.md5(F.concat(F.lit(f"{SEED}:"), grp, F.lit(":"), number(i))).alias("d"), i.alias("i"))
    )
    more = F.transform(F.slice(F.array_sort(drawn), F.lit(1), (quota % blocks).cast("int")), lambda x: x["i"])
    every = F.floor(quota / blocks).cast("tinyint")
    # The chosen places and all places, sorted together: a place that is there twice is taken once more.
    both = F.array_sort(F.concat(F.transform(places, lambda i: i * 2), F.transform(more, lambda i: i * 2 + 1)))
    chosen = lambda x, j, all_: F.when(F.get(all_, j + 1) == x + 1, F.lit(1)).otherwise(F.lit(0))
    marked = let(both, lambda all_: F.transform(all_, lambda x, j: F.when(x % 2 == 0, every + chosen(x, j, all_)).cast("tinyint")))
    return F.filter(marked, lambda x: x.isNotNull())


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, spans``, one row per document.

    ``spans`` lists the words taken: the first, the one after the last, both counted from 0, and how often.
    """
    text, source = F.col("text").cast("string"), F.col("source").cast("string")
    doc_id = F.col("doc_id").cast("bigint")
    draw = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")))))
    rows = docs.select(
        F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source)).alias("grp"),
        doc_id.alias("doc_id"),
        F.size(words_of(text)).cast("bigint").alias("size"),
        draw.alias("draw"),
    )
    # Written first, as sorting by ranges reads its rows twice.
    rows = placed(written(rows, "sizes"), ["grp"], ["draw", "doc_id", "size"], "size", "start").withColumnRenamed("group_size", "source_size")
    rows = written(rows.drop("draw").withColumn("row", F.monotonically_increasing_id()), "streams")

    weights = F.array(*[F.lit(w) for w in mix.weights])
    sources = placed(rows.groupBy("grp").agg(F.sum("size").alias("size")), [], ["grp"]).drop("group_size")
    weight = F.get(weights, (F.col("rank") % len(mix.weights)).cast("int"))
    sources = written(targets(sources.withColumn("weight", weight.cast("bigint")), mix), "targets")
    total = int(sources.agg(F.sum("size").alias("n")).first().n or 0)
    seats = (mix.percent * total + 50 * BLOCK_WORDS) // (100 * BLOCK_WORDS)

    blocks = F.ceil(F.col("size") / BLOCK_WORDS)
    units = sources.select(F.lit("").alias("grp"), F.col("grp").alias("unit"), F.col("target").alias("votes"), (blocks * mix.most).alias("most"))
    spark = docs.sparkSession
    quotas = apportioned(units, spark.range(1).select(F.lit("").alias("grp"), F.lit(seats).cast("bigint").alias("seats")))
    quotas = written(quotas.select(F.col("unit").alias("grp"), F.col("quota").alias("seats")), "quotas")

    words = SHARD_BLOCKS * BLOCK_WORDS
    shards = sources.filter("size > 0").select(
        "grp", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("size") / words) - 1)).alias("unit")
    )
    votes = F.least(F.col("size") - F.col("unit") * words, F.lit(words))
    shards = shards.select("grp", "unit", votes.cast("double").alias("votes"), F.ceil(votes / BLOCK_WORDS).alias("blocks"))
    shares = apportioned(shards.select("grp", "unit", "votes", (F.col("blocks") * mix.most).alias("most")), quotas)
    # Drawing blocks is the work here and not the bytes, so the number of tasks follows the number of blocks.
    tasks = 1 + total // (BLOCK_WORDS * DRAWN_TOGETHER)
    shares = shards.join(shares, ["grp", "unit"]).repartition(tasks, "grp", "unit")
    shares = written(shares.select("grp", "unit", _taken(F.col("unit"), F.col("blocks"), F.col("quota"), F.col("grp")).alias("times")), "shares")

    end = F.col("start") + F.col("size")
    pieces = rows.filter("size > 0").select(
        "row", "grp", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / words), F.floor((end - 1) / words))).alias("unit")
    )
    low = F.greatest(F.col("start"), F.col("unit") * words)
    high = F.least(end, (F.col("unit") + 1) * words)
    met = looked_up(pieces, shares, ["grp", "unit"])
    numbers = F.sequence(F.floor(low / BLOCK_WORDS), F.floor((high - 1) / BLOCK_WORDS))

    def span(block: Column) -> Column:
        return F.struct(
            (F.greatest(low, block * BLOCK_WORDS) - F.col("start")).alias("first"),
            (F.least(high, (block + 1) * BLOCK_WORDS) - F.col("start")).alias("last"),
            F.get("times", (block % SHARD_BLOCKS).cast("int")).alias("times"),
        )

    spans = F.filter(F.transform(numbers, span), lambda s: s["times"] > 0)
    found = met.select("row", spans.alias("spans")).groupBy("row").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    out = rows.join(found, "row", "left")
    out = looked_up(out, sources.select("grp", "target"), ["grp"])
    spans = F.coalesce("spans", F.array().cast("array<struct<first: bigint, last: bigint, times: tinyint>>"))
    name = F.when(F.col("grp") != "1", F.substring("grp", 2, 1 << 30))
    taken = F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + (s["last"] - s["first"]) * s["times"])
    return out.select("doc_id", name.alias("source"), "size", "source_size", "target", taken.alias("taken"), spans.alias("spans"))


def pieces_of(text: Column, spans: Column) -> Column:
    """The stretches of a text that its spans stand for, each as often as it is taken, words joined by spaces."""
    words = words_of(text)
    one = lambda s: F.array_join(F.slice(words, (s["first"] + 1).cast("int"), (s["last"] - s["first"]).cast("int")), " ")
    return F.flatten(F.transform(spans, lambda s: F.array_repeat(one(s), s["times"].cast("int"))))


def mix_table(docs: DataFrame) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words of it that the mix takes."""
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken")
