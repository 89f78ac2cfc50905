"""Quality rules whose thresholds follow the data: mergeable quantile sketches per language and source.

Every document gets a few integer measures. A sketch of each measure is kept for every (language, source) as counts by
log-linear bucket: a value keeps its ``SKETCH_BITS`` leading bits, so a quantile is off by less than one part in 32.
Such sketches merge by adding counts, in any order and with the same result, so lost executors change nothing. The sketch
of a language is the sum of its sources' sketches, and that of the corpus the sum of all.

A document is rejected by a measure that lies over ``high + WIDTH * max(high - low, least)`` of its group. ``low`` and ``high`` are
quantiles of the sketch: the quartiles for measures that vary among sound documents, the median and a far quantile for those that
are zero in most; ``least`` is a spread so small that only groups without any spread fall back on it. A group's bound is held against
that of its language, and a language's against the corpus', as if ``HELD`` more documents spoke for the larger one; a small group thus
has nearly the bound of its language, and no group's rows move the bound of another by more than that share.

Only DataFrame functions are used. Null languages and sources are groups of their own. A null or empty text has no words
and fails the base rules. Rows that repeat count as often as they occur. Extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.common import SPACES, packed, words_of, written

SKETCH_BITS = 6
WIDTH = 8
HELD = 50
#: By measure: the lower and the upper quantile, in percent, and the least spread; shares and lengths are in thousandths.
RULES = {
    "symbol_share": (25, 75, 4),
    "capital_share": (25, 75, 2),
    "dup_line_share": (50, 99, 45),
    "repeat_share": (50, 99, 45),
    "mean_length": (25, 75, 60),
}
#: Groups whose thresholds may be sent to every executor; beyond, they are joined by a salted shuffle.
MAX_SENT_GROUPS = 50_000
SALTS = 32
MEASURES = list(RULES)


def _starts(sorted_windows: Column) -> Column:
    """Positions, in order, of windows whose hash occurs at least twice in the sorted windows."""
    here = F.sequence(F.lit(0), F.size(sorted_windows) - 1)

    def repeated(j: Column) -> Column:
        own = F.get(sorted_windows, j)["h"]
        before, after = F.get(sorted_windows, j - 1)["h"], F.get(sorted_windows, j + 1)["h"]
        return F.coalesce(own == before, F.lit(False)) | F.coalesce(own == after, F.lit(False))

    return F.sort_array(F.transform(F.filter(here, repeated), lambda j: F.get(sorted_windows, j)["i"]))


def measured(docs: DataFrame) -> DataFrame:
    """``doc`` (all columns), ``lang``, ``source`` and ``q``, the counts and measures of the text; no shuffle.

    Equal 3-word windows are told by their 64-bit hash.
    """
    rows = docs.select(packed(docs), "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    bare = lambda c: F.length(F.translate(c, SPACES, "")).cast("long")
    without = lambda c: F.length("text") - F.length(F.translate("text", c, ""))
    lines = F.filter(F.split("text", "\n"), lambda line: bare(line) > 0)
    kept = ["doc", "lang", "source", "n_symbols", "n_capitals", "word_chars"]
    first = rows.select(
        "doc",
        "lang",
        "source",
        without("#*$%&|<>").cast("long").alias("n_symbols"),
        without("ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_capitals"),
        bare("text").alias("word_chars"),
        words_of("text").alias("words"),
        lines.alias("lines"),
    )
    word = lambda i: F.get("words", i)
    hashes = F.when(F.size("words") < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)))
    )
    kept += ["n_words", "n_lines", "n_dup_lines"]
    counted = first.select(
        *kept[:-3],
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        hashes.alias("hashes"),
    )
    windows = F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"),
        F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    sorted_windows = counted.select(*kept, windows.alias("windows"))
    starts = F.when(F.col("windows").isNotNull(), _starts(F.col("windows")))
    n_repeat = F.aggregate(
        "starts",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    out = sorted_windows.select(*kept, starts.alias("starts")).select(
        *kept, F.coalesce(n_repeat, F.lit(0).cast("long")).alias("n_repeat_words")
    )
    share = lambda a, b: F.coalesce(F.expr(f"{a} * 1000 div nullif({b}, 0)"), F.lit(0))
    return out.select(
        "doc",
        "lang",
        "source",
        F.struct(
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words").alias("base_failed"),
            share("n_symbols", "word_chars").alias("symbol_share"),
            share("n_capitals", "word_chars").alias("capital_share"),
            share("n_dup_lines", "n_lines").alias("dup_line_share"),
            share("n_repeat_words", "n_words").alias("repeat_share"),
            share("word_chars", "n_words").alias("mean_length"),
        ).alias("q"),
    )


def bucket(value: Column) -> Column:
    """Lower end of the log-linear bucket of a whole number of at least 0."""
    shift = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(rows: DataFrame) -> DataFrame:
    """Sketch of every measure by language and source: ``lang``, ``source``, ``measure``, ``bucket``, ``n``."""
    each = F.explode(
        F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(f"q.{m}")).alias("bucket")) for m in MEASURES])
    )
    sound = rows.filter(~F.col("q.base_failed")).select("lang", "source", each.alias("m"))
    return sound.groupBy("lang", "source", "m.measure", "m.bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches added up over everything but ``keys``."""
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """``rows``, ``low`` and ``high`` of each measure by ``keys``; a group has some hundred buckets at most."""
    group = [*keys, "measure"]
    listed = sketch.groupBy(*group).agg(
        F.sum("n").alias("rows"), F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("b")
    )

    def at(percent: Column) -> Column:
        """The first bucket at which ``percent`` of the rows are reached."""
        return F.aggregate(
            "b",
            F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("found")),
            lambda a, x: F.struct(
                (a["seen"] + x["n"]).alias("seen"),
                F.when(a["found"].isNotNull(), a["found"])
                .when(100 * (a["seen"] + x["n"]) >= percent * F.col("rows"), x["bucket"])
                .alias("found"),
            ),
            lambda a: a["found"],
        )

    return listed.select(*group, "rows", at(_rule(0)).alias("low"), at(_rule(1)).alias("high"))


def _rule(part: int) -> Column:
    """A number of the rule of each row's measure."""
    return F.element_at(F.create_map(*[F.lit(x) for m in MEASURES for x in (m, RULES[m][part])]), F.col("measure"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row for every language and source of the sketch, with a bound for each measure."""

    def bounds(keys: list[str], name: str) -> DataFrame:
        found = quantiles(merged(sketch, keys), keys)
        limit = F.col("high") + WIDTH * F.greatest(F.col("high") - F.col("low"), _rule(2).cast("long"))
        return found.groupBy(*keys).agg(
            F.max("rows").alias(f"{name}_rows"),
            *[F.max(F.when(F.col("measure") == m, limit)).alias(f"{name}_{m}") for m in MEASURES],
        )

    def held(name: str, m: str, by: Column) -> Column:
        """A bound pulled toward the one above it."""
        rows = F.col(f"{name}_rows")
        return F.call_function("div", rows * F.col(f"{name}_{m}") + F.lit(HELD).cast("long") * by, rows + HELD)

    own = bounds(["lang", "source"], "own")
    lang = bounds(["lang"], "lang").withColumnRenamed("lang", "_lang")
    every = bounds([], "all").first()
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    return joined.select(
        F.col("lang").alias("_lang"),
        F.col("source").alias("_source"),
        *[held("own", m, held("lang", m, F.lit(every[f"all_{m}"]).cast("long"))).alias(f"max_{m}") for m in MEASURES],
    )


def judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Measured rows with ``kept``: joined with the thresholds of their group. Rows of unknown groups pass by default."""
    count = limits.limit(MAX_SENT_GROUPS + 1).count()
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    if count <= MAX_SENT_GROUPS:
        joined = rows.join(F.broadcast(limits), same, "left")
    else:
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)))
        spread = limits.withColumn("_salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
        joined = salted.join(spread, same & (F.col("_salt") == F.col("_salt2")), "left")
    rejected = F.col("q.base_failed")
    for m in MEASURES:
        rejected = rejected | F.coalesce(F.col(f"q.{m}") > F.col(f"max_{m}"), F.lit(False))
    return joined.select(*rows.columns, (~rejected).alias("kept"))


def quality_table(docs: DataFrame) -> DataFrame:
    """One row per document: counts, whether the base rules fail, and the verdict."""
    rows = written(measured(docs.select("doc_id", "lang", "source", "text")).withColumn("doc", F.struct("doc.doc_id")), "quality")
    limits = written(thresholds(sketches(rows)), "thresholds")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return judged(rows, limits).select("doc.doc_id", *[f"q.{n}" for n in names], "kept")


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns.

    The measured documents are written once, so that texts are measured once and never shuffled.
    """
    rows = written(measured(docs), "measured")
    limits = written(thresholds(sketches(rows)), "thresholds")
    return judged(rows, limits).filter("kept").select("doc.*")
