"""URL filter: host and path rules first, then a logistic regression on hashed character n-grams of host and path.

The regression is trained from a small labelled table of URLs. Without one, the URLs that rules decide are the labels: at
most ``MAX_LABELLED`` different (host, path) pairs, those with the least hash, so the choice is even and repeatable. All
URLs are scored, on the JVM and without a shuffle.

A null URL, or one without ``://``, has an empty host and path; no rule fits it and the model judges it. If the labels
hold one verdict only, that is the model's verdict; without any label it allows. Repeated rows get equal verdicts.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.common import let, lower_ascii, packed, written

MAX_LABELLED = 20_000
FEATURES = 1 << 16
SIZES = (2, 3, 4)
Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A to Z in lower case, and path of a URL; empty strings where it has none."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none does.

    A rule ``(host, path, verdict)`` fits its host and all subdomains, for paths that start with its path.
    """
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _grams(text: Column, mark: str) -> list[Column]:
    """Arrays of n-grams of a text with its ends marked; one for each size. The text is cut into characters once."""
    ends = F.concat(F.lit("\x02"), text, F.lit("\x03"))

    def of(size: int) -> Column:
        def joined(signs: Column) -> Column:
            starts = F.sequence(F.lit(1), F.greatest(F.size(signs) - size + 1, F.lit(1)))
            return F.transform(starts, lambda i: F.concat(F.lit(f"{mark}{size}"), *[F.coalesce(F.get(signs, i + k), F.lit("")) for k in range(-1, size - 1)]))

        return let(F.split(ends, ""), joined)

    return [of(size) for size in SIZES]


def featured(rows: DataFrame) -> DataFrame:
    """Rows with ``features``, a sparse vector of the n-grams of ``host`` and ``path``."""
    grams = F.array_distinct(F.concat(*_grams(F.col("host"), "h"), *_grams(F.col("path"), "p")))
    hashing = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
    return hashing.transform(rows.withColumn("grams", grams)).drop("grams")


def judged(pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None) -> DataFrame:
    """``doc`` (all columns), ``host``, ``path``, ``rule`` and ``verdict`` of each row.

    ``labelled`` has ``host``, ``path`` and ``verdict`` (allow or block).
    """
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(packed(pages), host.alias("host"), path.alias("path"))
    name, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.select("doc", "host", "path", name.alias("rule"), verdict.alias("ruled"))
    if labelled is None:
        labelled = rows.filter("ruled IS NOT NULL").select("host", "path", F.col("ruled").alias("verdict"))
    sample = labelled.distinct().orderBy(F.xxhash64("host", "path"), "host", "path", "verdict").limit(MAX_LABELLED)
    sample = written(sample.withColumn("label", F.when(F.col("verdict") == "block", 1.0).otherwise(0.0)), "labelled")
    kinds = sorted(r["label"] for r in sample.select("label").distinct().collect())
    if len(kinds) < 2:
        guess = F.lit("block" if kinds == [1.0] else "allow")
        scored = rows.withColumn("guess", guess)
    else:
        counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
        weight = F.when(F.col("label") == 1.0, sum(counts.values()) / counts[1.0] / 2).otherwise(
            sum(counts.values()) / counts[0.0] / 2
        )
        model = LogisticRegression(maxIter=40, regParam=1e-3, weightCol="weight").fit(
            featured(sample.withColumn("weight", weight).coalesce(4))
        )
        scored = model.transform(featured(rows))
        scored = scored.withColumn("guess", F.when(F.col("prediction") == 1.0, "block").otherwise("allow"))
    return scored.select("doc", "host", "path", "rule", F.coalesce("ruled", "guess").alias("verdict"))


def url_table(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per page: host, path, rule and verdict."""
    return judged(pages.select("page_id", "url"), rules).select("doc.page_id", "host", "path", "rule", "verdict")
