"""Secret scans with an incremental ledger of blobs.

Every version of a document is addressed by the SHA-256 of its text. The ledger holds the pairs (blob, rule version) that
were scanned and what was found. A run scans only blobs that the ledger lacks for the present rules, one copy of each, and
joins the findings back to every path that has the blob. Copies and later runs over the same history so cost a hash and a
join, and new rules rescan each blob once. A run appends to the ledger as its last step, by one write of its own folder,
so a lost run leaves nothing half known.

Kinds, in order: ``assign``, ``access`` and ``hex`` as the base, found leftmost and without overlaps for each kind; then
``pem`` (private key blocks), ``jwt`` (signed web tokens), ``prefix`` (tokens that issuers mark by a prefix) and ``userinfo``
(passwords in addresses). Spans are in code points, end exclusive.

A ``pem`` span runs from its BEGIN line to the next END line, whatever lies between, unless another BEGIN line comes first.
Without an END line it takes the header lines and base64 that follow: tokens of 16 signs or more, or with padding, between
spaces or escaped line breaks.

A null text is the empty text. Rows without ``doc_id`` and repeated rows are scanned and get a row each. Texts of any
length are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.llm.common import MAX_SENT_IDS, columns_of, packed, scratch, small_batches, written

RULES = "3"
SPAN = "array<struct<start: int, kind: int, end: int>>"
# The kinds in order, the base patterns and their least lengths.
KINDS = ["assign", "access", "hex", "pem", "jwt", "prefix", "userinfo"]
BASE_KINDS = 3
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
LEAST_VALUE = 6
PATTERNS = [
    (1, re.compile(r"AKIA[A-Z0-9]{16,}")),
    (2, re.compile(r"[0-9a-f]{24,}")),
    (4, re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    (5, re.compile(r"(?:gh[opsur]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})")),
    (6, re.compile(r"(?<=://)[^\s:/@]*+:[^\s:/@]{6,}+(?=@)")),
]

PEM = 3
EDGE = re.compile(r"-----(BEGIN|END) [A-Z ]{0,30}PRIVATE KEY-----")
BREAK = r"(?:\s|\\[nrt])++"
BODY = re.compile(rf"(?:{BREAK}[A-Za-z-]++:\x20[^\n\\]*+)*+(?:{BREAK}(?:[A-Za-z0-9+/]{{16,}}+=*+|[A-Za-z0-9+/]++=++))*+")


def _keys(text: str) -> list[tuple[int, int, int]]:
    """Private key blocks; work grows with the length of the text however many edges it holds."""
    edges = list(EDGE.finditer(text))
    found = []
    for edge, after in zip(edges, [*edges[1:], None]):
        if edge.group(1) == "BEGIN":
            closed = after is not None and after.group(1) == "END"
            found.append((edge.start(), PEM, after.end() if closed else BODY.match(text, edge.end()).end()))
    return found


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all findings, in order.

    The length bounds of ``access`` and ``hex`` stand in the patterns: a run that is too short holds no longer one. A value
    of an assignment that is too short still takes its place, so that is tested afterwards.
    """
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(1)) >= LEAST_VALUE]
    for kind, pattern in PATTERNS:
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
    return sorted(found + _keys(text))


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        spans = [[dict(zip(("start", "kind", "end"), s)) for s in spans_of(t or "")] for t in batch["text"]]
        yield pd.DataFrame({"blob": batch["blob"], "spans": spans})


def _text() -> F.Column:
    return F.coalesce(F.col("text"), F.lit(""))


def paths(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the address of its text."""
    return docs.select("doc_id", F.sha2(_text(), 256).alias("blob"))


def _ledger(spark: SparkSession, ledger: str) -> DataFrame:
    schema = f"blob string, spans {SPAN}, rules string"
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(ledger)
    if path.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(path.suffix("/run=*")):
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(ledger)
    return spark.createDataFrame([], schema)


def scan(docs: DataFrame, ledger: str) -> DataFrame:
    """Scan what the ledger lacks, note it there, and return ``doc_id``, ``blob`` and ``spans`` of every row."""
    spark = docs.sparkSession
    seen = _ledger(spark, ledger).filter(F.col("rules") == RULES)
    here = written(paths(docs), "paths")
    blobs = here.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
    new = written(blobs.join(seen.select("blob"), "blob", "left_anti"), "unseen")
    texts = _only(docs, here, new)
    # A blob may come twice if rows repeat its path; findings are equal, so any will do.
    once = texts.mapInPandas(_scan, f"blob string, spans {SPAN}").groupBy("blob").agg(F.max("spans").alias("spans"))
    run = scratch(spark, "run").rpartition("/")[2].removeprefix("run-")
    with small_batches(spark):
        once.withColumn("rules", F.lit(RULES)).write.parquet(f"{ledger}/run={run}")
    known = _ledger(spark, ledger).filter((F.col("rules") == RULES) & (F.size("spans") > 0)).select("blob", "spans")
    # Two runs at a time may both scan a blob.
    known = known.groupBy("blob").agg(F.max("spans").alias("spans"))
    joined = here.join(known, "blob", "left")
    return joined.select("doc_id", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))


def _only(docs: DataFrame, here: DataFrame, new: DataFrame) -> DataFrame:
    """Texts of the unseen blobs, one path each; rows without a path for blobs that no other row has.

    The smaller of both sides, the pairs to scan or the pairs to leave out, is sent to the executors if it is small
    enough; else texts are shuffled once by path and blob.
    """
    rows = docs.select("doc_id", F.sha2(_text(), 256).alias("blob"), _text().alias("text"))
    wanted = new.filter("doc_id IS NOT NULL").select("doc_id", "blob")
    rest = here.filter("doc_id IS NOT NULL").select("doc_id", "blob").distinct()
    rest = written(rest.join(wanted, ["doc_id", "blob"], "left_anti"), "known")
    limit = MAX_SENT_IDS // 8  # an address is 64 bytes
    named = rows.filter("doc_id IS NOT NULL")
    if rest.limit(limit + 1).count() <= limit:
        texts = named.join(F.broadcast(rest), ["doc_id", "blob"], "left_anti")
    else:
        few = wanted.limit(limit + 1).count() <= limit
        texts = named.join(F.broadcast(wanted) if few else wanted, ["doc_id", "blob"], "left_semi")
    if here.filter("doc_id IS NULL").isEmpty():
        return texts
    nameless = rows.filter("doc_id IS NULL").join(new.filter("doc_id IS NULL").select("blob"), "blob", "left_semi")
    return texts.unionByName(nameless)


def _listed(spans: F.Column) -> F.Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def secrets_table(docs: DataFrame, ledger: str) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of their spans, and all spans as text."""
    rows = scan(docs, ledger)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < BASE_KINDS)
    return rows.select(
        "doc_id",
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(BASE_KINDS)],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


MARK = "[secret]"


@F.pandas_udf(T.StringType())
def masked(text: pd.Series, spans: pd.Series) -> pd.Series:
    """The text with every span, or run of overlapping spans, replaced by a mark."""
    out = []
    for whole, found in zip(text, spans):
        if found is None or not len(found):
            out.append(whole)
            continue
        parts, at = [], 0
        for span in found:
            if span["start"] >= at:
                parts += [whole[at : span["start"]], MARK]
            at = max(at, span["end"])
        out.append("".join([*parts, whole[at:]]))
    return pd.Series(out, dtype="object")


def redacted(docs: DataFrame, ledger: str) -> DataFrame:
    """All documents, with secrets masked in ``text`` and ``n_chars`` set anew where the text changed."""
    found = scan(docs, ledger).filter(F.size("spans") > 0).groupBy("blob").agg(F.max("spans").alias("spans"))
    found = written(found, "findings")
    limit = MAX_SENT_IDS // 16
    found = F.broadcast(found) if found.limit(limit + 1).count() <= limit else found
    rows = docs.select(packed(docs), F.sha2(_text(), 256).alias("blob")).join(found, "blob", "left")
    changed = F.col("spans").isNotNull()
    # Every row goes to the Python worker; only texts that change go with it.
    text = F.when(changed, masked(F.when(changed, F.col("doc.text")), F.col("spans"))).otherwise(F.col("doc.text"))
    rows = rows.select("doc", changed.alias("changed"), text.alias("clean"))
    columns = []
    for name, column in zip(docs.columns, columns_of(docs.select("*"))):
        value = F.col("doc").getField(name)
        if name == "text":
            value = F.col("clean")
        elif name == "n_chars":
            value = F.when(F.col("changed"), F.length("clean")).otherwise(value).cast(docs.schema[name].dataType)
        columns.append(value.alias(name))
    return rows.select(*columns)
