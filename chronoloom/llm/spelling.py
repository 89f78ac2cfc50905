"""Grouping of spelling variants: words at one inserted, deleted or replaced letter from each other, and the form each leads to.

Candidates come from a bit-sliced position index. For a list of words and each (position, letter) that occurs there, a bitset
says which words have the letter at the position. A query word is held against all of them at once: step by step along its letters,
64 words in each machine word, one set keeps the words without an error so far, and three sets those with one, by its kind:
a replaced letter (same positions), a letter more in the word (positions shifted up), a letter less (shifted down).
After the last letter the words of length m, m + 1 and m - 1 in these sets are just those at one error; nothing is verified later.

So that the work grows with the vocabulary and not with its square, an index is built for each *bucket*. One error leaves the first or
the last half (rounded down) of the shorter word as it is, so words are bucketed by those halves, for their own length and for one
letter less. Halves are hashed to buckets of about ``LETTERS`` letters by the length of the half; a bucket that a frequent half
makes larger is cut into parts, each indexed by itself and met by all parts as queries. A pair counts in the one bucket of the half that its
words share, the first half if they share both, so it counts once.

Counting words is one grouping with partial sums. Forms are followed to their roots by doubling steps, each written out.

Null and empty texts have no words. In rows without ``doc_id`` no letter is deleted. Repeated rows count as often as they occur. Ties between near
words go to the smallest in code-point order. An empty table gives no rows. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.common import lower_ascii, written
from chronoloom.llm.ranking import looked_up

RUN = "[a-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
DELETED = 97
#: A form occurs at least this many times as often as the word.
TIMES = 2
#: Letters in an index, about, and words of bits worked on at a time.
LETTERS = 1 << 15
TOGETHER = 1 << 16
FOUND = "word string, n_near bigint, near string, near_n bigint"


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n, length`` of the words to be grouped."""
    runs = docs.select(
        F.col("doc_id").cast("bigint").cast("string").alias("doc_id"),
        F.explode(F.regexp_extract_all(lower_ascii(F.col("text").cast("string")), F.lit(RUN), F.lit(0))).alias("run"),
    )
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % DELETED == 0, less).otherwise(F.col("run")).alias("word"))
    counts = words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= LEAST_COUNT).withColumn("length", F.length("word"))


class Index:
    """Bitsets by position and letter over some words."""

    def __init__(self, words: list[str]):
        self.lengths, letters, places = _letters(words)
        self.width = -(-len(words) // 64)
        self.alphabet = np.unique(letters)
        self.size = len(self.alphabet) + 1
        codes = np.searchsorted(self.alphabet, letters)
        owner = np.repeat(np.arange(len(words)), self.lengths)
        self.keys, rows = np.unique(places * self.size + codes, return_inverse=True)
        # One row more than there are keys: the empty set, for what occurs nowhere.
        self.sets = np.zeros((len(self.keys) + 1, self.width), np.uint64)
        np.bitwise_or.at(self.sets, (rows, owner >> 6), np.uint64(1) << (owner & 63).astype(np.uint64))

    def of_length(self, length: int) -> np.ndarray:
        bits = np.zeros(self.width * 64, bool)
        bits[: len(self.lengths)] = self.lengths == length
        return np.packbits(bits, bitorder="little").view("<u8").astype(np.uint64)

    def codes(self, letters: np.ndarray) -> np.ndarray:
        """Numbers of letters; the last number stands for letters that no word here has."""
        at = np.searchsorted(self.alphabet, letters)
        known = self.alphabet[np.minimum(at, self.size - 2)] == letters
        return np.where(known, at, self.size - 1)

    def having(self, place: int, codes: np.ndarray) -> np.ndarray:
        """For each query the words that have its letter at a position."""
        keys = place * self.size + codes
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.sets[np.where(self.keys[at] == keys, at, len(self.keys))]

    def near(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of queries, rows of letters, and of the words at exactly one error from them."""
        n, m = letters.shape
        codes = self.codes(letters)
        same = np.full((n, self.width), np.uint64(0xFFFFFFFFFFFFFFFF))
        replaced, fewer, more = np.zeros_like(same), np.zeros_like(same), same.copy()
        for i in range(m):
            here = self.having(i, codes[:, i])
            replaced = replaced & here | same & ~here
            fewer = fewer & self.having(i - 1, codes[:, i]) | same if i else same.copy()
            same = same & here
            more = more & self.having(i + 1, codes[:, i]) | same
        found = replaced & self.of_length(m) | more & self.of_length(m + 1) | fewer & self.of_length(m - 1)
        query, part = np.nonzero(found)
        bits = np.unpackbits(found[query, part].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, bit = np.nonzero(bits)
        return query[which], part[which] * 64 + bit


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of words, their letters end to end, and the position of each letter in its word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    return lengths, letters, np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _pairs(queries: pd.DataFrame, targets: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of queries and targets that are near and count in the half they were bucketed by."""
    index = Index(targets["word"].tolist())
    lengths, letters, _ = _letters(queries["word"].tolist())
    starts = np.cumsum(lengths) - lengths
    query_words, target_words = queries["word"].tolist(), targets["word"].tolist()
    query_half, target_half = queries["half"].to_numpy(), targets["half"].to_numpy()
    last, size = queries["last"].to_numpy(), queries["size"].to_numpy()
    target_last, target_size = targets["last"].to_numpy(), targets["size"].to_numpy()
    for m in np.unique(lengths):
        some = np.flatnonzero(lengths == m)
        step = max(1, TOGETHER // max(index.width, int(m)))
        for at in range(0, len(some), step):
            rows = some[at : at + step]
            q, t = index.near(letters[starts[rows][:, None] + np.arange(m)])
            q = rows[q]
            right = (query_half[q] == target_half[t]) & (last[q] == target_last[t]) & (size[q] == target_size[t])
            right &= np.minimum(m, index.lengths[t]) // 2 == size[q]
            q, t = q[right], t[right]
            # The same half by its letters and not its hash alone; a pair that shares its first half counts there.
            counts = np.array([_counts(query_words[a], target_words[b], size[a], last[a]) for a, b in zip(q, t)], bool)
            yield q[counts], t[counts]


def _counts(a: str, b: str, size: int, last: bool) -> bool:
    first = a[:size] == b[:size]
    return a[-size:] == b[-size:] and not first if last else first


def _matched(rows: pd.DataFrame) -> pd.DataFrame:
    """Of each query word: how many near words count here, and the best of them."""
    queries = rows[rows["role"] != 1].reset_index(drop=True)
    targets = rows[rows["role"] != 0].reset_index(drop=True)
    found = [(np.zeros(0, object), np.zeros(0, np.int64), np.zeros(0, object), np.zeros(0, np.int64))]
    words, n = targets["word"].to_numpy(object), targets["n"].to_numpy()
    place = np.empty(len(words), np.int64)
    place[np.argsort(words, kind="stable")] = np.arange(len(words))
    asked = queries["word"].to_numpy(object)
    for q, t in _pairs(queries, targets) if len(queries) and len(targets) else ():
        order = np.lexsort((place[t], -n[t], q))
        q, t = q[order], t[order]
        those, first, times = np.unique(q, return_index=True, return_counts=True)
        found.append((asked[those], times, words[t[first]], n[t[first]]))
    columns = map(np.concatenate, zip(*found))
    # Strings stay objects: pandas' own string columns, put together, reach Arrow in chunks, which Spark refuses.
    return pd.DataFrame({name: pd.Series(c, dtype=c.dtype) for name, c in zip(("word", "n_near", "near", "near_n"), columns)})


def bucketed(words: DataFrame) -> DataFrame:
    """Rows of words for each half they may share, by ``bucket, part, against`` and their role there.

    ``role`` is 0 for a query, 1 for a word of the index and 2 for both.
    """
    total = words.agg(F.sum("length").alias("n")).first().n or 0
    sides = []
    for last in (False, True):
        for size in (F.floor(F.col("length") / 2), F.floor((F.col("length") - 1) / 2)):
            half = F.right("word", size) if last else F.left("word", size)
            sides.append(F.struct(F.lit(last).alias("last"), size.cast("int").alias("size"), F.xxhash64(half).alias("half")))
    # Words of odd length have both sizes equal; the lists are made distinct.
    rows = words.select("word", "n", "length", F.explode(F.array_distinct(F.array(*sides))).alias("s"))
    many = 1 + 4 * total // LETTERS
    # Long halves have buckets of their own, as an index has a row for each position.
    depth = F.length(F.bin(F.col("s.size").cast("bigint")))
    rows = rows.select(
        "word", "n", "length", "s.*", F.struct(depth.alias("depth"), F.pmod(F.xxhash64("s.last", "s.size", "s.half"), F.lit(many)).alias("nth")).alias("bucket")
    )
    sums = rows.groupBy("bucket").agg(F.sum("length").alias("letters"))
    parts = sums.select("bucket", F.ceil(F.col("letters") / (4 * LETTERS)).cast("int").alias("parts"))
    rows = looked_up(rows, written(parts, "buckets"), ["bucket"])
    own = F.pmod(F.xxhash64("word", "last", "size"), "parts").cast("int")
    rows = rows.withColumn("own", own)
    there = lambda part, against, role: F.struct(
        part.alias("part"), against.alias("against"), F.lit(role).cast("tinyint").alias("role")
    )
    places = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda j: F.when(j == F.col("own"), F.array(there(j, j, 2))).otherwise(
                F.array(there(F.col("own"), j, 1), there(j, F.col("own"), 0))
            ),
        )
    )
    return rows.select("bucket", F.explode(places).alias("p"), "word", "n", "last", "size", "half").select(
        "bucket", "p.*", "word", "n", "last", "size", "half"
    )


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, near, near_n``: how many words are near each word of ``word, n, length``, and the most frequent of them."""
    parts = bucketed(words).groupBy("bucket", "part", "against").applyInPandas(_matched, FOUND)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    sums = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return sums.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of rows ``word, form``: the last word that following forms leads to. Forms make no rings."""
    links = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        there = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if links.join(there.select("root"), "root", "left_semi").isEmpty():
            return links
        onward = links.join(there, "root", "left")
        links = written(onward.select("word", F.coalesce("further", "root").alias("root")), "forms")


def spelling_table(docs: DataFrame) -> DataFrame:
    """One row per word: its count, its near words' number, its form with its count, and the root its forms lead to."""
    words = written(vocabulary(docs), "vocabulary")
    near = near_words(words)
    fits = F.col("near_n") >= TIMES * F.col("n")
    rows = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("near")).alias("form"),
        F.when(fits, F.col("near_n")).alias("form_n"),
    )
    rows = written(rows, "variants")
    ends = roots(rows.filter(F.col("form").isNotNull()).select("word", "form"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
