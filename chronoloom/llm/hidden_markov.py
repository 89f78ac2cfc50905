"""Language-model scores by a hidden Markov model, beside a smoothed unigram.

Hidden states emit word *classes*: each of the ``COMMON`` most frequent words is a class of its own, as is the end of a
text, and other words share ``HASHED`` classes by a hash of their last three letters. Within a class a word has its
smoothed share of the class's count in training. The likelihood of a text under this model is exact: the scaled forward
recursion over its classes times the shares of its words.

Training is Baum-Welch. Every partition runs forward and backward over its documents and returns expected counts of
starts, steps and emissions; these are added up by an aggregation and only the sums, whose number is set by the model,
come to the driver. In training every ``STRETCH`` tokens of a text are a sequence of their own; scores run through the whole
text.

Texts are read once into *blocks*: distinct words, and each document as numbers of words. Counts of words are summed over
the whole corpus, joined back to the words of each block, and gathered by block, so what is shuffled is distinct words of
blocks, not tokens; a hot word is one row a block.

A null text has the end token alone. Rows without ``doc_id`` are held out. Repeated rows count and score as often as they
occur. Where training is empty every token is unknown.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.common import SPACES, written

STATES = 8
COMMON = 2000
HASHED = 1024
ROUNDS = 4
STRETCH = 256
#: Documents side by side in a recursion, and characters in a block.
TOGETHER = 1024
BLOCK_CHARS = 6_000_000
ALPHA = 0.1
#: Added to every expected count, so that nothing becomes impossible.
PRIOR = 0.01
SEED = 7
#: Stands for the end; no word holds a line break.
END = "\n"
CLASSES = COMMON + HASHED + 1

BLOCK = """block bigint, doc_ids array<bigint>, held array<boolean>, sizes array<int>, tokens binary, words array<string>,
    n array<int>, tails array<int>"""


def _block(ids: pa.Array, held: np.ndarray, texts: pa.Array) -> pa.RecordBatch:
    """One row: the documents of a block as numbers of words. Word 0 is the end."""
    texts = pc.ascii_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    for space in SPACES[1:]:
        texts = pc.replace_substring(texts, space, " ")
    cut = pc.split_pattern(texts, " ")
    coded = cut.flatten().dictionary_encode()
    some = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    number = np.where(some, np.cumsum(some), 0).astype(np.int32)[coded.indices.to_numpy()]
    owner = np.repeat(np.arange(len(texts)), np.diff(cut.offsets.to_numpy()))
    sizes = np.bincount(owner[number > 0], minlength=len(texts)) + 1
    tokens = np.zeros(int(sizes.sum()), np.int32)
    inside = np.ones(len(tokens), bool)
    inside[np.cumsum(sizes) - 1] = False
    tokens[inside] = number[number > 0]
    words = pa.concat_arrays([pa.array([END]), coded.dictionary.filter(pa.array(some)).cast(pa.string())])
    n = np.bincount(tokens[np.repeat(~held, sizes)], minlength=len(words))
    packed = zlib.compress(tokens.astype("<i4").reshape(-1, 1).view(np.uint8).T.tobytes(), 1)
    one = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values).cast(kind))
    columns = {
        "block": pa.array([uuid4().int >> 65], pa.int64()),
        "doc_ids": one(ids, pa.int64()),
        "held": one(held, pa.bool_()),
        "sizes": one(sizes, pa.int32()),
        "tokens": pa.array([packed], pa.binary()),
        "words": one(words, pa.string()),
        "n": one(n, pa.int32()),
        "tails": one(tails_of(words), pa.int32()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, size = [], 0

    def whole() -> pa.RecordBatch:
        ids, held, texts = (pa.concat_arrays(column) for column in zip(*parts))
        return _block(ids, held.to_numpy(zero_copy_only=False), texts)

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy().astype(np.int64))
        at = 0
        while at < len(ends):
            # As many documents as fit, one at least if the block is empty.
            room = BLOCK_CHARS - size + (int(ends[at - 1]) if at else 0)
            stop = max(int(np.searchsorted(ends, room, "right")), at if parts else at + 1)
            if stop > at:
                parts.append([batch.column(i).slice(at, stop - at) for i in range(3)])
                size += int(ends[stop - 1]) - (int(ends[at - 1]) if at else 0)
                at = stop
            if at < len(ends):
                yield whole()
                parts, size = [], 0
    if parts:
        yield whole()


def _tokens(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(raw.T).view("<i4").ravel()


def tails_of(words: pa.Array) -> np.ndarray:
    """Class that each word has if it is not a common one."""
    own = (CLASSES - 1 if w == END else COMMON + zlib.crc32(w[-3:].encode()) % HASHED for w in words.to_pylist())
    return np.fromiter(own, np.int32, len(words))


def classes_of(words: pa.Array, common: pa.Array, tails: np.ndarray) -> np.ndarray:
    """Class of each word."""
    place = pc.index_in(words, common)
    return np.where(place.is_valid().to_numpy(zero_copy_only=False), pc.fill_null(place, 0).to_numpy(), tails)


class Model:
    """Start, step and emission probabilities."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.start, self.step, self.emit = start, step, emit
        self.by_class = np.ascontiguousarray(emit.T)

    @classmethod
    def first(cls, counts: np.ndarray) -> Model:
        """States that tend to stay, with the corpus' emissions bent a little at random so that they can part."""
        random = np.random.default_rng(SEED)
        emit = (counts + PRIOR) * random.uniform(0.5, 1.5, (STATES, CLASSES))
        step = np.full((STATES, STATES), 0.05 / STATES) + 0.95 * np.eye(STATES)
        return cls(np.full(STATES, 1 / STATES), step / step.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    @classmethod
    def of(cls, sums: np.ndarray) -> Model:
        """The model that expected counts, laid end to end, call for."""
        start, step, emit = np.split(sums + PRIOR, [STATES, STATES + STATES * STATES])
        step, emit = step.reshape(STATES, STATES), emit.reshape(STATES, CLASSES)
        return cls(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def _together(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Documents of like length, some at a time, longest first."""
    order = np.argsort(-sizes, kind="stable")
    for at in range(0, len(order), TOGETHER):
        yield order[at : at + TOGETHER]


def _stretches(classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First place, classes by place and document, and which count; documents are longest first."""
    for first in range(0, int(sizes[0]), STRETCH):
        live = int(np.searchsorted(-sizes, -first, "left"))
        steps = np.arange(first, min(first + STRETCH, int(sizes[0])))
        there = steps[:, None] < sizes[None, :live]
        yield first, classes[np.where(there, starts[None, :live] + steps[:, None], 0)], there


def likelihood(model: Model, classes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log10 likelihood of each document's classes, by the scaled forward recursion."""
    starts, out = np.cumsum(sizes) - sizes, np.zeros(len(sizes))
    for some in _together(sizes):
        total, ahead = np.zeros(len(some)), np.tile(model.start, (len(some), 1))
        for _, seen, there in _stretches(classes, starts[some], sizes[some]):
            for symbols, mask in zip(seen, there):
                n = int(mask.sum())
                alpha = ahead[:n] * model.by_class[symbols[:n]]
                scale = alpha.sum(1)
                total[:n] += np.log10(scale)
                ahead[:n] = (alpha / scale[:, None]) @ model.step
        out[some] = total
    return out


def expected(model: Model, classes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Expected starts, steps and emissions, laid end to end; every ``STRETCH`` tokens of a text are a sequence."""
    parts = -(-sizes // STRETCH)
    first = np.repeat(np.cumsum(sizes) - sizes, parts)
    nth = np.arange(len(first)) - np.repeat(np.cumsum(parts) - parts, parts)
    starts, lengths = first + nth * STRETCH, np.minimum(np.repeat(sizes, parts) - nth * STRETCH, STRETCH)
    begun, step, emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, CLASSES))
    for some in _together(lengths):
        _, seen, there = next(_stretches(classes, starts[some], lengths[some]))
        length, live = seen.shape
        counts = there.sum(1)
        emitted = model.by_class[seen]
        alpha, scale = np.zeros((length, live, STATES)), np.ones((length, live, 1))
        ahead = np.tile(model.start, (live, 1))
        for t in range(length):
            n = counts[t]
            a = ahead[:n] * emitted[t, :n]
            scale[t, :n] = a.sum(1, keepdims=True)
            a /= scale[t, :n]
            alpha[t, :n] = a
            ahead = a @ model.step
        beta = np.ones((live, STATES))
        gamma = np.zeros((length, live, STATES))
        emitted /= scale
        for t in range(length - 1, -1, -1):
            n = counts[t]
            gamma[t, :n] = alpha[t, :n] * beta[:n]
            later = emitted[t, :n] * beta[:n]
            if t:
                step += model.step * (alpha[t - 1, :n].T @ later)
            beta[:n] = later @ model.step.T
        begun += gamma[0].sum(0)
        symbols = seen.ravel()
        for s in range(STATES):
            emit[s] += np.bincount(symbols, gamma[:, :, s].ravel(), CLASSES)
    return np.concatenate([begun, step.ravel(), emit.ravel()])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, pa.Array]]:
    """The lists of each row of a table of blocks."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(j).slice(i, 1) for j, name in enumerate(batch.schema.names)}
            yield {name: c.flatten() if pa.types.is_list(c.type) else c for name, c in row.items()}


def _numbers(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False)


def _counter(model: Model, common: pa.Array) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(STATES + STATES * STATES + STATES * CLASSES)
        for row in _rows(batches):
            kept, sizes = ~_numbers(row["held"]), _numbers(row["sizes"]).astype(np.int64)
            if kept.any():
                classes = classes_of(row["words"], common, _numbers(row["tails"]))[_tokens(row["tokens"][0].as_py())]
                total += expected(model, classes[np.repeat(kept, sizes)], sizes[kept])
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["place", "value"])

    return run


def trained(blocks: DataFrame, common: pa.Array, class_counts: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over the training documents of all blocks."""
    model = Model.first(class_counts)
    texts = blocks.select("tokens", "held", "sizes", "words", "tails")
    for _ in range(rounds):
        counts = texts.mapInArrow(_counter(model, common), "place bigint, value double")
        sums = np.zeros(STATES + STATES * STATES + STATES * CLASSES)
        found = counts.groupBy("place").agg(F.sum("value").alias("value")).toPandas()
        sums[found["place"].to_numpy()] = found["value"].to_numpy()
        model = Model.of(sums)
    return model


def _scorer(model: Model, common: pa.Array, total: int, distinct: int, sums: np.ndarray, kinds: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            sizes, tokens = _numbers(row["sizes"]).astype(np.int64), _tokens(row["tokens"][0].as_py())
            classes = classes_of(row["words"], common, _numbers(row["tails"]))
            count = np.zeros(len(classes))
            count[_numbers(row["places"])] = _numbers(row["counts"])
            base = np.log10((count + ALPHA) / (total + ALPHA * (distinct + 1)))
            share = np.log10((count + ALPHA) / (sums[classes] + ALPHA * (kinds[classes] + 1)))
            share[(classes < COMMON) | (classes == CLASSES - 1)] = 0
            first = np.cumsum(sizes) - sizes
            add = lambda by_word: np.add.reduceat(by_word[tokens], first)
            columns = {
                "doc_id": row["doc_ids"],
                "held_out": row["held"],
                "n_tokens": pa.array(sizes),
                "n_known": pa.array(add((count > 0).astype(np.int64))),
                "train_tokens": pa.array(np.full(len(sizes), total, np.int64)),
                "base_score": pa.array(add(base)),
                "score": pa.array(likelihood(model, classes[tokens], sizes) + add(share)),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


SCORES = "doc_id bigint, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def class_sums(counts: DataFrame, common: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Training count and number of distinct words of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes = classes_of(batch.column(0), common, tails_of(batch.column(0)))
            sums, kinds = np.bincount(classes, _numbers(batch.column(1)), CLASSES), np.bincount(classes, minlength=CLASSES)
            found = np.flatnonzero(kinds)
            columns = [pa.array(found, pa.int32()), pa.array(sums[found].astype(np.int64)), pa.array(kinds[found])]
            yield pa.RecordBatch.from_arrays(columns, ["k", "c", "v"])

    rows = counts.select("word", "c").mapInArrow(run, "k int, c bigint, v bigint")
    found = rows.groupBy("k").agg(F.sum("c").alias("c"), F.sum("v").alias("v")).toPandas()
    sums, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    sums[found["k"]], kinds[found["k"]] = found["c"], found["v"]
    return sums, kinds


def score_table(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: its tokens, those known from training, and both log10 scores."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(True))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held.alias("held"), F.col("text").cast("string").alias("text"))
    blocks = written(rows.mapInArrow(_blocks, BLOCK), "blocks")
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("words", "n")).alias("place", "w"))
    counts = pairs.filter("w.n > 0").groupBy(F.col("w.words").alias("word")).agg(F.sum("w.n").alias("c"))
    counts = written(counts, "counts")
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = counts.filter(F.col("word") != END).orderBy(F.col("c").desc(), "word").limit(COMMON).collect()
    common = pa.array([row["word"] for row in top], pa.string())
    sums, kinds = class_sums(counts, common)
    model = trained(blocks, common, sums, rounds)
    known = pairs.select("block", "place", F.col("w.words").alias("word")).join(counts, "word")
    known = known.groupBy("block").agg(F.collect_list("place").alias("places"), F.collect_list("c").alias("counts"))
    joined = blocks.select("block", "doc_ids", "held", "sizes", "tokens", "words", "tails").join(known, "block", "left")
    joined = joined.withColumn("places", F.coalesce("places", F.array().cast("array<int>")))
    joined = joined.withColumn("counts", F.coalesce("counts", F.array().cast("array<bigint>")))
    return joined.drop("block").mapInArrow(_scorer(model, common, int(total["n"] or 0), int(total["v"]), sums, kinds), SCORES)
