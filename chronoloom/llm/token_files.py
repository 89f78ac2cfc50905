"""Token files: ids in a canonical, length-limited Huffman code.

Texts are encoded by a public tokenizer, an end id is added to each, and the ids of all documents are written in ascending
``doc_id`` order. Code lengths come from the counts of ids over the whole corpus by the package-merge method, at most
``MAX_BITS`` bits long; codes are canonical, so a file holds lengths only. The vocabulary bounds what comes to the driver.

A file is: magic, header length, header (JSON), then the sections the header names: code lengths, document ids, ids by
document, checkpoints and the bit stream. The stream is cut into *blocks* of ``BLOCK_IDS`` ids; a checkpoint is the bit
offset at which a block starts, so any block can be decoded by itself. Decoding looks ``MAX_BITS`` bits up in a table; the
blocks of a run of documents are decoded side by side, one id of each at a time.

Between the steps the ids of a document are one binary value, big-endian and as wide as the vocabulary asks for, so that Spark
handles a value and not each id, and values sort as the lists of ids do.

Tasks write files under names of their own and report them; only reported files are read, so files of lost tasks do no
harm. A null text is empty and has the end id alone. Rows that repeat a ``doc_id`` stay next to each other, in the order of
their ids; null comes first.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.llm.common import scratch, small_batches, written
from chronoloom.llm.files import open_in, open_out

MAGIC = b"IDHUF001"
MAX_BITS = 20
BLOCK_IDS = 1024
#: Ids packed or decoded at a time, a number of whole blocks, and ids in a file.
RUN_IDS = 1 << 18
FILE_IDS = 1 << 24
#: Words kept with their ids by a worker, the longest of them, words put together for the library, and bytes of text encoded at a time.
MAX_KEPT = 600_000
KEPT_CHARS = 64
TOGETHER = 128
RUN_BYTES = 4_000_000
IDS = pa.large_list(pa.int32())
#: Letters that are one word to the tokenizer, and with signs after them that are another; an apostrophe may be a part of a word.
LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+"
LETTERS_SIGNS = LETTERS + "[!-&(-/:-@\\[-`{-~]*$"


# Encoding


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids of texts by a tokenizer that drops white space, so that stretches between spaces can be encoded by themselves.

    Texts are split, their stretches numbered and ids gathered by Arrow. Where the tokenizer sees letters and signs apart and
    marks the ends of words, a stretch of letters, perhaps with signs after them, is a word and its signs; words go to the library
    many in a text, are told apart by their marks, and are kept, up to ``MAX_KEPT`` of them, for later texts. All other stretches
    go to the library as they are.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        # Ids that end a word; none if the model does not mark words' ends.
        mark = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for piece, i in vocabulary.items() if mark and piece.endswith(mark)]] = True
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], IDS)

    def _library(self, texts: list[str]) -> pa.LargeListArray:
        """Ids of each text by itself."""
        sizes, flat = [np.zeros(1, np.int64)], [np.zeros(0, np.int32)]
        for at in range(0, len(texts), 10_000):
            ids = [one.ids for one in self.tokenizer.encode_batch_fast(texts[at : at + 10_000], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), np.int32, int(sizes[-1].sum())))
        return pa.LargeListArray.from_arrays(pa.array(np.cumsum(np.concatenate(sizes))), pa.array(np.concatenate(flat)))

    def _of_words(self, words: pa.Array) -> pa.LargeListArray:
        """Ids of distinct words of nothing but letters."""
        place = pc.index_in(words, self.words)
        unknown = pc.is_null(place)
        new = words.filter(unknown)
        listed = new.to_pylist()
        flat = self._library([" ".join(listed[i : i + TOGETHER]) for i in range(0, len(listed), TOGETHER)]).flatten()
        ends = np.flatnonzero(self.last[flat.to_numpy()]) + 1
        if len(ends) != len(new):
            raise ValueError("the tokenizer does not mark the ends of words as expected")
        ids = pa.LargeListArray.from_arrays(pa.array(np.r_[0, ends]), flat)
        # Those to be kept come first.
        short = pc.less_equal(pc.utf8_length(new), KEPT_CHARS).to_numpy(zero_copy_only=False)
        order = pa.array(np.argsort(~short, kind="stable"))
        every = pa.concat_arrays([self.ids, ids.take(order)])
        number = pc.fill_null(place, 0).to_numpy().astype(np.int64)
        number[np.flatnonzero(unknown.to_numpy(zero_copy_only=False))[order.to_numpy()]] = len(self.words) + np.arange(len(new))
        found = every.take(pa.array(number))
        if len(self.words) + len(new) <= MAX_KEPT:
            n = int(np.count_nonzero(short))
            self.words = pa.concat_arrays([self.words, new.take(order[:n])])
            self.ids = every[: len(self.words)]
        else:
            self.words, self.ids = pa.array([], pa.large_string()), pa.array([], IDS)
        return found

    def encode(self, texts: pa.Array, end: int) -> pa.LargeListArray:
        """Ids of each text and the end id."""
        cut = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "), " ")
        coded = cut.flatten().dictionary_encode()
        plain = pc.and_(pc.match_substring_regex(coded.dictionary, LETTERS_SIGNS), bool(self.last.any()))
        parts = pc.extract_regex(coded.dictionary.filter(plain), f"(?P<word>{LETTERS})(?P<signs>.*)")
        # The tokenizer lower-cases; doing so here for A to Z makes fewer words.
        words = pc.ascii_lower(parts.field("word")).dictionary_encode()
        signs = parts.field("signs").dictionary_encode()
        known = self._of_words(words.dictionary)
        after, others = self._library(signs.dictionary.to_pylist()), self._library(coded.dictionary.filter(pc.invert(plain)).to_pylist())
        units = pa.concat_arrays([known, after, others, pa.array([[]], IDS)])
        # Each stretch is two units: its word and its signs, or what the library made of it and nothing.
        here = plain.to_numpy(zero_copy_only=False)
        both = np.full((len(here), 2), len(units) - 1, np.int64)
        both[here, 0] = words.indices.to_numpy()
        both[here, 1] = len(known) + signs.indices.to_numpy()
        both[~here, 0] = len(known) + len(after) + np.arange(len(others))
        found = units.take(pa.array(both[coded.indices.to_numpy()].ravel()))
        ends = found.offsets.to_numpy()[2 * (cut.offsets.to_numpy() - cut.offsets[0].as_py())]
        ends = ends - ends[0] + np.arange(len(ends))
        out = np.full(int(ends[-1]), end, np.int32)
        inside = np.ones(len(out), bool)
        inside[ends[1:] - 1] = False
        out[inside] = found.flatten().to_numpy()
        return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(out))


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One for each Python worker, whatever tasks it is given."""
    return Encoder(path)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts of the documents, about ``RUN_BYTES`` of text at a time, whatever batches they come in.

    What the encoder does for a call grows with the words it keeps, so calls should be few.
    """
    held, size = [], 0

    def run() -> tuple[pa.Array, pa.Array]:
        return tuple(pa.concat_arrays(columns) for columns in zip(*held))

    for batch in batches:
        texts = pc.fill_null(batch.column(1), "").cast(pa.large_string())
        ends, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
        while at < len(texts):
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + RUN_BYTES - size, "right")))
            held.append((batch.column(0).slice(at, stop - at), texts.slice(at, stop - at)))
            size, at = size + int(ends[stop - 1]) - before, stop
            if at < len(texts) or size >= RUN_BYTES:
                yield run()
                held, size = [], 0
    if held:
        yield run()


def _packed(ids: pa.LargeListArray, kind: str) -> pa.Array:
    """The ids of each document as one binary value, each id as ``kind`` says."""
    values = ids.flatten().to_numpy().astype(kind)
    offsets = (ids.offsets.to_numpy() - ids.offsets[0].as_py()) * values.itemsize
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(values.view(np.uint8))]
    return pa.Array.from_buffers(pa.large_binary(), len(ids), buffers).cast(pa.binary())


def _values(ids: pa.Array, kind: str | None) -> tuple[np.ndarray, np.ndarray]:
    """All ids of some documents, and where those of each end; lists of ids, or, with a kind, packed ones."""
    ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1] if len(ids) else np.zeros(1, np.int32)
    if kind is None:
        return ids.flatten().to_numpy(zero_copy_only=False), ends[1:] - ends[0]
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(ids.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return raw.view(kind).astype(np.int32), (ends[1:] - ends[0]) // width


def kind_of(tokenizer_path: str, end: int) -> str:
    """The least kind of number that holds all ids of a tokenizer file; big-endian, so that bytes sort as numbers do."""
    with open(tokenizer_path, encoding="utf-8") as file:
        known = json.load(file)
    pieces = known["model"]["vocab"]
    ids = pieces.values() if isinstance(pieces, dict) else range(len(pieces))
    return ">u2" if max([end, *ids, *(t["id"] for t in known["added_tokens"])]) < 1 << 16 else ">u4"


def _encode(path: str, end: int, kind: str | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for doc_ids, texts in _runs(batches):
            ids = encoder.encode(texts, end)
            ids = ids.cast(pa.list_(pa.int32())) if kind is None else _packed(ids, kind)
            yield pa.RecordBatch.from_arrays([doc_ids, ids], ["doc_id", "ids"])

    return run


def encoded(docs: DataFrame, tokenizer_path: str, end: int, kind: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids``, the end id included; with a kind, ids are packed into one binary value."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = "array<int>" if kind is None else "binary"
    return rows.mapInArrow(_encode(tokenizer_path, end, kind), f"doc_id bigint, ids {ids}")


# The code


def _counter(kind: str | None) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            some = np.bincount(_values(batch.column(0), kind)[0])
            if len(some) > len(total):
                total = np.concatenate([total, np.zeros(len(some) - len(total), np.int64)])
            total[: len(some)] += some
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], ["id", "n"])

    return count


def lengths_of(counts: np.ndarray) -> np.ndarray:
    """Code length of every id with a count, by package-merge; 0 for the others."""
    found = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(found) < 2:
        lengths[found] = 1
        return lengths
    if len(found) > 1 << MAX_BITS:
        raise ValueError("more ids than codes")
    order = found[np.argsort(counts[found], kind="stable")]
    coins = counts[order].astype(np.int64)
    packages, leaves = np.zeros(0, np.int64), []
    for _ in range(MAX_BITS):
        both = np.concatenate([coins, packages])
        by_weight = np.argsort(both, kind="stable")
        leaves.append(by_weight < len(coins))
        both = both[by_weight]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    taken = 2 * len(coins) - 2
    for level in reversed(leaves):
        n = int(level[:taken].sum())
        lengths[order[:n]] += 1
        taken = 2 * (taken - n)
    return lengths


def codes_of(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes: by length, then by id."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    shares = np.uint64(1) << (MAX_BITS - lengths[order].astype(np.int64)).astype(np.uint64)
    starts = np.cumsum(shares) - shares
    codes[order] = starts >> (MAX_BITS - lengths[order].astype(np.int64)).astype(np.uint64)
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit stream and the bit offset of each block."""
    size = lengths[ids].astype(np.int64)
    offset = np.cumsum(size) - size
    total = int(size.sum())
    word, shift = offset >> 6, 64 - (offset & 63) - size
    code = codes[ids]
    left = np.where(shift >= 0, code << np.maximum(shift, 0).astype(np.uint64), code >> np.maximum(-shift, 0).astype(np.uint64))
    over = np.where(shift < 0, code << np.where(shift < 0, 64 + shift, 0).astype(np.uint64), np.uint64(0))
    out = np.zeros((total >> 6) + 2, np.uint64)
    if len(ids):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        out[word[first]] |= np.bitwise_or.reduceat(left, first)
        out[word[first] + 1] |= np.bitwise_or.reduceat(over, first)
    return out.astype(">u8").tobytes(), offset[::BLOCK_IDS]


@lru_cache(maxsize=2)
def _decoder(packed_lengths: bytes) -> tuple[np.ndarray, np.ndarray]:
    """By the next ``MAX_BITS`` bits: the id and the length of its code."""
    lengths = np.frombuffer(zlib.decompress(packed_lengths), np.uint8)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    shares = 1 << (MAX_BITS - lengths[order].astype(np.int64))
    ids, sizes = np.zeros(1 << MAX_BITS, np.int32), np.ones(1 << MAX_BITS, np.uint8)
    total = int(shares.sum())
    ids[:total], sizes[:total] = np.repeat(order, shares), np.repeat(lengths[order], shares)
    return ids, sizes


def unpack(stream: bytes, offsets: np.ndarray, count: int, packed_lengths: bytes) -> np.ndarray:
    """Ids of blocks that start at these bit offsets of a stream; ``count`` ids in all, full blocks but for the last."""
    ids, sizes = _decoder(packed_lengths)
    raw = np.frombuffer(stream + b"\0" * 8, np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    out = np.zeros((min(BLOCK_IDS, count), len(offsets)), np.int32)
    at = offsets.astype(np.int64)
    last = len(window) - 1
    for i in range(len(out)):
        bits = window[np.minimum(at >> 3, last)] >> (32 - MAX_BITS - (at & 7)).astype(np.uint32)
        bits &= (1 << MAX_BITS) - 1
        out[i] = ids[bits]
        at += sizes[bits]
    return out.T.ravel()[:count] if len(offsets) == 1 else out.T.reshape(-1)[:count]


# Files


def _write_file(path: str, doc_ids: list[int | None], docs: list[np.ndarray], packed_lengths: bytes, codes: tuple) -> None:
    lengths, words = codes
    ids = np.concatenate(docs)
    streams, offsets, at = [], [], 0
    for first in range(0, len(ids), RUN_IDS):
        stream, starts = pack(ids[first : first + RUN_IDS], lengths, words)
        streams.append(stream)
        offsets.append(starts + 8 * at)
        at += len(stream)
    stream, offsets = b"".join(streams), np.concatenate(offsets)
    numbers = np.array([0 if d is None else d for d in doc_ids], "<i8")
    sections = {
        "lengths": packed_lengths,
        "doc_ids": numbers.tobytes(),
        "nulls": np.packbits([d is None for d in doc_ids]).tobytes(),
        "sizes": np.array([len(d) for d in docs], "<i8").tobytes(),
        "offsets": offsets.astype("<i8").tobytes(),
        "stream": stream,
    }
    header = json.dumps({"docs": len(docs), "ids": len(ids), "sections": {k: len(v) for k, v in sections.items()}}).encode()
    with open_out(path) as out:
        out.write(MAGIC + struct.pack("<I", len(header)) + header)
        for section in sections.values():
            out.write(section)


MANIFEST = "part int, number int, path string, ids bigint"


def _writer(folder: str, packed_lengths: bytes, kind: str | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = np.frombuffer(zlib.decompress(packed_lengths), np.uint8)
        codes = lengths, codes_of(lengths)
        part, number, size = TaskContext.get().partitionId(), 0, 0
        doc_ids, docs, done = [], [], []

        def flush() -> None:
            path = f"{folder}/{part:06d}-{number:04d}-{uuid4().hex}.ids"
            _write_file(path, doc_ids, docs, packed_lengths, codes)
            done.append((part, number, path, size))

        for batch in batches:
            values, ends = _values(batch.column(1), kind)
            for doc_id, a, b in zip(batch.column(0).to_pylist(), np.r_[0, ends[:-1]].tolist(), ends.tolist()):
                if docs and size + b - a > FILE_IDS:
                    flush()
                    number, size, doc_ids, docs = number + 1, 0, [], []
                doc_ids.append(doc_id)
                docs.append(values[a:b])
                size += b - a
        if docs:
            flush()
        columns = list(zip(*done)) or [()] * 4
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "number", "path", "ids"])

    return run


def write_files(rows: DataFrame, folder: str, kind: str | None = None) -> DataFrame:
    """Write ``doc_id``, ``ids`` in ascending order; returns the manifest: part, number, path and ids of each file.

    Ids are arrays of numbers, or, with a kind, packed as ``encoded`` does.
    """
    counts = rows.select("ids").mapInArrow(_counter(kind), "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    totals = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 1, np.int64)
    totals[counts["id"]] = counts["n"]
    packed_lengths = zlib.compress(lengths_of(totals).tobytes())
    parts = max(1, int(totals.sum() // FILE_IDS * 4), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "ids")
    return written(ordered.mapInArrow(_writer(folder, packed_lengths, kind), MANIFEST), "manifest")


class File:
    """A token file, of which sections and stretches are read as needed."""

    def __init__(self, path: str):
        self.source = open_in(path)
        head = self.source.read_at(len(MAGIC) + 4, 0)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"not a token file: {path}")
        size = struct.unpack("<I", head[len(MAGIC) :])[0]
        self.header = json.loads(self.source.read_at(size, len(head)))
        self.start, at = {}, len(head) + size
        for name, length in self.header["sections"].items():
            self.start[name] = at
            at += length

    def section(self, name: str, first: int = 0, size: int | None = None) -> bytes:
        length = self.header["sections"][name] - first if size is None else size
        return self.source.read_at(length, self.start[name] + first)

    def numbers(self, name: str) -> np.ndarray:
        return np.frombuffer(self.section(name), "<i8")


RUNS = "path string, base bigint, first int, last int"


def _plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of documents of about ``RUN_IDS`` ids in each file."""
    for batch in batches:
        for path, base in zip(batch["path"], batch["base"]):
            ends = np.cumsum(File(path).numbers("sizes"))
            cuts = np.unique(np.r_[0, np.searchsorted(ends, np.arange(RUN_IDS, ends[-1], RUN_IDS)) + 1, len(ends)])
            yield pd.DataFrame({"path": path, "base": base, "first": cuts[:-1], "last": cuts[1:]})


def _reader(then: Callable[[pa.RecordBatch], pa.RecordBatch] | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, runs in batch.to_pandas().groupby("path"):
                for read in _documents(path, runs):
                    yield read if then is None else then(read)

    return run


def _documents(path: str, runs: pd.DataFrame) -> Iterator[pa.RecordBatch]:
    """The documents of some runs of a file."""
    file = File(path)
    sizes, offsets, doc_ids = file.numbers("sizes"), file.numbers("offsets"), file.numbers("doc_ids")
    nulls = np.unpackbits(np.frombuffer(file.section("nulls"), np.uint8))[: len(sizes)].astype(bool)
    lengths, starts = file.section("lengths"), np.cumsum(sizes) - sizes
    total, bits = int(sizes.sum()), 8 * file.header["sections"]["stream"]
    for base, first, last in zip(runs["base"], runs["first"], runs["last"]):
        begin, end = int(starts[first]), int(starts[last - 1] + sizes[last - 1])
        low, high = begin // BLOCK_IDS, -(-end // BLOCK_IDS)
        low_byte = int(offsets[low]) // 8
        high_byte = -(-(int(offsets[high]) if high < len(offsets) else bits) // 8)
        stream = file.section("stream", low_byte, high_byte - low_byte)
        count = min(high * BLOCK_IDS, total) - low * BLOCK_IDS
        ids = unpack(stream, offsets[low:high] - 8 * low_byte, count, lengths)
        at = low * BLOCK_IDS
        cuts = np.r_[starts[first:last], end] - begin
        lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids[begin - at : end - at]))
        columns = [pa.array(doc_ids[first:last], mask=nulls[first:last]), pa.array(starts[first:last] + base), lists]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "ids"])


def read_files(
    manifest: DataFrame, then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None, kinds: str = "ids array<int>"
) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before) and ``ids`` of every document in the files.

    ``then`` may make something else of them in the same task; ``kinds`` names its columns in place of ``ids``.
    """
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    files = manifest.select("path", (F.sum("ids").over(order) - F.col("ids")).alias("base"))
    parts = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    runs = files.repartition(parts, "path").mapInPandas(_plan, RUNS).repartition(parts, "path", "first")
    return runs.mapInArrow(_reader(then), f"doc_id bigint, start bigint, {kinds}")


def _digests(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Number and checksum of the ids of each document."""
    lists = batch.column(2)
    flat, ends = lists.flatten().to_numpy().astype("<u4"), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    columns = [batch.column(0), batch.column(1), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_table(docs: DataFrame, tokenizer_path: str, end: int = 1) -> DataFrame:
    """One row per document, read back from the files: place, number and checksum of its ids."""
    spark = docs.sparkSession
    path, kind = scratch(spark, "ids"), kind_of(tokenizer_path, end)
    with small_batches(spark):
        encoded(docs, tokenizer_path, end, kind).write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema("doc_id bigint, ids binary").parquet(path)
    return read_files(write_files(rows, scratch(spark, "token-files"), kind), _digests, "n_tokens bigint, ids_crc32 bigint")
