"""Byte-level BPE encoding and decoding with Spark's higher-order functions.

Texts are cut by the tokenizer's pattern into *words*. Merging is done on distinct words: a higher-order fold takes the
array of a word's byte ids and, step by step, joins the leftmost pair of least rank. The rank map is a table of one row that
is broadcast: as a literal it would be in the text of every plan, which the driver keeps, and in every task. It is laid out in
arrays where a pair has one place, as Spark's own map type is searched from end to end; pairs of bytes, which every word
begins with, have an array of their own. Ids of documents are gathered from those of their words, and decoded by putting
binary pieces end to end, by Arrow in the same stage.

Words that are frequent in the corpus, at most ``MAX_COMMON`` of them, are chosen by a count over all documents and merged once,
into a table in the shared folder that each Python worker reads for itself; only the names of its files pass through the
driver. Documents are gone through in blocks of about ``BLOCK_CHARS`` characters (a longer
text is a block by itself), each with a list of its other distinct words, which are merged in the block. Blocks are made
and merged in one narrow stage: texts and ids are never shuffled, and a lost task is done again by itself.

Words of more than ``LONG`` bytes, such as long runs of one sign, take the same merges from the tokenizer's own library, as
the fold's work grows with the square of a word's length. Null is the empty text, which has no ids. Repeated rows give
equal rows.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.llm.common import columns_of, written
from chronoloom.llm.files import open_in

MAX_COMMON = 1 << 20
#: Tasks that merge them.
PARTS = 64
BLOCK_CHARS = 3_000_000
#: Bytes of the longest words that are folded, a power of two.
LONG_BITS = 10
LONG = 1 << LONG_BITS
Then = Callable[[pa.LargeListArray, pa.Array], dict[str, pa.Array]]
#: Places of the rank map for each pair, bits of a rank, and what stands in a place without a pair.
ROOM = 4
BITS = 17
EMPTY = 1 << 40
#: Rank of pairs that make no piece; as an id, one that is in no pair.
NONE = (1 << BITS) - 1
#: Where the rank begins in an entry of the fold, and the number that stands for the byte after the last one.
RANK = BITS + LONG_BITS
END = 256

#: A space beside other white space: only there can a word that begins with a space not be told from the space alone.
UNEVEN = r" [\s\pZ\x0b\x1c-\x1f\x{85}]|[\s\pZ\x0b\x1c-\x1f\x{85}] "
#: Stretches that are one word to the pattern.
PLAIN = r"^ ?\pL+$"
#: Stretches that are two words to the pattern.
ENDED = r"^(?P<word> ?\pL+)(?P<end>[.,;:!?]+)$"


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank of every piece, from a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _rank_map(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Every two pieces that make a third: a start for each first piece, and first piece and rank in one number at start + second.

    Pieces that are first in many pairs choose their start first, so that no two pairs meet.
    """
    pairs: dict[int, list[tuple[int, int]]] = {}
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            a, b = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if a is not None and b is not None:
                pairs.setdefault(a, []).append((b, rank))
    width, size = max(ranks.values()) + 1, 1 + ROOM * sum(map(len, pairs.values()))
    starts, slots = np.zeros(width, np.int64), np.full(size + width, EMPTY, np.int64)
    draw = np.random.default_rng(0).integers
    for a, found in sorted(pairs.items(), key=lambda item: -len(item[1])):
        b, rank = np.array(found).T
        for tries in chain([8], [1 + (1 << 16) // len(b)] * 100):
            drawn = draw(0, size, tries)
            free = (slots[drawn[:, None] + b] == EMPTY).all(axis=1)
            if free.any():
                starts[a] = drawn[free.argmax()]
                break
        else:
            starts[a], slots = len(slots), np.append(slots, np.full(width, EMPTY))
        slots[starts[a] + b] = (a << BITS) + rank
    return starts, slots


def _rank(table: Column, a: Column, b: Column) -> Column:
    """Rank of the piece that two pieces make, ``NONE`` if they make none or one of them is null or ``NONE``.

    An entry of the first piece differs from it in the bits of the rank alone, any other one in higher bits as well.
    """
    found = F.get(table["slots"], (F.get(table["starts"], a.cast("int")) + b).cast("int"))
    return F.least(found.bitwiseXOR(F.shiftleft(a, BITS)), F.lit(NONE).cast("bigint"))


def rank_table(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """The rank map, and first entries of the fold by pair of bytes, as one row to be broadcast."""
    starts, slots = _rank_map(ranks)
    after = [bytes([i]) for i in range(256)]
    pairs = [(ranks.get(a + b, NONE) if b else NONE, ranks[a]) for a in after for b in [*after, b""]]
    columns = {"starts": starts, "slots": slots, "pairs": [(rank << RANK) + id_ for rank, id_ in pairs]}
    return F.broadcast(spark.createDataFrame(pa.table({c: pa.array([v], pa.list_(pa.int64())) for c, v in columns.items()})))


def _pairs(words: pa.Array) -> pa.ListArray:
    """The bytes of each word as numbers of the pairs that they make with the next one, the last with ``END``."""
    data = np.frombuffer("".join(words.to_pylist()).encode(), np.uint8).astype(np.int32)
    ends, after = _ends(np.asarray(pc.binary_length(words))), np.full(len(data), END, np.int32)
    after[:-1] = data[1:]
    after[ends[1:] - 1] = END
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(data * (END + 1) + after))


def merged(words: Column) -> Column:
    """Ids of each word of an array of words, given as ``_pairs``, in rows joined with ``rank_table``; words have at most ``LONG`` bytes.

    The state of the fold is one number for each piece so far: the rank of it and the next piece, where it starts, and its id.
    The least of them is the leftmost pair of least rank. One that is in no pair stands before the first.
    """
    id_of = lambda x: x.bitwiseAND(NONE)

    def joined(table: Column, s: Column, at: Column, least: Column) -> Column:
        new, left = F.shiftright(least, RANK), F.get(s, at - 2)
        before = F.shiftleft(_rank(table, id_of(left), new), RANK) + left.bitwiseAND((1 << RANK) - 1)
        here = F.shiftleft(_rank(table, new, id_of(F.get(s, at + 1))), RANK) + least.bitwiseAND(LONG - 1 << BITS) + new
        return F.flatten(F.array(F.slice(s, 1, at - 2), F.array(before, here), F.slice(s, at + 2, LONG)))

    def fold(table: Column, pairs: Column) -> Column:
        def step(s: Column, _: Column) -> Column:
            def of(least: Column) -> Column:
                further = _let(F.array_position(s, least).cast("int"), lambda at: joined(table, s, at, least))
                return F.when(least < NONE << RANK, further).otherwise(s)

            return _let(F.array_min(s), of)

        entries = F.transform(pairs, lambda p, i: F.get(table["pairs"], p) + F.shiftleft(i, BITS))
        first = F.concat(F.array(F.lit((NONE << RANK) + NONE)), entries)
        last = lambda s: F.transform(F.slice(s, 2, LONG), lambda x: id_of(x).cast("int"))
        return F.aggregate(F.slice(pairs, 2, LONG), first, step, last)

    return _let(F.struct("starts", "slots", "pairs"), lambda t: F.transform(words, lambda w: fold(t, w)))


@lru_cache(maxsize=1)
def _splitter(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def _cut(texts: pa.Array, pattern: str) -> tuple[pa.ListArray, np.ndarray, pa.Array, np.ndarray]:
    """Texts as numbers of distinct *stretches*, the number of words of each stretch, distinct words, and stretches as words.

    Texts are cut at single spaces, which the pattern keeps with what follows, so a stretch holds whole words; one of
    nothing but letters is a word, and signs that end it are one more. A text in which a space stands beside other white space
    is cut by the pattern instead.
    The cuts are marked with a character that no text of the run holds, and Arrow splits there and numbers the stretches.
    """
    find = _splitter(pattern).findall
    signs = map(chr, chain(range(0xD800), range(0xE000, 0x110000)))
    mark = next(m for m in signs if not pc.any(pc.match_substring(texts, m)).as_py())
    marked, uneven = pc.replace_substring(texts, " ", mark + " "), pc.match_substring_regex(texts, UNEVEN)
    if pc.any(uneven).as_py():
        cut = [mark.join(find(t)) for t in texts.filter(uneven).to_pylist()]
        marked = pc.replace_with_mask(marked, uneven, pa.array(cut, pa.string()))
    parts = pc.split_pattern(marked, mark)
    coded = parts.flatten().dictionary_encode()
    stretches = coded.dictionary
    plain = pc.match_substring_regex(stretches, PLAIN)
    rest = stretches.filter(pc.invert(plain))
    split = pc.extract_regex(rest, ENDED)
    others = list(map(find, rest.filter(split.is_null()).to_pylist()))
    ended, words = split.drop_null().flatten(), pa.array(chain.from_iterable(others), pa.string())
    words = pa.concat_arrays([stretches.filter(plain), *ended, words]).dictionary_encode()
    # Stretches of one word, of a word and its end, and others.
    kind = np.where(plain.to_numpy(zero_copy_only=False), 0, 2)
    kind[kind == 2] -= split.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.where(kind == 1, 2, 1)
    sizes[kind == 2] = np.fromiter(map(len, others), np.int64, len(others))
    kind, order = np.repeat(kind, sizes), np.zeros(int(sizes.sum()), np.int32)
    ones, twos = np.count_nonzero(kind == 0), np.count_nonzero(kind == 1)
    order[kind == 0], pairs, order[kind == 2] = np.split(words.indices.to_numpy(), [ones, ones + twos])
    order[kind == 1] = pairs.reshape(2, -1).T.ravel()
    return pa.ListArray.from_arrays(parts.offsets, coded.indices), sizes, words.dictionary, order


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Keys and texts of the documents, block by block."""
    for batch in batches:
        keys, texts = batch.column(0), pc.fill_null(batch.column(1), "")
        first, size = 0, 0
        for i, n in enumerate(pc.utf8_length(texts).to_pylist()):
            if i > first and size + n > BLOCK_CHARS:
                yield keys.slice(first, i - first), pa.concat_arrays([texts.slice(first, i - first)])
                first, size = i, 0
            size += n
        if len(texts):
            yield keys.slice(first), pa.concat_arrays([texts.slice(first)])


def _trimmed(made: pa.RecordBatch) -> pa.RecordBatch:
    """What was made of a block, when the memory that Arrow keeps of the work is given back: a task has two Python workers."""
    pa.default_memory_pool().release_unused()
    return made


def _counter(pattern: str) -> Callable:
    def counted(texts: pa.Array) -> pa.RecordBatch:
        numbers, sizes, words, order = _cut(texts, pattern)
        times = np.bincount(numbers.flatten().to_numpy(), minlength=len(sizes))
        n = np.bincount(order, np.repeat(times, sizes), len(words)).astype(np.int64)
        return pa.RecordBatch.from_arrays([words, pa.array(n)], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _blocks(batches):
            table = _trimmed(counted(texts))
            for at in range(0, table.num_rows, 20_000):
                yield table.slice(at, 20_000)

    return count


def common_words(texts: DataFrame, pattern: str) -> DataFrame:
    """The most frequent words, at most ``MAX_COMMON`` and none of them long.

    The bound on the count is a power of two, found from the number of words by size of their count.
    """
    counts = texts.mapInArrow(_counter(pattern), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = written(counts.filter((F.octet_length("word") <= 64) & (F.col("n") > 1)), "words")
    sizes = counts.groupBy(F.length(F.bin("n")).alias("bits")).count().orderBy(F.col("bits").desc()).collect()
    total, least = 0, 64
    for row in sizes:
        total += row["count"]
        if total > MAX_COMMON:
            break
        least = row["bits"]
    return counts.filter(F.length(F.bin("n")) >= least).select("word")


def _one(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each batch and their pairs of bytes as one row."""
    for batch in batches:
        if batch.num_rows:
            words = batch.column(0)
            yield pa.RecordBatch.from_arrays([_one(words), _one(_pairs(words))], ["words", "spelt"])


def common_files(texts: DataFrame, pattern: str, ranks: DataFrame) -> tuple[str, ...]:
    """Files of ``words array<string>`` and their ``ids array<array<int>>``, for all common words."""
    listed = common_words(texts, pattern).repartition(PARTS, "word")
    listed = listed.mapInArrow(_listed, "words array<string>, spelt array<array<int>>")
    return tuple(written(listed.crossJoin(ranks).select("words", merged(F.col("spelt")).alias("ids")), "common").inputFiles())


@lru_cache(maxsize=1)
def _common(paths: tuple[str, ...]) -> tuple[pa.Array, pa.ListArray]:
    """Common words and their ids."""
    words, ids = [pa.array([], pa.string())], [pa.array([], pa.list_(pa.int32()))]
    for path in paths:
        with open_in(path) as source:
            table = pq.ParquetFile(source).read()
        words += [chunk.flatten().cast(words[0].type) for chunk in table["words"].chunks]
        ids += [chunk.flatten().cast(ids[0].type) for chunk in table["ids"].chunks]
    return pa.concat_arrays(words), pa.concat_arrays(ids)


def _found(words: pa.Array, table: pa.Array) -> pa.Array:
    """Place of each distinct word in the table, null for others; the table is looked up in the words, which are far fewer."""
    at = pc.index_in(table, words)
    place = np.full(len(words), -1, np.int32)
    place[at.drop_null().to_numpy()] = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
    return pa.array(place, mask=place < 0)


def _encoder(pattern: str, common: tuple[str, ...], by_id: object) -> Callable:
    def block(keys: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        (table, table_ids), pieces = _common(common), by_id.value
        numbers, sizes, words, order = _cut(texts, pattern)
        place = _found(words, table)
        known, long = place.is_valid().to_numpy(zero_copy_only=False), np.array(pc.binary_length(words)) > LONG
        # Common words are numbered first, then long ones, then those left to be merged.
        kind = np.where(known, 0, np.where(long, 1, 2))
        number = np.zeros(len(kind), np.int32)
        number[np.argsort(kind, kind="stable")] = np.arange(len(kind))
        piece = _library(pattern, pieces)._encode_single_piece if 1 in kind else None
        long_ids = [piece(word.encode()) for word in words.filter(pa.array(kind == 1)).to_pylist()]
        ids = pa.concat_arrays([table_ids.take(place.drop_null()), pa.array(long_ids, table_ids.type)])
        packed = [numbers.offsets, numbers.flatten(), sizes, number[order], ids.value_lengths(), ids.flatten()]
        packed = [np.asarray(a).astype("<i4").tobytes() for a in packed]
        columns = {
            "docs": _one(pa.concat_arrays([keys])),
            "rare": _one(_pairs(words.filter(pa.array(kind == 2)))),
            "packed": pa.array([packed], pa.list_(pa.binary())),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _blocks(batches):
            yield _trimmed(block(keys, texts))

    return cut_up


def _ends(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)])


def _gatherer(by_id: object, then: Then | None) -> Callable:
    """Ids of the documents of a block, put together from those of its words."""

    def block(docs: pa.Array, rare: pa.Array, packed: pa.Array) -> pa.RecordBatch:
        cuts, parts, sizes, order, lengths, known = (np.frombuffer(b.as_buffer(), "<i4") for b in packed)
        first = pa.LargeListArray.from_arrays(pa.array(_ends(lengths)), pa.array(known))
        ids = pa.concat_arrays([first, rare.cast(first.type)])
        stretches = pa.LargeListArray.from_arrays(pa.array(_ends(sizes)), pa.array(order)).take(pa.array(parts))
        words = ids.take(stretches.flatten())
        ends = words.offsets.to_numpy()[stretches.offsets.to_numpy()[cuts]]
        lists = pa.LargeListArray.from_arrays(pa.array(ends - ends[0]), words.flatten())
        made = {"ids": lists.cast(pa.list_(pa.int32()))} if then is None else then(lists, by_id.value)
        return pa.RecordBatch.from_arrays([docs, *made.values()], ["doc", *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _trimmed(block(*(batch.column(c).slice(i, 1).flatten() for c in range(3))))

    return run


_libraries: dict[str, object] = {}


def _library(pattern: str, pieces: pa.Array):
    if pattern not in _libraries:
        import tiktoken

        ranks = {piece: i for i, piece in enumerate(pieces.to_pylist()) if piece is not None}
        _libraries[pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _libraries[pattern]


def pieces_of(ranks: dict[bytes, int]) -> pa.Array:
    """Pieces by id; ids without one are null."""
    pieces: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pa.array(pieces, pa.large_binary())


def encode(docs: DataFrame, ranks_path: str, pattern: str, then: Then | None = None, kinds: str = "ids array<int>") -> DataFrame:
    """All columns of the documents as ``doc``, without their text, and ``ids array<int>``.

    ``then`` may make other columns of the ids and the pieces in the same task; ``kinds`` names them.
    """
    spark = docs.sparkSession
    ranks = read_ranks(ranks_path)
    text = F.col("text").cast("string").alias("text")
    table, by_id = rank_table(spark, ranks), spark.sparkContext.broadcast(pieces_of(ranks))
    common = common_files(docs.select(F.lit(0).alias("key"), text), pattern, table)
    others = [c for name, c in zip(docs.columns, columns_of(docs)) if name != "text"]
    rows = docs.select(F.struct(*others).alias("key"), text) if others else docs.select(F.lit(0).alias("key"), text)
    key = rows.schema["key"].dataType.simpleString()
    kinds_cut = f"docs array<{key}>, rare array<array<int>>, packed array<binary>"
    blocks = rows.mapInArrow(_encoder(pattern, common, by_id), kinds_cut).crossJoin(table)
    folded = blocks.select("docs", merged(F.col("rare")).alias("rare"), "packed")
    return folded.mapInArrow(_gatherer(by_id, then), f"doc {key}, {kinds}")


def joined(lists: pa.LargeListArray, pieces: pa.Array) -> pa.Array:
    """The bytes that lists of ids stand for: their pieces, end to end."""
    found = pa.LargeListArray.from_arrays(lists.offsets, pieces.take(lists.flatten()))
    return pc.binary_join(found, pa.scalar(b"", pa.large_binary()))


def texts(lists: pa.LargeListArray, pieces: pa.Array) -> dict[str, pa.Array]:
    """For ``then``: the ids, their number, and the text that they stand for."""
    text = joined(lists, pieces).cast(pa.large_string()).cast(pa.string())
    return {"ids": lists.cast(pa.list_(pa.int32())), "n_tokens": lists.value_lengths(), "text": text}


TEXTS = "ids array<int>, n_tokens bigint, text string"


def digests(lists: pa.LargeListArray, pieces: pa.Array) -> dict[str, pa.Array]:
    """For ``then``: number of ids, and digests of the ids and of the decoded bytes."""
    numbers = pa.LargeListArray.from_arrays(lists.offsets, lists.flatten().cast(pa.large_string()))
    listed, decoded = pc.binary_join(numbers, pa.scalar(" ", pa.large_string())), joined(lists, pieces)
    hashed = lambda values: pa.array([sha256(v.as_buffer()).hexdigest() for v in values], pa.string())
    return {"n_tokens": lists.value_lengths(), "ids_sha256": hashed(listed), "decoded_sha256": hashed(decoded)}


DIGESTS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def bpe_table(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per document: number of ids, and digests of the ids and of the decoded bytes."""
    rows = encode(docs.select("doc_id", "text"), ranks_path, pattern, digests, DIGESTS)
    return rows.select("doc.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
