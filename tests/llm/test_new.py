"""Manifest, mix and spelling variants against brute-force versions, and on rows with every oddity."""

import collections
import hashlib
import itertools
import math
import random
import re
import time
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chronoloom.llm import byte_bpe, decontaminate, entries, hidden_markov, merkle, mixing, quality, secret_scan, spelling, token_files, url_filter, warc_zip
from chronoloom.llm.common import scratch, written
from chronoloom.llm.ranking import placed

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, grp string, rank int, word string"
LONG = "alpha beta gamma delta epsilon zeta\n" * 20_000


@pytest.fixture(scope="module")
def docs(spark):
    """Null columns and ids, ids over 2^53, empty and long texts, repeated rows, clashing extra columns."""
    big = 1 << 60
    texts = [None, "", " \n ", "one two\nthree", LONG, "colour color\ncolours colors " * 3, "élan vital élans", "aaaaaaaa " * 5]
    out = [(i, t, None if i == 2 else "en", f"s{i % 3}", None if i == 3 else len(t or ""), "x", 1, "w") for i, t in enumerate(texts)]
    out += [(big + i, f"large\nid number {i}", "de", "big", i, "x", 1, "w") for i in range(40)]
    out += [(None, "no id\nat all", "en", None, 3, "x", 1, "w"), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(out + [out[5], out[5], out[-2]], SCHEMA)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(hashes):
    paths, below = [[] for _ in hashes], [[i] for i in range(len(hashes))]
    while len(hashes) > 1:
        runs = [range(i, min(i + 3, len(hashes))) for i in range(0, len(hashes), 3)]
        for run in runs:
            for i in run:
                step = "".join(hashes[j] for j in run if j < i), "".join(hashes[j] for j in run if j > i)
                for leaf in below[i]:
                    paths[leaf].append(step)
        below = [[leaf for i in run for leaf in below[i]] for run in runs]
        hashes = [digest("".join(hashes[i] for i in run)) for run in runs]
    return hashes[0], paths


def manifest_of(rows):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = collections.defaultdict(list)
    for r in rows:
        head = "".join(map(part, (r.doc_id, r.source, r.lang, r.n_chars)))
        own = again = digest(head + part(r.text))
        if r.doc_id is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
            again = digest(head + part(r.text.replace("\n", "")))
        groups[r.source].append((r.doc_id, own, again))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    sources = []
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        sources.append(tree([own for _, own, _ in groups[name]]))
    root, above = tree([subroot for subroot, _ in sources])
    out = []
    for name, (subroot, paths), rest in zip(names, sources, above):
        for (doc_id, own, again), path in zip(groups[name], paths):
            for before, after in path + rest:
                again = digest(before + again + after)
            proof = digest("".join(b + a for b, a in path + rest))
            out.append((doc_id, own, subroot, root, proof, again, again == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest(docs, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    got = sorted(map(tuple, merkle.merkle_table(docs).collect()), key=repr)
    assert got == manifest_of(docs.collect())
    assert len({r[-1] for r in got}) == 2


@pytest.mark.parametrize("n", [0, 1, 3, 4, 28])
def test_manifest_sizes(spark, n):
    rows = spark.range(n).selectExpr("id AS doc_id", "'t' AS text", "'s' AS source", "'l' AS lang", "id AS n_chars")
    got = merkle.merkle_table(rows).collect()
    assert sorted(map(tuple, got), key=repr) == (manifest_of(rows.collect()) if n else [])


def test_manifest_shows_changes(docs):
    root = merkle.merkle_table(docs).first().root
    changed = docs.withColumn("n_chars", F.when(F.col("doc_id") == 1, 99).otherwise(F.col("n_chars")))
    assert merkle.merkle_table(changed).first().root != root
    assert merkle.merkle_table(docs.repartition(7)).first().root == root


def test_placed_counts_and_sums(spark):
    rows = spark.range(1000).selectExpr("id", "CAST(id % 3 AS STRING) AS g", "id % 7 AS v").repartition(5)
    for r in placed(rows, ["g"], ["id"]).collect():
        assert r.rank == r.id // 3 and r.group_size == (334 if r.g == "0" else 333)
    sums = collections.Counter()
    for r in placed(rows, ["g"], ["id"], "v", "before").orderBy("id").collect():
        assert r.before == sums[r.g]
        sums[r.g] += r.v


def seats_of(votes, most, seats):
    """One seat after the other, to the highest quotient."""
    out = [0] * len(votes)
    for _ in range(seats):
        open_ = [i for i in range(len(votes)) if out[i] < most[i] and votes[i] > 0]
        if not open_:
            break
        out[min(open_, key=lambda i: (-votes[i] / (2 * out[i] + 1), i))] += 1
    return out


def test_seats(spark):
    cases = [
        ([5.0, 5.0, 5.0, 5.0], [9, 9, 9, 9], 6),
        ([1000.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0], [500, 9, 9, 9, 9, 9, 9], 101),
        ([1000.0, 1.0, 1.0, 1.0], [10, 50, 50, 50], 100),
        ([3.0, 0.0, 2.0], [2, 5, 2], 50),
        ([7.0], [100], 0),
        ([53.0, 24.0, 23.0], [99, 99, 99], 7),
    ]
    units = [(f"g{g}", u, v, m) for g, (votes, most, _) in enumerate(cases) for u, (v, m) in enumerate(zip(votes, most))]
    seats = spark.createDataFrame([(f"g{g}", case[2]) for g, case in enumerate(cases)], "grp string, seats bigint")
    got = mixing.apportioned(spark.createDataFrame(units, "grp string, unit bigint, votes double, most bigint"), seats)
    found = {(r.grp, r.unit): r.quota for r in got.collect()}
    for g, case in enumerate(cases):
        assert [found[f"g{g}", u] for u in range(len(case[0]))] == seats_of(*case)


def mix_of(rows):
    """Targets by resharing round by round, seats one by one, blocks by their digests."""
    b, s, seed = mixing.BLOCK_WORDS, mixing.SHARD_BLOCKS, mixing.SEED
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    names = sorted({r.source for r in rows}, key=lambda x: (x is None, (x or "").encode()))
    sizes = {n: sum(size(r.text) for r in rows if r.source == n) for n in names}
    weight = dict(zip(names, itertools.cycle((5, 2, 1))))
    target, open_, rest = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        unit = rest / sum(weight[n] for n in open_)
        over = {n for n in open_ if weight[n] * unit > 2 * sizes[n]}
        if not over:
            target.update({n: weight[n] * unit for n in open_})
            break
        target.update({n: 2.0 * sizes[n] for n in over})
        rest -= sum(2 * sizes[n] for n in over)
        open_ -= over
    seats = math.floor(1.5 * sum(sizes.values()) / b + 0.5)
    quota = dict(zip(names, seats_of([target[n] for n in names], [2 * -(-sizes[n] // b) for n in names], seats)))
    out = []
    for n in names:
        key = "1" if n is None else "0" + n
        parts = [min(sizes[n] - at, b * s) for at in range(0, sizes[n], b * s)]
        blocks = [-(-p // b) for p in parts]
        times = []
        for shard, (m, q) in enumerate(zip(blocks, seats_of(parts, [2 * m for m in blocks], quota[n]))):
            drawn = sorted(range(m), key=lambda i: md5(f"{seed}:{key}:{shard * s + i}"))
            times += [q // m + (i in drawn[: q % m]) for i in range(m)]
        own = [r for r in rows if r.source == n]
        own.sort(key=lambda r: (md5(f"{seed}:{'-' if r.doc_id is None else r.doc_id}:{md5(r.text or '')}"), r.doc_id or -1))
        at = 0
        for r in own:
            words = range(at, at + size(r.text))
            out.append((r.doc_id, len(words), sizes[n], round(target[n], 6), sum(times[w // b] for w in words)))
            at += len(words)
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard", [3, 1024])
def test_mix(docs, monkeypatch, shard):
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", shard)
    rows = docs.filter("doc_id IS NULL OR doc_id <> 4").unionByName(docs.filter("doc_id = 4").withColumn("text", F.substring("text", 1, 4000)))
    got = mixing.mixed(rows).collect()
    assert sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got), key=repr) == mix_of(rows.collect())
    for r in got:
        assert all(s.first < s.last <= r.size and s.times in (1, 2) for s in r.spans)
        assert r.taken == sum((s.last - s.first) * s.times for s in r.spans)


def test_mix_reruns_and_targets(docs):
    first, again = (sorted(map(tuple, mixing.mix_table(d).collect()), key=repr) for d in (docs, docs.repartition(9)))
    assert first == again and all(taken <= 2 * size for _, size, _, _, taken in first)
    whole = mixing.mixed(docs).groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n")).collect()
    assert all(abs(r.t - r.n) <= 3 * mixing.BLOCK_WORDS for r in whole)


def test_mix_of_nothing(spark, docs):
    assert mixing.mix_table(docs.limit(0)).collect() == []
    assert {(r.target, r.taken) for r in mixing.mix_table(docs.withColumn("text", F.lit(" \n"))).collect()} == {(0.0, 0)}


def test_mix_pieces(spark):
    row = spark.range(1).select(mixing.pieces_of(F.lit("a b\nc d"), F.expr("array(struct(1L AS first, 3L AS last, 2 AS times))")).alias("p"))
    assert row.first().p == ["b c", "b c"]


def words_of(rows):
    counts = collections.Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            if r.doc_id is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_error(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_of(counts):
    near = {w: [v for v in counts if one_error(w, v)] for w in counts}
    best = {w: min(near[w], key=lambda v: (-counts[v], v)) for w in counts if near[w]}
    form = {w: v for w, v in best.items() if counts[v] >= 2 * counts[w]}
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("letters", [40, 1 << 15])
def test_spelling(spark, docs, monkeypatch, letters):
    monkeypatch.setattr(spelling, "LETTERS", letters)
    made = ["abcde", "abcdf", "abcd", "abcdef", "xabcde", "bcde", "abcdeé", "ábcde", "aaaaaa", "aaaaa", "aaaaaaa", "ababab", "bababa"]
    made += ["".join(p) for p in itertools.product("ab", repeat=6)] + ["q" * 3000, "q" * 2999, "q" * 1500 + "r" + "q" * 1499]
    texts = [(i, " ".join([w.upper() if i % 2 and w.isascii() else w] * (3 + i % 9 * (i % 4)))) for i, w in enumerate(made)]
    more = spark.createDataFrame(texts, "doc_id bigint, text string")
    rows = docs.filter("doc_id IS NULL OR doc_id <> 4").select("doc_id", "text").unionByName(more)
    got = sorted(map(tuple, spelling.spelling_table(rows).collect()), key=repr)
    assert got == variants_of(words_of(rows.collect()))


def test_spelling_of_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = spelling.spelling_table(rows)
    counts = words_of(rows.collect())
    assert {r.word: r.n for r in got.collect()} == counts
    some = sorted(counts)[::40]
    wanted = {w: sum(one_error(w, v) for v in counts) for w in some}
    assert {r.word: r.n_near for r in got.collect() if r.word in wanted} == wanted


def test_spelling_of_nothing(docs):
    assert spelling.spelling_table(docs.limit(0)).collect() == []
    assert spelling.spelling_table(docs.withColumn("text", F.lit(None).cast("string"))).collect() == []


# What earlier operators must do with odd rows.

BIG = 1 << 60


def test_ids_over_the_range_of_floats(spark):
    pages = [(BIG + 1, "http://a.b/c", "one"), (BIG + 3, "http://a.b/d", "one"), (BIG + 5, None, None), (None, "x", "two")]
    got = warc_zip.warc_table(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()
    found = {r.page_id: (r.record_type, r.refers_to) for r in got}
    assert found == {BIG + 1: ("revisit", BIG + 3), BIG + 3: ("response", None), BIG + 5: ("response", None), None: ("response", None)}
    docs = [(BIG + i, "some words here " * i) for i in range(1, 6)] + [(None, "no id")]
    scores = hidden_markov.score_table(spark.createDataFrame(docs, "doc_id bigint, text string"), 1).collect()
    assert {r.doc_id: r.n_tokens for r in scores} == {**{BIG + i: 3 * i + 1 for i in range(1, 6)}, None: 3}


def test_items_without_id_are_looked_for(spark, docs):
    passage = "A question that nobody has asked before: which of these seven answers is the right one, and why?"
    item = spark.createDataFrame([(None, passage), (1, "something else entirely, which is in no document at all here")], "item_id bigint, text string")
    rows = docs.filter("doc_id < 3").withColumn("text", F.when(F.col("doc_id") == 1, f"Before. {passage} After.").otherwise("clean text"))
    assert [(r.doc_id, r.item_id) for r in decontaminate.leaks(rows, item).collect()] == [(1, None)]
    assert sorted(r.doc_id for r in decontaminate.decontaminated(rows, item).collect()) == [0, 2]


def test_long_urls(spark):
    urls = [(1, "http://x.org/" + "añ\U0001f600b" * 250_000), (2, "http://net/es/1"), (3, "http://www.example.com/en/"), (4, "http://q.org/" + "z" * 9000)]
    started = time.monotonic()
    got = url_filter.url_table(spark.createDataFrame(urls, "page_id bigint, url string"), entries.RULES).collect()
    assert len(got) == 4 and {r.verdict for r in got} <= {"allow", "block"} and time.monotonic() - started < 60


def test_grams_are_those_of_the_text(spark):
    text = "aé\U0001f600b.c"
    ends = f"\x02{text}\x03"
    row = spark.range(1).select(*[g.alias(f"g{i}") for i, g in enumerate(url_filter._grams(F.lit(text), "h"))]).first()
    for size, found in zip(url_filter.SIZES, row):
        assert found == [f"h{size}{ends[i : i + size]}" for i in range(max(1, len(ends) - size + 1))]


def test_token_ids_of_odd_texts():
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    random.seed(5)
    signs = [*"abXYZéßÀ ñ'  \n\t.,;:!?$<|>/w\"#&*123é́中文ﬁ-_`^~[]{}@\\", "<|endoftext|>", "'s", "</w>", "\u0085", "ſ", "İ", "ΑΣ"]
    texts = ["".join(random.choices(signs, k=random.randrange(60))) for _ in range(5000)]
    want = [[*e.ids, 1] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    encoder = token_files.Encoder(path)
    assert encoder.encode(pa.array(texts), 1).to_pylist() == want
    assert encoder.encode(pa.array(texts[::-1]), 1).to_pylist() == want[::-1]


def test_bounds_follow_the_data_of_their_group(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(16)

    def bounds(rows):
        found = quality.thresholds(quality.sketches(written(quality.measured(rows), "measured"))).collect()
        return {(r._lang, r._source): r.asDict() for r in found}

    before = bounds(table)
    for m in ("capital_share", "mean_length"):
        assert len({b[f"max_{m}"] for b in before.values()}) > 10
    # Longer words, and words of more different lengths, in one source of one language.
    one = (F.col("lang") == "en") & (F.col("source") == "src3")
    longer = F.regexp_replace("text", "([a-z]{6,})", "$1$1")
    after = bounds(table.withColumn("text", F.when(one & (F.col("doc_id") % 3 == 0), longer).otherwise(F.col("text"))))
    moved = {k for k in before if abs(after[k]["max_mean_length"] - before[k]["max_mean_length"]) > 300}
    assert moved == {("en", "src3")}


def test_quality_acts_and_keeps_good_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(16)
    rows = written(quality.measured(table), "measured")
    limits = written(quality.thresholds(quality.sketches(rows)), "thresholds")
    judged = quality.judged(rows, limits).filter("NOT q.base_failed")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    counts = judged.select("doc.doc_id", "kept").join(labels, "doc_id").groupBy("quality").agg(
        F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("rejected")
    )
    found = {r.quality: (r.kept, r.rejected) for r in counts.collect()}
    assert found[1][1] == 0 and found[0][0] == 0
    joined = judged.join(limits, (F.col("lang") == F.col("_lang")) & (F.col("source") == F.col("_source")))
    acts = joined.agg(*[F.count_if(F.col(f"q.{m}") > F.col(f"max_{m}")).alias(m) for m in quality.MEASURES]).first()
    assert acts.symbol_share > 100 and acts.mean_length > 100


def test_rank_map_and_common_words_stay_out_of_plans_and_driver(spark, monkeypatch):
    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    random.seed(7)
    words = ["".join(random.choices("abcdeéß中-", k=random.randrange(1, 9))) for _ in range(3000)]
    texts = [" ".join(random.choices(words, k=50)) for _ in range(300)]
    sent = []
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda v, f=spark.sparkContext.broadcast: sent.append(v) or f(v))
    rows = byte_bpe.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), path, P.PATTERN)
    # The driver keeps the text of every plan, and every task carries what the plan holds.
    assert len(rows._jdf.queryExecution().toString()) < 100_000
    assert [type(v).__name__ for v in sent] == ["LargeBinaryArray"] and len(sent[0]) == 1 + max(byte_bpe.read_ranks(path).values())
    assert {r.doc.doc_id: r.ids for r in rows.collect()} == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_byte_bpe_looks_up_no_more_than_it_must(monkeypatch):
    import public_tokenizers as P
    import pyarrow as pa
    import regex

    # Words with signs at their end are cut without the pattern, as the pattern would cut them.
    texts = ["One, two.\nthree! it's 12, élan; (x) a.b ... don't'. 中文。 no?!", "", " ", ",", " a", "a,", " \n b. c:", "x's, y.'s q 's. e\u0301."] * 2
    seen = []
    find = regex.compile(P.PATTERN).findall
    monkeypatch.setattr(byte_bpe, "_splitter", lambda pattern: type("", (), {"findall": staticmethod(lambda t: seen.append(t) or find(t))}))
    numbers, sizes, words, order = byte_bpe._cut(pa.array(texts), P.PATTERN)
    assert " two.\nthree!" in seen and not {"One,", " élan;", " no?!", "a,"} & set(seen)
    words, ends = words.to_pylist(), [0, *itertools.accumulate(sizes.tolist())]
    assert len(set(words)) == len(words)
    assert [[words[order[i]] for n in some for i in range(ends[n], ends[n + 1])] for some in numbers.to_pylist()] == list(map(find, texts))
    for none in ([""], ["", ""], ["plain words"], ["ended. words,"]):
        assert len(byte_bpe._cut(pa.array(none), P.PATTERN)[2]) == len({w for t in none for w in find(t)})

    # Common words are looked up in the words of the block: what is laid out anew for each block does not grow with the corpus.
    common, laid = pa.array([f"w{i}" for i in range(50_000)]), []
    monkeypatch.setattr(byte_bpe.pc, "index_in", lambda v, value_set, f=byte_bpe.pc.index_in: laid.append(len(value_set)) or f(v, value_set))
    monkeypatch.setattr(byte_bpe, "_common", lambda paths: (common, pa.array([[i] for i in range(50_000)], pa.list_(pa.int32()))))
    sent = type("", (), {"value": byte_bpe.pieces_of({b"x": 0})})
    rows = [pa.record_batch([pa.array(range(len(t))), pa.array(t, pa.string())], ["key", "text"]) for t in (["w7 none w49999", "é"], [None], [])]
    made = list(byte_bpe._encoder(P.PATTERN, ("a",), sent)(iter(rows)))
    assert laid and max(laid) < 10
    spelt = [[ends * 257 + after for ends, after in zip(w, [*w[1:], 256])] for w in (b"w", b"7", b" none", b" w", b"49999", "é".encode())]
    assert sorted(made[0]["rare"][0].as_py()) == sorted(spelt) and made[1]["rare"][0].as_py() == [] and len(made) == 2


@pytest.mark.parametrize("room", [4, 0])
def test_rank_map_has_one_place_for_each_pair(monkeypatch, room):
    """Also where no room is left, and a start is taken at the end."""
    monkeypatch.setattr(byte_bpe, "ROOM", room)
    random.seed(5)
    ranks = {bytes([i]): i for i in range(256)}
    for _ in range(300):
        ranks.setdefault(random.choice(list(ranks)) + random.choice(list(ranks)), len(ranks))
    starts, slots = byte_bpe._rank_map(ranks)
    for a, i in ranks.items():
        for b, j in random.sample(sorted(ranks.items()), 100) + [(piece[len(a) :], ranks.get(piece[len(a) :])) for piece in ranks if piece.startswith(a)]:
            if j is not None:
                assert min(slots[starts[i] + j] ^ i << byte_bpe.BITS, byte_bpe.NONE) == ranks.get(a + b, byte_bpe.NONE)


def test_token_encoder_is_called_once_for_many_small_batches(monkeypatch):
    import public_tokenizers
    import pyarrow as pa

    path = public_tokenizers.path("word_bpe_49k.json")
    sizes = []
    monkeypatch.setattr(token_files.Encoder, "encode", lambda self, texts, end, f=token_files.Encoder.encode: sizes.append(len(texts)) or f(self, texts, end))
    texts = ["", None, "one two, three", "Élan vital " * 3, "x" * 100, "中文 text"] * 50
    run = token_files._encode(path, 1, None)
    batches = [pa.record_batch([pa.array([i, i + 1], pa.int64()), pa.array(texts[i : i + 2])], ["doc_id", "text"]) for i in range(0, 300, 2)]
    got = [row for batch in run(iter(batches)) for row in zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist())]
    assert sizes == [300]
    want = token_files._tokenizer(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert got == [(i, [*e.ids, 1]) for i, e in enumerate(want)]
    # A run holds no more than it should, whatever way the batches cut it; a longer text is in one run with what came before.
    monkeypatch.setattr(token_files, "RUN_BYTES", 40)
    sizes.clear()
    again = [row for batch in run(iter(batches)) for row in zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist())]
    assert again == got and len(sizes) > 50 and sum(sizes) == 300
    assert list(run(iter([]))) == [] == list(run(iter([batches[0].slice(0, 0)])))


@pytest.mark.parametrize("kind, top", [(">u2", 1 << 16), (">u4", 1 << 31)])
def test_packed_ids_keep_values_and_order(kind, top):
    import pyarrow as pa

    random.seed(3)
    lists = [[random.choice([0, 1, 255, 256, 257, top - 1]) for _ in range(random.randrange(5))] for _ in range(300)]
    packed = token_files._packed(pa.array([[9], *lists], token_files.IDS).slice(1), kind)
    for rows, some in ((packed, lists), (packed.slice(7, 90), lists[7:97]), (packed.slice(3, 0), [])):
        values, ends = token_files._values(rows, kind)
        assert values.tolist() == [i for ids in some for i in ids] and ends.tolist() == list(itertools.accumulate(map(len, some)))
    whole = pa.array(lists, pa.list_(pa.int32())).slice(7, 90)
    values, ends = token_files._values(whole, None)
    assert values.tolist() == [i for ids in lists[7:97] for i in ids] and ends.tolist() == list(itertools.accumulate(map(len, lists[7:97])))
    # Spark sorts binary values as bytes without a sign.
    order = sorted(range(300), key=lambda i: (packed[i].as_py(), i))
    assert [lists[i] for i in order] == sorted(lists)


def test_files_of_lists_and_of_packed_ids_are_equal(spark, docs):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    kind = token_files.kind_of(path, 1)
    assert kind == ">u2" and token_files.kind_of(path, 1 << 16) == ">u4"
    read = []
    for k in (None, kind, ">u4"):
        rows = written(token_files.encoded(docs, path, 1, k), "ids")
        files = token_files.write_files(rows, token_files.scratch(spark, "files"), k)
        read.append(sorted(map(repr, token_files.read_files(files).collect())))
    assert read[0] == read[1] == read[2] and len(read[0]) == docs.count()


def test_texts_without_secrets_stay_in_the_jvm(spark, monkeypatch):
    own = secret_scan.masked.func

    @F.pandas_udf("string")
    def strict(text, spans):
        if not all(t is None or s is not None for t, s in zip(text, spans)):
            raise ValueError("a text without findings was sent")
        return own(text, spans)

    monkeypatch.setattr(secret_scan, "masked", strict)
    texts = {1: "nothing here", 2: "password = hunter2hunter2 and more", 3: None, 4: ""}
    frame = spark.createDataFrame([*texts.items(), (2, texts[2])], "doc_id bigint, text string")
    rows = secret_scan.redacted(frame, scratch(spark, "ledger")).collect()
    masked = texts | {2: "[secret] and more"}
    assert sorted((r.doc_id, r.text or "") for r in rows) == sorted((i, masked[i] or "") for i in [1, 2, 2, 3, 4])
    assert {r.doc_id for r in rows if r.text is None} == {3}


def test_last_stage_hands_little_to_python_at_once(spark, monkeypatch):
    """However its rows are read: 600 texts of 4,000 characters would fit a block, and a batch."""
    texts = byte_bpe.texts

    def with_block(lists, pieces):
        return texts(lists, pieces) | {"n_tokens": pa.array([len(lists)] * len(lists), pa.int64())}

    monkeypatch.setattr(byte_bpe, "texts", with_block)
    whole = [f"{i:04} " + "word " * 799 for i in range(600)]
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(whole)], "doc_id int, text string, lang string, source string")
    rows = corpus_pipeline.tokens(spark, docs.coalesce(1), "").collect()
    assert {r.doc_id: r.text for r in rows} == dict(enumerate(whole)) and len(rows) == 600
    assert max(r.n_tokens for r in rows) < 300
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
