"""Phrase collocations by dynamic itemset counting.

The texts are cut into pieces and words once and stored in ``SHARDS`` shards of like size,
as rows of a bounded number of words of one language: their distinct words, and a number
for each word in order (0 ends a piece). The shards are scanned in a cycle, all phrase
lengths together. Words count from the first scan on. A longer phrase is active from the
scan after the one in which the later of its two subphrases (without its last, without its
first word) reached the threshold, and is complete once it has seen each shard once, so
every active phrase ends with its exact number of occurrences.

A scan counts phrases by a short number of ``NUMBER_BITS`` bits, a hash of language and words: a task
sorts and sums the numbers it met and deals them, in blobs of sorted differences, to parts of the range of
numbers; a part sums the scans of the last cycle and names the numbers that reached the threshold. Phrases
that share a number add up, so a reached number may be none of a frequent phrase, but no frequent phrase
lacks one. Tasks learn what is reached from two Bloom filters of bounded size: all numbers that are, and
those that were in the last cycle (a phrase of which both subphrases are older is complete). Errors of the
filters cost a counter as well. When nothing counts any more, the phrases of reached numbers are counted
exactly, by the phrase itself and over all shards, and those below the threshold go; a task joins the phrases
it sends to one part in one row.

Defined cases: a null text is empty; a null language is ``und``; a text without words
counts nothing; very long texts are cut between pieces, and inside a piece with the words
that phrases across the cut need; repeated rows count each; an empty table gives an empty
one; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.common import BATCH_ROWS, arrow_rows, compact, stored, text_bytes
from orderloom.llm.near_dedup import mix
from orderloom.session import scratch_path

LEAST, LONGEST = 30, 4
PERCENT, TOP, SCALE = 80, 2000, 2_000_000
SHARDS = 2
UNKNOWN = "und"
#: words in one stored row, all languages that a task holds at most, and bits of a filter at most
ROW_WORDS, HELD_WORDS, MOST_BITS = 800_000, 2_000_000, 1 << 28
PROBES = 4
#: bits of the numbers that phrases are counted by; their last one tells the longest phrases, which are no subphrases
NUMBER_BITS = 40
#: numbers, or rows of exact counts, that a task holds before it sums or sends them; words of a shard for each part
HELD_NUMBERS, HELD_COUNTS, PART_WORDS = 4_000_000, 1_000_000, 500_000
#: powers of two of parts, at least and at most, and by how much fewer the exact counts need, which languages and lengths part too
PARTS, WIDER = (6, 13), 3
#: frequent phrases up to which their counts are shipped to the joins of the scores
SHIPPED_PHRASES = 100_000

#: fixed values: what ends a piece, and what parts words inside one
_CUT = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")


# ---- texts as numbered words

def cut_words(text: bytes) -> list[bytes]:
    """The words of all pieces; ``b"\\n"`` ends a piece."""
    return re.findall(rb"\n|[^ \n]+", text.lower().translate(_CUT))


def _rows_of(words: list[bytes]):
    """Parts of at most ``ROW_WORDS`` words; the last words of a part that is cut inside a piece come again,
    where they only begin phrases that the part before lacks."""
    for at in range(0, len(words), ROW_WORDS):
        part = words[at:at + ROW_WORDS]
        after = words[at + ROW_WORDS:at + ROW_WORDS + LONGEST - 1]
        yield part, after


def encoded(docs: DataFrame, shards: int) -> DataFrame:
    """shard, lang, words (distinct), codes (int32, 0 between pieces), own: how many codes begin phrases of this row,
    n_words: how many of these are words."""

    def run(batches):
        held, count, row = {}, 0, TaskContext.get().partitionId()

        def emit(lang, words):
            nonlocal row
            for part, after in _rows_of(words):
                every = part + after
                names = {w: i for i, w in enumerate(dict.fromkeys([b"\n", *every]))}
                codes = np.fromiter(map(names.__getitem__, every), np.int32, len(every))
                own = [w.decode("utf-8", "replace") for w in names]
                yield pa.RecordBatch.from_arrays([pa.array([row % shards], pa.int32()), pa.array([lang]), pa.array([own], pa.list_(pa.string())),
                                                  pa.array([codes.tobytes()], pa.binary()), pa.array([len(part)], pa.int32()),
                                                  pa.array([np.count_nonzero(codes[:len(part)])], pa.int32())],
                                                 names=["shard", "lang", "words", "codes", "own", "n_words"])
                row += 1

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                words = cut_words(text)
                own = held.setdefault(lang, [])
                own += words
                own.append(b"\n")
                count += len(words) + 1
                if len(own) >= ROW_WORDS:
                    yield from emit(lang, held.pop(lang))
                    count -= len(own)
                elif count > HELD_WORDS:
                    for x in list(held):
                        yield from emit(x, held.pop(x))
                    count = 0
        for x, words in held.items():
            yield from emit(x, words)

    return docs.select("lang", "text").mapInArrow(run, "shard int, lang string, words array<string>, codes binary, own int, n_words int")


# ---- numbers of phrases

def extended(before: np.ndarray, words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of phrases of ``length`` words, from those of all but the last word (the language's, for one word)."""
    return mix(before ^ words) + np.uint64(length)


def short(hashes: np.ndarray, length: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - NUMBER_BITS)) & ~np.uint64(1) | np.uint64(length == LONGEST)


def summed(numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, ascending, and the sums of their counts."""
    order = np.argsort(numbers, kind="stable")
    numbers = numbers[order]
    first = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]])[:len(numbers)])
    return numbers[first], np.add.reduceat(counts[order], first) if len(first) else counts


def packed(numbers: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending numbers as differences, and counts, each byte of them in a run of its own."""
    steps = np.diff(numbers, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :NUMBER_BITS // 8]
    return pa.compress(np.concatenate([steps.T.ravel(), counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.ravel()]).tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    width = NUMBER_BITS // 8
    planes = np.frombuffer(pa.decompress(blob, n * (width + 4), codec="zstd", asbytes=True), np.uint8).reshape(width + 4, n)
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :width] = planes[:width].T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64), np.ascontiguousarray(planes[width:].T).view("<u4").ravel().astype(np.int64)


BLOBS = "part int, scan int, n bigint, subs bigint, blob binary"
#: the ``scan`` of a blob that holds reached numbers
REACHED = -1


def blob_row(part: int, scan: int, numbers: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    subs = int(np.count_nonzero(numbers & np.uint64(1) == 0))
    return pa.RecordBatch.from_pylist([{"part": part, "scan": scan, "n": len(numbers), "subs": subs, "blob": packed(numbers, counts)}],
                                      pa.schema([("part", pa.int32()), ("scan", pa.int32()), ("n", pa.int64()), ("subs", pa.int64()), ("blob", pa.binary())]))


# ---- filters of reached numbers

class Filter:
    """A Bloom filter of a power of two of bits."""

    def __init__(self, bits: int):
        self.bits = np.zeros(bits // 8, np.uint8)

    def _places(self, hashes: np.ndarray):
        mask = np.uint64(len(self.bits) * 8 - 1)
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        for i in range(PROBES):
            yield (hashes + np.uint64(i) * step) & mask

    def add(self, hashes: np.ndarray) -> None:
        for at in self._places(hashes):
            np.bitwise_or.at(self.bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in self._places(hashes):
            found &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0
        return found


def filter_of(blobs: DataFrame, n: int) -> Filter:
    """The filter of the numbers in ``blobs``: 16 bits for each of the ``n``, at most ``MOST_BITS``."""
    size = min(MOST_BITS, 1 << max(10, (16 * n).bit_length()))

    def run(batches):
        own = Filter(size)
        for batch in batches:
            for n, blob in zip(*(c.to_pylist() for c in batch.columns)):
                own.add(mix(unpacked(blob, n)[0]))
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(own.bits.tobytes(), 1)], pa.binary())], names=["bits"])

    out = Filter(size)
    # one bounded bitmap of each task at a time
    for row in blobs.select("n", "blob").coalesce(8).mapInArrow(run, "bits binary").toLocalIterator():
        out.bits |= np.frombuffer(zlib.decompress(row.bits), np.uint8)
    return out


# ---- scans

def walk(lang: str, words: list[str], codes: np.ndarray, reached: Filter | None, late: Filter | None):
    """(length, where, numbers, was, lately): the phrases of each length whose two subphrases are reached, where they begin,
    whether they are reached themselves, and whether one of the two was reached lately."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    whole = extended(np.full(len(words), xxhash.xxh3_64_intdigest(lang), np.uint64), hashes, 1)
    at = np.flatnonzero(codes)
    numbers = short(whole, 1)
    has = lambda f, numbers: np.zeros(len(numbers), bool) if f is None else f.has(mix(numbers))
    was, new = has(reached, numbers), has(late, numbers)
    numbers, was, new, before = numbers[codes[at]], was[codes[at]], new[codes[at]], whole[codes]
    yield 1, at, numbers, was, None
    for length in range(2, LONGEST + 1):
        # a phrase's first and last subphrase begin at neighbouring words
        old, lately = np.zeros(len(codes) + 1, bool), np.zeros(len(codes) + 1, bool)
        old[at], lately[at] = was, new & was
        at = np.flatnonzero(old[:-1] & old[1:])
        if not len(at):
            return
        found = extended(before[at], hashes[codes[at + length - 1]], length)
        before = np.zeros(len(codes), np.uint64)
        before[at] = found
        numbers = short(found, length)
        was = has(reached, numbers)
        yield length, at, numbers, was, lately[at] | lately[at + 1]
        new = has(late, numbers)


def scan(rows: DataFrame, step: int, bits: int, count_words: bool, least: int, filters) -> DataFrame:
    """``BLOBS``: how often the active phrases' numbers come in one shard, up to ``least``, in 2 ** ``bits`` parts."""

    def run(batches):
        held, size = [], 0

        def sums():
            numbers, counts = summed(*(np.concatenate(x) for x in zip(*held)))
            return numbers, np.minimum(counts, least)

        def sent() -> Iterator[pa.RecordBatch]:
            numbers, counts = sums()
            ends = np.searchsorted(numbers >> np.uint64(NUMBER_BITS - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
            for part in np.flatnonzero(np.diff(ends)):
                some = slice(ends[part], ends[part + 1])
                yield blob_row(int(part), step, numbers[some], counts[some])

        for batch in batches:
            for lang, words, codes, own in zip(*(c.to_pylist() for c in batch.columns)):
                for length, at, numbers, _, lately in walk(lang, words, np.frombuffer(codes, np.int32), *filters.value):
                    mine = at < own
                    if length > 1:
                        mine &= lately
                    elif not count_words:
                        continue
                    held.append((numbers[mine], np.ones(np.count_nonzero(mine), np.int64)))
                    size += len(held[-1][0])
                    if size > HELD_NUMBERS:
                        held = [sums()]
                        size = len(held[0][0])
                        if 2 * size > HELD_NUMBERS:
                            yield from sent()
                            held, size = [], 0
        if size:
            yield from sent()

    return rows.select("lang", "words", "codes", "own").mapInArrow(run, BLOBS)


def merged(blobs: DataFrame, step: int, least: int) -> DataFrame:
    """``BLOBS`` of one part each: what this scan counted, and the numbers that have reached ``least`` with it."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        by: dict[bool | int, list] = {}
        for at, n, blob in zip(*(table.column(c).to_pylist() for c in ("scan", "n", "blob"))):
            by.setdefault(REACHED if at == REACHED else at == step, []).append(unpacked(blob, n))
        joined = lambda parts: tuple(np.concatenate(x) for x in zip(*parts))
        none = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        own = summed(*joined(by.get(True, none)))
        numbers, counts = summed(*joined([own, *by.get(False, none)]))
        known = joined(by.get(REACHED, none))[0]
        new = np.setdiff1d(numbers[counts >= least], known, assume_unique=True)
        # what is reached needs no count any more
        still = ~np.isin(own[0], np.concatenate([known, new]))
        out = [blob_row(part, step, own[0][still], np.minimum(own[1][still], least)), blob_row(part, REACHED, np.sort(new), np.ones(len(new), np.int64))]
        return pa.Table.from_batches([b for b in out if b.column("n")[0].as_py()], out[0].schema)

    return blobs.groupBy("part").applyInArrow(run, BLOBS)


def exact_counts(rows: DataFrame, bits: int, least: int, filters) -> DataFrame:
    """(lang, k, phrase, n): the phrases of reached numbers that come ``least`` times, with all their occurrences."""
    names = ["lang", "k", "part"]

    def run(batches):
        held, size = [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            whole = pa.concat_tables(held).group_by([*names, "phrase"]).aggregate([("n", "sum")]).sort_by([(x, "ascending") for x in names]).combine_chunks()
            codes = np.stack([whole.column("lang").chunk(0).dictionary_encode().indices.to_numpy(), *(whole.column(x).to_numpy() for x in names[1:])])
            starts = np.flatnonzero(np.concatenate([[True], (codes[:, 1:] != codes[:, :-1]).any(axis=0)]))
            keys = whole.take(pa.array(starts)).combine_chunks()
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(starts, len(whole)), pa.int32()), whole.column("phrase").chunk(0)), "\n")
            counts = [x.astype("<i8").tobytes() for x in np.split(whole.column("n_sum").to_numpy(), starts[1:])]
            phrases = [pa.compress(x.as_buffer(), codec="zstd", asbytes=True) for x in texts]
            sizes = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*(keys.column(x).chunk(0) for x in names), sizes, pa.array(phrases, pa.binary()),
                                              pa.array([len(x) // 8 for x in counts], pa.int64()),
                                              pa.array([pa.compress(x, codec="zstd", asbytes=True) for x in counts], pa.binary())],
                                             names=[*names, "bytes", "phrases", "n", "counts"])

        for batch in batches:
            for lang, words, codes, own in zip(*(c.to_pylist() for c in batch.columns)):
                texts, codes = pa.array(words, pa.string()), np.frombuffer(codes, np.int32)
                for length, at, numbers, was, _ in walk(lang, words, codes, filters.value, None):
                    mine = was & (at < own)
                    if not mine.any():
                        continue
                    at, numbers = at[mine], numbers[mine]
                    columns = [codes[at + i].astype(np.int64) for i in range(length)]
                    # the distinct phrases of a row, exactly: pairs of numbers, one word at a time
                    number = columns[0]
                    for column in columns[1:]:
                        number = np.unique(number, return_inverse=True)[1] * len(words) + column
                    _, first, counts = np.unique(number, return_index=True, return_counts=True)
                    parts = [texts.take(pa.array(c[first])) for c in columns]
                    phrase = pc.binary_join_element_wise(*parts, " ") if length > 1 else parts[0]
                    held.append(pa.table([pa.array([lang] * len(first), pa.string()), pa.array(np.full(len(first), length, np.int32)),
                                          pa.array((numbers[first] >> np.uint64(NUMBER_BITS - bits)).astype(np.int32)), phrase,
                                          pa.array(counts.astype(np.int64))], names=[*names, "phrase", "n"]))
                    size += len(first)
                if size > HELD_COUNTS:
                    yield from sent()
                    held, size = [], 0
        if size:
            yield from sent()

    def merge(table: pa.Table) -> pa.Table:
        texts = [pa.decompress(x, n, codec="zstd", asbytes=True).decode() for x, n in zip(table.column("phrases").to_pylist(), table.column("bytes").to_pylist())]
        # a word holds no end of line
        phrases = pc.list_flatten(pc.split_pattern(pa.array(texts, pa.large_string()), "\n")).cast(pa.string())
        counts = [np.frombuffer(pa.decompress(x, 8 * n, codec="zstd", asbytes=True), "<i8") for x, n in zip(table.column("counts").to_pylist(), table.column("n").to_pylist())]
        sums = pa.table([phrases, pa.array(np.concatenate(counts))], names=["phrase", "n"]).group_by("phrase", use_threads=False).aggregate([("n", "sum")])
        sums = sums.filter(pc.greater_equal(sums.column("n_sum"), least))
        lang, k = (table.column(x)[0].as_py() for x in ("lang", "k"))
        return pa.table([pa.array([lang] * len(sums), pa.string()), pa.array([k] * len(sums), pa.int32()), sums.column("phrase"), sums.column("n_sum")],
                        names=["lang", "k", "phrase", "n"])

    found = rows.select("lang", "words", "codes", "own").mapInArrow(
        run, "lang string, k int, part int, bytes bigint, phrases binary, n bigint, counts binary")
    return found.groupBy("lang", "k", "part").applyInArrow(merge, "lang string, k int, phrase string, n bigint")


def part(phrase: Column, k: Column, first: Column, n: Column) -> Column:
    """``n`` words of a phrase of ``k`` words, from the ``first`` (0) on."""
    return F.array_join(F.slice(F.split(phrase, " "), first + 1, n), " ")


def _all(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for more in frames[1:]:
        whole = whole.unionByName(more)
    return whole


def frequent_phrases(docs: DataFrame, *, least: int = LEAST, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, n) of all words and phrases with ``n`` >= ``least``, and (lang, n): all words."""
    spark: SparkSession = docs.sparkSession
    path, coded = scratch_path(spark, "llm-phrase-words"), encoded(docs, shards)
    with arrow_rows(spark, BATCH_ROWS):
        coded.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    rows = spark.read.schema(coded.schema).parquet(path)
    words = rows.groupBy("lang").agg(F.sum("n_words").alias("n"))
    total = rows.agg(F.sum("n_words")).first()[0] or 0
    bits = min(max((total // shards // PART_WORDS).bit_length(), PARTS[0]), PARTS[1])
    states, sizes, reached_n = [], [], 0
    reached, filters = None, []
    step = 0
    # on while something counts: words in the first cycle, phrases of what was reached in the last one
    while step < shards or any(sizes[-shards:]):
        own = rows.where(F.col("shard") == step % shards)
        late = _joined([f for f in filters[-shards:] if f])
        shared = spark.sparkContext.broadcast((reached, late))
        # only the last cycle counts for what is not complete
        before = [b.where((F.col("scan") == REACHED) | (F.col("scan") > step - shards)) for b in states]
        with arrow_rows(spark, 1):
            states.append(stored(merged(_all([scan(own, step, bits, step < shards, least, shared), *before]), step, least), "phrase-scan"))
        shared.destroy()
        new = states[-1].where(F.col("scan") == REACHED)
        n, subs = (x or 0 for x in new.agg(F.sum("n"), F.sum("subs")).first())
        reached_n += n
        sizes.append(subs)
        filters.append(filter_of(new, n) if n else None)
        reached = _joined([f for f in (reached, filters[-1]) if f])
        filters = filters[-shards:]
        step += 1
    shared = spark.sparkContext.broadcast(filter_of(_all(states).where(F.col("scan") == REACHED), reached_n))
    with arrow_rows(spark, 1):
        whole = stored(exact_counts(rows, max(bits - WIDER, PARTS[0]), least, shared), "phrase-totals")
    shared.destroy()
    return whole, words


def _joined(filters: list[Filter]) -> Filter | None:
    """One filter of the size of the largest; a smaller one is repeated, as its places are remainders."""
    if not filters:
        return None
    size = max(len(f.bits) for f in filters)
    out = Filter(size * 8)
    for f in filters:
        out.bits |= np.tile(f.bits, size // len(f.bits))
    return out


# ---- scores

def exact(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def whole_quotient(wanted: Column, d: Column) -> Column:
    """floor(wanted / d), whatever the division rounds to."""
    q = F.floor(wanted / d).cast("long")
    return q + F.when((exact(q) + 1) * d <= wanted, 1).when(exact(q) * d > wanted, -1).otherwise(0)


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, shards: int = SHARDS,
                 top: int | None = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases (None: all)."""
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    with compact(docs.sparkSession):
        whole, words = frequent_phrases(texts, least=least, shards=shards)
    phrases = whole.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"))
    counted = F.broadcast(whole) if whole.count() <= SHIPPED_PHRASES else whole

    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    k = F.col("k")
    cuts = cuts.withColumns({"head": part(F.col("phrase"), k, F.lit(0), F.col("cut")), "tail": part(F.col("phrase"), k, F.col("cut"), k - F.col("cut"))})
    of = lambda name, n: counted.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    cuts = cuts.join(of("head", "l"), ["lang", "head"]).join(of("tail", "r"), ["lang", "tail"])
    score = whole_quotient(exact(F.lit(SCALE)) * exact(F.col("a")), exact(F.col("l")) + exact(F.col("r")))
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("least"))

    longer = (phrases.where("k > 2").withColumn("size", F.explode(F.sequence(F.lit(2), k - 1)))
              .withColumn("at", F.explode(F.sequence(F.lit(0), k - F.col("size"))))
              .groupBy("lang", part(F.col("phrase"), k, F.col("at"), F.col("size")).alias("phrase")).agg(F.max("a").alias("inside")))
    inside = exact(F.coalesce("inside", F.lit(0))) * 100 >= exact(F.col("a")) * PERCENT
    kept = best.join(longer, ["lang", "phrase"], "left").where(~inside).select("lang", "phrase", "a", "least.l", "least.r", "least.score")
    ranked = kept.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
