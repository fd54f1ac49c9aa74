"""Benchmark decontamination: a broadcast set of normalised n-grams meets every text.

The windows of the benchmark (``n`` consecutive words of an item; a shorter
item is one window) are numbered word by word. A task turns a document's
words into those numbers (0: not a word of the benchmark), looks the rolling
hash of every run of known words up in the set, and verifies each hit on the
words themselves. What travels to the tasks is one block of the benchmark of
at most ``block_bytes`` of ids and text. A larger benchmark makes more blocks, and each
one passes over the documents alone and is dropped after that; the hits of all passes are
stored and merged by row. So what the driver (two blocks) and a worker (one)
hold does not grow with the benchmark, the number of passes does.

Defined cases: null or empty texts and items have no words; an item without
words has no window; equal items and repeated ids count once per id; the hits
of an item whose id is null count as hits, the id is not listed; an empty
benchmark leaves every document clean; other columns are kept.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import BATCH_ROWS, as_doc, map_texts, stored, text_bytes, undoc
from orderloom.session import scratch_path

N_WORDS = 10
BLOCK_BYTES = 2 << 20
HITS = "row bigint, spans array<int>, items array<string>"

# A-Z to lower case; every other ASCII byte but 0-9 and a-z ends a word
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def word_spans(text: bytes) -> list[tuple[int, int]]:
    return [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_FOLD))]


def _rolled(ids: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    h = np.zeros(len(starts), np.uint64)
    for j in range(length):
        h = (h ^ ids[starts + j].astype(np.uint64)) * _MULTIPLIER
        h ^= h >> np.uint64(29)
    return h


class WindowSet:
    """The windows of one block of the benchmark."""

    def __init__(self, items: list[tuple[str | None, bytes]], n: int = N_WORDS):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[int, dict[bytes, set]] = defaultdict(lambda: defaultdict(set))
        for item_id, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)], np.int32)
            length = min(n, len(ids))
            for i in range(len(ids) - length + 1 if length else 0):
                owners[length][ids[i:i + length].tobytes()].add(item_id)
        self.by_length = []
        for length, found in sorted(owners.items()):
            flat = np.frombuffer(b"".join(found), np.int32)
            hashes = _rolled(flat, np.arange(len(found)) * length, length)
            self.by_length.append((length, np.unique(hashes), {w: sorted(x for x in ids if x is not None) for w, ids in found.items()}))

    def scan(self, text_words: list[bytes]) -> tuple[np.ndarray | None, set[str]]:
        """Which words are hit (None: none are), and the items with occurring windows."""
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in text_words], np.int32)
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))
        hit, items = None, set()
        for length, hashes, owners in self.by_length:
            if len(ids) < length:
                continue
            starts = np.flatnonzero(unknown[length:] == unknown[:-length])
            if not len(starts):
                continue
            h = _rolled(ids, starts, length)
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for i in starts[hashes[at] == h]:
                owned = owners.get(ids[i:i + length].tobytes())
                if owned is not None:
                    hit = np.zeros(len(ids), bool) if hit is None else hit
                    hit[i:i + length] = True
                    items.update(owned)
        return hit, items


def _spans(hit: np.ndarray) -> np.ndarray:
    """Start and end (exclusive) of every run of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return edge.reshape(-1, 2)


def _without(text: bytes, spans: np.ndarray) -> bytes:
    at, kept, last = word_spans(text), [], 0
    for a, b in spans:
        kept.append(text[last:at[a][0]])
        last = at[b - 1][1]
    return b"".join([*kept, text[last:]])


def pieces(text: bytes, n: int, limit: int) -> list[bytes]:
    """A text cut between words into pieces of at most ``limit`` bytes that hold all of its windows, and no other.

    Only a piece of a single window can be longer.
    """
    if len(text) <= limit:
        return [text]
    spans = word_spans(text)
    starts, out, a = max(1, len(spans) - n + 1) if spans else 0, [], 0
    while a < starts:  # a piece holds the windows that start at a to b - 1
        b = a + 1
        while b < starts and spans[b + n - 1][1] - spans[a][0] <= limit:
            b += 1
        out.append(text[spans[a][0]:spans[min(b - 1 + n, len(spans)) - 1][1]])
        a = b
    return out


def benchmark_blocks(benchmark: DataFrame, n: int = N_WORDS, block_bytes: int = BLOCK_BYTES,
                     id_col: str = "item_id", text_col: str = "text"):
    """One ``WindowSet`` after the other, each of at most ``block_bytes`` of ids and text.

    Long items are cut, equal rows are taken once. A block is made when it is asked for; the
    driver holds it and one partition of the pieces.
    """
    def cut(batches):
        for batch in batches:
            found = [(i, p) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())
                     for p in pieces(t, n, block_bytes // 4)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.string()), pa.array([p for _, p in found], pa.binary())], names=["id", "text"])

    benchmark.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    rows = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where(F.octet_length("text") > 0)
    held, size = [], 0
    for r in rows.mapInArrow(cut, "id string, text binary").distinct().toLocalIterator():
        more = len(r["text"]) + len(r["id"] or "")
        if held and size + more > block_bytes:
            yield WindowSet(held, n)
            held, size = [], 0
        held.append((r["id"], bytes(r["text"])))
        size += more
    if held:
        yield WindowSet(held, n)


def _columns(texts: list[bytes], found: list[tuple], remove_spans: bool) -> list[pa.Array]:
    """The added columns from (number of words, hit or None, items) of each text."""
    columns = [pa.array([n for n, _, _ in found], pa.int64()),
               pa.array([0 if hit is None else int(hit.sum()) for _, hit, _ in found], pa.int64()),
               pa.array([sorted(items) for _, _, items in found], pa.list_(pa.string()))]
    if remove_spans:
        clean = [(t if hit is None else _without(t, _spans(hit))).decode("utf-8", "replace") for t, (_, hit, _) in zip(texts, found)]
        columns.append(pa.array(clean, pa.string()))
    return columns


def _pass(texts: DataFrame, block: WindowSet) -> str:
    """Where (row, spans: starts and ends in turn, items) of the texts (row, text) that hold windows of ``block`` are written."""
    spark = texts.sparkSession
    shared, path = spark.sparkContext.broadcast(block), scratch_path(spark, "llm-contamination-hits")

    def scan(batches):
        for batch in batches:
            out = []
            for row, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                hit, items = shared.value.scan(words(text))
                if hit is not None:
                    out.append((row, _spans(hit).ravel().tolist(), sorted(items)))
            rows, spans, items = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                                             names=["row", "spans", "items"])

    texts.mapInArrow(scan, HITS).write.parquet(path)
    shared.destroy()
    return path


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, n: int = N_WORDS, text_col: str = "text",
                       block_bytes: int = BLOCK_BYTES, remove_spans: bool = False) -> DataFrame:
    """``doc`` with n_words, n_hit, items (ids as text, sorted), and ``clean_text`` if spans are to be removed."""
    spark = docs.sparkSession
    added = "n_words bigint, n_hit bigint, items array<string>" + (", clean_text string" if remove_spans else "")
    blocks = benchmark_blocks(benchmark, n, block_bytes)
    only, second = next(blocks, None) or WindowSet([], n), next(blocks, None)
    if second is None:
        shared = spark.sparkContext.broadcast(only)

        def start():
            block = shared.value

            def work(texts: list[bytes]) -> list[pa.Array]:
                split = [words(t) for t in texts]
                return _columns(texts, [(len(w), *block.scan(w)) for w in split], remove_spans)

            return work

        return map_texts(docs, text_col, added, start)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    rows = stored(as_doc(docs).withColumn("row", F.monotonically_increasing_id()), "contamination-rows")
    texts = rows.select("row", F.col(f"doc.`{text_col}`").alias("text"))
    paths = [_pass(texts, only), _pass(texts, second)]
    del only, second
    for block in blocks:
        paths.append(_pass(texts, block))
    merged = spark.read.schema(HITS).parquet(*paths).groupBy("row").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    at = docs.columns.index(text_col)

    def finish(batches):
        for batch in batches:
            doc, found = batch.column(0), []
            texts = text_bytes(doc.field(at))
            for text, spans, items in zip(texts, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                size = len(words(text))
                hit = np.zeros(size, bool) if spans else None
                for a, b in zip(spans[::2], spans[1::2]) if spans else ():
                    hit[a:b] = True
                found.append((size, hit, items or ()))
            yield pa.RecordBatch.from_arrays([doc, *_columns(texts, found, remove_spans)], names=schema.names)

    frame = rows.join(merged, "row", "left").select("doc", "spans", "items")
    schema = T.StructType([frame.schema["doc"], *T._parse_datatype_string(added).fields])
    return frame.mapInArrow(finish, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit, with their own columns."""
    return undoc(find_contamination(docs, benchmark, **options).where(F.col("n_hit") == 0), docs)


