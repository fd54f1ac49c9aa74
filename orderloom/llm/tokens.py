"""Token ids as Parquet list columns that can be read in part.

Documents are range-partitioned and sorted by id, encoded in Arrow batches,
and written by Spark's Parquet writer: ids as a dictionary-encoded list
column, row groups and pages of set sizes, column and offset indexes in the
footer. A reader that needs lengths or offsets reads the metadata columns
only; one that needs some documents reads the pages that hold them.

Each file knows its number (``part``) and each document its offset inside the
file, so the offset in the whole corpus is a sum over one row per file.

Text is cut at spaces and newlines before it meets the tokenizer: its
pre-tokenizer never joins characters across white space, so the ids of a text
are the ids of its chunks in a row. Only words that are not in a worker's bounded
cache are encoded.

Defined cases: a null or empty text is the end id alone; a null id sorts after
all others; rows with one id follow each other by the hash of their text; an
empty table writes no documents; other columns are kept out of the files.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import BATCH_ROWS, id_order, per_worker
from orderloom.session import scratch_path

END_ID = 2
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
CACHED_WORDS = 500_000
JOINED_BYTES = 10 << 20
TOGETHER = 64
CACHED_CHARS = 64
SPECIAL = "<|"           # begins every special token
TAIL = ".,!?;:*%$#&|"

SCHEMA = "doc_id bigint, part int, first bigint, n_tokens bigint, ids array<int>"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of whole texts. Words are split, numbered and put together again by Arrow, in columns;
    Python sees each distinct chunk of a batch once, and the tokenizer each word not yet cached."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {"": b""}

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of each distinct word as 32-bit bytes."""
        cached = self.words
        out = list(map(cached.get, words))
        missing = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(missing, self._encoded([words[i] for i in missing])):
            out[i] = x
            if len(words[i]) <= CACHED_CHARS:
                cached[words[i]] = x
        if len(cached) > CACHED_WORDS:
            self.words = {"": b""}
        return out

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Words of letters go to the tokenizer ``TOGETHER`` at once, which tells their ids apart; others alone."""
        out: list = [None] * len(words)
        plain = [i for i, w in enumerate(words) if w.isalpha() and len(w) <= CACHED_CHARS]
        groups = [plain[at:at + TOGETHER] for at in range(0, len(plain), TOGETHER)]
        for group, x in zip(groups, self.tokenizer.encode_batch([" ".join([words[i] for i in g]) for g in groups], add_special_tokens=False)):
            cuts = [0, *(np.flatnonzero(np.diff(x.word_ids)) * 4 + 4).tolist(), 4 * len(x)]
            if len(cuts) == len(group) + 1:     # a word that folds to more than letters is several
                ids = array("I", x.ids).tobytes()
                for i, a, b in zip(group, cuts, cuts[1:]):
                    out[i] = ids[a:b]
        alone = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(alone, self.tokenizer.encode_batch_fast([words[i] for i in alone], add_special_tokens=False)):
            out[i] = array("I", x.ids).tobytes()
        return out

    def batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids end, and the ids of all texts in a row."""
        chunks = pc.split_pattern(pa.array([folded(t).replace("\n", " ") for t in texts], pa.large_string()), " ")
        coded = chunks.flatten().dictionary_encode()
        parts = words_and_tails(coded.dictionary).dictionary_encode()
        ids = self._ids(parts.dictionary.to_pylist())
        lists = pa.LargeListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids])))),
            pa.Array.from_buffers(pa.uint32(), sum(map(len, ids)) // 4, [None, pa.py_buffer(b"".join(ids))]))
        # a chunk's ids: those of its word, then those of its tail
        both = lists.take(parts.indices)
        ends = both.offsets.to_numpy()[::2]
        whole = pa.LargeListArray.from_arrays(pa.array(ends - ends[0]), both.flatten())
        values = whole.take(coded.indices).flatten().to_numpy()
        upto = np.concatenate(([0], np.cumsum(np.diff(ends)[coded.indices.to_numpy()])))
        return upto[chunks.offsets.to_numpy()[1:]], values


def folded(text: str) -> str:
    """Lower case where that is the tokenizer's own folding for sure: in texts of Latin-1 characters
    without ``SPECIAL``, as special tokens are matched before folding."""
    if SPECIAL in text:
        return text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


def folds_to_letters(word: str) -> bool:
    """Some letters fold to a letter and a mark, which joins the punctuation after it."""
    return unicodedata.normalize("NFC", word).lower().isalpha()


def words_and_tails(chunks: pa.Array) -> pa.Array:
    """For each chunk its word, then the punctuation that closes it, pre-tokens of their own; a chunk whose
    word is not of letters alone stays whole, with an empty tail."""
    word = pc.utf8_rtrim(chunks, TAIL)
    plain = pc.and_(pc.utf8_is_alpha(word), pc.string_is_ascii(word)).to_numpy(zero_copy_only=False)
    other = np.flatnonzero(pc.and_(pc.utf8_is_alpha(word), pc.not_equal(word, chunks)).to_numpy(zero_copy_only=False) & ~plain)
    plain[other] = [folds_to_letters(w) for w in word.take(pa.array(other)).to_pylist()]
    word = pc.if_else(pa.array(plain), word, chunks)
    closed = pa.array(np.flatnonzero(pc.not_equal(word, chunks).to_numpy(zero_copy_only=False)))
    tails = pa.array([c[n:] for c, n in zip(chunks.take(closed).to_pylist(), pc.utf8_length(word.take(closed)).to_pylist())], word.type)
    # number 0 is the empty tail
    which = np.zeros(len(chunks), np.int64)
    which[closed.to_numpy()] = np.arange(1, len(tails) + 1)
    both = pa.concat_arrays([word, pa.concat_arrays([pa.array([""], word.type), tails]).take(pa.array(which))])
    return both.take(pa.array(np.arange(2 * len(chunks)).reshape(2, -1).T.ravel()))


def _joined(batches):
    """Batches of at least ``JOINED_BYTES`` of text, so that words recur in them."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= JOINED_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if size:
        yield pa.concat_batches(held)


def _encoder(path: str) -> Encoder:
    return per_worker(("encoder", path), lambda: Encoder(path))


def write_tokens(docs: DataFrame, path: str, *, tokenizer: str | None = None, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text and write the files in ascending id order."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    model = tokenizer or default_tokenizer()
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .withColumns({"place": id_order(F.col("doc_id")), "tie": F.xxhash64("text")})
        .repartitionByRange("place", "tie").sortWithinPartitions("place", "tie").select("doc_id", "text"))

    def encode(batches):
        part, first = TaskContext.get().partitionId(), 0
        work = _encoder(model)
        for rows in _joined(batches):
            ends, ids = work.batch(rows.column(1).to_pylist())
            ids = np.insert(ids, ends, end_id).astype(np.int32)
            ends = ends + np.arange(1, len(ends) + 1)
            counts = np.diff(ends, prepend=0)
            for at in range(0, len(ends), BATCH_ROWS):
                some = slice(at, at + BATCH_ROWS)
                begin = int(ends[at] - counts[at])
                offsets = np.concatenate(([0], ends[some] - begin)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    rows.column(0)[some], pa.array(np.full(len(offsets) - 1, part, np.int32)), pa.array(first + ends[some] - counts[some]),
                    pa.array(counts[some]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[begin:begin + int(offsets[-1])])),
                ], names=["doc_id", "part", "first", "n_tokens", "ids"])
            first += int(ends[-1])

    (ordered.mapInArrow(encode, SCHEMA).write
     .option("compression", "zstd")
     .option("parquet.block.size", ROW_GROUP_BYTES)
     .option("parquet.page.size", PAGE_BYTES)
     .option("parquet.enable.dictionary", "true")
     .parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def part_offsets(tokens: DataFrame) -> DataFrame:
    """(part, before): ids of all earlier files; reads the metadata columns only, one row per file."""
    per = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    return per.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))


def token_digests(tokens: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32."""
    def digest(batches):
        for batch in batches:
            lists = batch.column(3)
            offsets = lists.offsets.to_numpy()
            values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4").view(np.uint8)
            crc = [zlib.crc32(values[a * 4:b * 4]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "part", "first", "n_tokens", "ids_crc32"])

    read = tokens.select("doc_id", "part", "first", "ids").mapInArrow(
        digest, "doc_id bigint, part int, first bigint, n_tokens bigint, ids_crc32 bigint")
    # one row per file: its size is bounded by the number of files
    return (read.join(F.broadcast(part_offsets(tokens)), "part")
            .select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"))


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write under the shared checkpoint folder, read the files back, return their digests."""
    spark = docs.sparkSession
    path = scratch_path(spark, "llm-tokens")
    write_tokens(docs, path, **options)
    return token_digests(read_tokens(spark, path))
