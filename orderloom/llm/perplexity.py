"""Quality rules: counts of a text, and its perplexity under a language's own n-gram model.

The model is a modified Kneser-Ney model of byte n-grams up to ``ORDER`` for each value of
the language column (words joined by one space, A-Z lower-cased). Texts fall into two halves
by their hash, and a text is scored by the model of the other half: one that has learned a
strange text by heart would find nothing strange in it, and copies share a half. Tasks count
the highest order of every whole text, Spark sums the counts; the lower orders count distinct left
neighbours, and discounts, totals and interpolated probabilities are joins and windows
over these tables. A window is at most the 255 followers of one context. The n-grams are
packed into one long each, so no two of them share a key.

Scoring looks the n-grams up in sorted hash arrays: mixed keys in order with an index by
their leading bits, beside fixed-point values of -log2 (``ONE`` to the bit). They are shipped
to the tasks only if the model has at most ``SHIPPED_ROWS`` rows; a larger one stays a table
that the distinct n-grams of the texts are joined with, order by order. Sums of fixed-point
values do not depend on order, so both ways and all reruns agree to the last digit.

A language's band is the median of bits per byte of its documents that pass the base rules,
plus and minus ``WIDTH`` spreads; the spread is the median distance to the median, at least
``LEAST_SPREAD``. Below ``STEADY_BYTES`` bytes the band widens as chance does. A language with
fewer than ``LEAST_DOCUMENTS`` such documents has no band: the base rules alone judge its
documents. Both quantiles are exact, from a histogram in thousandths of a bit.

Defined cases: a null text has no words; a text without words has no n-grams and fails the
base rules; a null language is ``und``; rows of one id are judged each by its own text; very
long texts are counted and scored in pieces that overlap; an empty table gives an empty one;
other columns are kept, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orderloom.llm.common import BATCH_ROWS, arrow_rows, as_doc, compact, per_worker, stored, text_bytes, undoc
from orderloom.llm.langid import _Shared
from orderloom.llm.near_dedup import mix

ORDER = 5
SYMBOLS = 255
ONE = 1 << 16
#: fixed values: what the base rules count and require
SIGNS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50
WIDTH, LEAST_SPREAD, LEAST_DOCUMENTS, STEADY_BYTES = 15.0, 20, 50, 2048
SHIPPED_ROWS = 8_000_000
PIECE = 1 << 18
#: distinct n-grams that a task holds before it passes their counts on
HELD_GRAMS = 1_000_000
UNKNOWN = "und"

_FOLD = bytes([1, *range(1, 65), *range(97, 123), *range(91, 256)])
_PAD = bytes(ORDER - 1)


# ---- texts

def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    chars = sum(map(len, words)) if text.isascii() else len(b"".join(words).decode("utf-8", "replace"))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), chars, sum(text.count(s.encode()) for s in SIGNS), len(lines) - len(set(lines)), repeated_words(words))


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    inside = np.zeros(len(words), bool)
    at = np.flatnonzero(np.fromiter((often[w] > 1 for w in windows), bool, len(windows)))
    for shift in range(3):
        inside[at + shift] = True
    return int(inside.sum())


def symbols(words: list[bytes]) -> bytes:
    return b" ".join(words).translate(_FOLD)


def packed(data: np.ndarray) -> np.ndarray:
    """The n-gram of ``ORDER`` symbols that ends at each symbol from the (ORDER - 1)-th on."""
    one = data.astype(np.uint64)
    grams = one[ORDER - 1:].copy()
    for back in range(1, ORDER):
        grams |= one[ORDER - 1 - back:len(one) - back] << np.uint64(8 * back)
    return grams


def pieces(data: np.ndarray):
    """(first, n-grams) of overlapping pieces of texts that each follow a pad."""
    for first in range(0, max(0, len(data) - ORDER + 1), PIECE):
        yield first, packed(data[first:first + PIECE + ORDER - 1])


def padded(texts: list[bytes]) -> np.ndarray:
    return np.frombuffer(_PAD + _PAD.join(texts), np.uint8)


# ---- counts and model

def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, counts = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(grams, kind="stable")
    grams = grams[order]
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    return grams[first], np.add.reduceat(counts[order], first)


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over every whole text of ``docs`` (lang, text)."""

    def count(batches):
        held: dict = {}

        def size():
            return sum(len(g) for own in held.values() for g, _ in own)

        def emit():
            for lang, found in held.items():
                grams, counts = _merged(found)
                for at in range(0, len(grams), 1 << 16):
                    some = slice(at, at + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams[some]), pa.string()), pa.array(grams[some].astype(np.int64)),
                                                      pa.array(counts[some])], names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            by_lang: dict = {}
            for lang, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                if words := text.split():
                    by_lang.setdefault(lang, []).append(symbols(words))
            for lang, texts in by_lang.items():
                own = held.setdefault(lang, [])
                for _, grams in pieces(padded(texts)):
                    found, counts = np.unique(grams[grams & np.uint64(255) != 0], return_counts=True)
                    if len(found):
                        own.append((found, counts))
                if not own:
                    del held[lang]
            if size() > HELD_GRAMS:
                for own in held.values():
                    own[:] = [_merged(own)]
                if size() > HELD_GRAMS // 2:
                    yield from emit()
        yield from emit()

    found = docs.select("lang", "text").mapInArrow(count, "lang string, gram bigint, n bigint")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> DataFrame:
    """lang, d1, d2, d3: the discounts of counts 1, 2 and 3 or more."""
    n = [F.count_if(F.col("n") == i).cast("double") for i in range(1, 5)]
    got = counts.groupBy("lang").agg(*[x.alias(f"n{i + 1}") for i, x in enumerate(n)])
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def discount(i: int) -> Column:
        value = F.lit(float(i)) - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))
        # too few n-grams to tell: half a count; never nothing, never the whole count
        return F.least(F.greatest(F.coalesce(value, F.lit(0.5)), F.lit(0.1)), F.lit(i - 0.1)).alias(f"d{i}")

    return got.select("lang", *[discount(i) for i in range(1, 4)])


def _mask(order: int) -> Column:
    return F.lit(256 ** order - 1).cast("long")


def model_tables(counts: DataFrame) -> tuple[dict[int, DataFrame], dict[int, DataFrame]]:
    """By order: (lang, gram, p), and (lang, gram, weight) of the contexts, one symbol shorter."""
    raw = {ORDER: stored(counts, "kn-counts")}
    for order in range(ORDER - 1, 0, -1):  # distinct left neighbours
        shorter = raw[order + 1].groupBy("lang", F.col("gram").bitwiseAND(_mask(order)).alias("gram"))
        raw[order] = stored(shorter.agg(F.count("*").alias("n")), "kn-counts")
    probability, weight = {}, {}
    for order in range(1, ORDER + 1):
        # one small row a language; stored, so that Spark knows its size
        with_d = raw[order].join(stored(_discounts(raw[order]), "kn-discounts"), "lang").withColumn("context", F.shiftright("gram", 8))
        w = Window.partitionBy("lang", "context")
        many = lambda test: F.sum(test.cast("long")).over(w)
        n = F.col("n")
        left = many(n == 1) * F.col("d1") + many(n == 2) * F.col("d2") + many(n >= 3) * F.col("d3")
        own = n - F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))
        total = F.sum("n").over(w)
        rows = with_d.select("lang", "gram", "context", (own / total).alias("own"), (left / total).alias("weight"))
        if order == 1:
            rows = rows.withColumn("p", F.col("own") + F.col("weight") / SYMBOLS)
        else:
            lower = probability[order - 1].select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            rows = (rows.withColumn("suffix", F.col("gram").bitwiseAND(_mask(order - 1))).join(lower, ["lang", "suffix"])
                    .withColumn("p", F.col("own") + F.col("weight") * F.col("lower")))
        rows = stored(rows.select("lang", "gram", "context", "p", "weight"), "kn-model")
        probability[order] = rows.select("lang", "gram", "p")
        weight[order] = rows.groupBy("lang", F.col("context").alias("gram")).agg(F.min("weight").alias("weight"))
    return probability, weight


def _bits(p: Column) -> Column:
    return F.round(-F.log2(p) * ONE).cast("int")


def model_rows(probability: dict, weight: dict) -> DataFrame:
    """(lang, kind, gram, bits): kind 2 * order for n-grams, 2 * order + 1 for weights of contexts."""
    rows = None
    for order in range(1, ORDER + 1):
        for kind, table, value in ((2 * order, probability[order], "p"), (2 * order + 1, weight[order], "weight")):
            part = table.select("lang", F.lit(kind).alias("kind"), "gram", _bits(F.col(value)).alias("bits"))
            rows = part if rows is None else rows.unionByName(part)
    return rows


def learn(docs: DataFrame) -> DataFrame:
    """The model's rows from every whole text of ``docs`` (lang, text)."""
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return stored(model_rows(*model_tables(gram_counts(docs))), "kn-rows")


# ---- sorted hash arrays

class HashArray:
    """Sorted mixed keys with their values, found by an index of the leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        bits = max(1, int(len(keys)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(keys[order], np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
        # a last key that only itself can match, found to be absent below
        self.keys = np.append(keys[order], np.uint64(2**64 - 1))
        self.values = np.append(values[order], np.int32(-1))

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values; -1 where a key is absent."""
        at = self.first[keys >> self.shift]
        open_ = np.flatnonzero(self.keys[at] < keys)
        while len(open_):
            at[open_] += 1
            open_ = open_[self.keys[at[open_]] < keys[open_]]
        return np.where(self.keys[at] == keys, self.values[at], np.int32(-1))


def collected_model(rows: DataFrame) -> dict:
    """(lang, kind) -> mixed keys and values, of at most ``SHIPPED_ROWS`` rows."""

    def pack(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for lang, kind in {(a, b) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())}:
                own = table.filter(pa.compute.and_(pa.compute.equal(table["lang"], lang), pa.compute.equal(table["kind"], kind)))
                keys = mix(own["gram"].to_numpy().astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([kind], pa.int32()), pa.array([keys.tobytes()], pa.binary()),
                                                  pa.array([own["bits"].to_numpy().astype(np.int32).tobytes()], pa.binary())],
                                                 names=["lang", "kind", "keys", "bits"])

    found: dict = {}
    with arrow_rows(rows.sparkSession, 1 << 17):
        # one partition at a time, at most 12 bytes a row in all
        for r in rows.mapInArrow(pack, "lang string, kind int, keys binary, bits binary").toLocalIterator():
            found.setdefault((r.lang, r.kind), []).append((np.frombuffer(r.keys, np.uint64), np.frombuffer(r.bits, np.int32)))
    return {k: tuple(np.concatenate(x) for x in zip(*v)) for k, v in found.items()}


class Scorer:
    def __init__(self, model: dict):
        self.arrays = {k: HashArray(*v) for k, v in model.items()}
        self.none = HashArray(np.zeros(0, np.uint64), np.zeros(0, np.int32))

    def bits(self, lang: str, grams: np.ndarray) -> np.ndarray:
        """-log2 of the probability of each n-gram's last symbol, in fixed point."""
        out = np.zeros(len(grams), np.int64)
        left = np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            own = self.arrays.get((lang, 2 * order), self.none).get(mix(grams))
            hit = own >= 0
            out[left[hit]] += own[hit]
            left, grams = left[~hit], grams[~hit]
            if not len(left):
                return out
            out[left] += np.maximum(self.arrays.get((lang, 2 * order + 1), self.none).get(mix(grams >> np.uint64(8))), 0)
            grams = grams & np.uint64(256 ** (order - 1) - 1)
        out[left] += UNSEEN
        return out

    def texts(self, lang: str, texts: list[bytes]) -> np.ndarray:
        """Sum of bits over each whole text."""
        lengths = np.array([len(t) for t in texts])
        begin = np.cumsum(lengths + ORDER - 1) - lengths - ORDER + 1  # of the n-gram that ends in a text's first symbol
        total = np.zeros(len(texts), np.int64)
        for first, grams in pieces(padded(texts)):
            there = grams & np.uint64(255) != 0
            upto = np.zeros(len(grams) + 1, np.int64)
            upto[np.flatnonzero(there) + 1] = self.bits(lang, grams[there])
            np.cumsum(upto, out=upto)
            low, high = np.clip(begin - first, 0, len(grams)), np.clip(begin + lengths - first, 0, len(grams))
            total += upto[high] - upto[low]
        return total


UNSEEN = int(round(np.log2(SYMBOLS) * ONE))


# ---- judging

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _keys(lang_col: str, text_col: str) -> tuple[Column, Column]:
    """The model that a text is counted into, and the one that scores it: language and half."""
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN))
    half = F.pmod(F.xxhash64(F.col(f"`{text_col}`")), F.lit(2))
    return F.concat(lang, F.lit("/"), half.cast("string")), F.concat(lang, F.lit("/"), (1 - half).cast("string"))


def _scored(rows: DataFrame, shared: _Shared | None) -> DataFrame:
    """``doc``, lang, the base counts, n_bytes and bits (null without a shipped model) of ``rows`` (doc, lang, text)."""
    schema = T.StructType([rows.schema["doc"], *T._parse_datatype_string(
        "lang string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_bytes bigint, bits bigint").fields])

    def run(batches):
        scorer = per_worker(("perplexity", shared.id), lambda: Scorer(shared.value)) if shared else None
        for batch in batches:
            langs, texts = batch.column(1).to_pylist(), text_bytes(batch.column(2))
            counts, by_lang, sizes = [], {}, []
            for i, (lang, text) in enumerate(zip(langs, texts)):
                words = text.split()
                counts.append(base_counts(text, words))
                coded = symbols(words)
                sizes.append(len(coded))
                if coded:
                    by_lang.setdefault(lang, []).append((i, coded))
            bits = np.zeros(len(texts), np.int64)
            if scorer:
                for lang, own in by_lang.items():
                    bits[[i for i, _ in own]] = scorer.texts(lang, [t for _, t in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(x, pa.int64()) for x in zip(*counts)], pa.array(sizes, pa.int64()),
                 pa.array(bits) if scorer else pa.nulls(len(texts), pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def _text_grams(rows: DataFrame) -> DataFrame:
    """(row, lang, gram, n): the distinct n-grams of each text of ``rows`` (row, lang, text)."""

    def run(batches):
        for batch in batches:
            for row, lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2))):
                for _, grams in pieces(padded([symbols(text.split())])):
                    found, n = np.unique(grams[grams & np.uint64(255) != 0], return_counts=True)
                    for at in range(0, len(found), 1 << 16):
                        some = slice(at, at + (1 << 16))
                        yield pa.RecordBatch.from_arrays([pa.array([row] * len(found[some]), pa.int64()), pa.array([lang] * len(found[some]), pa.string()),
                                                          pa.array(found[some].astype(np.int64)), pa.array(n[some])], names=["row", "lang", "gram", "n"])

    return rows.select("row", "lang", "text").mapInArrow(run, "row bigint, lang string, gram bigint, n bigint")


def joined_bits(rows: DataFrame, model: DataFrame) -> DataFrame:
    """(row, bits) of ``rows`` (row, lang, text) by joins with a model that is not shipped."""
    with arrow_rows(rows.sparkSession, BATCH_ROWS):
        left = stored(_text_grams(rows), "kn-grams")
    found = None
    for order in range(ORDER, 0, -1):
        of = lambda kind: model.where(F.col("kind") == kind).select("lang", "gram", F.col("bits").alias("own"))  # noqa: E731, B023
        tried = left.join(of(2 * order), ["lang", "gram"], "left")
        hits = tried.where("own IS NOT NULL").select("row", (F.col("own") * F.col("n")).alias("bits"))
        missed = tried.where("own IS NULL").select("row", "lang", "gram", F.shiftright("gram", 8).alias("context"), "n")
        weights = of(2 * order + 1).withColumnRenamed("gram", "context")
        missed = missed.join(weights, ["lang", "context"], "left").select(
            "row", "lang", F.col("gram").bitwiseAND(_mask(order - 1)).alias("gram"), "n", F.coalesce("own", F.lit(0)).alias("w"))
        left = stored(missed, "kn-missed")
        sums = hits.unionByName(left.select("row", (F.col("w") * F.col("n")).alias("bits")))
        found = sums if found is None else found.unionByName(sums)
        left = left.select("row", "lang", "gram", "n")
    found = found.unionByName(left.select("row", (F.lit(UNSEEN) * F.col("n")).alias("bits")))
    return found.groupBy("row").agg(F.sum("bits").alias("bits"))


def bands(scored: DataFrame) -> DataFrame:
    """lang, median, spread of the documents that pass the base rules, in languages that have enough of them."""
    bins = stored(scored.where(~F.col("base_failed")).groupBy("lang", "rate").agg(F.count("*").alias("n")), "kn-bins")

    def median(rows: DataFrame, value: str) -> DataFrame:
        # a bin for each thousandth of a bit that occurs
        upto = F.sum("n").over(Window.partitionBy("lang").orderBy(value))
        total = F.sum("n").over(Window.partitionBy("lang"))
        return (rows.groupBy("lang", value).agg(F.sum("n").alias("n")).select("lang", value, upto.alias("upto"), total.alias("total"))
                .where(F.col("upto") * 2 >= F.col("total")).groupBy("lang").agg(F.min(value).alias("middle"), F.first("total").alias("total")))

    center = stored(median(bins, "rate").where(F.col("total") >= LEAST_DOCUMENTS), "kn-medians")
    away = bins.join(center, "lang").select("lang", F.abs(F.col("rate") - F.col("middle")).alias("away"), "n")
    spread = median(away, "away").select("lang", F.greatest("middle", F.lit(LEAST_SPREAD)).alias("spread"))
    return stored(center.join(spread, "lang").select("lang", F.col("middle").alias("median"), "spread"), "kn-bands")


def judge(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", shipped_rows: int = SHIPPED_ROWS) -> DataFrame:
    """``doc`` (every column but the text), the base counts, base_failed, rate (thousandths of a bit a byte), kept."""
    with compact(docs.sparkSession):
        return _judged(docs, text_col, lang_col, shipped_rows)


def _judged(docs: DataFrame, text_col: str, lang_col: str, shipped_rows: int) -> DataFrame:
    spark = docs.sparkSession
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    counted, scoring = _keys(lang_col, text_col)
    rows = docs.select(F.struct(F.lit(None).cast("int").alias("none"), *rest).alias("doc"), counted.alias("counted"), scoring.alias("lang"),
                       F.col(f"`{text_col}`").alias("text"))
    model = learn(rows.select(F.col("counted").alias("lang"), "text"))
    rows = rows.drop("counted")
    with arrow_rows(spark, BATCH_ROWS):
        if model.count() <= shipped_rows:
            scored = stored(_scored(rows, _Shared(spark.sparkContext.broadcast(collected_model(model)))), "kn-scored")
        else:
            numbered = stored(rows.withColumn("row", F.monotonically_increasing_id()), "kn-texts")
            named = numbered.select(F.struct("doc", "row").alias("doc"), "lang", "text")
            plain = stored(_scored(named, None).drop("bits"), "kn-scored")
            bits = joined_bits(numbered, model).withColumnRenamed("row", "r")
            scored = (plain.join(bits, F.col("doc.row") == F.col("r"), "left").drop("r")
                      .withColumns({"doc": F.col("doc.doc"), "bits": F.coalesce("bits", F.lit(0))}))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    scored = scored.withColumns({"base_failed": failed, "rate": F.floor(F.try_divide(F.col("bits") * 1000, F.col("n_bytes") * ONE)).cast("long"),
                                 "lang": F.expr("substring(lang, 1, length(lang) - 2)")})
    chance = F.greatest(F.lit(1.0), F.sqrt(F.lit(float(STEADY_BYTES)) / F.col("n_bytes")))
    inside = F.abs(F.col("rate") - F.col("median")) <= F.col("spread") * WIDTH * chance
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return scored.join(bands(scored), "lang", "left").select("doc", *COUNTS, "base_failed", "rate", kept.alias("kept"))


def drop_failed(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The documents that pass, with all their columns."""
    numbered = stored(as_doc(docs).withColumn("row", F.monotonically_increasing_id()), "kn-numbered")
    rows = numbered.select("row", F.col(f"doc.`{text_col}`").alias("text"), F.col(f"doc.`{lang_col}`").alias("lang"))
    kept = judge(rows, **options).where("kept").select("doc.row")
    return undoc(numbered.join(kept, "row", "left_semi"), docs)
