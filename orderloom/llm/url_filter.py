"""URL filter: host and path rules, and a character language-model ratio for the rest.

Two variable-order Markov models over the bytes of a URL, one of accepted and
one of rejected URLs, learn from the URLs that a rule decides. A model's
probability of a byte blends its counts in contexts of 0 to ``ORDER`` bytes, the
longer the context the more it says once it has been seen (Witten-Bell
weights). Counts cover every learning URL and are a stored table keyed by the
bytes themselves (six fit in 64 bits), which grows with the URLs; nothing of
it reaches the driver. The distinct windows of six bytes of all URLs get their log ratio by joins
with the counts, level by level, and each URL sums the ratios of its own windows. The score
of a URL is the difference of both log likelihoods per byte, calibrated to a
probability on a fifth of the learning URLs that the counts leave out.

Defined cases: a null or empty URL has empty host and path, fits no rule, and
scores 0 before calibration; without learning URLs of both kinds the
calibration is the identity; probability 0.5 and above allows; repeated URLs
count as often as they occur; other columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import BATCH_ROWS, as_doc, ascii_lower, stored

#: (verdict, host, path) rules
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))

ORDER = 5
HOT_SHARE, HOT_LEAST = 1000, 1000   # a window in more than a HOT_SHARE-th of the URLs, and in HOT_LEAST, is hot
BINS = 4001              # of the score, for the calibration


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(found)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (like ``com/fr/``) and its verdict; nulls if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _windows(urls: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of each byte, the byte with the ORDER bytes before it as one number (the byte lowest), lengths.

    Every URL is preceded by ORDER zero bytes and closed by one.
    """
    raw = b"".join(bytes(ORDER) + u + b"\0" for u in urls)
    codes = np.frombuffer(raw, np.uint8).astype(np.int64)
    lengths = np.array([len(u) + 1 for u in urls], np.int64)
    starts = np.cumsum(lengths + ORDER) - lengths
    row = np.repeat(np.arange(len(urls)), lengths)
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
    window = np.zeros(len(at), np.int64)
    for k in range(ORDER + 1):
        window |= codes[at - k] << (8 * k)
    return row, window, lengths


def _grams(urls: list[bytes]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Row of each byte, the 0..ORDER-byte contexts before it joined with it and alone, lengths."""
    row, window, lengths = _windows(urls)
    joined = [window & ((1 << 8 * (k + 1)) - 1) for k in range(ORDER + 1)]
    return row, [(j, j >> 8) for j in joined], lengths


def _low_bytes(window: Column, n: int) -> Column:
    return window.bitwiseAND(F.lit((1 << 8 * n) - 1).cast("bigint"))


def _texts(batch: pa.RecordBatch, at: int) -> list[bytes]:
    return batch.column(at).cast(pa.binary()).to_pylist()


def url_windows(urls: DataFrame) -> DataFrame:
    """(u, w, c): how often each window occurs in each URL (columns u: bigint, url: not null)."""
    urls.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS * 16))

    def emit(batches):
        for batch in batches:
            row, window, _ = _windows(_texts(batch, 1))
            order = np.lexsort((window, row))
            row, window = row[order], window[order]
            begin = np.flatnonzero(np.concatenate(([True], (np.diff(row) != 0) | (np.diff(window) != 0)))[:len(row)])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row[begin])), pa.array(window[begin]),
                                              pa.array(np.diff(begin, append=len(row)))], names=["u", "w", "c"])

    return urls.select("u", "url").mapInArrow(emit, "u bigint, w bigint, c bigint")


def gram_counts(urls: DataFrame) -> DataFrame:
    """(model, k, joined, alone, n) over all rows of ``urls`` (columns kind: 0 accepted, 1 rejected; url).

    ``joined`` is a context of k bytes with the byte after it, ``alone`` the context: the bytes themselves.
    """
    urls.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS * 16))

    def count(batches):
        for batch in batches:
            kinds = batch.column(0).to_numpy()
            rows, window, _ = _windows(_texts(batch, 1))
            keys, n = np.unique((kinds[rows].astype(np.int64) << 8 * (ORDER + 1)) | window, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array((keys >> 8 * (ORDER + 1)).astype(np.int32)),
                                              pa.array(keys & ((1 << 8 * (ORDER + 1)) - 1)), pa.array(n)], names=["model", "w", "n"])

    windows = urls.select("kind", "url").mapInArrow(count, "model int, w bigint, n bigint").groupBy("model", "w").agg(F.sum("n").alias("n"))
    levels = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), _low_bytes(F.col("w"), k + 1).alias("joined")) for k in range(ORDER + 1)]))
    return (windows.select("model", levels.alias("g"), "n").groupBy("model", "g.k", "g.joined").agg(F.sum("n").alias("n"))
            .select("model", "k", "joined", F.shiftright("joined", 8).alias("alone"), "n"))


class MarkovPair:
    """The stored counts of both models, and the slope and shift of the calibration."""

    def __init__(self, counts: DataFrame):
        self.counts = counts
        self.slope, self.shift = 1.0, 0.0

    def _ratios(self, needed: DataFrame) -> DataFrame:
        """(w, ratio) of the windows ``needed`` (w, distinct): log probability of the last byte, accepted less rejected.

        From the shortest context up, every level joins the level below on what is left
        without the first byte; at most 256 grams share a context, and as many a shorter gram.
        """
        below = None
        for k in range(ORDER + 1):
            n = lambda model: F.when(F.col("model") == model, F.col("n")).otherwise(0)
            counted = self.counts.where(F.col("k") == k).select(F.col("joined").alias("gram"), n(0).alias("n0"), n(1).alias("n1"), F.lit(0).alias("asked"))
            none = F.lit(0).cast("bigint")
            asked = needed.select(_low_bytes(F.col("w"), k + 1).alias("gram"), none.alias("n0"), none.alias("n1"), F.lit(1).alias("asked"))
            level = counted.unionByName(asked).groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.max("asked").alias("asked"))
            context = Window.partitionBy(F.shiftright("gram", 8))
            level = level.withColumns({f"{what}{m}": F.sum(c).over(context) for m in (0, 1) for what, c in (
                ("seen", F.col(f"n{m}")), ("kinds", (F.col(f"n{m}") > 0).cast("bigint")))}).where("asked = 1")
            if below is None:
                level = level.withColumns({"below0": F.lit(1 / 256), "below1": F.lit(1 / 256)})
            else:
                level = level.withColumn("shorter", _low_bytes(F.col("gram"), k)).join(below, "shorter")
            p = [F.when(F.col(f"seen{m}") > 0, (F.col(f"n{m}") + F.col(f"kinds{m}") * F.col(f"below{m}")) / (F.col(f"seen{m}") + F.col(f"kinds{m}")))
                 .otherwise(F.col(f"below{m}")) for m in (0, 1)]
            below = level.select(F.col("gram").alias("shorter"), p[0].alias("below0"), p[1].alias("below1"))
        return below.select(F.col("shorter").alias("w"), (F.log("below0") - F.log("below1")).alias("ratio"))

    def scores(self, urls: DataFrame) -> DataFrame:
        """(u, score) of the URLs (columns u, url; u is a key) that are neither null nor empty: log likelihood
        under the accepted model less that under the rejected one, per byte."""
        windows = stored(url_windows(urls.where(F.octet_length("url") > 0)), "url-windows")
        total = urls.count()
        asked = windows.groupBy("w").agg(F.count("*").alias("holders"))
        ratios = stored(asked.join(self._ratios(asked.select("w")), "w"), "ratios")
        # a URL has few windows, so few can be in a large share of the URLs: at most HOT_SHARE x bytes of
        # a URL, whatever the number of URLs. Those are broadcast; no other makes a partition large
        hot = F.col("holders") > max(HOT_LEAST, total // HOT_SHARE)
        often = F.broadcast(ratios.where(hot).select("w", F.col("ratio").alias("often")))
        dealt = windows.join(often, "w", "left")
        rare = dealt.where("often is null").join(ratios.where(~hot).select("w", "ratio"), "w").select("u", "c", "ratio")
        parts = rare.unionByName(dealt.where("often is not null").select("u", "c", F.col("often").alias("ratio")))
        return parts.groupBy("u").agg((F.sum(F.col("c") * F.col("ratio")) / F.sum("c")).alias("score"))

    def accepted(self, score: Column) -> Column:
        return 1 / (1 + F.exp(-F.greatest(F.lit(-60.0), F.least(F.lit(60.0), self.slope * score + self.shift))))

    def probability(self, urls: list[bytes]) -> np.ndarray:
        """For a few URLs."""
        spark = self.counts.sparkSession
        rows = spark.createDataFrame([(i, bytearray(u)) for i, u in enumerate(urls)], "u bigint, url binary")
        got = rows.join(self.scores(rows), "u", "left").select("u", self.accepted(F.coalesce("score", F.lit(0.0)))).collect()
        return np.array([p for _, p in sorted(got)])


def _count(rows: DataFrame) -> MarkovPair:
    return MarkovPair(stored(gram_counts(rows.where(F.col("kind").isNotNull() & ~apart())), "url-grams"))


def apart() -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(5)) == 4


def _rows(urls: DataFrame) -> DataFrame:
    """``urls`` (url, verdict and others) with a key ``u`` and ``kind``: 0 accepted, 1 rejected, null if not learned from."""
    kind = F.when(F.col("url").isNull() | F.col("verdict").isNull(), None).when(F.col("verdict") == "allow", 0).otherwise(1).cast("int")
    return stored(urls.withColumns({"u": F.monotonically_increasing_id(), "kind": kind}), "urls")


def learn(urls: DataFrame) -> MarkovPair:
    """``urls`` has url and verdict (allow or block)."""
    rows = _rows(urls.select("url", "verdict"))
    pair = _count(rows)
    some = rows.where(F.col("kind").isNotNull() & apart())
    _calibrate(pair, some.join(pair.scores(some.select("u", "url")), "u", "left"))
    return pair


def _calibrate(pair: MarkovPair, rows: DataFrame) -> None:
    """Slope and shift of a logistic curve, from a histogram of the scores by kind over all ``rows`` (kind, score)."""
    score = F.greatest(F.lit(-10.0), F.least(F.lit(10.0), F.coalesce("score", F.lit(0.0))))
    bins = F.rint((score + 10) / 20 * (BINS - 1)).cast("int").alias("bin")
    found = rows.select("kind", bins).groupBy("kind", "bin").count().collect()  # 2 x BINS rows
    x = np.array([r["bin"] / (BINS - 1) * 20 - 10 for r in found])
    y = np.array([1.0 - r["kind"] for r in found])
    n = np.array([float(r["count"]) for r in found])
    if not len(n) or not 0 < (n * y).sum() < n.sum():
        return
    n = n / n.sum()
    a, b = 1.0, 0.0
    for _ in range(100):  # Newton steps; a small penalty keeps separable scores finite
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -60, 60)))
        w = n * p * (1 - p)
        g = np.array([(n * (p - y) * x).sum() + 1e-4 * a, (n * (p - y)).sum()])
        h = np.array([[(w * x * x).sum() + 1e-4, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 10 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    pair.slope, pair.shift = float(a), float(b)


def judge(pages: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """``doc`` with host, path, rule, probability (of acceptance) and verdict."""
    url = F.col(f"doc.`{url_col}`")
    _, known = best_rule(host_of(url), path_of(url), rules)
    rows = _rows(as_doc(pages).select("doc", url.alias("url"), known.alias("verdict")))
    pair = _count(rows)
    scores = stored(pair.scores(rows.select("u", "url")), "url-scores")
    _calibrate(pair, rows.where(F.col("kind").isNotNull() & apart()).select("u", "kind").join(scores, "u", "left"))
    scored = (rows.select("doc", "u").join(scores, "u", "left")
              .select("doc", pair.accepted(F.coalesce("score", F.lit(0.0))).alias("probability")))
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("probability") >= 0.5, "allow").otherwise("block")
    return (scored.withColumns({"host": host_of(url), "path": path_of(url)})
            .select("doc", "host", "path", rule.alias("rule"), "probability", F.coalesce(verdict, method).alias("verdict")))
