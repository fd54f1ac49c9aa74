import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark import cloudpickle

from orderloom.llm import phrases as P

from cases import LONG, ROWS, collected, rows


def brute(data, least=30, top=2000):
    """The contract in plain Python: every phrase of up to four words counted."""
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in data:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if a >= least}
        inside = Counter()
        for p, a in frequent.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i:i + size]] = max(inside[p[i:i + size]], a)
        own = []
        for p, a in frequent.items():
            if len(p) > 1 and not 100 * inside[p] >= 80 * a:
                score, cut = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                own.append((-score, -a, " ".join(p).encode(), counts[p[:cut]], counts[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out, key=repr)


def got(docs, **options):
    return collected(P.collocations(docs, **options))


def made(seed, texts, words=40, size=60):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" if i % 3 else f"É{i}" for i in range(words)]
    share = 1 / np.arange(1, words + 1)
    marks = [" ", " ", " ", "\t", "  ", ", ", ".", "\n", "! "]
    return [(i, "".join(w + marks[m] for w, m in zip(rng.choice(vocabulary, size, p=share / share.sum()), rng.integers(0, len(marks), size))),
             ["en", "fr", None, "und"][i % 4], "a") for i in range(texts)]


@pytest.mark.parametrize("least,shards", [(1, 1), (3, 2), (30, 3), (7, 5)])
def test_equals_brute_force(spark, least, shards):
    data = made(least, 120) + ROWS
    docs = rows(spark, data, clash=("phrase", "k", "n", "shard", "words")).repartition(4)
    assert got(docs, least=least, shards=shards) == brute(data, least)


def test_late_phrases_and_rows_cut_inside_pieces(spark, monkeypatch):
    # what reaches the threshold in the last shard only starts longer phrases that see every shard once
    monkeypatch.setattr(P, "ROW_WORDS", 7)
    monkeypatch.setattr(P, "HELD_WORDS", 9)
    data = [(i, "a b c d e" if i % 5 else "b c d x a b c d", "en" if i % 7 else "de", "s") for i in range(97)] + made(3, 30, words=9)
    docs = rows(spark, data)
    for shards in (2, 4):
        assert got(docs, least=13, shards=shards) == brute(data, 13)


def test_filters_may_err_without_harm(spark, monkeypatch):
    monkeypatch.setattr(P, "MOST_BITS", 64)          # nearly everything passes
    data = made(8, 80)
    assert got(rows(spark, data), least=9) == brute(data, 9)
    monkeypatch.setattr(P, "SHIPPED_PHRASES", 0)     # joined, not broadcast
    assert got(rows(spark, data), least=9) == brute(data, 9)


def test_top_and_ties(spark):
    data = [(1, "b a. a b. c d. d c. é f. z z z z z", "en", "a")] * 30
    assert got(rows(spark, data), top=3) == brute(data, top=3)
    assert got(rows(spark, data)) == brute(data)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    df = spark.createDataFrame([(big, big, big + 1)], "a bigint, l bigint, r bigint")
    from pyspark.sql import functions as F
    d, wanted = P.exact(F.col("l")) + P.exact(F.col("r")), P.exact(F.lit(P.SCALE)) * P.exact(F.col("a"))
    assert df.select(P.whole_quotient(wanted, d)).first()[0] == 2_000_000 * big // (2 * big + 1)


def test_filter_has_no_false_negatives():
    hashes = np.random.default_rng(0).integers(0, 2**63, 5000).astype(np.uint64)
    one, two = P.Filter(1 << 16), P.Filter(1 << 12)
    one.add(hashes[:2500])
    two.add(hashes[2500:2700])
    assert P._joined([one, two]).has(hashes[:2700]).all()
    assert one.has(hashes[2500:]).mean() < 0.2


def test_long_text_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(P, "ROW_WORDS", 1000)
    data = [(1, LONG, "en", "a"), (2, LONG.replace(" ", " the "), "en", "a")]
    assert got(rows(spark, data), least=25) == brute(data, 25)
    assert got(rows(spark, [])) == []
    assert got(rows(spark, [(1, None, None, None), (2, ". ! \n\t", "en", "a")])) == []


def test_numbers_are_packed_and_summed_exactly():
    rng = np.random.default_rng(4)
    for n in (0, 1, 5000):
        numbers, counts = P.summed(rng.integers(0, 1 << P.NUMBER_BITS, n).astype(np.uint64), rng.integers(1, 1 << 20, n))
        back = P.unpacked(P.packed(numbers, counts), len(numbers))
        assert np.array_equal(back[0], numbers) and np.array_equal(back[1], counts)
    numbers, counts = P.summed(np.array([7, 3, 7, 3, 9], np.uint64), np.array([1, 2, 3, 4, 5]))
    assert numbers.tolist() == [3, 7, 9] and counts.tolist() == [6, 4, 5]


def test_tasks_that_send_in_between_and_shared_numbers(spark, monkeypatch):
    monkeypatch.setattr(P, "HELD_NUMBERS", 50)
    monkeypatch.setattr(P, "HELD_COUNTS", 20)
    data = made(5, 90)
    assert got(rows(spark, data), least=4) == brute(data, 4)


def test_phrases_that_share_numbers_are_told_apart(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(P, "short", lambda hashes, length: hashes >> np.uint64(62) << np.uint64(1) | np.uint64(length == 4))
    monkeypatch.setattr(P, "filter_of", lambda blobs, n, real=P.filter_of: asked.append(n) or real(blobs, n))
    cloudpickle.register_pickle_by_value(P)          # tasks take the module as it is patched here
    try:
        data = made(5, 90)
        assert got(rows(spark, data), least=4) == brute(data, 4)
    finally:
        cloudpickle.unregister_pickle_by_value(P)
    assert asked[-1] <= 8                             # all phrases had eight numbers


def test_scans_store_far_less_than_a_phrase_for_each_counter(spark, monkeypatch):
    stores = {}
    store = P.stored
    monkeypatch.setattr(P, "stored", lambda df, name: stores.setdefault(name, []).append(store(df, name)) or stores[name][-1])
    rng = np.random.default_rng(6)
    data = [(i, " ".join(f"w{x}" for x in rng.integers(0, 300, 400)), "en", "a") for i in range(150)]
    whole, _ = P.frequent_phrases(rows(spark, data).select("lang", "text"), least=30)
    # some 43,000 of 90,000 word pairs come, none 30 times: their counters are stored, the pairs are not
    assert {r.k for r in whole.collect()} == {1} and whole.count() == 300
    assert set(stores) == {"phrase-scan", "phrase-totals"}
    kept = sum(b.agg({"n": "sum"}).first()[0] or 0 for b in stores["phrase-scan"])
    size = sum(b.selectExpr("sum(length(blob))").first()[0] or 0 for b in stores["phrase-scan"])
    assert kept > 30_000 and size < 5 * kept
