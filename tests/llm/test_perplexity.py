import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from orderloom.llm import perplexity as P

from cases import BASE, LONG, ROWS, collected, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside))


def fold(text):
    coded = b" ".join((text or "").encode().split())
    return bytes({0: 1}.get(b, b + 32 if 65 <= b <= 90 else b) for b in coded)


def kneser_ney(texts, order):
    """p(symbol | context) of a modified Kneser-Ney model, from plain dicts and the definition."""
    raw = {order: Counter()}
    for t in texts:
        data = bytes(order - 1) + fold(t)
        for i in range(len(data) - order + 1):
            raw[order][data[i:i + order]] += 1
    for k in range(order - 1, 0, -1):
        raw[k] = Counter(g[1:] for g in raw[k + 1])
    discount, followers = {}, {}
    for k, counts in raw.items():
        n = Counter(counts.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
        discount[k] = {}
        for i in (1, 2, 3):
            value = i - (i + 1) * y * n[i + 1] / n[i] if y is not None and n[i] else 0.5
            discount[k][i] = min(max(value, 0.1), i - 0.1)
        followers[k] = defaultdict(list)
        for g, c in counts.items():
            followers[k][g[:-1]].append(c)

    def p(context, symbol, k):
        if k == 0:
            return 1 / P.SYMBOLS
        context = context[len(context) - k + 1:]
        lower = p(context, symbol, k - 1)
        own = followers[k].get(context)
        if not own:
            return lower
        c = raw[k].get(context + bytes([symbol]), 0)
        total = sum(own)
        weight = sum(discount[k][min(x, 3)] for x in own) / total
        return (max(c - discount[k][min(c, 3)], 0) / total if c else 0) + weight * lower

    def bits(text):
        data = bytes(order - 1) + fold(text)
        return sum(-math.log2(p(data[i - order + 1:i], data[i], order)) for i in range(order - 1, len(data)))

    return bits


DATA = [(1, "The cat sat on the mat. " * 3, "en", "a"), (2, "The dog sat on the log, the cat ran.", "en", "a"),
        (3, "Le chat dort là-bas é\x00A", "fr", "a"), (4, "", "fr", "a"), (5, None, "en", "a"), (6, "zzzz 中文", None, "a"),
        (7, "The CAT\tsat \n on", "en", "b"), (8, "x", "de", "b")]


@pytest.mark.parametrize("pieces", [P.PIECE, 16])
def test_probabilities_equal_the_definition(spark, monkeypatch, pieces):
    docs = rows(spark, DATA).selectExpr("doc_id", "coalesce(lang, 'und') AS lang", "text")
    model = P.learn(docs)
    scorer = P.Scorer(P.collected_model(model))
    monkeypatch.setattr(P, "PIECE", pieces)
    for lang in ("en", "fr", "und", "de"):
        own = [t for _, t, l, _ in DATA if (l or "und") == lang and (t or "").split()]
        bits = kneser_ney(own, P.ORDER)
        texts = [*own, "the mat dog", "unseen ÿ 9"]
        got = scorer.texts(lang, [P.symbols(t.encode().split()) for t in texts])
        for t, b in zip(texts, got):
            assert b / P.ONE == pytest.approx(bits(t), abs=1e-3 * len(t) + 1e-3)


def test_probabilities_of_a_context_sum_to_one(spark):
    docs = rows(spark, DATA).selectExpr("doc_id", "'x' AS lang", "text")
    scorer = P.Scorer(P.collected_model(P.learn(docs)))
    for context in (b"\0\0\0\0", b"the ", b"zzzz", b"\0the"):
        grams = np.concatenate([P.packed(np.frombuffer(context + bytes([s]), np.uint8)) for s in range(1, 256)])
        assert (2.0 ** (-scorer.bits("x", grams) / P.ONE)).sum() == pytest.approx(1, abs=2e-3)


def test_counts_equal_brute_force(spark):
    data = ROWS + [(20, "a b c a b c", "en", "a"), (21, "a a a a", "en", "a"), (22, "x\ny\nx \nx\n \n ", "en", "a"), (23, "é\x85b #*$%&|<>", "en", "a")]
    docs = rows(spark, data, clash=("n_words", "lang_pred", "kept", "row", "l", "median"))
    got = sorted((r.doc.doc_id is None, r.doc.doc_id or 0, *[r[c] for c in P.COUNTS]) for r in P.judge(docs).collect())
    assert got == sorted((i is None, i or 0, *brute_counts(t)) for i, t, _, _ in data)


def test_both_ways_agree_and_outliers_go(spark):
    rng = np.random.default_rng(1)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), 2 + i % 5)) for i in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    data = [(i, text(60 + i % 90), "en" if i % 2 else "xx", "a") for i in range(200)]
    odd = " ".join("".join(chr(0x400 + int(c)) for c in rng.integers(0, 800, 9)) for _ in range(80))
    notice = text(150)                                # foreseen word by word, as many other texts hold it
    data += [(901 + 1000 * i, f"{notice} {i}", "xx", "a") for i in range(12)]
    data += [(900, odd, "en", "a"), (905, odd + " x", "zz", "a"), (902, "too short", "en", "a"), (903, "w x y " * 40, "en", "a"), (904, None, None, None)]
    docs = rows(spark, data)
    shipped, joined = P.judge(docs), P.judge(docs, shipped_rows=0)
    assert shipped.columns == joined.columns and collected(shipped) == collected(joined)
    by = {r.doc.doc_id: r for r in shipped.collect()}
    assert all(by[i].kept for i in range(200))
    assert [by[i].base_failed for i in (900, 901, 902, 903, 904)] == [False, False, True, True, True]
    assert not any(by[i].kept for i in (900, 901, 902, 903, 904))
    assert by[905].kept                               # a language of one document has no band
    assert by[900].rate > by[0].rate > by[901].rate
    kept = P.drop_failed(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [*range(200), 905]


def test_bands_are_exact_quantiles(spark):
    values = [("a", 100 + i * i % 71) for i in range(60)] + [("c", 5 * i) for i in range(51)] + [("b", 5), ("b", 7)]
    rows_ = [(lang, v, False) for lang, v in values] + [("a", 9999, True)]
    got = {r.lang: r for r in P.bands(spark.createDataFrame(rows_, "lang string, rate bigint, base_failed boolean")).collect()}
    assert set(got) == {"a", "c"}
    for lang in got:
        own = sorted(v for x, v in values if x == lang)
        middle = own[(len(own) - 1) // 2]
        away = sorted(abs(v - middle) for v in own)
        assert (got[lang].median, got[lang].spread) == (middle, max(P.LEAST_SPREAD, away[(len(own) - 1) // 2]))


def test_empty_and_wordless_tables(spark):
    assert P.judge(rows(spark, [])).collect() == []
    got = P.judge(rows(spark, [(1, None, None, None), (1, "", "en", "a")])).collect()
    assert [(r.n_words, r.base_failed, r.kept) for r in got] == [(0, True, False)] * 2


def test_long_texts_are_scored_whole(spark, monkeypatch):
    scorer = P.Scorer(P.collected_model(P.learn(rows(spark, [(1, LONG, "de", "a"), (2, BASE, "de", "a")]).select("doc_id", "lang", "text"))))
    texts = [P.symbols(x.encode().split()) for x in (LONG, BASE, LONG)]
    whole = scorer.texts("de", texts)
    monkeypatch.setattr(P, "PIECE", 1000)
    assert whole.tolist() == scorer.texts("de", texts).tolist() and whole[0] == whole[2]
