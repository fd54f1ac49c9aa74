import itertools
import math

import numpy as np
import pytest

from orderloom.llm import langid as L

from cases import ROWS, crc, rows


def test_forward_pass_sums_all_segmentations():
    pieces = L.vocabulary(L.default_vocabulary())
    counts = np.random.RandomState(1).randint(0, 50, (2, len(pieces))).astype(float)
    model = L.LanguageModel(["x", "y"], counts, L.default_vocabulary())
    scorer = L.Scorer(model)
    for word in ("thing", "años", "中a"):
        for lang in range(2):
            total = 0.0
            for cuts in itertools.product([0, 1], repeat=len(word) - 1):
                at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
                p = 1.0
                for a, b in zip(at, at[1:]):
                    own = pieces.get(word[a:b])
                    p *= model.probability[lang, own] if own is not None else 1e-6 if b - a == 1 else 0.0
                total += p
            assert scorer.score_words([word, "a", "xyz" * 30])[0, lang] == pytest.approx(math.log(total), rel=1e-9)


def test_the_longest_pieces_take_part():
    pieces = L.vocabulary(L.default_vocabulary())
    longest = max(pieces, key=len)
    assert len(longest) > 12
    counts = np.ones((2, len(pieces)))
    counts[0, pieces[longest]] = 1e6                    # the language that knows the whole piece
    scorer = L.Scorer(L.LanguageModel(["x", "y"], counts, L.default_vocabulary()))
    x, y = scorer.score_words([longest])[0]
    assert x == pytest.approx(math.log((1e6 + L.SMOOTHING) / (counts[0] + L.SMOOTHING).sum()), abs=1e-3) and x > y + 5


def test_greedy_pieces_are_counted(spark):
    pieces = L.vocabulary(L.default_vocabulary())
    texts = [("x", "Thing things THING xyzzy"), ("y", "años\nthing 中"), ("x", None), ("x", "")]
    expected = {}
    for lang, text in texts:
        for word in L.LETTERS.findall((text or "").lower()):
            while word:
                for end in range(len(word), 0, -1):
                    if word[:end] in pieces:
                        expected[lang, pieces[word[:end]]] = expected.get((lang, pieces[word[:end]]), 0) + 1
                        break
                word = word[end:]
    got = L.piece_counts(spark.createDataFrame(texts, "lang string, text string").where("text IS NOT NULL"), L.default_vocabulary())
    assert {(r.lang, r.piece): r.n for r in got.collect()} == expected


def test_very_long_words_stay_finite():
    pieces = L.vocabulary(L.default_vocabulary())
    scorer = L.Scorer(L.LanguageModel(["x"], np.ones((1, len(pieces))), L.default_vocabulary()))
    one, two = scorer.score_words(["ab" * 1000])[0, 0], scorer.score_words(["ab" * 2000, "a"])[0, 0]
    assert math.isfinite(two) and two == pytest.approx(2 * one, rel=1e-2)


def test_awkward_rows(spark):
    docs = rows(spark, clash=("lang_pred", "score", "doc"))
    model = L.learn(L.learning_rows(docs))
    got = L.identify(docs, model).collect()
    assert len(got) == len(ROWS)
    for r in got:
        none = not any(c.isalpha() for c in r[0].text or "")
        assert (r[1] == "und") == none and 0 <= r[2] <= 1
        assert r[1] in {"und", *model.langs}


def test_nothing_to_learn_from(spark):
    model = L.learn(L.learning_rows(rows(spark, [])))
    assert {r.lang_pred for r in L.identify(rows(spark), model).collect()} == {"und"}
    assert L.identify(rows(spark, []), model).collect() == []


def test_held_out_accuracy(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = E.queries()["op3_language_id"](spark, sf).collect()
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) for r in got)
    test = [r for r in got if r.held_out and any(c.isalpha() for c in truth[r.doc_id][1] or "")]
    assert np.mean([r.lang_pred == truth[r.doc_id][0] for r in test]) > 0.97
