"""Language identification by segmentation-marginalised unigrams.

A text's likelihood under a language is the product over its words of the sum,
over all ways to cut the word into pieces of a fixed public vocabulary, of the
product of the pieces' probabilities (a forward pass over the word). The piece
probabilities of a language come from counts over every learning row: each
task counts the pieces of its words, Spark sums the counts by language and
piece: of the pieces that a greedy cut of each word from the left into the longest ones
gives, as the counts before any probabilities are known. Words recur, so a task keeps the scores of the words it has met in a
bounded cache; the score of a text is then a sum over all of its words.

Defined cases: a null text and one without a letter are ``und`` with score 0;
rows with a null language or id are not learned from; if nothing can be
learned every text is ``und``; letters outside the vocabulary cost the same
in every language; ties go to the first language by code point; very long
words are scored whole; other columns are kept.

The posterior says which language is the likeliest, not whether the text is in
any: it goes to 1 with length. ``plausible`` decides that on the log likelihood per
letter, against what the learning rows of the same language have.
"""

from __future__ import annotations

import functools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import BATCH_ROWS, map_texts, per_worker

UNKNOWN = "und"
SMOOTHING = 0.5       # added to the count of every piece
UNKNOWN_LETTER = 1e-6
SCALE = 20.0
CACHED_WORDS = 300_000
#: letters from which differences between documents, no more chance, spread the log likelihood per letter
STEADY_LETTERS = 256
WIDTH, LEAST_SPREAD = 10.0, 1.0   # spreads below the median that are still plausible; least spread, by 1 / sqrt(letters)
LETTERS = re.compile(r"[^\W\d_]+")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@functools.lru_cache(maxsize=1)
def vocabulary(path: str) -> dict[str, int]:
    """The lower-cased letter pieces of a public vocabulary, numbered by code point order."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).replace("▁", "").lower() for i in range(model.get_piece_size())}
    return {p: i for i, p in enumerate(sorted(p for p in pieces if p.isalpha()))}


def text_words(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def longest_piece(pieces: dict[str, int]) -> int:
    return max(map(len, pieces), default=1)


def longest_pieces(word: str, pieces: dict[str, int], longest: int) -> list[int]:
    """The word cut from the left into the longest pieces; letters outside are left out."""
    out, at = [], 0
    while at < len(word):
        for end in range(min(len(word), at + longest), at, -1):
            piece = pieces.get(word[at:end])
            if piece is not None:
                out.append(piece)
                break
        at = max(end, at + 1)
    return out


class _PieceCache(dict):
    def __init__(self, pieces):
        self.pieces, self.longest = pieces, longest_piece(pieces)

    def __missing__(self, word):
        found = longest_pieces(word, self.pieces, self.longest)
        if len(self) > CACHED_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = found
        return found


def _piece_cache(path: str) -> _PieceCache:
    return per_worker(("pieces", path), lambda: _PieceCache(vocabulary(path)))


def piece_counts(rows: DataFrame, vocabulary_path: str) -> DataFrame:
    """(lang, piece, n) over every row of ``rows`` (columns lang, text)."""
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def emit(counts):
        keys, values = list(counts), list(counts.values())
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                                           pa.array(values, pa.int64())], names=["lang", "piece", "n"])

    def count(batches):
        known, words = _piece_cache(vocabulary_path), {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.setdefault(lang, Counter()).update(text_words(text))
            if sum(map(len, words.values())) > CACHED_WORDS // 2:
                yield emit(_total(words, known))
                words = {}
        yield emit(_total(words, known))

    found = rows.select("lang", "text").mapInArrow(count, "lang string, piece int, n bigint")
    return found.groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def _total(words: dict[str, Counter], known: _PieceCache) -> dict:
    total: dict = {}
    for lang, counter in words.items():
        own: dict = {}
        for word, n in counter.items():
            for p in known[word]:
                own[p] = own.get(p, 0) + n
        total |= {(lang, p): n for p, n in own.items()}
    return total


class LanguageModel:
    """Per-language piece probabilities; at most vocabulary size x number of languages numbers."""

    def __init__(self, langs: list[str], counts: np.ndarray, vocabulary_path: str):
        self.langs, self.path = langs, vocabulary_path
        smooth = counts + SMOOTHING
        self.probability = smooth / smooth.sum(axis=1, keepdims=True) if len(langs) else smooth


def learn(rows: DataFrame, vocabulary_path: str | None = None) -> LanguageModel:
    """Counts over all ``rows`` with a language (columns lang, text)."""
    path = vocabulary_path or default_vocabulary()
    used = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # one row per language and piece: languages x vocabulary bounds what is collected
    found = piece_counts(used, path).collect()
    langs = sorted({r["lang"] for r in found})
    counts = np.zeros((len(langs), len(vocabulary(path))))
    for r in found:
        counts[langs.index(r["lang"]), r["piece"]] = r["n"]
    return LanguageModel(langs, counts, path)


class Trie:
    """The vocabulary as sorted edges (node * letters + letter -> node), to be walked by many words at once."""

    def __init__(self, pieces: dict[str, int]):
        self.letters = {c: i + 1 for i, c in enumerate(sorted(set("".join(pieces))))}
        self.width = len(self.letters) + 1
        edges, piece_at = {}, [-1]
        for piece, number in pieces.items():
            node = 0
            for c in piece:
                key = node * self.width + self.letters[c]
                if key not in edges:
                    edges[key] = len(piece_at)
                    piece_at.append(-1)
                node = edges[key]
            piece_at[node] = number
        self.keys = np.array(sorted(edges), np.int64)
        self.nodes = np.array([edges[k] for k in self.keys.tolist()], np.int64)
        self.piece_at = np.array(piece_at)

    def codes(self, words: list[str]) -> np.ndarray:
        """(words, longest) letters; 0 stands for letters outside the vocabulary and for the end."""
        longest = max(map(len, words))
        get = self.letters.get
        return np.array([[get(c, 0) for c in w.ljust(longest, "\0")] for w in words], np.int64)


class Scorer(dict):
    """word -> row of ``table``: log likelihoods by language, and the number of letters."""

    def __init__(self, model: LanguageModel):
        pieces = vocabulary(model.path)
        self.n, self.trie, self.longest = len(model.langs), Trie(pieces), longest_piece(pieces)
        #: probabilities are scaled by a constant per letter so that sums of short words stay near 1
        self.scaled = model.probability.T * SCALE ** np.array([len(p) for p in pieces])[:, None]
        self.table = np.zeros((1024, self.n + 1))

    def score_words(self, words: list[str]) -> np.ndarray:
        """(words, languages): log of the sum over all segmentations, by the forward algorithm.

        ``alpha[:, at]`` sums the ways to reach a letter; the words walk the trie from
        there together. Sums are brought back to 1 every 16 letters.
        """
        trie, codes = self.trie, self.trie.codes(words)
        lengths = np.array([len(w) for w in words])
        alpha = np.zeros((len(words), codes.shape[1] + self.longest + 1, self.n))
        alpha[:, 0] = 1.0
        logs = np.zeros((len(words), self.n))
        for at in range(codes.shape[1]):
            rows = np.flatnonzero(lengths > at)
            if at and at % 16 == 0:
                now = alpha[rows, at]
                alpha[rows, at:at + self.longest] /= now[:, None]
                logs[rows] += np.log(now)
            node, alone = np.zeros(len(rows), np.int64), rows
            for k in range(min(self.longest, codes.shape[1] - at)):
                key = node * trie.width + codes[rows, at + k]
                place = np.minimum(np.searchsorted(trie.keys, key), len(trie.keys) - 1)
                on = trie.keys[place] == key
                rows, node = rows[on], trie.nodes[place[on]]
                piece = trie.piece_at[node]
                whole = piece >= 0
                ends = rows[whole]
                alpha[ends, at + k + 1] += alpha[ends, at] * self.scaled[piece[whole]]
                if k == 0:  # a letter that is no piece costs the same in every language
                    other = np.setdiff1d(alone, ends, assume_unique=True)
                    alpha[other, at + 1] += alpha[other, at] * (UNKNOWN_LETTER * SCALE)
                if not len(rows):
                    break
        return logs + np.log(alpha[np.arange(len(words)), lengths]) - lengths[:, None] * np.log(SCALE)

    def learn(self, words: set[str]) -> None:
        """Rows for words that have none."""
        new, at = sorted(words, key=len), 0
        while len(self) + len(new) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        while at < len(new):  # words of like length together
            group = new[at:at + max(1, min(8192, (1 << 18) // len(new[at])))]
            group = group[:sum(len(w) <= 2 * len(group[0]) + 8 for w in group)]
            first = len(self)
            self.table[first:first + len(group), :-1] = self.score_words(group)
            self.table[first:first + len(group), -1] = [len(w) for w in group]
            self.update(zip(group, range(first, first + len(group))))
            at += len(group)

    def log_likelihoods(self, texts: list[str]) -> np.ndarray:
        """(texts, languages and at the end the number of letters), over all words of each text."""
        if len(self) > CACHED_WORDS:
            self.clear()
            self.table = np.zeros((1024, self.n + 1))
        split = [text_words(t) for t in texts]
        self.learn(set().union(*split).difference(self))
        return np.array([self.table[np.fromiter(map(self.__getitem__, words), np.int64, len(words))].sum(axis=0) for words in split])


def _scorer_of(model) -> Scorer:
    return per_worker(("scorer", model.id), lambda: Scorer(model.value))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``doc`` with lang_pred, score (the posterior of lang_pred under equal priors), the number of
    letters, and the log likelihood per letter under lang_pred (null for ``und``)."""
    shared = _Shared(docs.sparkSession.sparkContext.broadcast(model))

    def start():
        scorer = _scorer_of(shared)
        langs = shared.value.langs

        def work(texts):
            pred, score, size, each = [], [], [], []
            for *logs, letters in scorer.log_likelihoods([t.decode("utf-8", "replace") for t in texts]):
                size.append(int(letters))
                if not letters or not langs:
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    each.append(None)
                    continue
                best = int(np.argmax(logs))
                pred.append(langs[best])
                score.append(float(1.0 / np.exp(np.array(logs) - logs[best]).sum()))
                each.append(float(logs[best] / letters))
            return [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(size, pa.int64()), pa.array(each, pa.float64())]

        return work

    return map_texts(docs, text_col, "lang_pred string, score double, letters bigint, per_letter double", start)


def plausible(found: DataFrame, learned: Column) -> Column:
    """Whether a row of ``found`` (from ``identify``, stored) reads like its language.

    The log likelihood per letter may lie ``WIDTH`` spreads below the median of the learning rows
    (``learned``) found to be in the language; the spread is the 95% quantile of their distances to
    the median, and widens by 1 / sqrt(letters) for texts of under ``STEADY_LETTERS`` letters. A
    language that no learning row is found to be in takes the figures of all learning rows.
    """
    rows = found.where(learned & F.col("per_letter").isNotNull()).select("lang_pred", "letters", "per_letter")
    steady = F.sqrt(F.least(F.col("letters"), F.lit(STEADY_LETTERS)))

    def quantile(value: Column, share: float) -> Column:
        # a row for each language, and one for all
        got = {r[0]: r[1] for r in rows.rollup("lang_pred").agg(F.percentile_approx(value, share)).collect()}
        out = F.lit(got.get(None))
        for lang, x in got.items():
            if lang is not None:
                out = F.when(F.col("lang_pred") == lang, x).otherwise(out)
        return out.cast("double")

    median = quantile(F.col("per_letter"), 0.5)
    spread = F.greatest(quantile(F.abs(F.col("per_letter") - median) * steady, 0.95), F.lit(LEAST_SPREAD))
    return F.coalesce(F.col("per_letter") >= median - WIDTH * spread / steady, F.lit(False))


class _Shared:
    """A broadcast value with a name that is the same in every task."""

    def __init__(self, broadcast):
        import uuid
        self.broadcast, self.id = broadcast, uuid.uuid4().hex

    @property
    def value(self):
        return self.broadcast.value


def held_out(id_col: str = "doc_id"):
    """Rows that are never learned from; a row without id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learned(id_col: str = "doc_id") -> Column:
    return F.col(id_col).isNotNull() & ~held_out(id_col)


def learning_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    return docs.where(learned(id_col)).select(
        F.col(lang_col).cast(T.StringType()).alias("lang"), F.col(text_col).alias("text"))
