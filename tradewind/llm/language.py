"""Language identification by known words first, then by ever shorter character n-grams.

Each language has log frequencies of words and of character n-grams of 5 down to 1 letters, word ends marked.  A word
known in any language is scored by its frequency in each; an unknown one by the n-grams of the largest length of which
any is known, averaged so that a word weighs alike at every length.  The sum over all words of the text decides.

The fit reads a bounded sample: at most ``SAMPLE_ROWS`` labelled documents outside the held-out fifth, dealt to the
languages in equal shares as far as they have rows.  N-grams are counted over all words of the sample; then each
language keeps its ``MODEL_WORDS`` most frequent words and ``MODEL_GRAMS`` n-grams of each length.  Defined cases: a text that is
null or has no letter is ``und`` with score 0; ties go to the language that comes first in the alphabet; without
training rows everything is ``und``; repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import by_batch, held_out, stored, texts
from tradewind.llm.sampling import letter_words, sample_texts

SAMPLE_ROWS = 8_000
MODEL_WORDS = 60_000
MODEL_GRAMS = 20_000
LONGEST = 5
CACHED_WORDS = 200_000
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")


class Rows:
    """Row of a table for each key; one array travels to the tasks instead of many."""

    def __init__(self, keys: list[str], table: np.ndarray):
        self.at, self.table = {x: at for at, x in enumerate(keys)}, table

    def __iter__(self):
        return iter(self.at)

    def get(self, key: str) -> np.ndarray | None:
        at = self.at.get(key)
        return None if at is None else self.table[at]


class Model:
    """Log frequencies by language, as one row of numbers per word and n-gram."""

    def __init__(self, counts: dict[str, dict[str, int]]):
        """``counts``: word to language to number of documents.  Caps are for each language; n-grams come before the words' cut."""
        self.languages = sorted({lang for found in counts.values() for lang in found})
        self.words = self._rows(counts, MODEL_WORDS)
        self.grams = {}
        for n in range(LONGEST, 0, -1):
            sums: dict[str, Counter] = defaultdict(Counter)
            for word, found in counts.items():
                for gram in grams(word, n):
                    sums[gram].update(found)
            self.grams[n] = self._rows(sums, MODEL_GRAMS)

    def _rows(self, counts: dict, most: int) -> Rows:
        ranked: dict[str, list] = defaultdict(list)
        for x, found in counts.items():
            for lang, n in found.items():
                ranked[lang].append((-n, x))
        best = sorted({x for of in ranked.values() for _, x in heapq.nsmallest(most, of)})
        total = {lang: sum(counts[x].get(lang, 0) for x in best) + 1 for lang in self.languages}
        table = [[math.log((counts[x].get(lang, 0) + 0.1) / (total[lang] + 0.1 * len(best))) for lang in self.languages] for x in best]
        return Rows(best, np.array(table))


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[at: at + n] for at in range(len(marked) - n + 1)]


class Scores(dict):
    """Row of a growing table of scores for each word met so far."""

    def __init__(self, model: Model):
        self.model = model
        self.table = np.zeros((1024, len(model.languages)))

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[at] = self.score(word)
        return at

    def score(self, word: str) -> np.ndarray:
        known = self.model.words.get(word)
        if known is not None:
            return known
        for n in range(LONGEST, 0, -1):
            rows = [row for gram in grams(word, n) if (row := self.model.grams[n].get(gram)) is not None]
            if rows:
                return np.mean(rows, axis=0)
        return np.zeros(len(self.model.languages))

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) > CACHED_WORDS:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.table[at].sum(axis=0)


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most ``rows`` documents with a language outside the held-out fifth."""
    sample = stored(sample_texts(docs, docs, "lang", rows, ~held_out(F.col("doc_id")), shares=True), "language-sample")
    words = letter_words(sample).groupBy("word", "label").count()
    common = words.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("label", "count"))).alias("by"))
    return Model({r.word: r.by for r in common.toLocalIterator()})


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, from its text alone."""

    def work(batch: pa.RecordBatch, scores: Scores) -> pa.RecordBatch:
        langs, sure = [], []
        for text in batch.column(1).to_pylist():
            words = LETTERS.findall(text.lower())
            lettered = any(map(str.isalpha, words)) or any(map(str.isalpha, text))
            if not lettered or not model.languages:
                langs.append(UNKNOWN)
                sure.append(0.0)
                continue
            sums = scores.of(words)
            share = np.exp(sums - sums.max())
            langs.append(model.languages[int(sums.argmax())])
            sure.append(float(1 / share.sum()))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(langs, pa.string()), pa.array(sure, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return by_batch(texts(docs), "doc_id long, lang_pred string, score double", work, lambda: Scores(model))


def identify_language(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document."""
    return predict(docs, fit(docs, rows)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
