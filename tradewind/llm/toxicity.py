"""Toxicity scores of texts whose disguised words are restored first.

Disguise is a noisy channel: letters are written as look-alike digits and signs, spaced out or interspersed with
marks, and repeated.  A suspicious word becomes a lattice of what each sign may stand for, with the cost of that
disguise, and Viterbi decoding finds the reading that the channel and a character trigram model make likeliest.
A logistic regression over the restored words and their beginnings then scores the document.

The character model counts the words of all texts.  Only the regression reads a bounded sample: at most ``SAMPLE_ROWS``
labelled documents outside the held-out fifth, and at most ``MODEL_FEATURES`` features, the ones that set labels apart
most surely among all its words.  Every document is scored over its whole text.  Defined cases: a null or empty text gets the score of no evidence; without labels every
score is 0; repeated rows get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import ROWS_PER_BATCH, by_batch, held_out, stored, texts
from tradewind.llm.sampling import distinct_stories, fit_logistic, letter_words, sample_texts

SAMPLE_ROWS = 12_000
MODEL_FEATURES = 6_000
CACHED_WORDS = 100_000
LEAST_SUPPORT = 5

# What a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "×": "x",
}
FILLERS = " .-_*~'`·,/\\#^=:;"
EDGES = ".,;:!?\"'()[]{}<>*-_~`|/\\=#%&"
SIGNS = "".join(c for c in LOOKALIKES if not c.isalnum())
# One letter, digit or look-alike sign on its own; a run has three or more, with white space and marks between them.
SINGLE = rf"[^\W_{re.escape(SIGNS)}](?!\w)|[{re.escape(SIGNS)}](?!\w)"
SPACED = re.compile(rf"(?<!\w)(?<!\w['’])(?:{SINGLE})(?:[\s{re.escape(FILLERS)}]+(?:{SINGLE})(?!['’](?!s\b)\w)){{2,}}+")
GLUED_AFTER, GLUED_BEFORE = re.compile(r"[^\w\s]+\w"), re.compile(r"\w[^\w\s]+\Z")
INVISIBLE = re.compile("[\u00ad\u034f\u061c\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufe00-\ufe0f\ufeff]+")
REPEATED = re.compile(r"(.)\1")
DISGUISE, FILL, DOUBLE, SINGLED, UNREAD, MARK = -1.5, -0.5, -0.7, -3.5, -9.0, -5.0


class CharModel:
    """Interpolated character trigrams of words; unseen letters get a small share."""

    def __init__(self, three: dict[str, float]):
        """``three``: the weight of each trigram of the words, with two spaces before a word and one after it."""
        two, one = Counter(), Counter()
        for gram, n in three.items():
            two[gram[1:]] += n
            one[gram[2]] += n
        pairs, singles = Counter(), Counter()
        for gram, n in three.items():
            pairs[gram[:2]] += n
        for gram, n in two.items():
            singles[gram[0]] += n
        total = sum(one.values()) or 1
        flat = lambda c: 0.98 * one[c] / total + 0.02 / 1000
        self.two = {g: math.log(0.8 * n / singles[g[0]] + 0.2 * flat(g[1])) for g, n in two.items()}
        self.one = {c: math.log(0.2 * flat(c)) for c in one}
        self.three = {
            g: math.log(0.85 * n / pairs[g[:2]] + 0.15 * math.exp(self.two.get(g[1:], self.one[g[2]]))) for g, n in three.items()}

    def cost(self, before: str, char: str) -> float:
        gram = before + char
        found = self.three.get(gram)
        if found is None:
            found = self.two.get(gram[1:])
            found = (self.one.get(char, -12.0) if found is None else found) - 1.9
        return found


class Decoder(dict):
    """Cache of restored words; a missing one is decoded.  A plain word that has a feature of ``known`` stays."""

    def __init__(self, model: CharModel, known: dict[str, int] | None = None):
        self.model, self.known = model, known or {}

    def __missing__(self, word: str) -> str:
        if len(self) >= CACHED_WORDS:
            self.clear()
        core, open_ = self.bare(word)
        if self.is_suspect(core, open_):
            core = self.decode(open_)
        self[word] = core
        return core

    @staticmethod
    def bare(word: str) -> tuple[str, str]:
        """The word without signs at both ends, and without those behind it."""
        open_ = word.rstrip(EDGES)
        return open_.lstrip(EDGES), open_

    def is_suspect(self, core: str, open_: str) -> bool:
        if core.isalpha():
            return self.doubled(core) or (open_ != core and open_[0] in LOOKALIKES)
        return any(map(str.isalpha, core))

    def doubled(self, word: str) -> bool:
        return bool(REPEATED.search(word)) and not any(x in self.known for x in beginnings(word))

    def lattice(self, word: str) -> list[list[tuple[str, float]]]:
        slots, at = [], 0
        while at < len(word):
            char, run = word[at], 1
            while at + run < len(word) and word[at + run] == char:
                run += 1
            at += run
            if char.isalpha():
                slots.append([[(char, 0.0)], [(char * 2, 0.0), (char, SINGLED)], [(char, 0.0), (char * 2, DOUBLE)]][min(run, 3) - 1])
            elif char in LOOKALIKES:
                reads = [(c * n, DISGUISE) for c in LOOKALIKES[char] for n in range(1, min(run, 2) + 1)]
                slots.append([*reads, (" ", UNREAD if char.isdigit() else MARK)])
            elif char in FILLERS or char.isspace():
                slots.append([("", FILL), (" ", FILL - 2.5)])
            else:
                slots.append([("", FILL), (" ", FILL)])
        return slots

    def decode(self, word: str) -> str:
        """The likeliest reading; a state is the last two characters read."""
        states: dict[str, tuple[float, tuple]] = {"  ": (0.0, ())}
        for slot in [*self.lattice(word), [(" ", 0.0)]]:
            after: dict[str, tuple[float, tuple]] = {}
            for last, (score, path) in states.items():
                for read, cost in slot:
                    state, total = last, score + cost
                    for char in read:
                        if char == " " and state[1] == " ":
                            continue
                        total += self.model.cost(state, char)
                        state = state[1] + char
                    if state not in after or total > after[state][0]:
                        after[state] = (total, (path, read))
            states = after
        _, path = max(states.values(), key=lambda x: x[0])
        reads = []
        while path:
            path, read = path
            reads.append(read)
        return " ".join("".join(reversed(reads)).split())

    def spaced(self, match: re.Match) -> str:
        """The reading of a run of single characters, set apart from what touches it.

        Marks after the run are outside it, and so is an outer part without white space that is glued to a longer word.
        """
        text, (start, stop) = match.string, match.span()
        parts = match[0].split()
        if len(parts) < 2:
            return match[0]
        if len(parts[-1]) > 1 and GLUED_AFTER.match(text, stop):
            stop -= len(parts[-1])
        if len(parts[0]) > 1 and GLUED_BEFORE.search(text, max(0, start - 8), start):
            start += len(parts[0])
        run = text[start:stop].strip().rstrip(EDGES + " ")
        if sum(c.isalnum() or c in SIGNS for c in run) < 3 or not any(map(str.isalnum, run)):
            return match[0]
        at = text.index(run, start)
        return f"{text[match.start(): at]} {self.decode(run)} {text[at + len(run): match.end()]}"

    def opened(self, text: str) -> str:
        """The lower-case text without invisible signs, its runs of single characters read."""
        lower = text.lower()
        return SPACED.sub(self.spaced, lower if lower.isascii() else INVISIBLE.sub("", lower))

    def words(self, text: str) -> list[str]:
        """The restored words of a text in order."""
        return " ".join(map(self.__getitem__, self.opened(text).split())).split()


def beginnings(word: str) -> list[str]:
    """A word's features: itself and its beginnings of four, five and six letters."""
    return [word, *(f"{word[:n]}~" for n in (4, 5, 6) if len(word) > n)]


class Scorer(dict):
    """Cache of the features of a word as it stands in a text; a missing one is restored if a feature can come of it.

    A walk over the word's lattice follows the beginnings of the features, from every place where a word may start.  Where it meets
    none whole, no reading has a feature, and the likeliest one need not be found.
    """

    def __init__(self, decoder: Decoder, features: dict[str, int]):
        self.decoder, self.features = decoder, features
        spelled = {f.rstrip("~") for f in features}
        self.whole, self.starts = spelled, {f[:n] for f in spelled for n in range(1, len(f) + 1)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHED_WORDS:
            for old in list(islice(self, CACHED_WORDS // 2)):
                del self[old]
        decoder = self.decoder
        core, open_ = decoder.bare(word)
        if not decoder.is_suspect(core, open_):
            restored = core
        else:
            restored = decoder.decode(open_) if self.can_score(open_) else ""
        found = self[word] = tuple({self.features[x] for w in restored.split() for x in beginnings(w) if x in self.features})
        return found

    def can_score(self, word: str) -> bool:
        met = {""}
        for slot in self.decoder.lattice(word):
            after = set()
            for read, _ in slot:
                if read == " ":
                    after.add("")
                    continue
                for state in met:
                    for char in read:
                        state += char
                        if state in self.whole:
                            return True
                        if state not in self.starts:
                            break
                    else:
                        after.add(state)
            met = after
        return False

    def of(self, text: str) -> list[int]:
        """The features of a text, in order."""
        return sorted({x for found in map(self.__getitem__, set(self.decoder.opened(text).split())) if found for x in found})


class Model:
    def __init__(self, trigrams: dict[str, float], features: dict[str, int]):
        self.trigrams, self.features = trigrams, features
        self.weights, self.bias = np.zeros(len(features)), -30.0

    def score(self, found: list[int]) -> float:
        z = self.bias + float(self.weights[found].sum())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def workers(self) -> tuple[Decoder, Scorer]:
        decoder = Decoder(CharModel(self.trigrams), self.features)
        return decoder, Scorer(decoder, self.features)


def count_trigrams(docs: DataFrame) -> dict[str, float]:
    """The character trigrams of all words of all texts, each word weighing as many as its documents."""
    words = letter_words(texts(docs, F.lit(0).alias("label"))).groupBy("word").count()
    padded = words.select(F.concat(F.lit("  "), "word", F.lit(" ")).alias("padded"), F.col("count").alias("weight"))
    grams = padded.select("weight", F.explode(F.expr("transform(sequence(1, length(padded) - 2), at -> substring(padded, at, 3))")).alias("gram"))
    return {r.gram: r.weight for r in grams.groupBy("gram").agg(F.sum("weight").alias("weight")).toLocalIterator()}


def choose_features(sample: DataFrame, positives: int, negatives: int) -> dict[str, int]:
    """The features that set toxic documents apart most surely, by a lower bound of their log odds."""
    words = letter_words(sample).groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    starts = [F.when(F.length("word") > n, F.concat(F.substring("word", 1, n), F.lit("~"))) for n in (4, 5, 6)]
    counts = (words.select("a", "b", F.explode(F.array("word", *starts)).alias("feature")).where("feature is not null")
              .groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where(f"a + b >= {LEAST_SUPPORT}"))
    odds = F.log((F.col("a") + 0.5) / (positives + 1)) - F.log((F.col("b") + 0.5) / (negatives + 1))
    bound = odds - 1.5 * F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    best = counts.where(odds > 0).select("feature", bound.alias("bound")).where("bound > 0.5")
    return {r.feature: at for at, r in enumerate(best.orderBy(F.desc("bound"), "feature").limit(MODEL_FEATURES).collect())}


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Count the trigrams of all texts; train on at most ``rows`` labelled documents outside the held-out fifth."""
    sample = stored(distinct_stories(sample_texts(docs, labels, "toxic", rows, ~held_out(F.col("doc_id")))), "toxic-sample")
    size = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    features = choose_features(sample, size.get(1, 0), size.get(0, 0))
    model = Model(count_trigrams(docs), features)

    def found(batch: pa.RecordBatch, workers: tuple[Decoder, Scorer]) -> pa.RecordBatch:
        _, scorer = workers
        rows = [scorer.of(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], names=["label", "found"])

    seen = by_batch(sample, "label int, found array<int>", found, model.workers).collect()
    if size.get(1, 0) and size.get(0, 0):
        model.weights, model.bias = fit_logistic(
            [np.array(r.found, np.int64) for r in seen], [np.ones(len(r.found)) for r in seen],
            np.array([r.label for r in seen], float), len(features), 1e-5, 300, 0.05)
    return model


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row."""

    def work(batch: pa.RecordBatch, workers: tuple[Decoder, Scorer]) -> pa.RecordBatch:
        _, scorer = workers
        scores = [model.score(scorer.of(text)) for text in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return by_batch(texts(docs), "doc_id long, score double", work, model.workers)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose text scores below the threshold; nothing is shuffled."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, scorer = model.workers()
        for part in (batch.slice(at, ROWS_PER_BATCH) for batch in batches for at in range(0, batch.num_rows, ROWS_PER_BATCH)):
            clean = [model.score(scorer.of(t or "")) < threshold for t in part.column(place).to_pylist()]
            yield part.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def restore_texts(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, restored``: the decoded words of every text, separated by single spaces."""

    def work(batch: pa.RecordBatch, workers: tuple[Decoder, Scorer]) -> pa.RecordBatch:
        out = [" ".join(workers[0].words(t)) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "restored"])

    return by_batch(texts(docs), "doc_id long, restored string", work, model.workers)


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    scored = score_toxicity(docs, fit(docs, labels, rows))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
