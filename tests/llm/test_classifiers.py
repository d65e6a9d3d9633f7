"""Quality, language and toxicity: exact counts, held-out accuracy, defined cases."""

import itertools
import math
import re
from collections import Counter

import pytest
from cases import EDGES, documents, edge_docs, labels, no_docs
from pyspark.sql import functions as F

from tradewind.llm import language, quality, toxicity

MIDDLE = "/root/testdata/sf0.01"


def want_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i: i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i: i + 3])] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


def test_quality_counts_and_verdict(spark, small):
    docs, marks = documents(spark, small), documents(spark, small, "labels")
    for frame, known in ((docs, marks), (edge_docs(spark), labels(spark))):
        rows = quality.quality(frame, known).collect()
        texts = {r.doc_id: r.text for r in frame.select("doc_id", "text").collect() if r.doc_id is not None}
        for r in rows:
            if r.doc_id is None:
                continue
            want = want_counts(texts[r.doc_id])
            assert tuple(r)[1:6] == want, r.doc_id
            assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert not (r.base_failed and r.kept) and 0 <= r.probability <= 1
    assert quality.quality(no_docs(spark), labels(spark)).count() == 0


def test_quality_classifier_tells_held_out_rows(spark):
    docs, marks = documents(spark, MIDDLE), documents(spark, MIDDLE, "labels")
    spare = F.col("doc_id") % 4 == 0
    model = quality.fit(docs, marks.where(~spare))
    rows = quality.score_quality(docs, model).join(marks.where(spare), "doc_id").where("not base_failed").collect()
    assert sum((r.probability >= 0.5) == (r.quality == 1) for r in rows) >= 0.9 * len(rows)


def test_quality_rare_class_calibrates(spark):
    """With few rows of a class the classifier stays on, whatever fifth their texts fall in."""
    for bad in (1, 2, 3):
        for salt in "abcd":
            rows = [(i, f"good words stand here {salt} {i}") for i in range(40)] + [(100 + i, f"junk spam zzz {salt} {i}") for i in range(bad)]
            docs = spark.createDataFrame(rows, "doc_id long, text string")
            marks = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows], "doc_id long, quality int")
            model = quality.fit(docs, marks)
            score = lambda text: model.probability(*quality.features(*quality.split_words(text, quality.Hashes())[::2]))
            assert score("junk spam zzz") < score("good words stand here") < 1
    assert quality.spare_fifth(quality.np.array([1.0] * 10 + [0.0] * 3), quality.np.arange(13)).sum() == 3


def test_language(spark):
    docs = documents(spark, MIDDLE)
    rows = language.identify_language(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 100 and sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)
    model = language.fit(docs)
    edge = {r.doc_id: r for r in language.predict(edge_docs(spark), model).collect()}
    assert all(edge[i].lang_pred == "und" and edge[i].score == 0 for i in (1, 2, 3))
    assert all(0 <= r.score <= 1 for r in edge.values())
    assert language.predict(no_docs(spark), model).count() == 0
    odd = spark.createDataFrame([(1, "12 ²³ !?"), (2, "²und")], "doc_id long, text string")
    assert [r.lang_pred == "und" for r in language.predict(odd, model).orderBy("doc_id").collect()] == [True, False]
    assert {r.lang_pred for r in language.identify_language(docs.withColumn("lang", F.lit(None).cast("string")).limit(20)).collect()} == {"und"}


def test_language_backs_off_to_shorter_grams():
    model = language.Model({"haus": {"de": 9}, "maison": {"fr": 9}, "hausboot": {"de": 1}})
    scores = language.Scores(model)
    assert model.languages == ["de", "fr"]
    for word, lang in (("haus", 0), ("hausen", 0), ("maisons", 1), ("xhau", 0)):
        assert scores.of([word]).argmax() == lang, word
    assert (scores.of(["qqq"]) == 0).all() or scores.of(["qqq"]).shape == (2,)


def test_rare_language_keeps_its_words(spark, monkeypatch):
    monkeypatch.setattr(language, "MODEL_WORDS", 40)
    monkeypatch.setattr(language, "MODEL_GRAMS", 40)
    name = lambda head, n: head + "".join("abcdefghij"[int(d)] for d in f"{n:02d}")
    rows = [(i, " ".join(name("big", n) for n in range(60)), "aa") for i in range(200)] + [(1000 + i, "xuqo xuqi xuqe", "zz") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, 20)
    assert model.languages == ["aa", "zz"] and {"xuqo", "xuqi", "xuqe"} <= set(model.words)
    probe = spark.createDataFrame([(1, "xuqo xuqe"), (2, "xuquu"), (3, "bigaa")], "doc_id long, text string")
    assert [r.lang_pred for r in language.predict(probe, model).orderBy("doc_id").collect()] == ["zz", "zz", "aa"]


@pytest.fixture(scope="module")
def toxic_model(spark):
    return toxicity.fit(documents(spark, "/root/testdata/sf0.1"), documents(spark, "/root/testdata/sf0.1", "labels"), 3000)


def test_toxicity_held_out(spark, toxic_model):
    docs, marks = documents(spark, "/root/testdata/sf0.1"), documents(spark, "/root/testdata/sf0.1", "labels")
    picked = docs.join(marks, "doc_id").where(toxicity.held_out(F.col("doc_id")))
    rows = toxicity.score_toxicity(picked, toxic_model).join(marks, "doc_id").collect()
    toxic = [r.score >= 0.5 for r in rows if r.toxic == 1]
    clean = [r.score >= 0.5 for r in rows if r.toxic == 0]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.03 * len(clean)


@pytest.mark.parametrize("disguised, word", [
    ("1d10t", "idiot"), ("p@th3t1c", "pathetic"), ("$cum", "scum"), ("m0r0n", "moron"), ("s-t-u-p-i-d", "stupid"),
    ("i d i o t", "idiot"), ("L O S E R", "loser"), ("stuuuupid", "stupid"), ("d1$gu5t1ng", "disgusting"), ("i.d.i.o.t", "idiot")])
def test_disguise_is_undone(toxic_model, disguised, word):
    decoder, _ = toxic_model.workers()
    assert word in decoder.words(f"und then {disguised} of the")


@pytest.mark.parametrize("disguised, word", [
    ("i d i o t.", "idiot"), ("i d i o t,", "idiot"), ("(i d i o t)", "idiot"), ('"m o r o n"', "moron"), ("i d ! o t", "idiot"),
    ("t r @ s h", "trash"), ("i  d  i  o  t", "idiot"), ("i\nd\ni\no\nt", "idiot"), ("s c u m !", "scum"), ("so:c l o w n", "clown"),
    ("i - d - i - o - t", "idiot"), ("i.d i.o t", "idiot"), ("$ c u m", "scum"), ("iddiott", "idiot"), ("mmoron", "moron"),
    ("idi\u200bot", "idiot"), ("i\u200bd\u200bi\u200bo\u200bt", "idiot"), ("i♥d♥i♥o♥t", "idiot"), ("s.t.u.p.id", "stupid"), ("i d i o t-like", "idiot")])
def test_disguise_with_marks_and_gaps_is_undone(toxic_model, disguised, word):
    decoder, _ = toxic_model.workers()
    assert word in decoder.words(f"und then {disguised} of the")


def test_trigrams_come_from_all_texts(spark):
    """Unlabelled texts decide how signs are read; labelled ones alone would read 'bl'."""
    rows = [(i, "blat blan blor") for i in range(8)] + [(100 + i, f"bixam bixor bixen bixul dixam{'abcdefgh'[i % 8] * 2} rixam") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, toxic int")
    decoder, _ = toxicity.fit(docs, marks).workers()
    assert decoder.words("b1xam") == ["bixam"]


def test_features_are_chosen_before_any_cut(spark):
    """Rare telling words count, however many common ones there are."""
    common = " ".join("w" + "".join("abcdefghij"[int(d)] for d in str(n)) for n in range(100_000, 161_000))
    rows = [(1 if i < 12 else 0, common + (" zzkill" if i < 12 else "")) for i in range(24)]
    sample = spark.createDataFrame(rows, "label int, text string")
    assert "zzkill" in toxicity.choose_features(sample, 12, 12)


def naive_features(decoder, features, text):
    """Every word restored by the full decoding, then looked up."""
    return sorted({features[x] for word in decoder.words(text) for x in toxicity.beginnings(word) if x in features})


def test_skipped_decodings_lose_no_feature(spark, toxic_model):
    decoder, scorer = toxic_model.workers()
    rows = documents(spark, "/root/testdata/sf0.1").where("doc_id % 7 = 0").collect()
    extra = ["id1ot", "iddi00t", "k1llllll", "$tuuup1d!", "s-t-u-p-i-d-ity", "p@@th3t1c mor0n~", "1diot1diot"]
    scored = 0
    for text in [r.text or "" for r in rows] + extra:
        want = naive_features(decoder, toxic_model.features, text)
        assert scorer.of(text) == want, text[:200]
        scored += bool(want)
    assert scored > 20


def test_score_is_the_logistic_of_the_summed_weights(spark, toxic_model):
    decoder, scorer = toxic_model.workers()
    rows = documents(spark, "/root/testdata/sf0.1").where("doc_id % 101 = 0")
    want = {}
    for r in rows.collect():
        z = toxic_model.bias + sum(toxic_model.weights[x] for x in naive_features(decoder, toxic_model.features, r.text or ""))
        want[r.doc_id] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(rows, toxic_model).collect()}
    assert got.keys() == want.keys() and all(abs(got[d] - want[d]) < 1e-12 for d in got)


@pytest.mark.parametrize("word", ["1d10t", "a--b", "$c", "mo0n", "l1", "aab3", "x.y", "!a!", "t7t"])
def test_decoding_finds_the_best_of_all_readings(toxic_model, word):
    """All paths through the lattice, each with its full cost; the best one must be the decoded one."""
    decoder, _ = toxic_model.workers()
    best = {}
    for path in itertools.product(*decoder.lattice(word), [(" ", 0.0)]):
        last, total, read = "  ", 0.0, ""
        for piece, cost in path:
            total += cost
            for char in piece:
                if char == " " and last[1] == " ":
                    continue
                total += decoder.model.cost(last, char)
                last, read = last[1] + char, read + char
        reading = " ".join(read.split())
        best[reading] = max(total, best.get(reading, -1e9))
    assert best[decoder.decode(word)] == pytest.approx(max(best.values()))


def test_plain_words_stay(toxic_model):
    decoder, _ = toxic_model.workers()
    assert decoder.words("The thing, of all (und) Straße!") == ["the", "thing", "of", "all", "und", "straße"]


def test_toxicity_edges(spark, toxic_model):
    rows = toxicity.score_toxicity(edge_docs(spark), toxic_model).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.score_toxicity(no_docs(spark), toxic_model).count() == 0
    unlabelled = toxicity.toxicity(edge_docs(spark), labels(spark)).collect()
    assert all(r.score < 1e-9 and r.predicted == 0 for r in unlabelled)
    kept = toxicity.drop_toxic(edge_docs(spark), toxic_model)
    assert kept.columns == edge_docs(spark).columns and kept.count() == len(EDGES)
