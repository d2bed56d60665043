from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from furrow.llm import language_id, quality
from furrow.llm.sampling import remainder, sample_per_class

DATA = "/root/testdata/sf0.01"


def tables(spark):
    return (spark.read.parquet(f"{DATA}/{name}.parquet") for name in ("documents", "labels"))


def test_sample_is_bounded_even_and_weighted(spark):
    rows = spark.range(9000).select(F.col("id"), F.when(F.col("id") % 90 == 0, "b").when(F.col("id") % 7 > 0, "a").alias("c"))
    taken = sample_per_class(rows, "c", "id", 500)
    got = {r["c"]: r for r in taken.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("all")).collect()}
    assert set(got) == {"a", "b"} and got["b"]["n"] == 100 and got["a"]["n"] == pytest.approx(500, abs=80)
    sizes = dict(map(tuple, rows.groupBy("c").count().collect()))
    assert all(got[c]["all"] == pytest.approx(sizes[c], rel=0.16) for c in got)


# Languages


@pytest.fixture(scope="module")
def model(spark):
    docs, _ = tables(spark)
    return language_id.fit(docs.where(remainder("doc_id", 4) != 2))


def test_held_out_languages(spark, model):
    docs, _ = tables(spark)
    found = language_id.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where(remainder("doc_id", 4) == 2).collect()
    assert len(held) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.99
    assert all(0 < r["score"] <= 1 for r in held)


def test_known_words_come_first_then_longer_grams(model):
    known = next(iter(model.tables[0]))
    assert (model.word(known) == model.matrix[model.tables[0][known]]).all()
    unseen = "zzthqq"
    assert unseen not in model.tables[0]
    size = next(n for n in (4, 3, 2, 1) if any(g in model.tables[n] for g in language_id.grams(unseen, n)))
    rows = [model.tables[size][g] for g in language_id.grams(unseen, size) if g in model.tables[size]]
    assert np.allclose(model.word(unseen), model.matrix[rows].mean(0))
    assert (model.word("漢字") == 0).all()


def test_frequencies_are_counted_over_all_training_words(docs):
    rows = [(1, "aa aa bb", "x"), (2, "aa cc", "x"), (3, "bb", "y"), (4, None, "y"), (5, "dd", None), (None, "ee", "y")]
    own = language_id.fit(docs(rows))
    assert own.languages == ["x", "y"] and set(own.tables[0]) == {"aa", "bb", "cc"}
    totals, words = [5, 1], {"aa": (3, 0), "bb": (1, 1), "cc": (1, 0)}
    for word, counts in words.items():
        want = [np.log((n + 0.5) / (total + 0.5 * 3 + 1)) for n, total in zip(counts, totals)]
        assert np.allclose(own.word(word), want)


def test_undetermined_repeated_long_and_clashing(spark, model, docs, clashing, monkeypatch):
    rows = [(1, None), (2, ""), (3, "123 !? ½ ٣"), (4, "the and of"), (4, "the and of"), (None, "the"), (6, "der die " * 90_000)]
    got = {str(r["doc_id"]): (r["lang_pred"], r["score"]) for r in language_id.predict(clashing(rows), model).collect()}
    assert all(got[i] == ("und", 0.0) for i in "123")
    assert got["4"][0] == "en" and got["None"][0] == "en" and got["6"][0] == "de"
    assert language_id.predict(docs([]), model).count() == 0
    nothing = language_id.fit(docs([]))
    assert language_id.predict(docs(rows), nothing).where("lang_pred != 'und' or score != 0").count() == 0


def test_a_small_cache_gives_the_same_scores(model, monkeypatch):
    text = " ".join(random.Random(1).choices("the of und die der zzz la les que".split(), k=5000))
    want = language_id._Scores(model).totals(pa.array([text, "", "der"]))
    monkeypatch.setattr(language_id, "HELD_WORDS", 1)
    more = text + " " + " ".join(map(str, range(3000)))
    small = language_id._Scores(model)
    assert np.allclose(small.totals(pa.array([more, "", "der"])), want, rtol=1e-4)
    assert np.allclose(small.totals(pa.array([more])), want[:1], rtol=1e-4) and small.limit == 1_000


def test_whole_texts_like_word_by_word(spark, model):
    """Every text of the smallest table, in plain Python over the model's words."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    for r in language_id.predict(table, model).collect():
        words = language_id.words_of(texts[r["doc_id"]] or "")
        if not words:
            assert (r["lang_pred"], r["score"], r["runs"]) == ("und", 0.0, 0)
            continue
        sums = np.sum([model.word(w).astype(float) for w in words], axis=0)
        known = [at for w in words if (at := model.tables[0].get(w)) is not None]
        shares = np.exp(min(len(words), language_id.EVIDENCE) / len(words) * (sums - sums.max()))
        assert r["lang_pred"] == model.languages[int(sums.argmax())] and r["runs"] == len(words)
        assert r["score"] == pytest.approx(1 / shares.sum(), rel=1e-4)
        assert r["familiar"] == pytest.approx(sum(model.familiar[at] for at in known) / len(words), abs=1e-6)


def test_rare_words_and_grams_of_a_large_vocabulary_are_kept(docs):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(letters[k // 26**i % 26] for i in range(4)) for k in range(0, 26**4, 10)]
    own = language_id.fit(docs([(1, " ".join(words), "x"), (2, "aaaa b", "y")]))
    assert len(words) > 45_000 and set(words) <= set(own.tables[0])
    counts, grams = {}, (g for w in words for g in language_id.grams(w, 3))
    for gram in grams:
        counts[gram] = counts.get(gram, 0) + 1
    assert 10_000 < len(counts) < 20_000 and all(g in own.tables[3] for g in counts)


def test_keys_are_a_small_exact_table(monkeypatch):
    import pickle

    names = [f"wörd{i}" for i in range(3000)] + ["", "漢字"]
    for clash in (False, True):
        if clash:
            monkeypatch.setattr(language_id.xxhash, "xxh3_64_intdigest", lambda b: len(b))
            names = names[-200:]
        keys = language_id.Keys(names, 7)
        again = pickle.loads(pickle.dumps(keys))
        assert sorted(map(again.get, names)) == list(range(7, 7 + len(names))) and set(keys) == set(names)
        assert "none" not in keys and keys.get("wörd3001") is None and len(keys) == len(names)
        assert len(pickle.dumps(keys)) < 32 * len(names) + 500
    assert language_id.Keys([]).get("a") is None


# Quality


@pytest.fixture(scope="module")
def judge(spark):
    docs, labels = tables(spark)
    return quality.fit(docs, labels.where(remainder("doc_id", 5) != 0))


def test_held_out_quality(spark, judge):
    docs, labels = tables(spark)
    held = quality.score(docs, judge).join(labels, "doc_id").where(remainder("doc_id", 5) == 0).collect()
    low, high = ([r["score"] for r in held if r["quality"] == q] for q in (0, 1))
    assert len(low) >= 5 and len(high) > 50
    assert np.mean([s >= 0.3 for s in high]) > 0.98 and np.mean([s < 0.3 for s in low]) > 0.8
    assert np.mean([h > x for h in high for x in low]) > 0.95


def test_index_vectors_are_sparse_and_fixed():
    one = quality.index_vector("word")
    assert (one == quality.index_vector("word")).all() and 0 < np.abs(one).sum() <= quality.NONZERO
    assert len({quality.index_vector(str(i)).tobytes() for i in range(300)}) > 295


def test_contexts_are_sums_of_neighbours(judge):
    import pyarrow as pa

    tokens = list(judge.vocabulary)[10:16]
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(tokens).encode()])], ["text"])
    (out,) = quality._contexts(iter([batch]), judge)
    near = {t: np.frombuffer(c.as_py(), np.float32) for t, c in zip(out.column(0).to_pylist(), out.column(1))}
    ids = judge.ids(quality.tokens_of(" ".join(tokens).encode()))
    for i, token in enumerate(ids):
        if ids.count(token) == 1:
            want = judge.vectors[ids[max(0, i - quality.REACH) : i + quality.REACH + 1]].sum(0)
            assert np.allclose(near[token], want, atol=1e-5)


def test_pooled_text_is_the_mean_of_its_tokens(judge, monkeypatch):
    text = ("The thing thing thing, of (and) WORDS unknownword 12 !! !! " * 9).encode()
    ids = judge.ids(quality.tokens_of(text))
    want = judge.vectors[ids].mean(0)
    assert np.allclose(quality._Vectors(judge).pooled(text), want, atol=1e-5)
    monkeypatch.setattr(quality, "HELD_WORDS", 8)
    assert np.allclose(quality._Vectors(judge).pooled(text), want, atol=1e-5)
    assert (quality._Vectors(judge).pooled(None) == 0).all()


def test_whole_texts_like_token_by_token(spark, judge):
    """Every text of the smallest table: vectors of its tokens, their mean, and the two layers, in plain Python."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in table.collect()}
    for r in quality.score(table, judge).collect():
        ids = judge.ids(quality.tokens_of(texts[r["doc_id"]].encode()))
        pooled = np.sum([judge.vectors[i].astype(float) for i in ids], axis=0) / len(ids) if ids else np.zeros(quality.DIMENSIONS)
        x = (pooled - judge.mean) / judge.spread
        hidden = [math.tanh(float(x @ w) + o) for w, o in zip(judge.hidden[0].T, judge.hidden[1])]
        logit = sum(h * w for h, w in zip(hidden, judge.output[0])) + judge.output[1]
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-logit / judge.temperature)), abs=1e-4)


def test_of_several_labels_of_one_id_the_smallest_counts(docs, spark):
    rows = docs([(i, f"word{i % 3} text") for i in range(30)])
    labels = [(i, i % 2) for i in range(30)]
    one, two = (
        quality.fit(rows, spark.createDataFrame(own, "doc_id long, quality int").repartition(parts))
        for own, parts in ((labels, 1), (labels + [(0, 1), (2, 1), (0, 0), (3, None)], 4))
    )
    assert np.allclose(one.hidden[0], two.hidden[0], atol=1e-4) and one.output[1] == pytest.approx(two.output[1], abs=1e-4)


def test_training_learns_and_the_temperature_calms():
    random_ = np.random.default_rng(5)
    x = random_.normal(0, 1, (3000, quality.DIMENSIONS))
    truth = 1 / (1 + np.exp(-(x[:, 0] * x[:, 1] + x[:, 2])))
    y = (random_.random(3000) < truth).astype(float)
    model = quality.QualityModel({}, x, np.zeros(1), np.ones(1), (x[:1].T, x[0]), (x[0], 0.0))
    quality.train(model, x, y, np.ones(3000))
    held = slice(2400, None)
    loss = lambda p: -np.mean(y[held] * np.log(p) + (1 - y[held]) * np.log(1 - p))
    calibrated = loss(np.clip(model.probability(x[held]), 1e-9, 1 - 1e-9))
    sharp, model.temperature = model.temperature, 1.0
    assert sharp > 1 and calibrated <= loss(np.clip(model.probability(x[held]), 1e-9, 1 - 1e-9))


def test_quality_edges(spark, judge, docs, clashing):
    rows = [(1, None), (2, ""), (3, "the thing"), (3, "the thing"), (None, "of"), (5, "word " * 200_000)]
    got = quality.score(clashing(rows), judge).collect()
    scores = {str(r["doc_id"]): r["score"] for r in got}
    assert len(got) == 6 and scores["1"] == scores["2"] and all(0 <= s <= 1 for s in scores.values())
    assert quality.score(docs([]), judge).count() == 0
    labels = spark.createDataFrame([(1, 1), (3, None), (None, 0)], "doc_id long, quality int")
    blank = quality.fit(docs(rows), labels)
    assert {r["score"] for r in quality.score(docs(rows), blank).collect()} == {0.5}
