"""Language ID: held-out accuracy, Viterbi against all paths, spans of mixed texts."""

import itertools

import numpy as np
import pytest

from riskloom.llm import language_id as lid

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return lid.fit(spark.read.parquet(f"{SF}/documents.parquet").where(~lid.held_out(4, 2)))


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = lid.op3(spark, SF).collect()
    assert len(got) == len(truth)
    tested = [r for r in got if r["held_out"]]
    assert 100 < len(tested) < 400
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in tested) / len(tested) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_spans_of_a_mixed_text(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars between 400 and 900")
    german, french = (docs.where(f"lang = '{x}'").orderBy("doc_id").first()["text"] for x in ("de", "fr"))
    n = len(lid.words_of(german))
    ((lang, score, spans),) = lid.predict(model, [german + " 12 " + french])
    assert [s[2] for s in spans] == ["de", "fr"] and abs(spans[1][0] - n) <= 3 and 0.2 < score < 0.8 and lang in ("de", "fr")


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "12 %% _ ²"), (4, "the " * 30_000), (4, "the the"), (None, "the and")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score string")
    got = lid.identify(docs, model).collect()
    assert [r["llm_lang"] for r in got] == ["und"] * 3 + ["en"] * 3 and got[0]["score"] == "x"
    assert lid.identify(docs.limit(0), model).count() == 0
    empty = lid.fit(docs.selectExpr("text", "cast(null as string) as lang"))
    assert {r["llm_lang"] for r in lid.identify(docs, empty).collect()} == {"und"}


def test_scripts_narrow_candidates(spark):
    rows = [("кот сидит на столе и спит", "ru")] * 3 + [("the cat sits on the mat", "en")] * 3 + [("le chat est sur la table", "fr")] * 3
    small = lid.fit(spark.createDataFrame(rows, "text string, lang string"))
    scores, _ = small.score(["дом", "mat", "日本"])
    en, fr, ru = (small.languages.index(x) for x in ("en", "fr", "ru"))
    assert scores[0, ru] == 0 and scores[0, en] < -19 and scores[1, ru] < -19 and scores[1, en] > scores[1, fr]
    assert (scores[2] > -19).all()


def test_best_paths():
    rng = np.random.default_rng(1)
    counts = np.array([3, 1, 6, 2])
    starts = np.cumsum(counts) - counts
    scores = -rng.random((counts.sum(), 3)).astype(np.float32) * 3
    labels = lid.best_paths(scores, starts, counts, 1.25)
    for s, n in zip(starts, counts):
        value = lambda p: sum(scores[s + i, x] for i, x in enumerate(p)) - 1.25 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: E731, B023
        best = max(itertools.product(range(3), repeat=int(n)), key=value)
        assert value(labels[s : s + n]) == pytest.approx(value(best))


def test_a_language_of_copies_is_learned(spark):
    rows = [(f"кот {i} сидит на столе", "ru") for i in range(5)] * 40 + [("the cat sits", "en"), ("le chat est", "fr")] * 3
    training = spark.createDataFrame(rows, "text string, lang string")
    # whatever the hashes of the texts: a bound of as many texts takes each once
    model, once = lid.fit(training, 5), lid.fit(training.distinct(), 5)
    assert model.uses.any(axis=1).all() and np.array_equal(model.log_p, once.log_p)
    assert lid.predict(model, ["кот на столе"])[0][0] == "ru"


def test_all_training_texts_count(spark):
    rnd = np.random.default_rng(4)
    letters = {"aa": list("abcdefg"), "bb": list("абвгдеж")}
    rows = [(" ".join("".join(rnd.choice(own, 4)) for _ in range(3)), lang) for lang, own in letters.items() for _ in range(2500)]
    model = lid.fit(spark.createDataFrame(rows + rows[:400], "text string, lang string").repartition(6))
    counts, scripts = np.zeros((2, lid.BUCKETS)), np.zeros((2, len(lid.SCRIPT_NAMES)))
    for text, lang in set(rows):
        grams = lid.grams_of(lid.words_of(text))
        counts[sorted(letters).index(lang)] += np.bincount(grams.buckets, minlength=lid.BUCKETS)
        scripts[sorted(letters).index(lang)] += grams.scripts.sum(axis=0)
    assert np.array_equal(model.log_p, lid.Model(sorted(letters), counts, scripts).log_p)
