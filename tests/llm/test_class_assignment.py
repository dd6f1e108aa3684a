"""Words that are no units of the exchange get the class of their neighbours, however many the words."""

import pytest

from riskloom.llm import class_lm as lm


# without a sweep the two words beside keep classes of their own; with sweeps and few units too
@pytest.mark.parametrize(("hot", "sweeps"), [(lm.HOT, 0), (2000, 2)])
def test_words_beyond_the_units_follow_their_neighbours(spark, monkeypatch, hot, sweeps):
    monkeypatch.setattr(lm, "HOT", hot)
    side = lambda i: "aa" if i % 2 == 0 else "bb"
    # more words than units, each seen 8 times; then 40 seen 6 times with one ending, beside one of two words each
    words = [(f"f{i}", side(i), 8) for i in range(lm.CLASSED + 8)] + [(f"q{i}xyz", side(i), 6) for i in range(40)]
    texts = [f"{s} " + f" {s} ".join([w] * n) + f" {s}" for w, s, n in words]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model, counts = lm.train(lm.texts_as_bytes(docs), sweeps)
    asked = [f"{s} q{i}xyz {s}" for s in ("aa", "bb") for i in range(40)]
    got = lm.score(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), model, counts).collect()
    found = {asked[r["doc_id"]]: r["score"] for r in got}
    for i in range(0, 40, 2):
        assert found[f"aa q{i}xyz aa"] > found[f"aa q{i + 1}xyz aa"] + 0.05
        assert found[f"bb q{i + 1}xyz bb"] > found[f"bb q{i}xyz bb"] + 0.05
