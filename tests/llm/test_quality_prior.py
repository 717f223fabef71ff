"""A bounded sample of the labels does not change what a score means."""

import random

import numpy as np

from affinia.llm import quality
from tests.llm.test_language_quality import labelled


def test_the_sample_size_keeps_the_prior():
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]

    def text(good):  # the two kinds overlap: half of the words come from either end
        at = [min(399, max(0, int(rng.gauss(220 if good else 180, 90)))) for _ in range(40)]
        return " ".join(words[i] for i in at)

    rows = [(label, text(label), rng.randrange(1 << 20)) for label in (1,) * 900 + (0,) * 100]
    few = [r for r in rows if r[0] == 0] + rows[:100]
    asked = [text(i % 2).encode() for i in range(200)]
    means = {}
    for name, model in (("all", quality.fit(rows)), ("few", quality.fit(few, {0: 100, 1: 900}))):
        compressors = quality.Compressors(model.good, model.bad, model.raw)
        means[name] = np.mean([model.score(compressors, t) for t in asked])
        assert model.empty == 0.9
    assert abs(means["all"] - means["few"]) < 0.1


def test_a_small_sample_scores_like_a_large_one(spark):
    rows, labels = labelled(random.Random(3))
    docs = spark.createDataFrame([*rows, (1000, "", 0.0)], "doc_id long, text string, score double")
    known = spark.createDataFrame(labels, "doc_id long, quality int, text int")
    large, small = ({r.doc_id: r for r in quality.quality_scores(docs, known, n).collect()} for n in (2000, 30))
    assert small[1000].score == large[1000].score
    assert np.mean([small[i].predicted == large[i].predicted for i in large]) > 0.97
