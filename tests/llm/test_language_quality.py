"""Language identification and compression quality: held-out accuracy, rows, odd inputs."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from affinia.llm import language, quality
from affinia.llm.samples import labelled_sample

SYLLABLES = {"xx": "ba ro ti lu ne".split(), "yy": "schen gru pft oß ein".split(), "zz": "ção nha lhe ões um".split()}


def prose(lang, rng, n=60):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


def crc(i):
    return zlib.crc32(str(i).encode())


def test_language_on_held_out_documents(spark):
    rng = random.Random(1)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(240)]
    rows = [(i, prose(lang, rng), lang, 5, "x") for i, lang in enumerate(langs)]
    odd = [(900, None, "xx", 0, ""), (901, "", "xx", 0, ""), (902, "12 34 !!", "yy", 0, ""), (None, rows[0][1], None, 0, "")]
    docs = spark.createDataFrame([*rows, *odd, rows[3]], "doc_id long, text string, lang string, score int, answer string")
    got = language.identify(docs).collect()
    assert len(got) == len(rows) + len(odd) + 1
    by_id = {r.doc_id: r for r in got}
    for i, lang in enumerate(langs):
        assert by_id[i].held_out == (crc(i) % 3 == 1)
        assert by_id[i].lang_pred == lang and 0 <= by_id[i].score <= 1
    for i in (900, 901, 902):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert by_id[None].held_out and by_id[None].lang_pred == langs[0]
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert not {900, 901, 902} & set(ids) and len(ids) >= 0.95 * len(rows)


def test_language_labels_of_held_out_rows_are_not_used(spark):
    rng = random.Random(2)
    rows = [(i, prose("xx", rng), "xx" if crc(i) % 3 != 1 else "never", 0, "") for i in range(60)]
    got = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, a int, b string"))
    assert {r.lang_pred for r in got.collect()} == {"xx"}


def test_language_without_rows(spark):
    schema = "doc_id long, text string, lang string"
    assert language.identify(spark.createDataFrame([], schema)).collect() == []
    alone = spark.createDataFrame([(1, "word", None)], schema)
    assert [tuple(r)[2:] for r in language.identify(alone).collect()] == [("und", 0.0, True)]


def test_subwords_do_not_depend_on_the_piece(monkeypatch):
    text = "Äber zwei-Wörter, und 3 mehr. " * 9
    whole = np.sort(np.concatenate(list(language.subwords(text))))
    monkeypatch.setattr(language, "_PIECE", 17)
    assert np.array_equal(np.sort(np.concatenate(list(language.subwords(text)))), whole)


def labelled(rng, n=500):
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = prose("xx", rng, 150)
        rows.append((i, text if good else " ".join(w.upper() + "!!" for w in text.split()), 0.5))
        if i % 3:
            labels.append((i, int(good), 9))
    return rows, labels


def test_quality_on_held_out_documents(spark):
    rng = random.Random(3)
    rows, labels = labelled(rng)
    odd = [(1000, None, 0.0), (1001, "", 0.0), (1002, "x" * 300_000, 0.0), (None, rows[0][1], 0.0), rows[5]]
    docs = spark.createDataFrame([*rows, *odd], "doc_id long, text string, score double")
    known = spark.createDataFrame([*labels, (1, 7, 0), (2, None, 0), (4, None, 1)], "doc_id long, quality int, text int")
    got = quality.quality_scores(docs, known).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and all(crc(r.doc_id) % 4 == 2 for r in held)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1000].score == by_id[1001].score and by_id[None].held_out


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)]])
def test_quality_without_both_labels(spark, labels):
    docs = spark.createDataFrame([(1, "some text", 0.0)], "doc_id long, text string, score double")
    known = spark.createDataFrame(labels, "doc_id long, quality int, text int")
    assert [(r.score, r.predicted) for r in quality.quality_scores(docs, known).collect()] == [(0.5, 0)]
    assert quality.quality_scores(docs.limit(0), known).collect() == []


def sampled(langs, n=80):
    rng = random.Random(5)
    return [(lang, prose(lang, rng, 40), i) for i in range(n) for lang in langs]


def test_texts_in_no_learned_language_are_rejected():
    model = language.fit(sampled(SYLLABLES))
    foreign = [
        "это предложение написано на языке, которого модель никогда не видела", "这是一个模型从未见过的语言写成的句子" * 3,
        "xkcd qwrtp zxcvb mnbvq plkjh wrtzx qqkzv bdfgh jklmn", prose("xx", random.Random(6), 40)[::-1].replace("a", "w").replace("o", "k"),
    ]
    for text in foreign:
        lang, score, rejected = model.predict(text)
        assert lang in SYLLABLES and score < 0.05 and rejected
    rng = random.Random(7)
    for lang in SYLLABLES:
        answers = [model.predict(prose(lang, rng, 40)) for _ in range(50)]
        assert all(a[0] == lang and a[1] > 0.5 and not a[2] for a in answers)


def test_a_left_out_language_is_rejected():
    for left in SYLLABLES:
        model = language.fit(sampled([lang for lang in SYLLABLES if lang != left]))
        rng = random.Random(8)
        assert all(model.predict(prose(left, rng, 40))[2] for _ in range(20))


def test_score_equals_a_plain_loop():
    model = language.fit(sampled(SYLLABLES, 30))
    text = "baro schen, ção"
    code = [0] + [ord(c) if c.isalpha() else 0 for c in text] + [0]
    total, n = np.zeros(language.DIMENSIONS + 1), 0
    for size in language.GRAMS:
        for at in range(len(code) - size + 1):
            run = code[at : at + size]
            if not (all(run[1:-1]) if size > 2 else any(run)):
                continue
            h = size
            for c, factor in zip(run, (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)):
                h = ((h ^ c) * factor) & 0xFFFFFFFF
                h ^= h >> 15
            total += model.table[h >> 17]
            n += 1
    mean = total / n
    z = [float(mean[:-1] @ model.weight[:, i] + model.bias[i]) / model.temperature for i in range(3)]
    p = np.exp(z) / np.exp(z).sum()
    best = int(p.argmax())
    x = (mean[-1] - model.usual[best]) * n / (n + language.SHORT)
    known = 1 / (1 + np.exp(-(model.familiar[0] * x + model.familiar[1])))
    assert model.predict(text)[:2] == (model.languages[best], pytest.approx(p[best] * known))


def test_every_language_is_learned_from(spark):
    rows = [(i, f"w{i} text", f"l{i % 300}") for i in range(1200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").select("lang", "text")
    got = labelled_sample(frame, "lang", 1000, 600)
    counts = Counter(lang for lang, _, _ in got)
    assert len(counts) == 300 and set(counts.values()) == {2}
    assert sorted(labelled_sample(frame.repartition(7), "lang", 1000, 600)) == sorted(got)
