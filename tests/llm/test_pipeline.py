"""The pipeline's stages on the smallest tables, against brute force where a model is not involved."""

import random

import corpus_pipeline
from affinia.llm import mixing, pieces, simhash, suffixes
from tests.llm.test_simhash import brute_fingerprint, brute_groups
from tests.llm.test_suffixes import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(folder):
    rng = random.Random(12)
    words = {"xx": [f"ba{c}ro{d}" for c in "abcde" for d in "iou"], "yy": [f"sch{c}pf{d}" for c in "äöüei" for d in "tng"]}
    rows = []
    for i in range(160):
        lang = rng.choice(["xx", "yy"])
        rows.append((i, " ".join(rng.choice(words[lang]) + str(rng.randrange(9)) for _ in range(90)), lang, f"s{i % 3}"))
    passage = " ".join(rng.choice(words["xx"]) for _ in range(60))
    for i in range(0, 40, 4):
        rows[i] = (*rows[i][:1], rows[i][1] + " " + passage, *rows[i][2:])
    rows += [(200 + i, rows[i][1], *rows[i][2:]) for i in range(20)]
    rows += [(300, None, "xx", "s1"), (301, "", "yy", None), (302, "12345 !!", None, "s0")]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


def test_stages(spark, tmp_path):
    rows = corpus(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "repeats", "mixing", "pieces"]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    tables = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        tables.append({r.doc_id: r for r in docs.collect()})
        if name != "pieces":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    language, near, cut, mixed, encoded = tables
    assert not {300, 301, 302} & set(language) and len(language) >= 0.98 * 180
    prints = {i: brute_fingerprint(r.text) for i, r in language.items()}
    group, least = brute_groups(prints.values()), {}
    for i, p in prints.items():
        least[group[p]] = min(i, least.get(group[p], i))
    assert set(near) == set(least.values()) and len(near) < len(language)
    ids = sorted(near)
    gone = brute([near[i].text for i in ids])
    for i, g in zip(ids, gone):
        left = "".join(c for c, x in zip(near[i].text.encode("latin1", "replace").decode("latin1"), g) if not x) if near[i].text.isascii() else None
        if left is not None:
            assert (i in cut) == bool(left)
            if left:
                assert cut[i].text == left and cut[i].n_chars == len(left)
    assert any(g.any() for g in gone)
    sampled = {r.doc_id for r in mixing.mixture(spark.createDataFrame(list(cut.values()), SCHEMA)).collect() if r.sampled}
    assert set(mixed) == sampled and sampled < set(cut)
    codec = pieces.Codec(pieces.load())
    for i, r in encoded.items():
        assert r.ids == codec.reference([mixed[i].text])[0] and r.n_tokens == len(r.ids)
    assert set(encoded) == set(mixed)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(encoded)


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stage_functions_are_the_operators():
    assert simhash.keep_one_each and suffixes.strip_repeats and corpus_pipeline.ORACLE_SQL is None
