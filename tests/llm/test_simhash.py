"""SimHash fingerprints and near-duplicate groups against brute force."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from affinia.llm import simhash
from affinia.llm.components import connected

SCHEMA = "doc_id long, text string, fingerprint int, root string"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    groups = []
    for p in set(prints):
        near = [g for g in groups if any((p ^ q).bit_count() <= 2 for q in g)]
        groups = [g for g in groups if g not in near] + [set().union({p}, *near)]
    return {p: i for i, g in enumerate(groups) for p in g}


def documents():
    rng = random.Random(5)
    base = [" ".join(rng.choice("a bb cCc Dd éÉ e f g").strip() + str(rng.randrange(40)) for _ in range(60)) for _ in range(12)]
    texts = [None, "", " \t\n", "one", "One two", "x" * 50_000, "word " * 20_000, *base]
    for _ in range(150):
        words = rng.choice(base).split()
        words[rng.randrange(len(words))] = f"edit{rng.randrange(9)}"
        texts.append(rng.choice([" ", "\n", "\x0b"]).join(words))
    rows = [(i, t, 7, "r") for i, t in enumerate(texts)]
    return [*rows, rows[9], rows[9], (None, texts[9], 1, "n"), (None, "only here", None, None)]


@pytest.mark.parametrize("members", [64, 3])
def test_groups_equal_brute_force(spark, members):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA)
    got = simhash.near_duplicates(docs, members=members).collect()
    prints = [brute_fingerprint(r[1]) for r in rows]
    group = brute_groups(prints)
    least = {}
    for row, p in zip(rows, prints):
        if row[0] is not None:
            least[group[p]] = min(least.get(group[p], row[0]), row[0])
    want = [(r[0], f"{p:016x}", least.get(group[p])) for r, p in zip(rows, prints)]
    assert len(set(group.values())) < len(group)  # some texts differ and are linked
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_every_pair_within_two_bits_shares_a_cell(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        a = rng.getrandbits(64)
        b = a ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        rows.append((simhash._signed(a), simhash._signed(b)))
    df = spark.createDataFrame(rows, "a long, b long")
    va, vb = simhash.embedding(F.col("a")), simhash.embedding(F.col("b"))
    assert df.filter(~F.arrays_overlap(simhash.cells(va), simhash.cells(vb))).count() == 0
    distance = F.bit_count(va.bitwiseXOR(vb))
    assert df.filter(distance > F.bit_count(F.col("a").bitwiseXOR(F.col("b")))).count() == 0
    one = df.select(simhash.embedding(F.lit(0b100111).cast("long")).alias("v")).first().v
    assert one == 0b010111  # counts 1, 1, 2


def test_one_document_of_each_group_stays(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    groups = simhash.near_duplicates(docs)
    kept = simhash.keep_one_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    want = groups.select("component_id").distinct().collect()
    assert sorted(ids, key=str) == sorted((r[0] for r in want), key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.keep_one_each(empty).collect() == []


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(200)] + [(5, 5), (None, 3)]
    links = spark.createDataFrame([*path, *star], "a long, b long")
    got = {r.node: r.root for r in connected(links).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 300)}
