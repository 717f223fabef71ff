"""The Merkle manifest against plain hashing, its SQL and tampered proofs."""

import hashlib
import zlib

import pytest

from affinia.llm import merkle
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, place long, tree string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_paths(digests):
    """The root, and for each node the (before, after) of every level."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[i : i + 3] for i in range(0, len(digests), 3)]
        for k, i in enumerate(at):
            run = runs[i // 3]
            paths[k].append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
        digests, at = [sha("".join(r)) for r in runs], [i // 3 for i in at]
    return digests[0], paths


def plain(rows):
    """The rows that the operator should return, in the order of `rows`."""
    made = []
    for i, row in enumerate(rows):
        text = row[1]
        if row[0] is not None and text and zlib.crc32(str(row[0]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        made.append((i, row[0], row[3], plain_leaf(row, row[1]), plain_leaf(row, text)))
    trees = {}
    for m in made:
        trees.setdefault(m[2], []).append(m)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    below = {}
    for name in names:
        trees[name].sort(key=lambda m: (m[1] is not None, m[1] or 0, m[3]))
        below[name] = plain_paths([m[3] for m in trees[name]])
    root, above = plain_paths([below[n][0] for n in names])
    out = {}
    for name, top in zip(names, above):
        subroot, paths = below[name]
        for m, path in zip(trees[name], paths):
            whole = path + top
            end = m[4]
            for before, after in whole:
                end = sha(before + end + after)
            out[m[0]] = (m[1], m[3], subroot, root, sha("".join(b + a for b, a in whole)), end, end == root)
    return [out[i] for i in range(len(rows))]


def documents():
    rows = [(i, f"text {i}\nline" if i % 2 else f"plain {i}", "en", ["a", "é", None, "b\n"][min(i % 7, 3)], i, "x", 1, "t") for i in range(150)]
    rows += [(7, "again\n", "fr", "a", None, "x", 1, "t"), (7, "again\n", "fr", "a", None, "x", 1, "t")]
    rows += [(None, "no\nid", None, "a", 1, None, None, None), (None, None, None, None, None, None, None, None)]
    rows += [(900, "", "en", "lone", 0, "x", 1, "t"), (901, "\n" * 50_000, "en", "", 9, "x", 1, "t"), (902, None, "en", "a", 0, "x", 1, "t")]
    return rows


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_rows_equal_plain_hashing(spark, levels):
    docs = spark.createDataFrame(documents(), SCHEMA)
    got = merkle.audited_documents(docs, levels).collect()
    assert ordered(got) == ordered(plain(documents()))
    assert {r.verified for r in got} == {True, False}


def test_equals_its_sql(spark):
    query = lambda s, d: merkle.audited_documents(s.read.parquet(f"{d}/documents.parquet"))
    assert compare(spark, SF, query, merkle.oracle()) > 0


def test_proofs_lead_to_the_root(spark):
    manifest = merkle.Manifest(merkle.document_leaves(spark.createDataFrame(documents(), SCHEMA)), levels=2)
    paths = {(r.tree, r.place): r.suffix for r in manifest.proofs().collect()}
    leaves = manifest.leaves.collect()
    assert len(paths) == len(leaves) == len(documents())
    for r in leaves:
        assert merkle.folded(r.leaf, paths[r.tree, r.place]) == manifest.root()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 81, 82])
def test_sizes_around_full_trees(spark, n):
    rows = [(i, f"{i}\n", "en", "s", 1, None, None, None) for i in range(n)]
    got = merkle.audited_documents(spark.createDataFrame(rows, SCHEMA), 1 if n < 30 else 2).collect()
    assert ordered(got) == ordered(plain(rows))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.audited_documents(empty).collect() == []
    assert merkle.Manifest(merkle.document_leaves(empty)).root() is None


def test_queue_delivers_in_label_order():
    levels = merkle.risen([str(i) for i in range(10)], 3)
    assert [len(x) for x in levels] == [10, 4, 2, 1]
    assert levels[1][3] == sha("9") and levels[2][1] == sha(levels[1][3])
