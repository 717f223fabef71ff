"""Merkle manifest of a dataset by time-forward processing.

Every node of a tree has a label (level, place) that is larger than those of its children. Nodes
are processed in label order, and a digest travels to the parent as a message that waits in a
priority queue until the parent's label is due. The tree is cut into blocks of LEVELS levels: inside a
block the queue is a heap of bounded size, between blocks it is external, a table of
messages under the shared folder that Spark deals out by the receiver's label. The reversed sweep
sends the siblings above each block, the suffix of its proofs, back down.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.operators.skew import ranked
from affinia.session import store

FANOUT = 3
LEVELS = 6  # a block has FANOUT ** LEVELS nodes at most
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

SUFFIX = "array<struct<before:string,after:string>>"
_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# -- leaves -------------------------------------------------------------------


def record(fields: Sequence[Column]) -> Column:
    """`-` for each null field, else its UTF-8 byte count, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return F.concat(
        *(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)
    )


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(record(fields).cast("binary"), 256)


def tree_name(column: Column) -> Column:
    """A name for each tree that sorts like `column`, UTF-8 bytewise with null first."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


# -- one block ----------------------------------------------------------------


def risen(digests: Sequence[str], levels: int | None, fanout: int = FANOUT) -> list[list[str]]:
    """The digests of all levels of a block, from its lowest nodes up.

    Messages (level, place of the parent, place of the sender, digest) leave the heap in the order of
    the parent's label. Without `levels` the block is a whole tree and ends with one node.
    """
    if levels is None:
        levels, n = 0, len(digests)
        while n > 1:
            n, levels = -(-n // fanout), levels + 1
    done = [list(digests), *([] for _ in range(levels))]
    queue = [(1, i // fanout, i, d) for i, d in enumerate(digests)] if levels else []
    heapq.heapify(queue)
    while queue:
        level, place = queue[0][:2]
        children = []
        while queue and queue[0][:2] == (level, place):
            children.append(heapq.heappop(queue)[3])
        done[level].append(digest(*children))
        if level < levels:
            heapq.heappush(queue, (level + 1, place // fanout, place, done[level][-1]))
    return done


def siblings(done: list[list[str]], place: int, fanout: int = FANOUT) -> list[tuple[str, str]]:
    """The digests before and after a node in its run, joined, level by level."""
    path = []
    for level in done[:-1]:
        first = place - place % fanout
        path.append(("".join(level[first:place]), "".join(level[place + 1 : first + fanout])))
        place //= fanout
    return path


def folded(own: str, path: Sequence[tuple[str, str]]) -> str:
    """The digest at the end of a path that starts at `own`."""
    for before, after in path:
        own = digest(before, own, after)
    return own


# -- the sweeps ---------------------------------------------------------------


def _in_blocks(nodes: DataFrame, levels: int, fanout: int) -> DataFrame:
    """(tree, place, digest, …) with `block`; `place` counts from 0 within the tree."""
    return nodes.withColumn("block", F.floor(F.col("place") / F.lit(fanout**levels)).cast("long"))


def _block_roots(blocks: DataFrame, levels: int, fanout: int) -> DataFrame:
    """(tree, block, whole, part): the root of each block if it is a whole tree, and if it is not."""

    def up(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        digests = table["digest"].to_pylist()
        whole = risen(digests, None, fanout)
        part = whole[-1][0]
        for _ in range(levels + 1 - len(whole)):
            part = digest(part)  # a lone node still becomes its digest while others remain
        return pa.table(
            {"tree": table["tree"][:1], "block": table["block"][:1], "whole": whole[-1], "part": [part]}
        )

    schema = "tree string, block long, whole string, part string"
    return blocks.select("tree", "block", "place", "digest").groupBy("tree", "block").applyInArrow(up, schema)


def _sent_down(blocks: DataFrame, messages: DataFrame, levels: int, fanout: int) -> DataFrame:
    """(tree, place, suffix) of the nodes of all blocks, from what each block was sent.

    `messages` is (tree, block, whole, suffix): whether the block is a whole tree, and the
    siblings above it. The heap of the upward sweep is run again for the digests inside the block.
    """

    def down(table: pa.Table, sent: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        above = [(s["before"], s["after"]) for s in sent["suffix"][0].as_py()]
        done = risen(table["digest"].to_pylist(), None if sent["whole"][0].as_py() else levels, fanout)
        paths = [
            [{"before": b, "after": a} for b, a in (*siblings(done, i, fanout), *above)] for i in range(len(table))
        ]
        return pa.table({"tree": table["tree"], "place": table["place"], "suffix": pa.array(paths, _PATH)})

    kept = blocks.select("tree", "block", "place", "digest")
    return (
        kept.groupBy("tree", "block")
        .cogroup(messages.groupBy("tree", "block"))
        .applyInArrow(down, f"tree string, place long, suffix {SUFFIX}")
    )


class Forest:
    """Trees over (tree, place, digest): `roots` holds (tree, digest) of each.

    Each tier of blocks is one shuffle and one written table of messages to the tier above, and a tree
    of n leaves has log(n) / (LEVELS * log(FANOUT)) tiers. A tree of any size, also one with most of the
    rows, is spread over its blocks.
    """

    def __init__(self, nodes: DataFrame, levels: int = LEVELS, fanout: int = FANOUT):
        self.levels, self.fanout = levels, fanout
        self.tiers: list[tuple[DataFrame, DataFrame]] = []  # nodes in blocks, (tree, block, whole, part, single)
        self.roots = None
        while True:
            blocks = _in_blocks(nodes, levels, fanout)
            tops = store(_block_roots(blocks, levels, fanout), "merkle_messages")
            counts = tops.groupBy("tree").agg((F.count(F.lit(1)) == 1).alias("single"))
            tops = tops.join(counts, "tree")
            self.tiers.append((blocks, tops))
            ended = tops.filter("single").select("tree", F.col("whole").alias("digest"))
            self.roots = ended if self.roots is None else self.roots.union(ended)
            nodes = tops.filter("NOT single").select("tree", F.col("block").alias("place"), F.col("part").alias("digest"))
            if nodes.isEmpty():
                break
        self.roots = store(self.roots, "merkle_roots")

    def messages(self, above: DataFrame) -> DataFrame:
        """(tree, block, whole, suffix) for the lowest blocks, from (tree, suffix) of the roots."""
        sent = None
        for tier in range(len(self.tiers) - 1, -1, -1):
            blocks, tops = self.tiers[tier]
            ends = tops.filter("single").select("tree", "block", F.lit(True).alias("whole")).join(above, "tree")
            if sent is not None:
                upper = _sent_down(self.tiers[tier + 1][0], sent, self.levels, self.fanout)
                inner = upper.select("tree", F.col("place").alias("block"), F.lit(False).alias("whole"), "suffix")
                ends = ends.select("tree", "block", "whole", "suffix").unionByName(inner)
            sent = store(ends.select("tree", "block", "whole", "suffix"), "merkle_suffixes")
        return sent

    def paths(self, above: DataFrame) -> DataFrame:
        """(tree, place, suffix): the siblings of every leaf up to the last root."""
        return _sent_down(self.tiers[0][0], self.messages(above), self.levels, self.fanout)


# -- the manifest -------------------------------------------------------------

RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


class Manifest:
    """Two forests: a tree for each name in `leaves`, and one tree over their roots, by name.

    `leaves` is (tree, doc_id, leaf, …), ordered within a tree by doc_id, nulls first, then leaf.
    """

    def __init__(self, leaves: DataFrame, levels: int = LEVELS, fanout: int = FANOUT):
        order = ["doc_id", *(c for c in leaves.columns if c not in ("tree", "doc_id"))]
        numbered = ranked(leaves, ["tree"], order, "rank").withColumn("place", F.col("rank") - 1).drop("rank")
        self.leaves = store(numbered, "merkle_leaves")
        self.forest = Forest(self.leaves.withColumnRenamed("leaf", "digest"), levels, fanout)
        subroots = self.forest.roots
        top = ranked(subroots.select(F.col("tree").alias("name"), "digest"), [], ["name"], "rank")
        top = store(top.select(F.lit("").alias("tree"), (F.col("rank") - 1).alias("place"), "digest", "name"), "merkle_top")
        self.top = Forest(top, levels, fanout)
        self.top_leaves = top

    def root(self) -> str | None:
        """The root digest; none for an empty table."""
        found = self.top.roots.first()
        return found.digest if found else None

    def _above(self) -> DataFrame:
        """(tree, suffix, subroot): the siblings above each tree's root."""
        start = self.top.roots.select("tree", F.expr(f"cast(array() as {SUFFIX})").alias("suffix"))
        placed = self.top.paths(start).select("place", "suffix")
        names = self.top_leaves.select("place", F.col("name").alias("tree"), F.col("digest").alias("subroot"))
        return store(placed.join(names, "place").select("tree", "suffix", "subroot"), "merkle_above")

    def proofs(self) -> DataFrame:
        """(tree, place, suffix): the digests before and after each node from a leaf to the root."""
        return self.forest.paths(self._above().select("tree", "suffix"))

    def audited(self, seen: str) -> DataFrame:
        """Every leaf with the root that folding its proof gives for the digest in column `seen`.

        Proofs are used inside the block that makes them and not written out.
        """
        root, levels, fanout = self.root(), self.forest.levels, self.forest.fanout
        above = self._above()
        sent = self.forest.messages(above.select("tree", "suffix")).join(above.select("tree", "subroot"), "tree")
        rows = _in_blocks(self.leaves, levels, fanout).select("tree", "block", "place", "doc_id", "leaf", F.col(seen).alias("seen"))

        def audit(table: pa.Table, sent: pa.Table) -> pa.Table:
            table = table.sort_by("place")
            above = [(s["before"], s["after"]) for s in sent["suffix"][0].as_py()]
            digests, seen = table["leaf"].to_pylist(), table["seen"].to_pylist()
            done = risen(digests, None if sent["whole"][0].as_py() else levels, fanout)
            suffix = "".join(b + a for b, a in above)
            proofs, ends = [], []
            for i, own in enumerate(seen):
                path = siblings(done, i, fanout)
                proofs.append(digest(*(b + a for b, a in path), suffix))
                ends.append(folded(folded(own, path), above))
            n = len(seen)
            return pa.table(
                {
                    "doc_id": table["doc_id"], "leaf": table["leaf"], "subroot": [sent["subroot"][0].as_py()] * n,
                    "root": [root] * n, "proof_sha256": proofs, "folded_root": ends, "verified": [e == root for e in ends],
                }
            )

        return rows.groupBy("tree", "block").cogroup(sent.groupBy("tree", "block")).applyInArrow(audit, RESULT)


def document_leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, seen) of the documents; `seen` is the leaf after tampering.

    Where 2 divides the CRC-32 of the decimal doc_id, tampering deletes the line feeds of the text.
    Rows without doc_id are not tampered with.
    """
    fields = {c: F.col(c) for c in FIELDS}
    cut = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = even & F.contains(F.col("text"), F.lit("\n"))
    leaves = docs.select(
        tree_name(F.col("source")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(list(fields.values())).alias("leaf"),
        F.when(changed, leaf(list((fields | {"text": cut}).values()))).alias("changed"),
    )
    return leaves.select("tree", "doc_id", "leaf", F.coalesce("changed", "leaf").alias("seen"))


def audited_documents(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), a row for each row of `docs`.

    A null source is a tree of its own, the first one. Rows without doc_id come first in their tree, rows
    that share a doc_id are ordered by leaf, and rows that are equal altogether by chance, which
    changes no result. Texts are hashed whole and only their digests are shuffled. An empty table gives
    no rows. Columns other than the five fields are not read.
    """
    return Manifest(document_leaves(docs), levels).audited("seen")


def oracle() -> str:
    """The same in SQL: a level of all trees for each step of a recursion."""

    def encoded(text: str) -> str:
        values = [f"{f}::VARCHAR" for f in ("doc_id", "source", "lang", "n_chars")] + [text]
        return " || ".join(f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in values)

    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    run = "PARTITION BY tree, lvl, pos // 3 ORDER BY pos ROWS BETWEEN"

    def forest(name: str, leaves: str) -> str:
        return f"""{name}_nodes AS (
  SELECT tree, 0 AS lvl, pos, digest FROM {leaves}
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}_nodes) WHERE n > 1 GROUP BY tree, lvl, pos // 3),
{name}_ends AS MATERIALIZED (SELECT tree, max(lvl) AS last, max_by(digest, lvl) AS top FROM {name}_nodes GROUP BY tree),
{name}_runs AS MATERIALIZED (
  SELECT tree, lvl, pos, coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}_nodes)"""

    def climb(name: str, start: str) -> str:
        return f"""{name}_paths AS (
  {start}
  UNION ALL
  SELECT p.id, p.tree, p.lvl + 1, p.pos // 3, proof || l || r, sha256(l || fold || r)
  FROM {name}_paths p JOIN {name}_ends e USING (tree) JOIN {name}_runs s ON s.tree = p.tree AND s.lvl = p.lvl AND s.pos = p.pos
  WHERE p.lvl < e.last)"""

    return f"""
WITH RECURSIVE
crc_table AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, x: {bit}) AS v FROM range(256) r(i))),
rows AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({encoded("text")}) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ord(d)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) & 1 = 0
    THEN sha256({encoded("replace(text, chr(10), '')")}) ELSE sha256({encoded("text")}) END AS seen
  FROM documents, crc_table),
leaves AS MATERIALIZED (
  SELECT *, leaf AS digest, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS id,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM rows),
{forest("low", "leaves")},
subroots AS MATERIALIZED (
  SELECT '' AS tree, tree AS name, top AS digest, row_number() OVER (ORDER BY tree) - 1 AS pos FROM low_ends),
{forest("high", "subroots")},
{climb("low", "SELECT id, tree, 0 AS lvl, pos, '' AS proof, seen AS fold FROM leaves")},
reached AS MATERIALIZED (
  SELECT p.id, s.pos, p.proof, p.fold FROM low_paths p JOIN low_ends e ON e.tree = p.tree AND e.last = p.lvl
  JOIN subroots s ON s.name = p.tree),
{climb("high", "SELECT id, '' AS tree, 0 AS lvl, pos, proof, fold FROM reached")}
SELECT v.doc_id, v.leaf, e.top AS subroot, h.top AS root, sha256(p.proof) AS proof_sha256, p.fold AS folded_root,
       p.fold = h.top AS verified
FROM leaves v JOIN low_ends e USING (tree) JOIN high_paths p USING (id), high_ends h WHERE p.lvl = h.last
"""
