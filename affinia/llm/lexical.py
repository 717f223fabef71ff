"""Ranked lexical search by presence masks.

The documents of a block are grouped, for each item, by which of the item's terms they hold. The
groups come from bitmaps, one a term, over the documents of the block. A group's mask bounds the
score of all its documents, so groups are scored in descending order of that bound, until ten
documents are known that no later group can beat.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.llm.batches import bounded, lean
from affinia.session import store

TOP = 10
SLICE_DOCS = 4096  # documents whose bitmaps are held at once
BLOCK_TERMS = 1 << 16  # terms of the items that are searched in one pass; more items take more passes
FIRST = 32  # documents scored before the threshold is looked at again; doubles each time
SPREAD = 64  # parts of an item's candidates that are ranked apart before the last ranking

# Each byte as the tokenizer sees it: A-Z lower-cased, other ASCII but digits and letters a break.
_SEEN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The maximal runs of digits, letters and characters beyond ASCII, in UTF-8."""
    return text.translate(_SEEN).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# -- index --------------------------------------------------------------------


def index(docs: DataFrame, vocabulary: Mapping[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): the length of each document with a term, and its terms in `vocabulary`.

    A null text has no terms. The terms of a row ascend by number.
    """
    vocabulary = dict(vocabulary)
    ints = pa.list_(pa.int32())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, lengths, found, times = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                words = terms(text.as_buffer().to_pybytes()) if text.is_valid else []
                if not words:
                    continue
                known = sorted((vocabulary[t], tf) for t, tf in Counter(words).items() if t in vocabulary)
                keep.append(i)
                lengths.append(len(words))
                found.append([t for t, _ in known])
                times.append([tf for _, tf in known])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0).take(pa.array(keep, pa.int64())),
                    "n": pa.array(lengths, pa.int64()),
                    "terms": pa.array(found, ints),
                    "tfs": pa.array(times, ints),
                }
            )

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return bounded(ids).mapInArrow(lean(run), "doc_id long, n long, terms array<int>, tfs array<int>")


# -- one slice of documents ---------------------------------------------------


@dataclass
class Item:
    """What an item asks for: term numbers in ascending order and how often each occurs."""

    item_id: int | None
    terms: np.ndarray
    times: np.ndarray


class Slice:
    """The postings of some documents: a bitmap, the documents and the contributions of each term.

    The arguments are the rows of an index in columns; `weights` has w of each term number, N and L are the
    counts of the whole table.
    """

    def __init__(self, doc_ids, lengths, offsets, numbers, tfs, weights, n_docs: int, n_terms: int):
        self.doc_ids, self.n = doc_ids, len(doc_ids)
        docs = np.repeat(np.arange(self.n, dtype=np.int32), np.diff(offsets))
        order = np.argsort(numbers, kind="stable")  # by term, documents ascend
        self.docs, numbers, tfs = docs[order], numbers[order], tfs[order].astype(np.int64)
        m = 100 - 75 + (75 * lengths * n_docs) // max(n_terms, 1)
        self.gains = weights[numbers] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[self.docs]))
        self.present, first = np.unique(numbers, return_index=True)
        self.bounds = np.append(first, len(numbers))
        self.most = np.maximum.reduceat(self.gains, first) if len(first) else np.zeros(0, np.int64)
        # Bit d of row t: document d holds the t-th present term. Postings ascend, so do their bytes.
        width = (self.n + 7) // 8
        rows = np.repeat(np.arange(len(self.present)), np.diff(self.bounds))
        place = rows * width + self.docs // 8
        begins = np.flatnonzero(np.diff(place, prepend=-1))
        self.bitmaps = np.zeros((len(self.present), width), np.uint8)
        if len(begins):
            bits = (128 >> (self.docs % 8)).astype(np.uint8)
            self.bitmaps.ravel()[place[begins]] = np.bitwise_or.reduceat(bits, begins)

    def groups(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(masks, documents, begins): the distinct masks over `rows` as 0/1, and their documents in turn."""
        bitmaps = self.bitmaps[rows]
        some = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bitmaps, axis=0), count=self.n))
        bits = np.unpackbits(bitmaps, axis=1, count=self.n)[:, some]
        packed = np.zeros((-(-len(rows) // 64) * 8, len(some)), np.uint8)
        packed[: -(-len(rows) // 8)] = np.packbits(bits, axis=0)
        group = np.zeros(len(some), np.int64)
        for words in np.ascontiguousarray(packed.T).view(np.uint64).T:
            part = np.unique(words, return_inverse=True)[1]
            group = np.unique(group * (int(part.max(initial=0)) + 1) + part, return_inverse=True)[1]
        order = np.argsort(group, kind="stable")
        begins = np.flatnonzero(np.diff(group[order], prepend=-1))
        return bits[:, order[begins]], some[order], begins

    def scores(self, rows: np.ndarray, times: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """The exact scores of some documents."""
        order = np.argsort(docs)
        asked, total = docs[order], np.zeros(len(docs), np.int64)
        for row, often in zip(rows, times):
            a, b = self.bounds[row], self.bounds[row + 1]
            at = np.searchsorted(self.docs[a:b], asked)
            hit = at < b - a
            hit[hit] = self.docs[a:b][at[hit]] == asked[hit]
            total[hit] += often * self.gains[a:b][at[hit]]
        out = np.empty_like(total)
        out[order] = total
        return out

    def search(self, item: Item, best: list[tuple], top: int = TOP) -> list[tuple]:
        """`best`, (-score, no doc_id, doc_id) in order, with this slice's documents among them."""
        rows = np.searchsorted(self.present, item.terms)
        here = rows < len(self.present)
        here[here] = self.present[rows[here]] == item.terms[here]
        rows, times = rows[here], item.times[here]
        limits = times * self.most[rows]
        least = -best[-1][0] if len(best) >= top else 1  # a score below this changes nothing
        if limits.sum() < least:
            return best
        masks, docs, begins = self.groups(rows)
        bound = limits @ masks
        order = np.argsort(-bound, kind="stable")
        sizes = np.diff(np.append(begins, len(docs)))
        done, slab = 0, FIRST
        while done < len(order) and bound[order[done]] >= least:
            stop, n = done, 0
            while stop < len(order) and n < slab and bound[order[stop]] >= least:
                n += sizes[order[stop]]
                stop += 1
            chosen = np.concatenate([docs[begins[g] : begins[g] + sizes[g]] for g in order[done:stop]])
            scores = self.scores(rows, times, chosen)
            good = scores >= least
            ids = [self.doc_ids[d] for d in chosen[good]]
            found = [(-s, i is None, i or 0) for s, i in zip(scores[good].tolist(), ids)]
            best = sorted([*best, *found])[:top]
            least = -best[-1][0] if len(best) >= top else 1
            done, slab = stop, slab * 2
        return best


# -- search -------------------------------------------------------------------


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple[int | None, Counter]]]:
    """The items with their terms, in blocks of `most` distinct terms or one item."""
    block, n = [], 0
    for row in items.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        counts = Counter(terms((row[1] or "").encode("utf-8")))
        if block and n + len(counts) > most:
            yield block
            block, n = [], 0
        if counts:
            block.append((row[0], counts))
            n += len(counts)
    if block:
        yield block


def _search_block(docs: DataFrame, block: list[tuple[int | None, Counter]], top: int) -> DataFrame:
    """(item_id, rank, doc_id, score) of one block of items."""
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(c for _, c in block))))}
    indexed = store(index(docs, vocabulary), "lexical_index")
    n_docs, n_terms = indexed.agg(F.count(F.lit(1)), F.sum("n")).first()
    n_terms = n_terms or 0
    df = indexed.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # one row a term at most
    weights = np.zeros(len(vocabulary), np.int64)
    for term, n in df:
        weights[term] = weight(n_docs, n)
    items = []
    for item_id, counts in block:
        numbers = sorted((vocabulary[t], n) for t, n in counts.items())
        items.append(Item(item_id, np.array([t for t, _ in numbers]), np.array([n for _, n in numbers])))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in items]
        for batch in batches:
            for at in range(0, len(batch), SLICE_DOCS):
                part = batch.slice(at, SLICE_DOCS)
                numbers, tfs = part.column("terms"), part.column("tfs")
                offsets = numbers.offsets.to_numpy() - numbers.offsets[0].as_py()
                here = Slice(
                    part.column("doc_id").to_pylist(), part.column("n").to_numpy(), offsets,
                    numbers.flatten().to_numpy(), tfs.flatten().to_numpy(), weights, n_docs, n_terms,
                )
                best = [here.search(item, b, top) for item, b in zip(items, best)]
        rows = [(i, items[i].item_id, None if none else d, -s) for i, b in enumerate(best) for s, none, d in b]
        number, item_id, doc_id, score = zip(*rows) if rows else ((),) * 4
        yield pa.RecordBatch.from_pydict(
            {
                "number": pa.array(number, pa.int64()), "item_id": pa.array(item_id, pa.int64()),
                "doc_id": pa.array(doc_id, pa.int64()), "score": pa.array(score, pa.int64()),
            }
        )

    found = bounded(indexed).mapInArrow(lean(run), "number long, item_id long, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    spread = found.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SPREAD)))
    within = Window.partitionBy("number", "part").orderBy(*order)
    few = spread.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= top).drop("rank")
    ranks = few.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*order)))
    return ranks.filter(F.col("rank") <= top).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` highest-scoring documents of each item, all with score above 0.

    Equal scores go by doc_id, documents without doc_id last. Every row of `items` is an item and every row of `docs` a
    document, also if they repeat an id. Null and empty texts, and items none of whose terms occurs, give no
    rows; so do empty tables. Texts are read whole. A task keeps `top` documents an item; the
    items of a pass are bounded by `block_terms`. Columns other than the ids and texts are not read.
    """
    out = None
    for block in _blocks(items, block_terms):
        found = _search_block(docs, block, top)
        out = found if out is None else out.union(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out


def oracle(top: int = TOP) -> str:
    """The same in SQL, by scoring every document that shares a term."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = f"regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH words AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {found} AS t FROM documents),
totals AS MATERIALIZED (SELECT count(*) FILTER (len(t) > 0) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM words),
tf AS MATERIALIZED (SELECT row, doc_id, n, term, count(*) AS tf
  FROM (SELECT row, doc_id, len(t) AS n, unnest(t) AS term FROM words) GROUP BY ALL),
w AS MATERIALIZED (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, totals GROUP BY term, n_docs),
asked AS MATERIALIZED (SELECT item_id, term, count(*) AS often
  FROM (SELECT item_id, unnest({found}) AS term FROM benchmark) GROUP BY ALL),
scored AS (SELECT item_id, row, doc_id, sum(often * w * ((1000000000 * tf) //
    (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term), totals GROUP BY item_id, row, doc_id),
ranks AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= {top}
"""
