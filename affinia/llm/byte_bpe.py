"""Byte-level BPE: overlapping chunks pre-tokenised in parallel, stitched, encoded; decoded as raw bytes.

A pre-token depends on the text from its first character on and on nothing before it. So two runs
of the pattern over the same text that share one boundary share all later ones. A long text is cut
into chunks that overlap; each chunk is pre-tokenised from its own first character, in whatever
task it lies; where the run of the chunk before and its own have a boundary in common inside the
overlap, the chunks are stitched.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinia.llm.batches import bounded, lean
from affinia.llm.names import apart
from affinia.session import store

VOCABULARY = "byte_bpe_50k.tiktoken"
CHUNK = 1 << 15  # characters; a text up to this length is one chunk
OVERLAP = 1 << 10
GROWTH = 4  # chunk and overlap of texts that do not resynchronise grow by this factor
#: A boundary this close to the end of a chunk may be another one in the whole text: the longest
#: contraction of the pattern has three characters and its look-ahead one.
MARGIN = 8
KNOWN, KNOWN_CHARS = 60_000, 32  # pre-tokens whose ids a task remembers, and their length


def load(path: str | None = None) -> bytes:
    """The ranks file; it goes to the tasks with the job."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        return file.read()


class _Known(dict):
    """Ids of pre-tokens, packed; at most KNOWN short ones are kept."""

    def __init__(self, ranks: dict[bytes, int], merge):
        super().__init__()
        self.ranks, self.merge = ranks, merge

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8")
        rank = self.ranks.get(raw)
        packed = np.array([rank] if rank is not None else self.merge(raw), "<u4").tobytes()
        if len(piece) <= KNOWN_CHARS:
            if len(self) >= KNOWN:
                self.clear()
            self[piece] = packed
        return packed


class Codec:
    """Pre-tokens, ids and bytes for one set of ranks. Made anew in each task and gone with it."""

    def __init__(self, ranks: bytes, pattern: str = public_tokenizers.PATTERN):
        of = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=of, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (max(of.values(), default=-1) + 1)
        for raw, rank in of.items():
            self.bytes_of[rank] = raw
        self.known = _Known(of, self.encoding._encode_single_piece)

    def pretokens(self, text: str) -> list[str]:
        """The matches of the pattern, which cover the whole text."""
        return self.pattern.findall(text)

    def boundaries(self, text: str) -> np.ndarray:
        """Where the pre-tokens end."""
        return np.cumsum(np.fromiter(map(len, self.pretokens(text)), np.int32), dtype=np.int32)

    def encode(self, pretokens: Iterable[str]) -> bytes:
        """The ids of pre-tokens, one after the other, as little-endian 32-bit numbers."""
        return b"".join(map(self.known.__getitem__, pretokens))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))


# -- long texts in chunks -----------------------------------------------------


def chunk_starts(n_chars: int, size: int, overlap: int) -> range:
    """Where the chunks of a text begin; the last one takes what one more would hold as overlap only."""
    return range(0, max(1, n_chars - overlap), size)


def _cut(size: int, overlap: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                for at, start in enumerate(chunk_starts(len(text), size, overlap)):
                    part, last = text[start : start + size + overlap], start + size + overlap >= len(text)
                    yield pa.RecordBatch.from_pydict({"key": [key], "at": pa.array([at], pa.int32()), "last": [last], "part": [part]})

    return run


def _pretokenised(ranks: bytes, size: int, overlap: int):
    """Adds all boundaries of a chunk, and those in its two overlaps counted from the overlap's begin."""
    ints = pa.list_(pa.int32())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks)
        for batch in batches:
            ends, heads, tails = [], [], []
            for part, last in zip(batch.column("part"), batch.column("last").to_pylist()):
                part = part.as_py()
                found = codec.boundaries(part)
                sure = found if last else found[found <= len(part) - MARGIN]
                ends.append(sure)
                heads.append(np.r_[np.int32(0), sure[sure <= overlap]])
                tails.append(sure[sure >= size] - np.int32(size))
            columns = {"ends": ends, "head": heads, "tail": tails}
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in ("key", "at", "part")} | {c: pa.array(v, ints) for c, v in columns.items()}
            )

    return run


def _encoded(ranks: bytes):
    """The ids of a chunk's pre-tokens from `start` to `stop`, or to the end."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks)
        for batch in batches:
            packed = []
            for part, ends, start, stop in zip(*(batch.column(c) for c in ("part", "ends", "start", "stop"))):
                part, ends = part.as_py(), ends.values.to_numpy()
                start, stop = start.as_py(), stop.as_py()
                ends = ends[(ends > start) & (ends <= (len(part) if stop is None else stop))].tolist()
                packed.append(codec.encode([part[a:b] for a, b in zip([start, *ends], ends)]))
            yield pa.RecordBatch.from_pydict(
                {"key": batch.column("key"), "at": batch.column("at"), "ids": pa.array(packed, pa.binary())}
            )

    return run


def encoded_chunks(texts: DataFrame, ranks: bytes, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, at, ids) of (key, text) with distinct keys: the ids of each text in parts, ordered by `at`.

    Texts whose chunks have no boundary in common in some overlap, because a pre-token is as long, are cut
    again into longer chunks with longer overlaps, at last into one.
    """
    done = None
    while True:
        cut = bounded(texts).select("key", "text").mapInArrow(
            lean(_cut(size, overlap)), "key string, at int, last boolean, part string"
        )
        chunks = store(cut.repartition("key", "at"), "bpe_chunks")
        found = bounded(chunks).mapInArrow(
            lean(_pretokenised(ranks, size, overlap)),
            "key string, at int, part string, ends array<int>, head array<int>, tail array<int>",
        )
        found = store(found, "bpe_boundaries")
        within = Window.partitionBy("key").orderBy("at")
        common = F.array_min(F.array_intersect(F.lag("tail").over(within), "head"))
        starts = found.select("key", "at", F.when(F.col("at") == 0, F.lit(0)).otherwise(common).alias("start"))
        stops = starts.select("key", "at", "start", (F.lead("start").over(within) + F.lit(size)).alias("stop"))
        stops = store(stops, "bpe_stitches")
        apart_ = stops.filter("start IS NULL").select("key").distinct()
        whole = stops.join(apart_, "key", "left_anti")
        parts = bounded(found.join(whole, ["key", "at"])).select("key", "at", "part", "ends", "start", "stop")
        parts = store(parts.mapInArrow(lean(_encoded(ranks)), "key string, at int, ids binary"), "bpe_ids")
        done = parts if done is None else done.union(parts)
        if apart_.isEmpty():
            return done
        texts = store(texts.join(apart_, "key"), "bpe_texts")
        size, overlap = size * GROWTH, overlap * GROWTH


def _split_by_length(docs: DataFrame, size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows whose text is one chunk; the others with the `_key` of their text; each long text once."""
    long = F.coalesce(F.char_length("text") > size, F.lit(False))
    keyed = docs.filter(long).withColumn("_key", F.sha2(F.col("text").cast("binary"), 256))
    texts = keyed.groupBy(F.col("_key").alias("key")).agg(F.first("text").alias("text"))
    return docs.filter(~long), keyed, texts


# -- operators ----------------------------------------------------------------


def encode(docs: DataFrame, ranks: bytes | None = None, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """`docs` with `ids` and `n_tokens` in place of `text`; a null text has no ids.

    All other columns stay; those called ids or n_tokens are replaced. An empty table stays empty.
    """
    ranks = ranks or load()
    others = [c for c in docs.columns if c not in ("text", "ids", "n_tokens")]
    docs, _ = apart(docs.select(*others, "text"), ("text",))
    kept = docs.columns[:-1]
    short, keyed, texts = _split_by_length(docs, size)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks)
        for batch in batches:
            place = batch.num_columns - 1
            ids = [np.frombuffer(codec.encode(codec.pretokens(t.as_py() or "")), "<i4") for t in batch.column(place)]
            yield batch.set_column(place, "ids", pa.array(ids, pa.list_(pa.int32())))

    schema = docs.drop("text").schema.add("ids", T.ArrayType(T.IntegerType()))
    direct = bounded(short).mapInArrow(lean(run), schema)

    def unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(x.as_buffer(), "<i4") for x in batch.column("ids")]
            yield batch.set_column(2, "ids", pa.array(ids, pa.list_(pa.int32())))

    parts = encoded_chunks(texts, ranks, size, overlap).mapInArrow(unpacked, "key string, at int, ids array<int>")
    joined = parts.groupBy(F.col("key").alias("_key")).agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("all"))
    whole = joined.select("_key", F.flatten(F.transform("all", lambda x: x.ids)).alias("ids"))
    chunked = keyed.drop("text").join(whole, "_key").select(*kept, "ids")
    return direct.union(chunked).toDF(*others, "ids").withColumn("n_tokens", F.size("ids").cast("long"))


def decode(tokens: DataFrame, ranks: bytes | None = None) -> DataFrame:
    """`tokens` with `bytes`, the raw bytes of its `ids` one after the other; null ids give null."""
    ranks = ranks or load()
    tokens = tokens.select(*(c for c in tokens.columns if c not in ("ids", "bytes")), "ids")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks)
        for batch in batches:
            place = batch.num_columns - 1
            raw = [None if x is None else codec.decode(np.array(x, "<u4").tobytes()) for x in batch.column(place).to_pylist()]
            yield batch.append_column("bytes", pa.array(raw, pa.binary()))

    return bounded(tokens).mapInArrow(lean(run), T.StructType([*tokens.schema, T.StructField("bytes", T.BinaryType())]))


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def token_digest(docs: DataFrame, ranks: bytes | None = None, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), a row for each row of `docs`.

    ids_sha256 is over the ids as little-endian 32-bit numbers, decoded_sha256 over the bytes they stand for.
    A null text is empty and has no tokens. Equal long texts are encoded once, and the parts of a long
    text are streamed into its checksums in order, so no task holds more than a chunk of it. Rows that share
    a doc_id are rows of their own. Columns other than doc_id and text are not read.
    """
    ranks = ranks or load()
    short, keyed, texts = _split_by_length(docs.select("doc_id", "text"), size)

    def direct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks)
        for batch in batches:
            packed = [codec.encode(codec.pretokens(t.as_py() or "")) for t in batch.column(1)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(codec.decode(p)).hexdigest() for p in packed], pa.string()),
                }
            )

    def streamed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, now, n = Codec(ranks), None, 0
        ids = raw = hashlib.sha256()

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"_key": [now], "n_tokens": [n], "ids_sha256": [ids.hexdigest()], "decoded_sha256": [raw.hexdigest()]}
            )

        for batch in batches:
            for key, packed in zip(batch.column("key").to_pylist(), batch.column("ids")):
                if key != now:
                    if now is not None:
                        yield row()
                    now, n, ids, raw = key, 0, hashlib.sha256(), hashlib.sha256()
                packed = packed.as_py()
                n += len(packed) // 4
                ids.update(packed)
                raw.update(codec.decode(packed))
        if now is not None:
            yield row()

    parts = encoded_chunks(texts, ranks, size, overlap).repartition("key").sortWithinPartitions("key", "at")
    digests = store(bounded(parts).mapInArrow(lean(streamed), f"_key string, {DIGEST}"), "bpe_digests")
    chunked = keyed.select("doc_id", "_key").join(digests, "_key").drop("_key")
    return bounded(short).mapInArrow(lean(direct), f"doc_id long, {DIGEST}").union(chunked)
