"""SentencePiece models on the tokenizers library: parsed, rebuilt, encoded in batches, verified."""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
import string
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from affinia.llm.batches import bounded, lean

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # the metaspace
BATCH = 64  # texts that are encoded at once
ENCODE_CACHE = 30_000  # runs in each table of a task that only encodes, whose memory other stages have used before
NEW_WORDS = 4096  # words that the library gets at once

# Fixed numbers of the published model format: kinds of model and kinds of piece.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; 4- and 8-byte values stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        if kind not in (1, 2, 5):
            raise ValueError(f"wire type {kind} is not part of a SentencePiece model")
        size = varint() if kind == 2 else 8 if kind == 1 else 4
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class Spec:
    """What a model file says. Defaults are those of the published format."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # text, score, kind
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    fewer_spaces: bool = True
    escape_spaces: bool = True

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def parse(data: bytes) -> Spec:
    """Reads the serialized ModelProto: pieces (1), trainer (2) and normalizer (3) settings."""
    spec = Spec()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            spec.pieces.append((piece[1].decode("utf-8"), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
            spec.kind = trainer.get(3, UNIGRAM)
            spec.byte_fallback = bool(trainer.get(35, 0))
        elif number == 3:
            normal = dict(_fields(value))
            spec.charsmap = normal.get(2, b"")
            spec.dummy_prefix = bool(normal.get(3, 1))
            spec.fewer_spaces = bool(normal.get(4, 1))
            spec.escape_spaces = bool(normal.get(5, 1))
    if spec.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return spec


def _merges(spec: Spec) -> list[tuple[str, str]]:
    """All ways to put a piece together from two others, best score first."""
    ids = {text: i for i, (text, _, kind) in enumerate(spec.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for i, (text, score, kind) in enumerate(spec.pieces):
        if kind == NORMAL:
            for cut in range(1, len(text)):
                a, b = text[:cut], text[cut:]
                if a in ids and b in ids:
                    found.append((-score, i, ids[a], ids[b], a, b))
    return [(a, b) for *_, a, b in sorted(found)]


def _normalizer(spec: Spec, prefix: bool) -> normalizers.Normalizer:
    steps: list = []
    if spec.charsmap:
        steps.append(normalizers.Precompiled(spec.charsmap))
    if spec.fewer_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if prefix and spec.dummy_prefix:
        steps.append(normalizers.Prepend(" " if not spec.escape_spaces else MARK))
    if spec.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    return normalizers.Sequence(steps)


def _words_apart(spec: Spec) -> bool:
    """No piece goes on past the end of a word, so words can be encoded one by one."""
    return spec.kind == BPE and not any(
        a != MARK and b == MARK for text, _, kind in spec.pieces if kind == NORMAL for a, b in zip(text, text[1:])
    )


def rebuild(spec: Spec, prefix: bool = True) -> Tokenizer:
    """The same tokenizer for the tokenizers library. Without `prefix` it goes on within a text."""
    if spec.kind == BPE:
        vocabulary = {text: i for i, (text, _, _) in enumerate(spec.pieces)}
        unknown = spec.pieces[spec.unknown][0]
        model = models.BPE(
            vocabulary, _merges(spec), unk_token=unknown, fuse_unk=True, byte_fallback=spec.byte_fallback
        )
    else:
        scored = [(text, score) for text, score, _ in spec.pieces]
        model = models.Unigram(scored, spec.unknown, spec.byte_fallback)
    tokenizer = Tokenizer(model)
    tokenizer.normalizer = _normalizer(spec, prefix)
    if _words_apart(spec):
        word = Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        tokenizer.pre_tokenizer = pre_tokenizers.Split(word, "isolated")
    steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if spec.dummy_prefix and prefix:
        steps.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(steps)
    return tokenizer


def _apart(spec: Spec) -> str:
    """Characters, line breaks and punctuation among them, that no piece joins to any other.

    Begins with white space and ASCII punctuation. Where a piece has one of them beside another
    character, that one comes in too, or, if it is an ASCII letter or digit, the first
    goes. In the end no merge reaches from these characters to the others.
    """
    pairs = {
        (a, b) for text, _, kind in spec.pieces if kind == NORMAL for a, b in zip(text, text[1:]) if MARK not in (a, b)
    }
    apart, gone = set("\n\r\t" + string.punctuation), set()
    while True:
        mixed = [(a, b) if a in apart else (b, a) for a, b in pairs if (a in apart) != (b in apart)]
        if not mixed:
            return "".join(sorted(apart))
        for own, other in mixed:
            if other in gone or (other.isascii() and other.isalnum()):
                apart.discard(own)
                gone.add(own)
            else:
                apart.add(other)


class Codec:
    """Encodes and decodes batches with the tokenizers library, on all threads of the process.

    Where no piece reaches across the words of a text (`_words_apart`) or from punctuation to
    letters (`_apart`), both read off the vocabulary, the ids of a text are those of its runs
    one after the other. Then the library gets each new run once. Two tables of about CACHE runs
    are kept: when the younger one is full it takes the place of the older. Each run is verified
    when it is new: `odd` has those to which SentencePiece gives other ids, `lost` those that
    decoding does not give back. Models without that property encode whole texts.
    """

    CACHE = 150_000

    def __init__(self, data: bytes, cache: int | None = None):
        self.cache = cache or self.CACHE
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        self.spec = parse(data)
        self.whole = rebuild(self.spec)
        self.rest = rebuild(self.spec, prefix=False)
        self.original = sentencepiece.SentencePieceProcessor(model_proto=data)
        plain = not self.spec.charsmap and not self.spec.fewer_spaces and self.spec.escape_spaces
        apart = _apart(self.spec)
        self._lead = "\n" if "\n" in apart else ""
        self.by_word = (
            _words_apart(self.spec) and plain and self.spec.dummy_prefix and self.spec.byte_fallback and bool(self._lead)
        )
        some = re.escape(apart)
        self._run = re.compile(f"{MARK}*[^{MARK}{some}]+|{MARK}*[{some}]+|{MARK}+")
        self._young: dict[str, list[int]] = {}
        self._old: dict[str, list[int]] = {}
        self._numbers = list(range(len(self.spec.pieces)))  # one object for each id
        self._texts = [None if kind == BYTE else text.replace(MARK, " ") for text, _, kind in self.spec.pieces]
        self.odd: set[str] = set()
        self.lost: set[str] = set()

    def runs(self, text: str) -> list[str]:
        """A text as the model sees it, with metaspace marks, in runs that are encoded apart."""
        return self._run.findall(MARK + text.replace(" ", MARK)) if text else []

    def _learn(self, words: list[str]) -> None:
        shared = self._numbers
        ids = [[shared[i] for i in e.ids] for e in self.rest.encode_batch_fast(words, add_special_tokens=False)]
        self._young.update(zip(words, ids))
        # SentencePiece puts a mark first: it stands for the run's own, or before a line break.
        asked = [w[1:] if w[0] == MARK else self._lead + w for w in words]
        before = len(self.original.encode(self._lead))
        texts, bytewise = self._texts, []
        for word, own, other in zip(words, ids, self.reference(asked)):
            if word == MARK:  # no text has this mark only
                other = [self.original.piece_to_id(MARK)]
            if own != (other if word[0] == MARK else other[before:]):
                self.odd.add(word)
            parts = [texts[i] for i in own]
            if None in parts:
                bytewise.append((word, own))
            elif "".join(parts) != word.replace(MARK, " "):
                self.lost.add(word)
        decoded = self.rest.decode_batch([own for _, own in bytewise], skip_special_tokens=False)
        for (word, _), back in zip(bytewise, decoded):
            if back != word.replace(MARK, " "):
                self.lost.add(word)

    def forget(self) -> None:
        """Drops the tables of runs."""
        self._young, self._old = {}, {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        if not self.by_word:
            found = self.whole.encode_batch_fast(texts, add_special_tokens=False)
            return [e.ids for e in found]
        return [ids for ids, _ in self._looked_up(texts)]

    def _looked_up(self, texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
        """(ids, runs) of each text."""
        if len(self._young) > self.cache:
            self._old, self._young = self._young, {}
        split = [self.runs(t) for t in texts]
        new = set().union(*split).difference(self._young)
        again = {w for w in new if w in self._old}
        self._young.update((w, self._old[w]) for w in again)
        unknown = sorted(new - again)
        for at in range(0, len(unknown), NEW_WORDS):
            self._learn(unknown[at : at + NEW_WORDS])
        for words in split:
            yield list(itertools.chain.from_iterable(map(self._young.__getitem__, words))), words

    def verified(self, texts: list[str]) -> list[tuple[list[int], bool, bool]]:
        """(ids, decoding gives the text again, SentencePiece gives the same ids) of each text.

        A metaspace character in the text comes back as a space, which counts as the same.
        """
        if not self.by_word:
            ids = self.encode(texts)
            rows = zip(texts, ids, self.decode(ids), self.reference(texts))
            return [(own, back == text.replace(MARK, " "), own == other) for text, own, back, other in rows]
        out = []
        for ids, words in self._looked_up(texts):
            trips = not self.lost or self.lost.isdisjoint(words)
            same = not self.odd or self.odd.isdisjoint(words)
            out.append((ids, trips, same))
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.whole.decode_batch(ids, skip_special_tokens=False)

    def reference(self, texts: list[str]) -> list[list[int]]:
        """The ids that the SentencePiece library gives."""
        return self.original.encode(texts, num_threads=1)


@functools.lru_cache(2)
def _codec(data: bytes, cache: int | None = None) -> Codec:
    return Codec(data, cache)


def load(path: str = MODEL) -> bytes:
    """The model file; it goes to the tasks with the job."""
    with open(path, "rb") as file:
        return file.read()


def _batches(texts: pa.Array) -> Iterator[list[str]]:
    for at in range(0, len(texts), BATCH):
        yield [t or "" for t in texts.slice(at, BATCH).to_pylist()]


def token_digest(docs: DataFrame, model: bytes | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, round_trip, parity), a row for each row of `docs`.

    ids_sha256 is over the ids as little-endian 32-bit numbers; round_trip: decoding gives the
    text again; parity: the SentencePiece library gives the same ids (see `Codec`). A null
    text is empty and has no tokens. Columns other than doc_id and text are not read.
    """
    data = model or load()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data)
        for batch in batches:
            out = []
            for texts in _batches(batch.column(1)):
                for ids, trips, parity in codec.verified(texts):
                    sha = hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
                    out.append((len(ids), sha, trips, parity))
            n, sha, trip, same = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(trip, pa.bool_()), pa.array(same, pa.bool_())],
                names=["doc_id", "n_tokens", "ids_sha256", "round_trip", "parity"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, round_trip boolean, parity boolean"
    return bounded(docs).select("doc_id", "text").mapInArrow(lean(run), schema)


def encode_verified(codec: Codec, texts: list[str]) -> list[list[int]]:
    """The ids of each text; those of SentencePiece where the rebuilt tokenizer gives others."""
    checked = zip(texts, codec.verified(texts))
    return [ids if same else codec.reference([text])[0] for text, (ids, _, same) in checked]


def encode(docs: DataFrame, model: bytes | None = None) -> DataFrame:
    """`docs` with its text as `ids` and `n_tokens` in place of `text`.

    A null text has no ids. Clashing columns of the same names are replaced. Each new run is verified as in
    `token_digest`; a text to which SentencePiece gives other ids gets those. A task keeps no runs when it ends.
    """
    data = model or load()
    others = [c for c in docs.columns if c not in ("text", "ids", "n_tokens")]
    kept = bounded(docs).select(*others, "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data, ENCODE_CACHE)
        for batch in batches:
            ids = [x for texts in _batches(batch.column(batch.num_columns - 1)) for x in encode_verified(codec, texts)]
            column = pa.array(ids, pa.list_(pa.int32()))
            yield batch.set_column(batch.num_columns - 1, "ids", column)
        codec.forget()

    schema = kept.drop("text").schema.add("ids", T.ArrayType(T.IntegerType()))
    return kept.mapInArrow(lean(run), schema).withColumn("n_tokens", F.size("ids").cast("long"))


def decode(tokens: DataFrame, model: bytes | None = None) -> DataFrame:
    """`tokens` with its `ids` as `text`; null ids give null."""
    data = model or load()
    others = [c for c in tokens.columns if c not in ("text", "ids")]
    kept = bounded(tokens).select(*others, "ids")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data)
        for batch in batches:
            ids = batch.column(batch.num_columns - 1).to_pylist()
            texts = codec.decode([x or [] for x in ids])
            column = pa.array([None if x is None else t for x, t in zip(ids, texts)], pa.string())
            yield batch.set_column(batch.num_columns - 1, "text", column)

    return kept.mapInArrow(run, kept.drop("ids").schema.add("text", T.StringType()))
