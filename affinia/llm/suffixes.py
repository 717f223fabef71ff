"""Removing long byte strings that occur more than once, by sorted suffixes.

A string of `LENGTH` bytes is found again through its anchor: of its 64-byte grams, the one
with the smallest hash (the last of equals). Equal strings have equal anchors at equal
offsets, so only strings around equal grams need comparing:

1. Each text is cut into contexts. A context is all the strings that share an anchor, as one
   piece of text. About one gram in seventy is an anchor.
2. Contexts meet by their gram. Equal contexts are counted as one (their strings all repeat).
   A gram with different contexts goes on if one of them stands alone.
3. The contexts of a gram are sorted twice: by the suffix that starts at the anchor and by the
   reversed prefix that ends there. Both sorts run multikey quicksort down to a shallow depth
   and leave what is still tied to blind tries. The common-prefix lengths between neighbours
   then say for each offset which strings are equal.
4. The covered bytes are joined back to the texts.

Texts are compared byte for byte or by 128 bits of hash. A gram with more than `GROUP` rows
is not sorted in one task: its strings are dealt out by their own 128-bit hash and counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm.batches import bounded, lean
from affinia.llm.names import apart
from affinia.session import store

LENGTH = 200
GRAM = 64
GROUP = 1 << 15  # rows of one gram that are sorted in one task
SHALLOW = 96  # bytes that multikey quicksort compares, a multiple of 8
CHUNK = 1 << 19  # bytes of text that are handled at once
BATCH = 1 << 14  # contexts that are sorted at once, or those of one gram

_LOW = np.uint64(0xFFFFFFFF)
_HIGH = np.uint64(0xFFFFFFFF00000000)
_random = np.random.default_rng(64)
_BYTE = _random.integers(0, 1 << 64, 256, np.uint64)
_FACTORS = _random.integers(0, 1 << 63, 6, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)

ROWS = "text_key binary, gram long, context long, n int, anchor int, lo int, hi int"
JUDGED = "text_key binary, gram long, n int, anchor int, lo int, hi int, hot boolean"
CUT = "kind int, gram long, other long, n int, text_key binary, anchor int, lo int, hi int, bytes binary"
SPANS = "text_key binary, start int, stop int"


# ---- 1. contexts ---------------------------------------------------------------------------


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of each gram: sums over byte values with one factor for each place."""
    h, k = _BYTE[data], 1
    for factor in _FACTORS:
        h = h[:-k] * factor + h[k:]
        k *= 2
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    y, k = x, 1
    while 2 * k <= width:
        y = np.minimum(y[:-k], y[k:])
        k *= 2
    n = len(x) - width + 1
    return np.minimum(y[:n], y[width - k : width - k + n])


def contexts(pieces: list[np.ndarray], length: int = LENGTH):
    """(piece, anchor, lo, hi, gram, digest) of the contexts of each piece, as arrays.

    lo and hi are the first and last start of a string, counted from the piece's start; the
    context is the bytes lo to hi + length.
    """
    sizes = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(sizes)
    data = np.concatenate(pieces) if pieces else np.zeros(0, np.uint8)
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    grams = _grams(data)
    keys = (grams & _HIGH) | (_LOW - np.arange(len(grams), dtype=np.uint64))
    least = _sliding_min(keys, length - GRAM + 1)
    starts = np.flatnonzero(np.arange(len(least)) + length <= np.repeat(ends, sizes)[: len(least)])
    if not len(starts):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    at = (_LOW - (least[starts] & _LOW)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    lo, hi, anchor = starts[first], starts[np.r_[first[1:] - 1, len(starts) - 1]], at[first]
    view = memoryview(data)
    digest = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(lo.tolist(), (hi + length).tolist())]
    piece = np.searchsorted(ends, lo, "right")
    base = (ends - sizes)[piece]
    return piece, anchor - base, lo - base, hi - base, grams[anchor], np.array(digest, np.uint64)


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary column without nulls."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def _pieces(column: pa.Array, length: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """(row, first byte, bytes) of the texts, in lists of about CHUNK bytes.

    A text beyond CHUNK comes in several pieces, each string of it in exactly one.
    """
    offsets, data = _binary(column)
    found, size = [], 0
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        for at in range(a, max(a + 1, b - length + 1), CHUNK):
            piece = data[at : min(b, at + CHUNK + length - 1)]
            if len(piece) >= length:
                found.append((row, at - a, piece))
                size += len(piece)
            if size >= CHUNK:
                yield found
                found, size = [], 0
    if found:
        yield found


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _i32(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.int32))


def _context_rows(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _pieces(batch.column(1), length):
                piece, anchor, lo, hi, gram, digest = contexts([p for _, _, p in chunk], length)
                if not len(piece):
                    continue
                row = np.array([r for r, _, _ in chunk])[piece]
                base = np.array([s for _, s, _ in chunk])[piece]
                anchor, lo, hi = anchor + base, lo + base, hi + base
                # What is equal here is counted here: covered, and one row goes on for all.
                order = np.lexsort((digest, gram))
                g, d = gram[order], digest[order]
                new = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (d[1:] != d[:-1])])
                count = np.diff(np.r_[new, len(order)])
                one = order[new]
                again = np.sort(order[np.repeat(count > 1, count)])
                keys = batch.column(0)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(row[one])), _i64(gram[one]), _i64(digest[one]), _i32(count), _i32(anchor[one]), _i32(lo[one]), _i32(hi[one])],
                    names=["text_key", "gram", "context", "n", "anchor", "lo", "hi"],
                )
                if len(again):
                    r, start, stop = row[again], lo[again], hi[again] + length
                    cut = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (start[1:] > stop[:-1])])
                    last = np.r_[cut[1:] - 1, len(r) - 1]
                    where = gram[again][cut]  # spans travel along, dealt out by some gram
                    zero = np.zeros(len(cut), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(r[cut])), _i64(where), _i64(zero), _i32(zero), _i32(zero), _i32(start[cut]), _i32(stop[last])],
                        names=["text_key", "gram", "context", "n", "anchor", "lo", "hi"],
                    )

    return run


# ---- 2. contexts of one gram ---------------------------------------------------------------


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    differs = np.zeros(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        differs |= c[1:] != c[:-1]
    return np.flatnonzero(np.r_[True, differs]) if len(columns[0]) else np.zeros(0, np.int64)


def _judged(keys, gram, n, anchor, lo, hi, hot) -> pa.RecordBatch:
    gram = pa.nulls(len(lo), pa.int64()) if gram is None else pa.array(gram)
    keys = keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys
    return pa.RecordBatch.from_arrays(
        [keys, gram, _i32(n), _i32(anchor), _i32(lo), _i32(hi), pa.array(np.full(len(lo), hot))],
        names=["text_key", "gram", "n", "anchor", "lo", "hi", "hot"],
    )


def _judge(length: int, group: int):
    def settle(t: pa.Table, hot: bool, more: bool) -> Iterator[pa.RecordBatch]:
        """Spans of contexts that repeat; contexts that must be sorted. `more`: the (only)
        gram has other contexts outside this table."""
        if not len(t):
            return
        gram, digest, n, anchor, lo, hi = (_ints(t, c) for c in ("gram", "context", "n", "anchor", "lo", "hi"))
        first = _starts(gram, digest)
        size = np.diff(np.r_[first, len(t)])
        total = np.add.reduceat(n, first)
        keys = t.column("text_key").combine_chunks()
        same = np.r_[False, pc.equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False) & (lo[1:] == lo[:-1])]
        full = np.flatnonzero(np.repeat(total > 1, size) & ~same)
        if len(full):
            zero = np.zeros(len(full), np.int64)
            yield _judged(keys.take(pa.array(full)), None, zero, zero, lo[full], hi[full] + length, False)
        of_gram = _starts(gram[first])
        members = np.diff(np.r_[of_gram, len(first)])
        alone = np.add.reduceat((total == 1).astype(np.int64), of_gram)
        go = np.repeat(((members > 1) & (alone > 0)) | more | (hot & (members > 1)), members)
        rows = first[go]
        if len(rows):
            yield _judged(keys.take(pa.array(rows)), gram[rows], total[go], anchor[rows], lo[rows], hi[rows], hot)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hot, more = None, False, False
        for batch in batches:
            t = pa.Table.from_batches([batch])
            n = _ints(t, "n")
            if (spans := np.flatnonzero(n == 0)).size:
                s = t.take(pa.array(spans))
                zero = np.zeros(len(s), np.int64)
                yield _judged(s.column("text_key"), None, zero, zero, _ints(s, "lo"), _ints(s, "hi"), False)
                t = t.take(pa.array(np.flatnonzero(n)))
            t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
            if not len(t):
                continue
            gram = _ints(t, "gram")
            last = int(_starts(gram)[-1])
            if last:
                end = int(np.searchsorted(gram, gram[0], "right"))
                if hot:  # the first gram began in an earlier batch
                    yield from settle(t.slice(0, end), True, more)
                    yield from settle(t.slice(end, last - end), False, False)
                else:
                    yield from settle(t.slice(0, last), False, False)
                hot, more = False, False
            held = t.slice(last)
            if len(held) > group:
                hot = True
                cut = int(_starts(_ints(held, "context"))[-1])
                if cut:
                    yield from settle(held.slice(0, cut), True, True)
                    more, held = True, held.slice(cut)
                if len(held) > group:  # one context: a single row can stand for all
                    yield from settle(held, True, False)
                    total = int(_ints(held, "n").sum())
                    held = held.slice(0, 1).set_column(3, "n", pa.array([min(total, 1 << 30)], pa.int32()))
        if held is not None:
            yield from settle(held, hot, more)

    return run


# ---- 3. deep-shallow sorting -----------------------------------------------------------------


def _words(data: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The eight bytes from `at` on as big-endian numbers; beyond `left` bytes they are zero."""
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)[np.minimum(at, len(data) - 8)]
    word = np.ascontiguousarray(eight).view(">u8").ravel().astype(np.uint64)
    cut = np.clip(8 - left, 0, 8).astype(np.uint64) * np.uint64(8)
    return np.where(cut >= 64, np.uint64(0), (word >> np.minimum(cut, np.uint64(63))) << np.minimum(cut, np.uint64(63)))


def multikey_quicksort(data, start, size, group, depth_limit):
    """Order of the suffixes data[start : start + size] within each group, to depth_limit bytes.

    `group` ascends. All segments of a round are partitioned around their own pivots at once:
    less, equal, greater. Equal ones go eight bytes deeper. Returns (order, tie): tie numbers
    runs of suffixes that agree to depth_limit bytes, in order. Suffixes beyond their size
    read as zero bytes.
    """
    order = np.arange(len(start))
    segment = np.cumsum(np.r_[False, group[1:] != group[:-1]])
    depth = np.zeros(len(start), np.int64)
    open_ = np.arange(len(start))  # places in `order` that may still move
    while True:
        first = _starts(segment[open_])
        many = np.repeat(np.diff(np.r_[first, len(open_)]) > 1, np.diff(np.r_[first, len(open_)]))
        open_ = open_[many & (depth[open_] < depth_limit)]
        if not len(open_):
            break
        seg, d, who = segment[open_], depth[open_], order[open_]
        first = _starts(seg)
        count = np.diff(np.r_[first, len(open_)])
        word = _words(data, start[who] + d, size[who] - d)
        pivot = np.sort(np.stack([word[first], word[first + count // 2], word[first + count - 1]]), axis=0)[1]
        pivot = np.repeat(pivot, count)
        side = (word > pivot).astype(np.int8) - (word < pivot).astype(np.int8)
        moved = np.argsort(np.repeat(np.arange(len(first)) * 3, count) + side + 1, kind="stable")
        order[open_] = who[moved]
        side, d = side[moved], d[moved]
        depth[open_] = d + 8 * (side == 0)
        segment = _renumbered(segment, open_, side)
    return order, segment


def _renumbered(segment: np.ndarray, places: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Segment numbers after each segment was split by side; they ascend with the places."""
    part = np.zeros(len(segment), np.int8)
    part[places] = side
    return np.cumsum(np.r_[False, (segment[1:] != segment[:-1]) | (part[1:] != part[:-1])])


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differs = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differs.bit_length() + 7) // 8


def blind_trie_order(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Sorted places of the strings and the common prefix of each with the one before (first: 0).

    The trie keeps for each branching only its depth and the byte that leads on. A new string
    walks down by those bytes without comparing, is compared with the one leaf it reaches, and
    branches off where it first differs. A string that ends at a branching sorts first.
    """
    root: list = [0]  # a leaf is a list of equal strings' places
    for i in range(1, len(strings)):
        s, node, path = strings[i], root, []
        while isinstance(node, tuple):
            path.append(node)
            depth, children = node
            step = s[depth] if depth < len(s) else -1
            node = children.get(step)
            if node is None:
                node = next(iter(children.values()))
        other = strings[node[0]]
        common = _common(s, other)
        if common == len(s) == len(other):
            node.append(i)
            continue
        mine = s[common] if common < len(s) else -1
        above = [p for p in path if p[0] <= common]
        if above and above[-1][0] == common:
            above[-1][1][mine] = [i]
            continue
        theirs = other[common] if common < len(other) else -1
        below = path[len(above)] if len(above) < len(path) else node
        new = (common, {theirs: below, mine: [i]})
        if above:
            up = above[-1]
            up[1][s[up[0]] if up[0] < len(s) else -1] = new
        else:
            root = new
    order, common_with_last, stack, edge = [], [], [(root, 0)], 0
    while stack:
        node, edge = stack.pop()
        if isinstance(node, tuple):
            depth, children = node
            steps = sorted(children)
            for k in range(len(steps) - 1, -1, -1):
                stack.append((children[steps[k]], depth if k else edge))
        else:
            order += node
            common_with_last += [edge] + [len(strings[node[0]])] * (len(node) - 1)
    return order, common_with_last


def sorted_suffixes(data: np.ndarray, start, size, group, shallow: int = SHALLOW):
    """Deep-shallow sort. Returns the order and the common prefix of each suffix with the one
    before, -1 at the first of a group. `data` has eight bytes beyond the last suffix."""
    order, tie = multikey_quicksort(data, start, size, group, shallow)
    start, size, group = start[order], size[order], group[order]
    common = np.full(len(order), -1, np.int64)
    # Neighbours that differ at shallow depth: eight bytes at a time.
    at = np.flatnonzero((group[1:] == group[:-1]) & (tie[1:] != tie[:-1])) + 1
    common[at] = 0
    for d in range(0, shallow, 8):
        if not len(at):
            break
        x = _words(data, start[at] + d, size[at] - d) ^ _words(data, start[at - 1] + d, size[at - 1] - d)
        ends = np.minimum(size[at], size[at - 1])
        here = x != 0
        zeros = np.full(len(at), 8)
        if here.any():
            zeros[here] = _leading_zero_bytes(x[here])
        common[at] = np.minimum(d + zeros, ends)
        at = at[~here]
    # Ties go to blind tries.
    first = _starts(tie)
    count = np.diff(np.r_[first, len(tie)])
    whole = data.tobytes()
    for f, c in zip(first[count > 1].tolist(), count[count > 1].tolist()):
        strings = [whole[a : a + n] for a, n in zip(start[f : f + c].tolist(), size[f : f + c].tolist())]
        inner, lengths = blind_trie_order(strings)
        order[f : f + c] = order[f : f + c][inner]
        common[f + 1 : f + c] = lengths[1:]
        if common[f] >= 0 and inner[0]:  # the first of the run is another one now, of another size
            common[f] = min(common[f], len(strings[inner[0]]))
    return order, common


def _leading_zero_bytes(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    for k in range(1, 8):
        out += x < (np.uint64(1) << np.uint64(64 - 8 * k))
    return out


def repeated_strings(group, n, left, windows, texts: list[bytes], length: int = LENGTH, shallow: int = SHALLOW):
    """Which strings of the contexts occur twice or more in their group.

    group ascends; n: how often each context occurs; left: bytes before its anchor; windows:
    its number of strings. Returns a matrix by context and offset of the anchor in the string.
    """
    m = len(texts)
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(size) - size
    data = np.frombuffer(b"".join(texts) + bytes(16), np.uint8)
    right_order, right = sorted_suffixes(data, begin + left, size - left, group, shallow)
    back = np.concatenate([data[:-16][::-1], np.zeros(16, np.uint8)])
    total = int(size.sum())
    left_order, leftwards = sorted_suffixes(back, total - begin - left, left, group, shallow)
    offsets = length - GRAM + 1
    out = np.zeros((m, offsets), bool)
    right_class, left_class = np.empty(m, np.int64), np.empty(m, np.int64)
    for o in range(offsets):
        who = np.flatnonzero((left >= o) & (left - windows < o))
        if not len(who):
            continue
        right_class[right_order] = np.cumsum(right < length - o)
        left_class[left_order] = np.cumsum(leftwards < o)
        pair = left_class[who] * (m + 1) + right_class[who]
        order = np.argsort(pair, kind="stable")
        first = _starts(pair[order])
        times = np.add.reduceat(n[who][order], first)
        found = np.repeat(times > 1, np.diff(np.r_[first, len(who)]))
        out[who[order[found]], o] = True
    return out


def _span_batch(keys: pa.Array, start, stop) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([keys, _i32(start), _i32(stop)], names=["text_key", "start", "stop"])


def _sort_contexts(length: int, shallow: int):
    def sort(t: pa.Table) -> Iterator[pa.RecordBatch]:
        gram, n, left, lo, hi = (_ints(t, c) for c in ("gram", "n", "anchor", "lo", "hi"))
        found = repeated_strings(gram, n, left, hi - lo + 1, t.column("bytes").to_pylist(), length, shallow)
        found[n > 1] = False  # known before
        # strings start at lo + left - offset: runs of offsets are runs of starts
        edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, a = np.nonzero(edge == 1)
        _, b = np.nonzero(edge == -1)
        if len(row):
            base = lo[row] + left[row]
            keys = t.column("text_key").combine_chunks().take(pa.array(row))
            yield _span_batch(keys, base - (b - 1), base - a + length)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, one = None, None  # contexts; the last string by hash: (hashes, times, its row)
        for batch in batches:
            t = pa.Table.from_batches([batch])
            kind = _ints(t, "kind")
            if (w := np.flatnonzero(kind == 1)).size:
                s = t.take(pa.array(w))
                if one is not None:
                    s = pa.concat_tables([one, s]).combine_chunks()
                first = _starts(_ints(s, "gram"), _ints(s, "other"))
                size = np.diff(np.r_[first, len(s)])
                n = _ints(s, "n")
                twice = np.repeat(np.add.reduceat(n, first) > 1, size)
                out = np.flatnonzero(twice & (n == 1))
                if len(out):
                    lo = _ints(s, "lo")[out]
                    yield _span_batch(s.column("text_key").combine_chunks().take(pa.array(out)), lo, lo + length)
                total = int(n[first[-1] :].sum())
                one = s.slice(len(s) - 1)
                if total > 1:
                    one = one.set_column(3, "n", pa.array([2], pa.int32()))
                t = t.take(pa.array(np.flatnonzero(kind == 0)))
            if not len(t):
                continue
            held = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
            last = int(_starts(_ints(held, "gram"))[-1])
            if last and len(held) >= BATCH:
                yield from sort(held.slice(0, last).combine_chunks())
                held = held.slice(last)
        if held is not None and len(held):
            yield from sort(held.combine_chunks())

    return run


def _cut_contexts(length: int):
    """Rows (text_key, text, list of contexts) -> the contexts' bytes; strings' hashes where hot."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, wanted in zip(*(batch.column(i) for i in range(3))):
                key, text = key.as_py(), memoryview(text.as_buffer())
                for c in wanted.as_py():
                    lo, hi = c["lo"], c["hi"]
                    if not c["hot"]:
                        rows.append((0, c["gram"], 0, c["n"], key, c["anchor"] - lo, lo, hi, text[lo : hi + length]))
                        continue
                    for s in range(lo, hi + 1):
                        h = xxhash.xxh3_128_digest(text[s : s + length])
                        a, b = (int.from_bytes(x, "big", signed=True) for x in (h[:8], h[8:]))
                        rows.append((1, a, b, c["n"], key, 0, s, s, b""))
                if len(rows) > 20_000:
                    yield _cut_batch(rows)
                    rows = []
            if rows:
                yield _cut_batch(rows)

    return run


def _cut_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    names = ["kind", "gram", "other", "n", "text_key", "anchor", "lo", "hi", "bytes"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


# ---- 4. the operator -------------------------------------------------------------------------


def text_key(text: Column) -> Column:
    """128 bits that name a text."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def covered(texts: DataFrame, length: int = LENGTH, group: int = GROUP, shallow: int = SHALLOW) -> DataFrame:
    """(text_key, spans) for texts of which bytes are covered: arrays of (start, stop).

    Takes (text_key, text as binary), a row for each document; spans may overlap.
    """
    if length < GRAM + 8:
        raise ValueError(f"length must be {GRAM + 8} or more")
    found = bounded(texts).filter(F.octet_length("text") >= length)
    rows = found.select("text_key", "text").mapInArrow(lean(_context_rows(length)), ROWS)
    met = rows.repartition("gram").sortWithinPartitions("gram", "context", "text_key", "lo")
    judged = store(met.mapInArrow(lean(_judge(length, group)), JUDGED), "judged")
    wanted = (
        judged.filter("gram IS NOT NULL")
        .groupBy("text_key")
        .agg(F.collect_list(F.struct("gram", "n", "anchor", "lo", "hi", "hot")).alias("wanted"))
    )
    once = found.groupBy("text_key").agg(F.first("text").alias("text"))
    cut = once.join(wanted, "text_key").select("text_key", "text", "wanted").mapInArrow(lean(_cut_contexts(length)), CUT)
    dealt = cut.repartition("gram").sortWithinPartitions("kind", "gram", "other")
    by_sort = store(dealt.mapInArrow(lean(_sort_contexts(length, shallow)), SPANS), "spans")
    known = judged.filter("gram IS NULL").select("text_key", F.col("lo").alias("start"), F.col("hi").alias("stop"))
    # Copies of a text bring the same spans: distinct ones are no more than the text's own length.
    return known.union(by_sort).distinct().groupBy("text_key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping or touching (start, stop) as maximal runs."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.r_[True, spans[1:, 0] > reach[:-1]])
    return np.stack([spans[new, 0], reach[np.r_[new[1:] - 1, len(spans) - 1]]], axis=1)


def _spans_of(lists: pa.Array, i: int) -> np.ndarray:
    if not lists.is_valid()[i].as_py():
        return np.zeros((0, 2), np.int64)
    value = lists[i].values
    return np.stack([value.field(0).to_numpy(), value.field(1).to_numpy()], axis=1).astype(np.int64)


def _kept(text: memoryview, runs: np.ndarray) -> list[memoryview]:
    edges = [0, *runs.ravel().tolist(), len(text)]
    return [text[a:b] for a, b in zip(edges[::2], edges[1::2])]


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for i, text in enumerate(batch.column(1)):
            text, spans = memoryview(text.as_buffer()), _spans_of(batch.column(2), i)
            runs = merged(spans)
            sha = hashlib.sha256()
            for part in _kept(text, runs):
                sha.update(part)
            out.append((len(text), int((runs[:, 1] - runs[:, 0]).sum()), len(runs), sha.hexdigest()))
        n, gone, count, sha = zip(*out) if out else ((),) * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return docs.withColumn("text", text).withColumn("text_key", text_key(F.col("text")))


def removal_digest(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), a row for each row of `docs`.

    A null text is empty. Rows that repeat a text (or a whole row) are documents of their own,
    so from `length` bytes on all of their text goes. Other columns are not read.
    """
    texts = _keyed(docs.select("doc_id", "text"))
    spans = covered(texts, **options)
    return (
        texts.join(spans, "text_key", "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(lean(_digests), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )


def _strip(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, texts = batch.column("_spans"), batch.column("text")
        out, stays = [], []
        for i, text in enumerate(texts):
            runs = merged(_spans_of(spans, i))
            if len(runs):
                text = b"".join(_kept(memoryview(text.as_buffer()), runs)).decode("utf-8", "ignore")
                out.append(text)
                stays.append(text != "")
            else:
                out.append(text.as_py())
                stays.append(True)
        place = batch.schema.get_field_index("text")
        changed = batch.set_column(place, "text", pa.array(out, pa.string())).drop_columns(["_spans"])
        yield changed.filter(pa.array(stays, pa.bool_()))


def strip_repeats(docs: DataFrame, **options) -> DataFrame:
    """The documents without their covered bytes; those that lose all their text go.

    Characters that a removal cuts through are dropped. `n_chars` is set anew if there is such
    a column. Null and short texts stay as they are, and so do other columns, whatever their names.
    """
    docs, named = apart(docs, ("text", "n_chars"))
    columns = docs.columns
    texts = _keyed(docs)
    spans = covered(texts.select("text_key", "text"), **options).withColumnsRenamed(
        {"text_key": "_key", "spans": "_spans"}
    )
    keyed = docs.withColumn("_key", text_key(F.coalesce(F.col("text").cast("binary"), F.lit(b""))))
    joined = keyed.join(spans, "_key", "left").drop("_key")
    stripped = joined.select(*columns, "_spans").mapInArrow(lean(_strip), docs.schema)
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        stripped = stripped.withColumn("n_chars", F.char_length("text").cast(kind))
    return named(stripped)
