"""Removing long repeats: bytes covered by a string that starts earlier somewhere in the corpus.

Strings of ``LENGTH`` bytes, windows, are grouped by content before any is
sorted.  Each window selects its leftmost smallest hashed 24-byte string, its
anchor, so equal windows select equal anchors; neighbouring windows that select
the same one make a block.  Blocks are dealt by anchor hash.  Of equal blocks, told by
cryptographic digests of their bytes, all but the earliest repeat whole.  An anchor whose blocks are all equal is then done; where they differ,
the earliest of each is sent on with its bytes.

There the suffixes that start at the anchors, and the reversed text before them, are
sorted by mergesort.  Two suffixes are compared by their longest
common extension, found by binary search over prefix polynomial hashes, and the
byte after it.  The extensions between neighbours of the sorted order, checked byte by byte
against collisions, tell for every window of every block which others equal it;
all but the earliest repeat.

Anchors with very many different blocks, such as the first of a passage
that a third of all documents share, would gather too much in one task: their
windows are dealt by digests of their own bytes instead.  Copies met in one task are
reduced to their earliest before anything is sent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import buckets, cell, grouped, small_batches, texts
from tradewind.llm.shingles import mix
from tradewind.sources.shared import staged

LENGTH = 100
GRAM = 24
#: Different blocks of one anchor from which on windows are dealt by their own hashes.
MANY_BLOCKS = 512
#: Bytes of text worked on at a time, and blocks a task holds before it sends them.
_TEXT_BYTES = 1 << 20
_HELD = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = _U(pow(_BASE, -1, 1 << 64))
_BYTES = np.array([xxhash.xxh3_64_intdigest(bytes([b]), 7) for b in range(256)], _U)
_LAST_ID = np.iinfo(np.int64).max
_KEY = _U((1 << 40) - 1)
_REPEATED, _DIFFERING, _CROWDED = 0, 1, 2


class PrefixHash:
    """Polynomial hashes of all substrings of a byte string, alike wherever they stand."""

    def __init__(self, text: np.ndarray) -> None:
        n = len(text)
        powers = np.full(n + 1, _U(_BASE))
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self.back = np.full(n + 1, _INVERSE)
        self.back[0] = 1
        np.multiply.accumulate(self.back, out=self.back)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(_BYTES[text] * powers[:-1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.back[start]


def _digests(text: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """128 bits of a cryptographic hash of each substring, as rows of two numbers: alike only for equal bytes."""
    digest = hashlib.sha256
    cells = [digest(text[a:b]).digest()[:16] for a, b in zip(start.tolist(), (start + size).tolist(), strict=True)]
    return np.frombuffer(b"".join(cells), _U).reshape(-1, 2)


def _checks(digests: np.ndarray) -> np.ndarray:
    """32 bits of each digest: they tell which of several texts under one id a block is of."""
    return digests[:, 0].astype(np.uint32)


def _check(piece: bytes) -> int:
    return int.from_bytes(hashlib.sha256(piece).digest()[:4], "little")


def _blocks(batch: list[bytes]) -> tuple[np.ndarray, ...]:
    """Place of the text, start, windows, anchor's offset, anchor hash and content digest of all blocks."""
    sizes = np.array([len(t) for t in batch], np.int64)
    joined = b"".join(batch)
    text = np.frombuffer(joined, np.uint8)
    begins = np.cumsum(sizes) - sizes
    windows = np.maximum(0, sizes - LENGTH + 1)
    if not windows.sum():
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(_U), np.zeros((0, 2), _U)
    hashed = PrefixHash(text)
    grams = mix(hashed(np.arange(len(text) - GRAM + 1), GRAM))
    span = LENGTH - GRAM + 1
    rows = -(-len(grams) // span)
    high = np.full(rows * span, ~_U(0))
    high[: len(grams)] = grams
    high = (high & ~_U(0xFF)).reshape(rows, span)
    # Smallest of each run of `span`, as that of a tail and of a head of two rows;
    # the low byte is the place from the first row's start, so ties go left.
    place = np.arange(span, dtype=_U)
    tails = np.minimum.accumulate((high | place)[:, ::-1], axis=1)[:, ::-1].ravel()
    heads = np.minimum.accumulate(high | (place + _U(span)), axis=1).ravel()
    owner = np.repeat(np.arange(len(batch)), windows)
    at = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows) + begins[owner]
    least = np.minimum(tails[at], heads[at + span - 1])
    anchor = at // span * span + (least & _U(0xFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    count = np.diff(np.concatenate((first, [len(at)])))
    start = at[first]
    content = _digests(joined, start, count + LENGTH - 1)
    return owner[first], start - begins[owner[first]], count, anchor[first] - start, grams[anchor[first]], content


def _earliest(keys: tuple[np.ndarray, ...], ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by keys, then document and start; where a key begins; what repeats an earlier row of its key."""
    order = np.lexsort((starts, ids, *keys))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    at = np.flatnonzero(new)
    head = order[np.repeat(at, np.diff(np.concatenate((at, [len(order)]))))]
    later = (ids[order] != ids[head]) | (starts[order] != starts[head])
    return order, new, later


_PARTS = {"anchor": _U, "content": _U, "id": np.int64, "start": np.int32, "windows": np.uint8, "offset": np.uint8}


def _planes(array: np.ndarray) -> bytes:
    """Bytes of equal rank together: the high ones, mostly zeros, compress away."""
    return cell(array.view(np.uint8).reshape(len(array), -1).T)


def _unplaned(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _packed_ids(ids: np.ndarray) -> bytes:
    return _planes(np.diff(ids, prepend=0))


def _sent_blocks(docs: DataFrame, parts: int) -> DataFrame:
    """Blocks by bucket of their anchor; those a task finds repeated travel as such."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        total = 0

        def out() -> pa.RecordBatch:
            ids, start, count, offset, anchor, content = (np.concatenate(x) for x in zip(*held, strict=True))
            order, new, later = _earliest((*content.T, anchor), ids, start)
            bucket = ((anchor >> _U(40)) % _U(parts)).astype(np.int64)
            # What is known to repeat needs no partner and goes anywhere.
            bucket[order[later]] = (mix(ids.astype(_U) + start.astype(_U)) % _U(parts)).astype(np.int64)[order[later]]
            known = np.zeros(len(ids), bool)
            known[order[later]] = True
            keep = np.zeros(len(ids), bool)
            keep[order[new]] = True
            rank = np.lexsort((ids, known, bucket))
            rank = rank[(keep | known)[rank]]
            bucket, known = bucket[rank], known[rank]
            cuts = np.flatnonzero(np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (known[1:] != known[:-1]), [True])))
            rows: dict[str, list] = {n: [] for n in ("bucket", "known", "low", "high", "content", "check", "ids", "start", "windows", "offset")}
            for a, b in zip(cuts, cuts[1:]):
                own = rank[a:b]
                rows["bucket"].append(int(bucket[a]))
                rows["known"].append(bool(known[a]))
                key = anchor[own] & _KEY
                rows["low"].append(b"" if known[a] else cell(key.astype(np.uint32)))
                rows["high"].append(b"" if known[a] else cell((key >> _U(32)).astype(np.uint8)))
                rows["content"].append(b"" if known[a] else cell(content[own]))
                rows["check"].append(cell(_checks(content[own])) if known[a] else b"")
                rows["ids"].append(_packed_ids(ids[own]))
                rows["start"].append(_planes(start[own].astype(np.int32)))
                rows["windows"].append(cell(count[own].astype(np.uint8)))
                rows["offset"].append(cell(offset[own].astype(np.uint8)))
            kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 8]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)], list(rows))

        for batch in batches:
            ids = batch.column("id").to_numpy()
            rows = zip(ids, texts(batch.column("text")), strict=True)
            for some in grouped(rows, lambda row: len(row[1]), _TEXT_BYTES):
                owner, *found = _blocks([row[1] for row in some])
                if len(owner):
                    held.append((np.array([row[0] for row in some], np.int64)[owner], *found))
                    total += len(owner)
            if total >= _HELD:
                yield out()
                held, total = [], 0
        if total:
            yield out()

    schema = "bucket int, known boolean, low binary, high binary, content binary, check binary, ids binary, start binary, windows binary, offset binary"
    return docs.mapInArrow(send, schema)


_REPLY = "id bigint, start int, windows smallint, offset smallint, kind tinyint, anchor bigint, check bigint"


def _reply(ids, start, windows, offset, kind, anchor, check) -> pa.Table:  # noqa: ANN001
    return pa.table(
        {
            "id": pa.array(ids, pa.int64()),
            "start": pa.array(start, pa.int32()),
            "windows": pa.array(windows, pa.int16()),
            "offset": pa.array(offset, pa.int16()),
            "kind": pa.array(kind, pa.int8()),
            "anchor": pa.array(anchor, pa.int64()),
            "check": pa.array(check, pa.int64()),
        }
    )


def _decided(sent: DataFrame) -> DataFrame:
    """Blocks that repeat whole, and the earliest of each where an anchor's blocks differ."""

    def decide(rows: pa.Table) -> pa.Table:
        def column(name: str, known: bool) -> list[bytes]:
            return [x for x, k in zip(rows.column(name).to_pylist(), rows.column("known").to_pylist(), strict=True) if k is known]

        def joined(known: bool) -> tuple[np.ndarray, ...]:
            none = [np.zeros(0, np.int64)]
            ids = [np.cumsum(_unplaned(x, np.int64)) for x in column("ids", known)]
            start = [_unplaned(x, np.int32).astype(np.int64) for x in column("start", known)]
            windows = [np.frombuffer(x, np.uint8).astype(np.int64) for x in column("windows", known)]
            offset = [np.frombuffer(x, np.uint8).astype(np.int64) for x in column("offset", known)]
            return tuple(np.concatenate(x or none) for x in (ids, start, windows, offset))

        done = joined(True)
        ids, start, windows, offset = joined(False)
        # Few bits of an anchor do: anchors that share them are told apart by their blocks' bytes.
        anchor = np.frombuffer(b"".join(column("low", False)), np.uint32).astype(_U)
        anchor |= np.frombuffer(b"".join(column("high", False)), np.uint8).astype(_U) << _U(32)
        content = np.frombuffer(b"".join(column("content", False)), _U).reshape(-1, 2)
        order, new, later = _earliest((*content.T, anchor), ids, start)
        sorted_anchor = anchor[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = sorted_anchor[1:] != sorted_anchor[:-1]
        group = np.cumsum(fresh) - 1
        different = np.bincount(group[new], minlength=group[-1] + 1 if len(group) else 0)
        kind = np.full(len(order), -1, np.int8)
        kind[later] = _REPEATED
        kind[new & (different[group] > 1)] = _DIFFERING
        kind[new & (different[group] > MANY_BLOCKS)] = _CROWDED
        told = kind >= 0
        at = order[told]
        zeros = np.zeros(len(done[0]), np.int64)
        known_checks = np.frombuffer(b"".join(column("check", True)), np.uint32).astype(np.int64)
        out = [
            np.concatenate((mine, theirs))
            for mine, theirs in zip(
                done + (zeros, zeros, known_checks),
                (ids[at], start[at], windows[at], offset[at], kind[told], anchor[at].view(np.int64), _checks(content[at]).astype(np.int64)),
                strict=True,
            )
        ]
        return _reply(*out)

    return sent.groupBy("bucket").applyInArrow(decide, _REPLY)


# --- sorting suffixes -------------------------------------------------------


class Suffixes:
    """Pieces of one byte string, compared by hashes of their common extensions."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.text = np.frombuffer(b"".join(pieces) + b"\0", np.uint8)
        self.start = np.cumsum(self.size) - self.size
        self.hash = PrefixHash(self.text)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes the pieces have in common from their start, by binary search."""
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.size[a], self.size[b])
        one, two = self.start[a], self.start[b]
        for _ in range(int(high.max(initial=0)).bit_length()):
            mid = (low + high + 1) >> 1
            same = self.hash(one, mid) == self.hash(two, mid)
            low = np.where(same, mid, low)
            high = np.where(same, high, mid - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        common = self.extension(a, b)
        ends_a, ends_b = common >= self.size[a], common >= self.size[b]
        after = self.text[np.where(ends_a, 0, self.start[a] + common)] < self.text[np.where(ends_b, 0, self.start[b] + common)]
        return ~ends_b & (ends_a | after)

    def sort(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order by group, then content, and each piece's extension with the one before it, -1 across groups.

        Mergesort from the bottom, all groups and runs at once: a piece's new
        place is its own rank plus its rank in the neighbouring run, by binary search.
        """
        order = np.argsort(group, kind="stable")
        new = np.concatenate(([True], group[order][1:] != group[order][:-1])) if len(order) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        count = np.diff(np.concatenate((begin, [len(order)])))
        begin, count = np.repeat(begin, count), np.repeat(count, count)
        width = 1
        while len(count) and width < count.max():
            slot = np.flatnonzero(count > width)
            base, end = begin[slot], begin[slot] + count[slot]
            run = (slot - base) // width
            left = run % 2 == 0
            low = np.minimum(base + np.where(left, run + 1, run - 1) * width, end)
            high = np.minimum(low + width, end)
            other, mine = low.copy(), order[slot]
            while (open_ := low < high).any():
                mid = (low[open_] + high[open_]) >> 1
                x, y = mine[open_], order[mid]
                on_left = left[open_]
                # Equal pieces keep their order: the left run's come first.
                before = np.where(on_left, self.less(np.where(on_left, y, x), np.where(on_left, x, y)), False)
                before |= ~on_left & ~self.less(np.where(on_left, y, x), np.where(on_left, x, y))
                low[open_] = np.where(before, mid + 1, low[open_])
                high[open_] = np.where(before, high[open_], mid)
            pair = base + run // 2 * 2 * width
            own = (slot - base) % width
            target = pair + own + (low - other)
            merged = order.copy()
            merged[target] = mine
            order = merged
            width *= 2
        shared = self.extension(order[:-1], order[1:]) if len(order) else np.zeros(0, np.int64)
        if not self._checked(order, shared):
            pieces = [self.text[s : s + n].tobytes() for s, n in zip(self.start, self.size, strict=True)]
            order = np.array(sorted(range(len(pieces)), key=lambda i: (group[i], pieces[i])), np.int64)
            shared = np.array(
                [next((k for k, (x, y) in enumerate(zip(pieces[a], pieces[b])) if x != y), min(len(pieces[a]), len(pieces[b])))
                 for a, b in zip(order, order[1:])], np.int64,
            )
        common = np.concatenate(([-1], shared))[: len(order)]
        common[new] = -1
        return order, common

    def _checked(self, order: np.ndarray, shared: np.ndarray) -> bool:
        """Whether the extensions found by hashes are equal bytes."""
        for a in range(0, len(shared), 4096):
            one, two, n = order[:-1][a : a + 4096], order[1:][a : a + 4096], shared[a : a + 4096]
            step = np.arange(n.max(initial=0))
            inside = step < n[:, None]
            x = self.text[np.where(inside, self.start[one][:, None] + step, 0)]
            y = self.text[np.where(inside, self.start[two][:, None] + step, 0)]
            if ((x != y) & inside).any():
                return False
        return True


def repeated_windows(
    anchor: np.ndarray, ids: np.ndarray, start: np.ndarray, windows: np.ndarray, offset: np.ndarray, content: list[bytes]
) -> list[tuple[int, int, int]]:
    """(document, start, windows) runs of windows that equal an earlier one at the same anchor."""
    return [(int(ids[i]), int(start[i] + a), n) for i, a, n in _repeated_runs(anchor, ids, start, windows, offset, content)]


def _repeated_runs(
    anchor: np.ndarray, ids: np.ndarray, start: np.ndarray, windows: np.ndarray, offset: np.ndarray, content: list[bytes]
) -> list[tuple[int, int, int]]:
    """The same as (block, first window in it, windows)."""
    count = len(ids)
    after = Suffixes([c[o:] for c, o in zip(content, offset, strict=True)])
    ahead = Suffixes([c[:o][::-1] for c, o in zip(content, offset, strict=True)])
    after_order, after_common = after.sort(anchor)
    ahead_order, ahead_common = ahead.sort(anchor)
    place = start + offset
    rank = np.empty(count, np.int64)
    rank[np.lexsort((place, ids))] = np.arange(count)
    hit = np.zeros((count, LENGTH - GRAM + 1), bool)
    classes = np.empty(count, np.int64)
    for back in range(LENGTH - GRAM + 1):
        some = np.flatnonzero((back <= offset) & (back > offset - windows))
        if len(some) < 2:
            continue
        classes[after_order] = np.cumsum(after_common < LENGTH - back)
        one = classes[some]
        classes[ahead_order] = np.cumsum(ahead_common < back)
        key = one * (count + 1) + classes[some]
        order = np.lexsort((rank[some], key))
        at, key = some[order], key[order]
        heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        head = at[np.repeat(heads, np.diff(np.concatenate((heads, [len(at)]))))]
        later = (ids[at] != ids[head]) | (place[at] != place[head])
        hit[at[later], offset[at[later]] - back] = True
    out = []
    edges = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    for (i, a), (_, b) in zip(np.argwhere(edges == 1), np.argwhere(edges == -1), strict=True):
        out.append((int(i), int(a), int(b - a)))
    return out


# --- the operator -----------------------------------------------------------


def _packed(docs: DataFrame) -> DataFrame:
    """The rows with their text compressed: what shuffles carry."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            cells = [squeeze(t or b"") for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("doc_id"), pa.array(cells, pa.binary())], ["id", "doc_id", "packed"])

    return docs.mapInArrow(pack, "id bigint, doc_id bigint, packed binary")


def _with_bytes(docs: DataFrame, open_: DataFrame, parts: int) -> DataFrame:
    """The blocks still to compare, with their bytes, and single windows of crowded anchors."""
    listed = open_.groupBy("id").agg(F.collect_list(F.struct("start", "windows", "offset", "kind", "anchor", "check")).alias("blocks"))
    joined = _packed(docs).join(listed, "id").select("id", "packed", "blocks")
    schema = "bucket int, " + _REPLY.removesuffix(", check bigint") + ", content binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inflate = zstandard.ZstdDecompressor().decompress
            rows: list[tuple] = []
            ids, starts, marks = [], [], []
            docs_, texts_ = [], []
            for doc, packed, blocks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = inflate(packed)
                docs_.append(doc)
                texts_.append(text)
                for block in blocks:
                    start, windows, anchor = block["start"], block["windows"], block["anchor"]
                    if _check(text[start : start + windows + LENGTH - 1]) != block["check"]:
                        continue  # of another text under the same id
                    if block["kind"] == _DIFFERING:
                        bucket = int(mix(np.array([anchor], np.int64).view(_U))[0] % _U(parts))
                        rows.append((bucket, doc, start, windows, block["offset"], _DIFFERING, anchor, text[start : start + windows + LENGTH - 1]))
                    else:
                        at = np.arange(start, start + windows)
                        marks.append(_digests(text, at, np.full(windows, LENGTH)))
                        starts.append(at)
                        ids.append(np.full(windows, len(docs_) - 1))
            if marks:
                mark, start, text_of = np.concatenate(marks), np.concatenate(starts), np.concatenate(ids)
                owner = np.array(docs_, np.int64)[text_of]
                order, new, later = _earliest(tuple(mark.T), owner, start)
                for place in order[new]:
                    rows.append((int(mark[place, 0] % _U(parts)), int(owner[place]), int(start[place]), 1, 0, _CROWDED, 0, mark[place].tobytes()))
                # Windows that repeat within the batch need no partner; neighbours go as one run.
                for place, first, count in _runs(text_of[order[later]], start[order[later]]):
                    doc, run = docs_[place], texts_[place][first : first + count + LENGTH - 1]
                    bucket = int(mix(np.array([doc ^ first], np.int64).view(_U))[0] % _U(parts))
                    rows.append((bucket, doc, first, count, 0, _REPEATED, 0, hashlib.sha256(run).digest()[:4]))
            if rows:
                kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int16(), pa.int16(), pa.int8(), pa.int64(), pa.binary()]
                names = ["bucket", "id", "start", "windows", "offset", "kind", "anchor", "content"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return joined.mapInArrow(cut, schema)


def _runs(ids: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """(document, start, windows) for runs of neighbouring windows."""
    order = np.lexsort((starts, ids))
    ids, starts = ids[order], starts[order]
    new = np.concatenate(([True], (ids[1:] != ids[:-1]) | (starts[1:] > starts[:-1] + 1)))[: len(ids)]
    heads = np.flatnonzero(new)
    tails = np.concatenate((heads[1:], [len(ids)])) - 1
    counts = starts[tails] - starts[heads] + 1 if len(ids) else heads
    return [(int(i), int(s), int(n)) for i, s, n in zip(ids[heads], starts[heads], counts, strict=True)]


def _compared(cut: DataFrame) -> DataFrame:
    """(id, start, windows, check) of the windows among ``cut`` that repeat."""

    def compare(rows: pa.Table) -> pa.Table:
        kind = rows.column("kind").to_numpy()
        ids, start, windows, offset, anchor = (rows.column(c).to_numpy().astype(np.int64) for c in ("id", "start", "windows", "offset", "anchor"))
        content = rows.column("content")
        found = [(ids[i], start[i], windows[i], int.from_bytes(content[int(i)].as_py(), "little")) for i in np.flatnonzero(kind == _REPEATED)]
        single = np.flatnonzero(kind == _CROWDED)
        if len(single):
            mark = np.frombuffer(b"".join(content.take(pa.array(single)).to_pylist()), _U).reshape(-1, 2)
            order, _, later = _earliest(tuple(mark.T), ids[single], start[single])
            checks = _checks(mark)
            found += [(ids[single[i]], start[single[i]], 1, int(checks[i])) for i in order[later]]
        some = np.flatnonzero(kind == _DIFFERING)
        if len(some):
            pieces = content.take(pa.array(some)).to_pylist()
            for i, a, n in _repeated_runs(anchor[some], ids[some], start[some], windows[some], offset[some], pieces):
                found.append((ids[some[i]], start[some[i]] + a, n, _check(pieces[i][a : a + n + LENGTH - 1])))
        columns = list(zip(*found, strict=True)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int32(), pa.int16(), pa.int64())
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("id", "start", "windows", "check"), columns, kinds, strict=True)})

    return cut.groupBy("bucket").applyInArrow(compare, "id bigint, start int, windows smallint, check bigint")


def merged_spans(windows: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the windows cover, within a text of ``size`` bytes."""
    spans: list[tuple[int, int]] = []
    for start, count in sorted(windows):
        end = min(size, start + count + LENGTH - 1)
        if start >= end:
            continue
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans for every row of ``docs`` (doc_id: long, text).

    ``spans`` lists the removed byte ranges as ``start:end``.  Documents are ordered by doc_id, one
    without an id after all others.  Rows of one doc_id, and rows without one, count as one document, so
    repeated rows do not remove each other; of several texts under one doc_id each loses what was found in itself.  A NULL or empty text has no bytes.  Texts shorter than a window
    lose nothing.  An empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = buckets(spark)
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(int(_LAST_ID))).alias("id")
    docs = docs.select(key, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    long = docs.filter(F.octet_length("text") >= LENGTH)
    told = staged(_decided(_sent_blocks(long.select("id", "text"), parts)), "repeat-blocks")
    open_ = told.filter(F.col("kind") != _REPEATED)
    rest = staged(_compared(_with_bytes(long, open_, parts)), "repeat-windows")
    windows = told.filter(F.col("kind") == _REPEATED).select("id", "start", "windows", "check").union(rest)
    listed = windows.groupBy("id").agg(F.collect_list(F.struct("start", "windows", "check")).alias("windows"))
    joined = _packed(docs).join(listed, "id", "left").select("doc_id", "packed", "windows")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inflate = zstandard.ZstdDecompressor().decompress
            rows = []
            for doc_id, packed, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = inflate(packed)
                # Of several texts under one id each loses what was found in it.
                own = [(w["start"], w["windows"]) for w in found or () if _check(text[w["start"] : w["start"] + w["windows"] + LENGTH - 1]) == w["check"]]
                spans = merged_spans(own, len(text))
                kept, at = hashlib.sha256(), 0
                for start, end in spans:
                    kept.update(text[at:start])
                    at = end
                kept.update(text[at:])
                removed = sum(b - a for a, b in spans)
                rows.append((doc_id, len(text), removed, len(spans), kept.hexdigest(), ",".join(f"{a}:{b}" for a, b in spans)))
            if rows:
                kinds = [*[pa.int64()] * 4, pa.string(), pa.string()]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return joined.mapInArrow(
        remove, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans string"
    )
