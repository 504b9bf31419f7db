"""Scoring texts with a hashed maximum-entropy language model.

A token's probability is that of its class given the history, times that of the token
within its class.  Both are softmaxes over weights of hashed features: the word
before, the pair before, and words skipped to.  A class gathers words of one ending;
its members are its most frequent words and one that stands for all others.  Among
those a third softmax decides: every training word has a weight of its own count and
one for each class of word that came before it, so these weights grow with the
vocabulary and the corpus.

Counting and training cover every training document.  Texts are written once as
batches of word numbers.  The batches' distinct words, with the classes before
them, are dealt by hash; their training counts are summed there and kept as a table.
The weights of the third softmax are trained on that table: a round needs the sum of each class and
history over all words, a table of fixed size, and moves each weight by its own gradient; the words'
log probabilities then go back to the batches.  The frequent words' weights are trained in rounds,
each over its share of every batch's documents: tasks start from common weights,
update them by gradients of small groups of tokens, and the updated rows are averaged,
weighted by how often a task updated each, by slices over several tasks.  Only the mixed weights, of fixed
size, come to the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import buckets, cell, grouped, slices, texts
from tradewind.llm.shingles import hashes_of
from tradewind.sources.shared import staged

# Fixed values of the split asked for.
HELD_OUT_OF, HELD_OUT = 7, 2

CLASSES = 32
MEMBERS = 32  # the last stands for all rarer words, which have weights of their own below it
ROWS_BITS = 14
ROUNDS = 2
RATE = 0.3
GROUP_TOKENS = 4096
BATCH_TOKENS = 1 << 19
_SLICES = 16
_FEW_ROWS = 8
# Histories of a rarer word: the class of the word before, or the start of the text.
HISTORIES = CLASSES + 1
STEPS = 4
DECAY = 1.0
# Sums of a round are whole numbers of this many parts of one, so that their order does not matter.
_PARTS = 1 << 16

_U = np.uint64
_START = CLASSES * MEMBERS
_CLASS = _U(CLASSES - 1)
_END = _U(xxhash.xxh3_64_intdigest(b"end of text", 1)) & ~_CLASS


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % HELD_OUT_OF == HELD_OUT


# --- batches of word numbers -------------------------------------------------


def _planes(array: np.ndarray) -> bytes:
    return cell(array.view(np.uint8).reshape(len(array), array.itemsize).T)


def _unplaned(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _batches(docs: DataFrame) -> DataFrame:
    """Rows of many documents: ids, held out, sizes, word numbers and the words' marks."""

    def encode(rows: list[tuple[int | None, bytes | None]]) -> tuple:
        held = np.array([is_held_out(i) for i, _ in rows])
        words = [(t or b"").lower().split() for _, t in rows]
        flat, counts = hashes_of(words)
        marks, first, inverse = np.unique(flat, return_index=True, return_inverse=True)
        # Endings are few: each is hashed once.
        words = list(chain.from_iterable(words))
        endings = [words[i][-2:] for i in first.tolist()]
        kind = {e: xxhash.xxh3_64_intdigest(e, 5) & (CLASSES - 1) for e in set(endings)}
        kinds = np.fromiter(map(kind.__getitem__, endings), _U, len(endings))
        marks = np.concatenate(((marks & ~_CLASS) | kinds, [_END]))
        sizes = counts + 1
        ends = np.cumsum(sizes) - 1
        tokens = np.full(int(sizes.sum()), len(marks) - 1)
        inside = np.ones(len(tokens), bool)
        inside[ends] = False
        tokens[inside] = inverse
        # Frequent words get small numbers, which compress well.
        order = np.argsort(-np.bincount(tokens, minlength=len(marks)), kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        ids = [i for i, _ in rows]
        return ids, held.tolist(), cell(sizes.astype(np.int32)), _planes(number[tokens].astype(np.uint32)), cell(marks[order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = slices(batches, "text")
        rows = (row for b in cut for row in zip(b.column("doc_id").to_pylist(), texts(b.column("text")), strict=True))
        # About six bytes a word; a text is never divided.
        for some in grouped(rows, lambda row: len(row[1] or b"") + 6, BATCH_TOKENS * 6):
            kinds = [pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 3]
            names = ["ids", "held", "sizes", "tokens", "marks"]
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(encode(some), kinds, strict=True)], names)

    schema = "ids array<bigint>, held array<boolean>, sizes binary, tokens binary, marks binary"
    return staged(docs.mapInArrow(run, schema).withColumn("batch", F.monotonically_increasing_id()), "model-batches")


def _bucket_of(marks: np.ndarray, parts: int) -> np.ndarray:
    return ((marks >> _U(32)) % _U(parts)).astype(np.int64)


def _dealt(marks: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Words in the order of their buckets, the buckets met, and where each one's words lie in that order."""
    bucket = _bucket_of(marks, parts)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) != 0, [True])))
    return order, bucket[order][cuts[:-1]], list(zip(cuts, cuts[1:]))


class Pairs:
    """The different pairs of a batch's word and history, ordered as ``order`` has the words, and each token's pair."""

    def __init__(self, tokens: np.ndarray, sizes: np.ndarray, marks: np.ndarray, order: np.ndarray) -> None:
        before = np.empty(len(tokens), np.int64)
        before[1:] = (marks & _CLASS).astype(np.int64)[tokens[:-1]]
        before[np.cumsum(sizes) - sizes] = CLASSES
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        keys = place[tokens] * HISTORIES + before
        met = np.zeros(len(marks) * HISTORIES, bool)
        met[keys] = True
        found = np.flatnonzero(met)
        self.of_token = np.cumsum(met, dtype=np.int32)[keys] - 1
        self.words, self.histories = found // HISTORIES, found % HISTORIES


_ANSWER = "batch bigint, bucket int, at binary, fan binary, hist binary, marks binary, seen binary, kind int, top binary, n bigint, v bigint"


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    parts = [part.split() for part in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(parts)
    return pa.table({name: pa.array(c, kinds[kind]) for (name, kind), c in zip(parts, columns, strict=True)})


def _counted(batches: DataFrame, parts: int) -> DataFrame:
    """By bucket: its words with training counts by history, where each batch's words stand among them; sums and frequent words of classes."""
    schema = "batch bigint, bucket int, marks binary, fan binary, hist binary, seen binary"

    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in rows:
            for row in some.to_pylist():
                marks, sizes = np.frombuffer(row["marks"], _U), np.frombuffer(row["sizes"], np.int32)
                order, met, spans = _dealt(marks, parts)
                pairs = Pairs(_unplaned(row["tokens"], np.uint32), sizes, marks, order)
                learned = np.repeat(~np.array(row["held"], bool), sizes)
                seen = np.bincount(pairs.of_token[learned], minlength=len(pairs.words)).astype(np.uint32)
                fan = np.bincount(pairs.words, minlength=len(marks)).astype(np.uint8)
                hist = pairs.histories.astype(np.uint8)
                out = []
                for bucket, (a, b) in zip(met.tolist(), spans, strict=True):
                    x, y = np.searchsorted(pairs.words, (a, b))
                    out.append((row["batch"], bucket, cell(marks[order[a:b]]), cell(fan[a:b]), cell(hist[x:y]), _planes(seen[x:y])))
                yield from _table(out, schema).to_batches()

    def answer(rows: pa.Table) -> pa.Table:
        read = lambda name, kind: [np.frombuffer(x, kind) for x in rows.column(name).to_pylist()]
        asked, fans = read("marks", _U), read("fan", np.uint8)
        hist = np.concatenate(read("hist", np.uint8))
        own = np.concatenate([_unplaned(x, np.uint32) for x in rows.column("seen").to_pylist()])
        marks, inverse = np.unique(np.concatenate(asked), return_inverse=True)
        keys, where = np.unique(np.repeat(inverse, np.concatenate(fans)) * HISTORIES + hist, return_inverse=True)
        seen = np.bincount(where, weights=own, minlength=len(keys)).astype(np.int64)
        keys, seen = keys[seen > 0], seen[seen > 0]
        word = keys // HISTORIES
        counts = np.bincount(word, weights=seen, minlength=len(marks)).astype(np.int64)
        bucket = rows.column("bucket")[0].as_py()
        none = (None,) * 4
        fan = np.bincount(word, minlength=len(marks)).astype(np.uint8)
        out = [(None, bucket, None, cell(fan), cell((keys % HISTORIES).astype(np.uint8)), cell(marks), _planes(seen), *none)]
        at = np.split(inverse.astype(np.uint32), np.cumsum([len(x) for x in asked])[:-1])
        for batch, a, f, h in zip(*(c.to_pylist() for c in (rows.column("batch"), at_column(at), rows.column("fan"), rows.column("hist"))), strict=True):
            out.append((batch, bucket, a, f, h, None, None, *none))
        kinds = (marks & _CLASS).astype(np.int64)
        n = np.bincount(kinds, weights=counts, minlength=CLASSES).astype(np.int64)
        v = np.bincount(kinds[counts > 0], minlength=CLASSES)
        for c in np.flatnonzero(v):
            top = _top(*(x[(counts > 0) & (kinds == c)] for x in (marks, counts)))
            out.append((*(None,) * 7, int(c), top, int(n[c]), int(v[c])))
        return _table(out, _ANSWER)

    def at_column(at: list[np.ndarray]) -> pa.Array:
        return pa.array([_planes(x) for x in at], pa.binary())

    asked = batches.select("batch", "held", "sizes", "tokens", "marks").mapInArrow(ask, schema)
    return staged(asked.groupBy("bucket").applyInArrow(answer, _ANSWER), "model-counts")


def _top(marks: np.ndarray, counts: np.ndarray) -> bytes:
    """The most frequent words of a class, as marks and then counts."""
    best = np.lexsort((marks, -counts))[: MEMBERS - 1]
    return cell(marks[best]) + cell(counts[best].astype(np.int64))


def _topmost(rows: pa.Table) -> pa.Table:
    """The most frequent words of one class over all buckets."""
    lists = [np.frombuffer(x, np.int64).reshape(2, -1) for x in rows.column("top").to_pylist()]
    marks, counts = np.concatenate(lists, axis=1)
    marks, counts = np.frombuffer(_top(marks.view(_U), counts), np.int64).reshape(2, -1)
    kind = np.full(len(marks), rows.column("kind")[0].as_py(), np.int32)
    return pa.table({"kind": kind, "place": np.arange(len(marks), dtype=np.int32), "mark": marks, "n": counts})


class Vocabulary:
    """Classes with their frequent words and the sums of the others: a table of fixed size."""

    def __init__(self, answers: DataFrame) -> None:
        sums = answers.filter("v IS NOT NULL").groupBy("kind").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
        tops = answers.filter("top IS NOT NULL").select("kind", "top").groupBy("kind")
        best = tops.applyInArrow(_topmost, "kind int, place int, mark bigint, n bigint").collect()
        self.tokens = sum(row.n for row in sums)
        self.types = sum(row.v for row in sums)
        self.counts = np.zeros((CLASSES, MEMBERS), np.int64)
        rest, rest_types = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for row in sums:
            rest[row.kind], rest_types[row.kind] = row.n, row.v
        found = sorted((np.int64(row.mark).view(_U), row.kind * MEMBERS + row.place) for row in best)
        self.marks = np.array([m for m, _ in found], _U)
        self.numbers = np.array([k for _, k in found], np.int64)
        for row in best:
            self.counts[row.kind, row.place] = row.n
            rest[row.kind] -= row.n
            rest_types[row.kind] -= 1
        self.counts[:, -1] = rest
        # Each rarer word weighs its count plus one, and all words not in training one together.
        self.spread = rest + rest_types + 1.0

    def number(self, marks: np.ndarray) -> np.ndarray:
        """Class and member of each word as one number."""
        out = (marks & _CLASS).astype(np.int64) * MEMBERS + MEMBERS - 1
        if len(self.marks):
            place = np.minimum(np.searchsorted(self.marks, marks), len(self.marks) - 1)
            same = self.marks[place] == marks
            out[same] = self.numbers[place[same]]
        return out


class Rarer:
    """The softmax of a class's rarer words by history, trained by gradients over the words' table.

    A word weighs (count + 1) exp(w) after history h, where w belongs to (word, h) and is 0
    unless the pair is in training.  A round moves each w by the gradient of the
    training texts' log probability less DECAY w^2 / 2, over that gradient's own slope and by 1 at most.
    """

    def __init__(self, answers: DataFrame, words: Vocabulary) -> None:
        self.words = words
        self.totals = np.zeros((CLASSES, HISTORIES))
        self.sums: list[np.ndarray] = []
        self.totals = self._summed(answers, lambda part: part.seen) / _PARTS
        self.sums.append(np.repeat(words.spread[:, None], HISTORIES, axis=1))
        for _ in range(STEPS):
            added = self._summed(answers, lambda part: part.plus[part.word] * np.expm1(self.weights(part)))
            self.sums.append(self.sums[0] + added / _PARTS)

    def weights(self, part: Words) -> np.ndarray:
        """Weights of a part's pairs after the rounds that are summed up."""
        out = np.zeros(len(part.word))
        at = part.kinds[part.word], part.hist
        for whole in self.sums[:STEPS]:
            expected = self.totals[at] * part.plus[part.word] * np.exp(out) / whole[at]
            out += np.clip((part.seen - expected - DECAY * out) / (expected + DECAY), -1, 1)
        return out

    def log10(self, part: Words) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """What gives log probabilities of a part's words after histories, among their class's rarer words; 0 for the frequent ones."""
        keys = part.word * HISTORIES + part.hist
        # One more for pairs that are not in training.
        weights = np.append(self.weights(part) / np.log(10), 0.0)
        plus, sums = np.log10(part.plus), np.log10(self.sums[-1])

        def of(word: np.ndarray, hist: np.ndarray) -> np.ndarray:
            asked = word * HISTORIES + hist
            at = np.searchsorted(keys, asked)
            met = at < len(keys)
            met[met] = keys[at[met]] == asked[met]
            out = plus[word] + weights[np.where(met, at, len(keys))] - sums[part.kinds[word], hist]
            return np.where(part.rare[word], out, 0.0)

        return of

    def _summed(self, answers: DataFrame, value: Callable[[Words], np.ndarray]) -> np.ndarray:
        """Sums of a value of each pair over all rarer words, by class and history: one row of fixed size a bucket, summed in two steps."""
        spread = int(buckets(answers.sparkSession, 1) ** 0.5) + 1
        cells = CLASSES * HISTORIES

        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for some in rows:
                for row in some.to_pylist():
                    part = Words(row, self.words)
                    kept = part.rare[part.word]
                    each = np.rint(value(part)[kept] * _PARTS)
                    sums = np.bincount((part.kinds[part.word] * HISTORIES + part.hist)[kept], weights=each, minlength=cells)
                    yield from _table([(row["bucket"] % spread, cell(sums.astype(np.int64)))], "share int, sums binary").to_batches()

        def add(rows: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x, np.int64) for x in rows.column("sums").to_pylist())
            return _table([(rows.column("share")[0].as_py(), cell(total))], "share int, sums binary")

        table = answers.filter("marks IS NOT NULL").select("bucket", "fan", "hist", "marks", "seen")
        shares = table.mapInArrow(run, "share int, sums binary").groupBy("share").applyInArrow(add, "share int, sums binary")
        out = np.zeros(cells, np.int64)
        for row in shares.collect():
            out += np.frombuffer(row.sums, np.int64)
        return out.reshape(CLASSES, HISTORIES)


class Words:
    """One bucket's words with their counts by history."""

    def __init__(self, row: dict, words: Vocabulary) -> None:
        self.marks = np.frombuffer(row["marks"], _U)
        self.word = np.repeat(np.arange(len(self.marks)), np.frombuffer(row["fan"], np.uint8))
        self.hist = np.frombuffer(row["hist"], np.uint8).astype(np.int64)
        self.seen = _unplaned(row["seen"], np.int64)
        self.counts = np.bincount(self.word, weights=self.seen, minlength=len(self.marks)).astype(np.int64)
        self.plus = self.counts + 1.0
        number = words.number(self.marks)
        self.kinds, self.rare = number // MEMBERS, number % MEMBERS == MEMBERS - 1


_REPLY = "batch bigint, bucket int, counts binary, inside binary"


def _replies(answers: DataFrame, words: Vocabulary, rarer: Rarer) -> DataFrame:
    """Training counts of each batch's words and log probabilities of its pairs, by bucket."""

    def reply(rows: pa.Table) -> pa.Table:
        listed = rows.to_pylist()
        part = Words(next(row for row in listed if row["marks"] is not None), words)
        inside_of, out = rarer.log10(part), []
        for row in listed:
            if row["marks"] is None:
                at = _unplaned(row["at"], np.uint32).astype(np.int64)
                word = np.repeat(at, np.frombuffer(row["fan"], np.uint8))
                inside = inside_of(word, np.frombuffer(row["hist"], np.uint8).astype(np.int64))
                out.append((row["batch"], row["bucket"], _planes(part.counts[at]), cell(inside.astype(np.float32))))
        return _table(out, _REPLY)

    dealt = answers.filter("kind IS NULL").select("batch", "bucket", "at", "fan", "hist", "marks", "seen")
    return dealt.groupBy("bucket").applyInArrow(reply, _REPLY)


def _measured(batches: DataFrame, answers: DataFrame, words: Vocabulary, rarer: Rarer, parts: int) -> DataFrame:
    """Batches with model numbers for words, and per document the known words, the base score and the rarer words' share."""
    replies = _replies(answers, words, rarer).groupBy("batch").agg(F.collect_list(F.struct("bucket", "counts", "inside")).alias("replies"))
    whole = np.log10(words.tokens + words.types + 1.0)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in rows:
            for row in some.to_pylist():
                marks, sizes = np.frombuffer(row["marks"], _U), np.frombuffer(row["sizes"], np.int32)
                tokens = _unplaned(row["tokens"], np.uint32)
                order, _, _ = _dealt(marks, parts)
                counts = np.empty(len(marks), np.int64)
                parts_ = sorted(row["replies"], key=lambda r: r["bucket"])
                counts[order] = np.concatenate([_unplaned(r["counts"], np.int64) for r in parts_])
                inside = np.concatenate([np.frombuffer(r["inside"], np.float32) for r in parts_]).astype(np.float64)
                starts = np.cumsum(sizes) - sizes
                add = lambda x: np.add.reduceat(x, starts)
                columns = [
                    pa.array([row["ids"]], pa.list_(pa.int64())),
                    pa.array([row["held"]], pa.list_(pa.bool_())),
                    pa.array([row["sizes"]], pa.binary()),
                    pa.array([cell(add((counts > 0).astype(np.int64)[tokens]))], pa.binary()),
                    pa.array([cell(add((np.log10(counts + 1.0) - whole)[tokens]))], pa.binary()),
                    pa.array([cell(add(inside[Pairs(tokens, sizes, marks, order).of_token]))], pa.binary()),
                    pa.array([_planes(words.number(marks).astype(np.uint16)[tokens])], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["ids", "held", "sizes", "known", "base", "rare", "numbers"])

    joined = batches.select("batch", "ids", "held", "sizes", "tokens", "marks").join(replies, "batch")
    schema = "ids array<bigint>, held array<boolean>, sizes binary, known binary, base binary, rare binary, numbers binary"
    return staged(joined.mapInArrow(run, schema), "model-tokens")


# --- the model ---------------------------------------------------------------


def _sums(x: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Sums of rows from each head to the next: of few rows for all heads at once, of many each by itself."""
    sizes = np.diff(np.append(heads, len(x)))
    few, many = np.flatnonzero(sizes <= _FEW_ROWS), np.flatnonzero(sizes > _FEW_ROWS)
    out = x.take(heads, 0)
    more = few[sizes[few] > 1]
    rest, place = x.take(heads[more] + 1, 0), np.arange(len(more))
    for k in range(2, _FEW_ROWS):
        place = place[sizes[more[place]] > k]
        rest[place] += x.take(heads[more[place]] + k, 0)
    out[more] += rest
    if len(many):
        own = sizes[many]
        out[many] = np.add.reduceat(x[np.repeat(sizes > _FEW_ROWS, sizes)], np.cumsum(own) - own, axis=0)
    return out


class Weights:
    """Weights of class and member softmaxes, beside the logarithms of plain frequencies."""

    def __init__(self, counts: np.ndarray) -> None:
        member = (counts + 0.1) / (counts + 0.1).sum(1, keepdims=True)
        kind = (counts.sum(1) + 0.1) / (counts.sum(1) + 0.1).sum()
        self.kind, self.member = np.log(kind).astype(np.float32), np.log(member).astype(np.float32)
        self.by_kind = np.zeros((1 << ROWS_BITS, CLASSES), np.float32)
        # One row for each word before and class.
        self.by_member = np.zeros(((_START + 1) * CLASSES, MEMBERS), np.float32)

    @staticmethod
    def features(numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the class softmax: word before, words two and three back, pair before; and the word before."""
        place = np.arange(len(numbers)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        back = []
        for k in (1, 2, 3):
            shifted = np.full(len(numbers), _START, np.uint32)
            shifted[k:] = numbers[:-k] if k < len(numbers) else shifted[k:]
            back.append(np.where(place >= k, shifted, np.uint32(_START)))
        one, two, three = back
        codes = np.stack((one, two + np.uint32(1 << 12), three + np.uint32(2 << 12), (one << np.uint32(14)) + two + np.uint32(3 << 26)), axis=1)
        codes = (codes * np.uint32(0x9E3779B1)) ^ (codes >> np.uint32(13)) * np.uint32(0x85EBCA77)
        return (codes >> np.uint32(32 - ROWS_BITS)).astype(np.int64), one.astype(np.int64)

    def _powers(self, rows: np.ndarray, before: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both softmaxes before their division by the sums of each row, and the rows of the second."""
        # Rows are added one feature after another: what is summed stays in the processor's cache.
        a = self.by_kind.take(rows[:, 0], 0)
        for k in range(1, rows.shape[1]):
            a += self.by_kind.take(rows[:, k], 0)
        a += self.kind
        at = before * CLASSES + kinds
        b = self.by_member.take(at, 0)
        b += self.member.take(kinds, 0)
        for x in (a, b):
            x -= x.max(1, keepdims=True)
            np.exp(x, out=x)
        return a, b, at

    def _softmax(self, rows: np.ndarray, before: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b, at = self._powers(rows, before, kinds)
        for x in (a, b):
            x /= x.sum(1, keepdims=True)
        return a, b, at

    def log10(self, numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log probabilities of all tokens' classes and members."""
        rows, before = self.features(numbers, sizes)
        kinds, members = numbers // MEMBERS, numbers % MEMBERS
        out = np.empty(len(numbers))
        for a in range(0, len(numbers), GROUP_TOKENS):
            some = slice(a, a + GROUP_TOKENS)
            k, m = kinds[some].astype(np.int64), members[some]
            x, y, _ = self._powers(rows[some], before[some], k)
            each = np.arange(len(k))
            kind, member = x[each, k] / x.sum(1), y[each, m] / y.sum(1)
            out[some] = np.log10(kind.astype(np.float64)) + np.log10(member.astype(np.float64))
        return out

    def learn(self, numbers: np.ndarray, sizes: np.ndarray, state: tuple[np.ndarray, ...]) -> None:
        """Gradient updates over groups of tokens, steps shrinking with each row's own updates."""
        rows, before = self.features(numbers, sizes)
        kinds, members = numbers // MEMBERS, numbers % MEMBERS
        for a in range(0, len(numbers), GROUP_TOKENS):
            some = slice(a, a + GROUP_TOKENS)
            k, m = kinds[some].astype(np.int64), members[some]
            x, y, at = self._softmax(rows[some], before[some], k)
            each = np.arange(len(k))
            x[each, k] -= 1
            y[each, m] -= 1
            wide = rows[some].shape[1]
            self._update(self.by_kind, state[0], state[1], rows[some].ravel(), np.repeat(each, wide), x)
            self._update(self.by_member, state[2], state[3], at, each, y)

    @staticmethod
    def _update(weights: np.ndarray, squares: np.ndarray, visits: np.ndarray, at: np.ndarray, of: np.ndarray, slope: np.ndarray) -> None:
        # Numbers of 16 bits are sorted by their digits.
        order = np.argsort(at.astype(np.uint16) if len(weights) <= 1 << 16 else at, kind="stable")
        at = at[order]
        heads = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        sums = _sums(slope.take(of[order], 0), heads)
        rows = at[heads]
        squares[rows] += (sums * sums).mean(1)
        weights[rows] -= (RATE / np.sqrt(squares[rows] + 1.0))[:, None] * sums
        visits[rows] += np.diff(np.concatenate((heads, [len(at)])))



def _round(tokens: DataFrame, weights: Weights, turn: int) -> None:
    """One round: train in all tasks from common weights, mix what they moved."""
    spark = tokens.sparkSession
    shared = spark.sparkContext.broadcast((weights.kind, weights.member, weights.by_kind, weights.by_member))

    def train(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Weights.__new__(Weights)
        own.kind, own.member, by_kind, by_member = shared.value
        own.by_kind, own.by_member = by_kind.copy(), by_member.copy()
        state = tuple(np.zeros(len(x), np.float32) for x in (by_kind, by_kind, by_member, by_member))
        mark = 0
        for some in rows:
            for held, sizes, numbers in zip(*(c.to_pylist() for c in some.columns), strict=True):
                sizes = np.frombuffer(sizes, np.int32)
                take = ~np.array(held) & (np.arange(len(held)) % ROUNDS == turn)
                if take.any():
                    inside = np.repeat(take, sizes)
                    numbers = _unplaned(numbers, np.uint16).astype(np.uint32)[inside]
                    own.learn(numbers, sizes[take], state)
                    mark = zlib.crc32(numbers[:1000].tobytes(), mark)
        out = []
        for which, moved, visits in ((0, own.by_kind, state[1]), (1, own.by_member, state[3])):
            seen = np.flatnonzero(visits)
            for piece in range(_SLICES):
                at = seen[seen % _SLICES == piece]
                if len(at):
                    out.append((piece, mark, which, cell(at.astype(np.int32)), cell(visits[at]), cell(moved[at].astype(np.float16))))
        if out:
            kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 3]
            names = ["slice", "task", "which", "rows", "visits", "weights"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    def mixed(keep: list[str]):  # noqa: ANN202
        def run(rows: pa.Table) -> pa.Table:
            which = rows.column("which")[0].as_py()
            wide = (CLASSES, MEMBERS)[which]
            size = (len(weights_size[0]), len(weights_size[1]))[which]
            total, visits = np.zeros((size, wide), np.float32), np.zeros(size, np.float32)
            for at, seen, moved in zip(*(rows.column(c).to_pylist() for c in ("rows", "visits", "weights")), strict=True):
                at, seen = np.frombuffer(at, np.int32), np.frombuffer(seen, np.float32)
                total[at] += np.frombuffer(moved, np.float16).reshape(len(at), wide).astype(np.float32) * seen[:, None]
                visits[at] += seen
            at = np.flatnonzero(visits)
            total = total[at] / visits[at][:, None]
            one = {"slice": rows.column("slice")[:1], "which": rows.column("which")[:1]}
            one |= {"rows": pa.array([cell(at.astype(np.int32))]), "visits": pa.array([cell(visits[at])])}
            one |= {"weights": pa.array([cell(total.astype(np.float16))])}
            return pa.table({k: one[k] for k in keep})

        return run

    weights_size = (range(len(weights.by_kind)), range(len(weights.by_member)))
    moved = tokens.select("held", "sizes", "numbers").mapInArrow(train, "slice int, task bigint, which int, rows binary, visits binary, weights binary")
    keep = ["slice", "which", "rows", "visits", "weights"]
    schema = "slice int, which int, rows binary, visits binary, weights binary"
    # Two steps, so that no task reads what all trainers sent for a slice.
    spread = int(buckets(spark) ** 0.5) + 1
    first = moved.groupBy("slice", "which", F.pmod("task", F.lit(spread)).alias("part")).applyInArrow(mixed(keep), schema)
    for row in first.groupBy("slice", "which").applyInArrow(mixed(keep), schema).toLocalIterator():
        table = (weights.by_kind, weights.by_member)[row.which]
        at = np.frombuffer(row.rows, np.int32)
        table[at] = np.frombuffer(row.weights, np.float16).reshape(len(at), -1)
    shared.unpersist()


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs`` (doc_id: long, text).

    Scores are log10 probabilities of whole texts, ends included.  A NULL or empty text is its end alone.  A
    row without a doc_id is split by an empty id.  Repeated rows count and are scored each; an
    empty table gives no rows; without training rows every word is unseen and the base score 0.
    Other columns are not looked at.
    """
    parts = buckets(docs.sparkSession, 1)
    batches = _batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    answers = _counted(batches, parts)
    words = Vocabulary(answers)
    tokens = _measured(batches, answers, words, Rarer(answers, words), parts)
    weights = Weights(words.counts)
    for turn in range(ROUNDS):
        _round(tokens, weights, turn)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    total = words.tokens

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for some in rows:
            for row in some.to_pylist():
                sizes = np.frombuffer(row["sizes"], np.int32)
                numbers = _unplaned(row["numbers"], np.uint16).astype(np.uint32)
                each = model.log10(numbers, sizes)
                starts = np.cumsum(sizes) - sizes
                columns = [
                    pa.array(row["ids"], pa.int64()),
                    pa.array(row["held"], pa.bool_()),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(np.frombuffer(row["known"], np.int64)),
                    pa.array(np.full(len(sizes), total, np.int64)),
                    pa.array(np.frombuffer(row["base"], np.float64)),
                    pa.array(np.add.reduceat(each, starts) + np.frombuffer(row["rare"], np.float64)),
                ]
                names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return tokens.mapInArrow(score, schema)
