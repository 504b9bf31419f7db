"""Joining texts whose five-word shingles overlap by 80 % or more, through parity sketches.

Texts of one shingle set are one class; classes are compared.  Classes fall
into bands of sizes such that any two that can link are of the same or the
next band.  For a band whose links differ in at most ``d`` shingles, each class
throws its shingles into ``d + 1 + s`` blocks of a sketch and XORs them there:
the parity of a block.  A shingle held by one side only changes one
block, so the number of blocks that differ is a lower bound on the symmetric
difference, and linked classes agree on ``s + 1`` blocks at least.  Ordering all
blocks' values in one way, it is therefore enough that each class sends its
first ``d + 1``: two linked classes share one of those (pigeonhole).  The order
puts values first that hold most shingles unknown to a bounded sample's list
of frequent ones, so common passages drop out of the keys unless a text
consists of little else.

Classes that meet on a value are tied to the smallest of them; what such ties
connect is a family.  All links lie within families.  The sets of a family that fits a
task meet in one cell.  A cell takes pairs by the Hamming distance of their sketches, which
never exceeds the symmetric difference, compares the exact sets, and skips pairs that
links have connected already.  So thousands of near copies cost a
comparison per member, not per pair, and no connection is lost.

Ties also chain classes that have little in common, and the more texts there are the longer such chains
grow.  A family too large for a task is therefore taken apart first: each value's
smallest class meets the others by sketch, and what is near enough is confirmed on the exact
sets.  Values whose other classes are connected then are done, so near copies leave few and
the many values of two classes none.  Classes left on a value form smaller families; of one that still
outgrows a task each value has cells of its own, each holding two slices of its classes, so that any two meet.
So a set moves as often as values are left that it may link on, not once a slice of its whole chain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.common import buckets, cell, small_batches, texts
from tradewind.llm.graph import components
from tradewind.llm.shingles import confirmed, mix, set_marks, shingle_sets
from tradewind.sources.shared import staged

PERCENT = 80
#: Texts, in expectation, whose shingles tell which are frequent, and in how many of them.
SAMPLE_TEXTS = 2000
FREQUENT = 8
#: Keys a task holds before it passes them on, and bytes of sets in a family or slice that one cell takes.
HELD_KEYS = 1 << 20
SLICE_BYTES = 4 << 20
SKETCH_BITS = 2048

_U = np.uint64
_REF = _U((1 << 48) - 1)
_KEY_BITS, _KEY_STEP = _U(40), _U(0x9E3779B97F4A7C15)


class Bands:
    """Bands of set sizes, and for each the largest difference of a link and the blocks."""

    def __init__(self, percent: int, largest: int) -> None:
        lows = [1, 2]
        while lows[-1] <= largest:
            lows.append(max(lows[-1] + 1, (lows[-1] - 1) * 100 // percent + 1))
        self.lows = np.array(lows, np.int64)
        most = self.lows[1:] - 1
        # |A| + |B| is largest for B / A = 100 / percent; (100 - p) / (100 + p) of it may differ.
        self.differ = (most * (100 + percent) // percent) * (100 - percent) // (100 + percent)
        self.spare = (self.differ + 1) // 4
        self.percent = percent

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows, sizes, side="right") - 1

    def reaches_below(self, sizes: np.ndarray, band: np.ndarray) -> np.ndarray:
        """Whether a set can link with one of the band below."""
        return (band > 0) & (100 * (self.lows[band] - 1) >= self.percent * sizes)


def _first_keys(band: int, codes: np.ndarray, rare: np.ndarray, differ: int, spare: int) -> np.ndarray:
    """The first ``differ + 1`` block values of one set in the order common to all sets."""
    blocks = differ + 1 + spare
    at = ((codes >> _U(32)) * _U(blocks)) >> _U(32)
    order = np.argsort(at, kind="stable")
    at = at[order]
    starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    parity = np.bitwise_xor.reduceat(mix(codes[order] * _KEY_STEP), starts)
    unknown = np.add.reduceat(rare[order].astype(np.int64), starts)
    at = at[starts]
    if len(at) <= differ:
        empty = np.setdiff1d(np.arange(blocks, dtype=_U), at)
        at = np.concatenate((at, empty))
        parity = np.concatenate((parity, np.zeros(len(empty), _U)))
        # Behind every filled block, for a set with more of those never gets to its empty ones.
        unknown = np.concatenate((unknown, np.full(len(empty), -1)))
    keys = mix(parity ^ mix(at + np.array([band], _U) * _KEY_STEP))
    # One order for all sets: it looks at nothing but the block's own value and whether it is empty.
    return keys[np.lexsort((keys, -unknown))[: differ + 1]]


def _classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and the mark of its set for every row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, sizes = shingle_sets(texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(set_marks(codes, sizes), pa.binary())],
                ["doc_id", "n_shingles", "mark"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(measure, f"doc_id {kind}, n_shingles bigint, mark binary")


def _frequent(docs: DataFrame, rows: int) -> np.ndarray:
    """Shingles of many texts of a sample: at most SAMPLE_TEXTS texts' shingles / FREQUENT."""
    share = min(1.0, SAMPLE_TEXTS / max(1, rows))
    bound = int(share * 2**62)
    sample = docs.filter((F.xxhash64("doc_id").bitwiseAND(F.lit(2**62 - 1))) < bound)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, _ = shingle_sets(texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64))], ["code"])

    counts = sample.select("text").mapInArrow(explode, "code bigint").groupBy("code").count()
    found = counts.filter(F.col("count") >= FREQUENT).select("code").toArrow()
    return np.sort(found.column("code").to_numpy().astype(np.int64).view(_U))


def _keys(docs: DataFrame, bands: Bands, frequent: np.ndarray, parts: int) -> DataFrame:
    """Block values by hash bucket: arrays of 40-bit values and of 48-bit class references."""

    def known(codes: np.ndarray) -> np.ndarray:
        if not len(frequent):
            return np.zeros(len(codes), bool)
        place = np.searchsorted(frequent, codes)
        place[place == len(frequent)] = 0
        return frequent[place] == codes

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, refs, total, seen = [], [], 0, set()

        def out() -> pa.RecordBatch:
            keys, owners = np.concatenate(held), np.concatenate(refs)
            bucket = ((keys >> _KEY_BITS) % _U(parts)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            keys, owners, bucket = keys[order], owners[order], bucket[order]
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
            low, high = keys.astype(np.uint32), (keys >> _U(32)).astype(np.uint8)
            ref_low, ref_high = owners.astype(np.uint32), (owners >> _U(32)).astype(np.uint16)
            columns = [[cell(x[a:b]) for a, b in zip(cuts, cuts[1:])] for x in (low, high, ref_low, ref_high)]
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts[:-1]], pa.int32()), *(pa.array(c, pa.binary()) for c in columns)],
                ["bucket", "low", "high", "ref_low", "ref_high"],
            )

        for batch in batches:
            codes, sizes = shingle_sets(texts(batch.column("text")))
            marks, rare = set_marks(codes, sizes), ~known(codes)
            ends = np.cumsum(sizes)
            own = bands.of(np.maximum(sizes, 1))
            below = bands.reaches_below(sizes, own)
            for i, (mark, end) in enumerate(zip(marks, ends, strict=True)):
                if not mark or mark in seen:
                    continue
                seen.add(mark)
                inside = slice(end - sizes[i], end)
                ref = np.frombuffer(mark, _U)[0] & _REF
                for band in (own[i], own[i] - 1)[: 1 + below[i]]:
                    differ = int(bands.differ[band])
                    if not differ:
                        continue  # only equal sets link
                    keys = _first_keys(int(band), codes[inside], rare[inside], differ, int(bands.spare[band]))
                    held.append(keys)
                    refs.append(np.full(len(keys), ref))
                    total += len(keys)
            if len(seen) > 100_000:
                seen.clear()  # equal sets met later send their keys again, which changes nothing
            if total >= HELD_KEYS:
                yield out()
                held, refs, total = [], [], 0
        if total:
            yield out()

    return docs.select("text").mapInArrow(emit, "bucket int, low binary, high binary, ref_low binary, ref_high binary")


def _ties(keys: DataFrame) -> DataFrame:
    """Each block value that classes share, with references of the smallest that has it and of each other one."""

    def meet(rows: pa.Table) -> pa.Table:
        def joined(name: str, kind: type) -> np.ndarray:
            return np.concatenate([np.frombuffer(x, kind) for x in rows.column(name).to_pylist()]).astype(_U)

        key = joined("low", np.uint32) | joined("high", np.uint8) << _U(32)
        ref = joined("ref_low", np.uint32) | joined("ref_high", np.uint16) << _U(32)
        order = np.lexsort((ref, key))
        key, ref = key[order], ref[order]
        # A class met in several tasks sends its keys from each.
        once = np.concatenate(([True], (key[1:] != key[:-1]) | (ref[1:] != ref[:-1])))
        key, ref = key[once], ref[once]
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        least = np.repeat(ref[starts], np.diff(np.concatenate((starts, [len(key)]))))
        tied = least != ref
        key = key[tied] | _U(rows.column("bucket")[0].as_py()) << _KEY_BITS
        return pa.table([pa.array(x.view(np.int64)) for x in (key, least[tied], ref[tied])], ["key", "ref_a", "ref_b"])

    return keys.groupBy("bucket").applyInArrow(meet, "key bigint, ref_a bigint, ref_b bigint")


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id and the compressed text: what a shuffle carries."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            cells = [squeeze(t or b"") for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(cells, pa.binary())], ["doc_id", "packed"])

    return docs.mapInArrow(pack, "doc_id bigint, packed binary")


def _sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The members' rows with their exact sets.

    A member's text is that of the rows with its smallest doc_id; repeated rows come out repeated.
    """
    kept = [c for c in members.columns if c != "doc_id"]

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inflate = zstandard.ZstdDecompressor().decompress
            codes, sizes = shingle_sets([inflate(x) for x in batch.column("packed").to_pylist()])
            ends = np.cumsum(sizes)
            marks = set_marks(codes, sizes)
            # Of one doc_id with several texts only the member's own counts.
            own = pa.array([a == b for a, b in zip(marks, batch.column("mark").to_pylist(), strict=True)], pa.bool_())
            sets = pa.array([cell(codes[e - s : e]) for e, s in zip(ends, sizes, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), sets], [*kept, "members"]).filter(own)

    # Neither side is bounded: both are always moved, whatever their size today.
    found = _packed(docs).join(members.hint("shuffle_merge"), "doc_id").select(*kept, "packed")
    return found.mapInArrow(spell, T.StructType([members.schema[c] for c in kept]).add("members", T.BinaryType()))


class _Forest:
    def __init__(self, size: int) -> None:
        self.up = list(range(size))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def _sketch(members: np.ndarray) -> np.ndarray:
    bits = np.bincount((members >> _U(20)) % _U(SKETCH_BITS), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(_U)


def _connect(sets: list[np.ndarray], component: np.ndarray, slices: np.ndarray, pair: tuple[int, int], percent: int) -> list[tuple[int, int]]:
    """Links that connect what is connected among the sets of one cell and in different components so far.

    ``slices`` holds the slice of each set; in a cell of two slices only pairs across them are taken.
    """
    sizes = np.array([len(x) for x in sets])
    sketches = np.stack([_sketch(x) for x in sets])
    component = np.unique(component, return_inverse=True)[1]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    left = np.flatnonzero(slices == pair[0])
    right = np.flatnonzero(slices == pair[1])
    for a in left:
        others = right[right > a] if pair[0] == pair[1] else right
        n, m = sizes[a], sizes[others]
        others = others[(100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (component[others] != component[a])]
        apart = np.bitwise_count(sketches[others] ^ sketches[a]).sum(1, dtype=np.int64)
        near = apart * (100 + percent) <= (n + sizes[others]) * (100 - percent)
        found.append((np.full(near.sum(), a), others[near], apart[near]))
    if not found:
        return []
    one, two, apart = (np.concatenate(x) for x in zip(*found, strict=True))
    forest, links = _Forest(len(sets)), []
    for place in np.argsort(apart, kind="stable"):
        a, b = int(one[place]), int(two[place])
        x, y = forest.root(int(component[a])), forest.root(int(component[b]))
        if x == y:
            continue
        both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            forest.up[x] = y
            links.append((a, b))
    return links


def _links(sets: DataFrame, parts: int, percent: int) -> DataFrame:
    """Links (u, v) that connect every component of links within its family, given the components so far."""
    # Every slice meets every slice, itself included: a row goes to one cell for each.
    other = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    dealt = sets.withColumn("other", other).select(
        "family", "first", "component", "members", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    bucket = F.pmod(F.xxhash64("family", "i", "j"), F.lit(parts))

    def connect(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("family", "i", "j", "first")])
        family, i, j, first, component, own = (rows.column(c).to_numpy() for c in ("family", "i", "j", "first", "component", "own"))
        new = (family[1:] != family[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        cuts = np.flatnonzero(np.concatenate(([True], new, [True])))
        u, v = [], []
        for a, b in zip(cuts, cuts[1:]):
            sets = [np.frombuffer(x, _U) for x in rows.column("members").slice(a, b - a).to_pylist()]
            for x, y in _connect(sets, component[a:b], own[a:b], (int(i[a]), int(j[a])), percent):
                u.append(first[a + x])
                v.append(first[a + y])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return dealt.groupBy(bucket.alias("bucket")).applyInArrow(connect, "u bigint, v bigint")


def _sketched(sets: DataFrame) -> DataFrame:
    """first, n, sketch and members of the sets of classes."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = [cell(_sketch(np.frombuffer(x, _U))) for x in batch.column("members").to_pylist()]
            columns = [batch.column("first"), batch.column("n"), pa.array(sketches, pa.binary()), batch.column("members")]
            yield pa.RecordBatch.from_arrays(columns, ["first", "n", "sketch", "members"])

    return sets.mapInArrow(draw, "first bigint, n bigint, sketch binary, members binary")


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (u, v) whose sizes and sketches leave a link possible."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), _U).reshape(-1, SKETCH_BITS // 64) for c in ("one", "two"))
            n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
            apart = np.bitwise_count(one ^ two).sum(1, dtype=np.int64)
            near = (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (apart * (100 + percent) <= (n + m) * (100 - percent))
            yield batch.select(["u", "v"]).filter(pa.array(near))

    one = sets.select(F.col("first").alias("u"), "n", F.col("sketch").alias("one"))
    two = sets.select(F.col("first").alias("v"), F.col("n").alias("m"), F.col("sketch").alias("two"))
    return pairs.join(two, "v").join(one, "u").mapInArrow(close, "u bigint, v bigint")


def _unconnected(rows: DataFrame, links: DataFrame, *columns: str) -> DataFrame:
    """The rows with the component of each column's class, itself without links, as ``<column>_in``."""
    labels = components(links)
    for column in columns:
        own = labels.select(F.col("node").alias(column), F.col("component").alias("_of"))
        rows = rows.join(own, column, "left").withColumn(f"{column}_in", F.coalesce("_of", column)).drop("_of")
    return rows


def _slices(size: Column) -> Column:
    """How many slices sets of so many shingles take together."""
    return F.ceil(size * 8 / SLICE_BYTES).cast("int")


def _links_apart(keys: DataFrame, sets: DataFrame, parts: int, percent: int) -> DataFrame:
    """Links (u, v) that connect every component among classes that share block values (key, u: the smallest, v).

    ``sets`` holds first, n, sketch and members of each.
    """
    near = staged(_near(keys.select("u", "v").distinct(), sets, percent), "shingle-near")
    exact = sets.select(F.col("first").alias("ref"), "members")
    # One pair a class connects most; of the others those go on that it left apart.
    links = staged(confirmed(near.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"), exact, percent), "shingle-links")
    rest = _unconnected(near, links, "u", "v").filter("u_in <> v_in").select("u", "v")
    links = staged(links.union(confirmed(rest, exact, percent)), "shingle-links")

    # A value's smallest class has met all others; they have not met each other.
    left = _unconnected(keys.select("key", "v"), links, "v")
    apart = left.groupBy("key").agg(F.min("v_in").alias("_least"), F.max("v_in").alias("_most")).filter("_least < _most")
    left = staged(left.join(apart.select("key"), "key"), "shingle-left")
    least = left.groupBy("key").agg(F.min("v").alias("u"))
    families = components(left.join(least, "key").select("u", "v")).select(F.col("node").alias("v"), F.col("component").alias("family"))
    sizes = sets.select(F.col("first").alias("v"), "n")
    size = families.join(sizes, "v").groupBy("family").agg(F.sum("n").alias("_n"))
    size = size.select("family", (_slices(F.col("_n")) > 1).alias("_large"))
    groups = left.join(families, "v").join(size, "family")
    groups = groups.select(F.when(F.col("_large"), F.col("key")).otherwise(F.col("family")).alias("family"), "v", "v_in").distinct()
    groups = staged(groups, "shingle-groups")
    slices = groups.join(sizes, "v").groupBy("family").agg(_slices(F.sum("n")).alias("slices"))
    dealt = groups.join(slices, "family").select("family", F.col("v").alias("first"), F.col("v_in").alias("component"), "slices")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("first"), F.col("slices")).cast("int"))
    return links.union(_links(dealt.join(sets.select("first", "members"), "first"), parts, percent))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id: long, text).

    ``component_id`` is the smallest doc_id that links reach, the row's own
    included.  A NULL or empty text has no shingles and links with nothing; so does
    a row without a doc_id, whose component is NULL.  Repeated rows are returned
    each; of one doc_id with several texts each text links on its own.  An empty
    table gives no rows.  Other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = staged(_classes(docs), "shingle-marks")
    stats = rows.agg(F.count("*"), F.max("n_shingles")).first()
    linkable = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = staged(linkable.groupBy("mark").agg(F.min("doc_id").alias("first"), F.max("n_shingles").alias("n")), "shingle-classes")
    # The mark's first six bytes, lowest first.
    digits = F.concat(*(F.hex(F.substring("mark", place, 1)) for place in range(6, 0, -1)))
    ref = F.conv(digits, 16, 10).cast("bigint")
    named = classes.withColumn("ref", ref)

    bands = Bands(percent, stats[1] or 1)
    present = docs.filter("text IS NOT NULL AND doc_id IS NOT NULL")
    parts = buckets(spark)
    keys = _keys(present, bands, _frequent(present, stats[0]), parts)
    ties = staged(_ties(keys), "shingle-ties")
    one = named.select(F.col("ref").alias("ref_a"), F.col("first").alias("u"))
    two = named.select(F.col("ref").alias("ref_b"), F.col("first").alias("v"))
    tied = ties.select("ref_a", "ref_b").distinct().join(one, "ref_a").join(two, "ref_b").select("u", "v")
    families = components(tied).select(F.col("node").alias("first"), F.col("component").alias("family"))
    members = classes.join(families, "first")
    size = members.groupBy("family").agg((_slices(F.sum("n")) > 1).alias("large"))
    members = staged(members.join(size, "family"), "shingle-families")
    member = [F.col("first").alias("doc_id"), "first", "mark"]
    small = members.filter("NOT large").select(*member, "family", F.col("first").alias("component"), F.lit(1).alias("slices"), F.lit(0).alias("own"))
    links = _links(_sets(present, small), parts, percent)
    large = members.filter("large")
    if not large.isEmpty():
        found = large.select(ref.alias("ref"), "first")
        one, two = found.toDF("ref_a", "u"), found.toDF("ref_b", "v")
        shared = staged(ties.join(one, "ref_a").join(two, "ref_b").select("key", "u", "v"), "shingle-shared")
        sets = staged(_sketched(_sets(present, large.select(*member, "n"))), "shingle-sets")
        links = links.union(_links_apart(shared, sets, parts, percent))
    labels = components(links)

    reach = classes.join(labels.withColumnRenamed("node", "first"), "first", "left")
    reach = reach.select("mark", F.coalesce("component", "first").alias("_component"))
    marked = rows.join(reach, "mark", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return marked.select("doc_id", "n_shingles", component.alias("component_id"))


def keep_one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` (doc_id: long, text, ...) with the smallest doc_id of their component, all their columns as they are.

    Rows equal in doc_id and text are one document, of which one stays.  Rows without a doc_id all stay.  NULL and empty
    texts link with nothing; an empty table gives no rows.
    """
    found = near_duplicates(docs, percent)
    first = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_id")).distinct()
    # The row travels as one struct, so its columns' names meet no others.
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"))
    rows = rows.select("_row", F.col("_row.doc_id").cast("bigint").alias("_id"), F.col("_row.text").alias("_text"))
    # One shuffle by doc_id serves the join and the numbering of equal rows.
    same = Window.partitionBy("_id", "_text").orderBy(F.lit(0))
    kept = rows.filter("_id IS NOT NULL").join(first, "_id", "left_semi")
    kept = kept.withColumn("_copy", F.row_number().over(same)).filter("_copy = 1")
    return kept.select("_row").union(rows.filter("_id IS NULL").select("_row")).select("_row.*")
