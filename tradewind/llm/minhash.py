"""Near duplicates among texts' word shingles, by fast similarity sketches, bands and exact sets.

A sketch has ``COORDINATES`` bins.  In round ``i`` every shingle of a set is thrown into one bin by a hash of
that round and brings the number ``i + u``, ``u`` another part of the hash; a bin keeps its
smallest number.  Rounds go on until no bin of the set is empty: random bins in the
first ``COORDINATES`` rounds, and in as many further rounds the one bin of that round for all shingles, so
that every coordinate is filled whatever the set's size.  The share of coordinates on which two
sets agree has the mean of their Jaccard similarity and at least the concentration of independent
draws, while a large set costs little more than one hash a shingle.

Texts of one shingle set are one class.  ``ROWS`` neighbouring coordinates are a band's key, and classes
with a key in common are candidates: of two sets on the threshold of 0.8, (1 - 0.8 ** ROWS) ** BANDS of such pairs,
under one in a billion, share none.  In each of ``ROUNDS`` rounds a key's smallest class is its center, which all its other
classes meet that it is not connected with yet; a center that met all leaves the key, and a key
whose classes are all connected is done.  Candidates that agree on too few coordinates go; the rest are
confirmed on the exact sets.  So a round costs one comparison a class and key at most, and a thousand near copies are connected by
about as many comparisons, while hot keys are joined as rows that Spark can split.

Keys that have unconnected classes left after the rounds are joined to families.  A family's classes are dealt to cells of bounded size,
each holding two slices of it, so that any two share a cell.  A cell compares sketches across components, confirms
exact sets, and returns the links that connect something new.  No pair with a common key goes unmet unless a path of links connects it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import cell, slices, texts
from tradewind.llm.graph import components
from tradewind.llm.shingles import confirmed, mix, set_marks, shingle_sets
from tradewind.sources.shared import staged

WIDTH = 2
PERCENT = 80
ROWS, BANDS = 4, 40
COORDINATES = ROWS * BANDS
#: Candidates agree on so many coordinates; a link of 80 % does so but for one in a hundred billion.
AGREE = 88
#: Rounds of meeting centers (each costs a search for components), and bytes of sketches and sets in a slice of what they leave.
ROUNDS = 1
SLICE_BYTES = 2 << 20

_U = np.uint64
_EMPTY = _U(2**64 - 1)
_STEP = 0x9E3779B97F4A7C15


def sketches(codes: np.ndarray, sizes: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """A row of 16-bit coordinates for each set; those of an empty set mean nothing."""
    bins = np.full(len(sizes) * coordinates, _EMPTY)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    open_sets = np.flatnonzero(sizes > 0)
    left = np.arange(len(codes))
    for turn in range(2 * coordinates):
        if not len(left):
            break
        hashed = mix(codes[left] + _U((turn + 1) * _STEP % 2**64))
        if turn < coordinates:
            at = (((hashed >> _U(40)) * _U(coordinates)) >> _U(24)).astype(np.int64)
        else:
            at = turn - coordinates
        np.minimum.at(bins, owner[left] * coordinates + at, (_U(turn) << _U(40)) | (hashed & _U(2**40 - 1)))
        lacks = (bins.reshape(-1, coordinates)[open_sets] == _EMPTY).any(1)
        if not lacks.all():
            open_sets = open_sets[lacks]
            still = np.zeros(len(sizes), bool)
            still[open_sets] = True
            left = left[still[owner[left]]]
    return (mix(bins) >> _U(48)).astype(np.uint16).reshape(-1, coordinates)


def band_keys(rows: np.ndarray) -> np.ndarray:
    """A 63-bit key of each band of each sketch."""
    parts = rows.reshape(len(rows), BANDS, ROWS).astype(_U)
    keys = np.broadcast_to(np.arange(BANDS, dtype=_U) + _U(1), parts.shape[:2])
    for place in range(ROWS):
        keys = mix(keys * _U(_STEP) + parts[:, :, place])
    return (keys >> _U(1)).astype(np.int64)


def _refs(marks: list[bytes]) -> np.ndarray:
    """63 bits of the marks of sets, 0 for an empty set."""
    return np.array([int.from_bytes(m[:8], "little") >> 1 for m in marks], np.int64)


def _measured(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, ref of the set and its sketch for every row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            codes, sizes = shingle_sets(texts(batch.column("text")), width)
            rows = [cell(x) for x in sketches(codes, sizes)]
            refs = _refs(set_marks(codes, sizes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(refs), pa.array(rows, pa.binary())],
                ["doc_id", "n_shingles", "ref", "sketch"],
            )

    return docs.mapInArrow(measure, "doc_id bigint, n_shingles bigint, ref bigint, sketch binary")


def _keys(classes: DataFrame) -> DataFrame:
    """key and ref: every class once for each band."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "sketch"):
            rows = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(-1, COORDINATES)
            refs = np.repeat(batch.column("ref").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(band_keys(rows).ravel()), pa.array(refs)], ["key", "ref"])

    return classes.select("ref", "sketch").mapInArrow(spread, "key bigint, ref bigint")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """ref and members, the exact set, of each class in ``wanted`` (doc_id, ref)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in slices(batches, "text"):
            cells = [squeeze(t or b"") for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(cells, pa.binary())], ["doc_id", "packed"])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inflate = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "packed", 2 << 20):
            codes, sizes = shingle_sets([inflate(x) for x in batch.column("packed").to_pylist()], width)
            ends = np.cumsum(sizes)
            # Of one doc_id with several texts only the class's own counts.
            own = _refs(set_marks(codes, sizes)) == batch.column("ref").to_numpy()
            members = [cell(codes[e - s : e]) for e, s in zip(ends, sizes, strict=True)]
            found = pa.RecordBatch.from_arrays([batch.column("ref"), pa.array(members, pa.binary())], ["ref", "members"])
            yield found.filter(pa.array(own))

    packed = docs.mapInArrow(pack, "doc_id bigint, packed binary")
    # Neither side is bounded: both are moved, whatever their size today.
    found = packed.join(wanted.hint("shuffle_merge"), "doc_id").select("ref", "packed")
    return found.mapInArrow(spell, "ref bigint, members binary").dropDuplicates(["ref"])


def _agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those pairs (u, v) whose sketches agree on enough coordinates."""

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, COORDINATES) for c in ("one", "two"))
            near = (one == two).sum(1) >= AGREE
            yield batch.select(["u", "v"]).filter(pa.array(near))

    one = classes.select(F.col("ref").alias("u"), F.col("sketch").alias("one"))
    two = classes.select(F.col("ref").alias("v"), F.col("sketch").alias("two"))
    return pairs.join(two, "v").join(one, "u").mapInArrow(agree, "u bigint, v bigint")


def _met(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each key's smallest class, and the pairs (u, v) of classes with it that nothing connects yet."""
    # Summed up on the map side: a hot key sends one row a task.
    center = keys.groupBy("key").agg(F.min(F.struct("ref", "component")).alias("_center"))
    center = center.select("key", F.col("_center.ref").alias("u"), F.col("_center.component").alias("own"))
    pairs = keys.join(center, "key").filter((F.col("ref") > F.col("u")) & (F.col("component") != F.col("own")))
    return center, pairs.select("u", F.col("ref").alias("v")).distinct()


def _rest(keys: DataFrame, center: DataFrame, labels: DataFrame) -> DataFrame:
    """The keys' classes without their centers, where some are still unconnected."""
    rest = keys.join(center.select("key", "u"), "key").filter("ref > u").select("key", "ref").join(labels, "ref", "left")
    rest = rest.select("key", "ref", F.coalesce("component", "ref").alias("component"))
    ends = rest.groupBy("key").agg(F.min("component").alias("_least"), F.max("component").alias("_most"))
    return rest.join(ends.filter("_least < _most").select("key"), "key")


def _connect(rows: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links between components among the classes of one cell, until all that is linked is connected.

    In a cell of two slices only pairs across them are taken.
    """
    ref, own, component = (rows.column(c).to_numpy() for c in ("ref", "own", "component"))
    i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint16).reshape(-1, COORDINATES)
    sets = [np.frombuffer(x, _U) for x in rows.column("members").to_pylist()]
    sizes = np.array([len(x) for x in sets])
    right = np.flatnonzero(own == j)
    found = []
    for a in np.flatnonzero(own == i):
        others = right[right > a] if i == j else right
        n, m = sizes[a], sizes[others]
        others = others[(100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (component[others] != component[a])]
        agree = (sketch[others] == sketch[a]).sum(1)
        near = agree >= AGREE
        found.append((np.full(int(near.sum()), a), others[near], agree[near]))
    if not found:
        return []
    one, two, agree = (np.concatenate(x) for x in zip(*found, strict=True))
    up, links = {c: c for c in component.tolist()}, []

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for place in np.argsort(-agree, kind="stable"):
        a, b = one[place], two[place]
        x, y = root(int(component[a])), root(int(component[b]))
        if x == y:
            continue
        both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        if 100 * both >= percent * (sizes[a] + sizes[b] - both):
            up[x] = y
            links.append((int(ref[a]), int(ref[b])))
    return links


def _family_links(keys: DataFrame, wanted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that connect every component of links among the classes of ``keys``, given those connected already."""
    least = keys.groupBy("key").agg(F.min("ref").alias("u"))
    families = components(keys.join(least, "key").select("u", F.col("ref").alias("v")))
    families = families.select(F.col("node").alias("ref"), F.col("component").alias("family"))
    of = keys.select("ref", "component").distinct()
    members = families.join(of, "ref").join(wanted.select("ref", "sketch"), "ref").join(sets, "ref")
    members = staged(members, "minhash-families")
    size = members.groupBy("family").agg(F.sum(F.length("members") + F.length("sketch")).alias("_bytes"))
    size = size.select("family", F.ceil(F.col("_bytes") / SLICE_BYTES).cast("int").alias("slices"))
    dealt = members.join(size, "family").withColumn("own", F.pmod(F.xxhash64("ref"), F.col("slices")).cast("int"))
    # Every slice meets every slice, itself included: a row goes to one cell for each.
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    dealt = dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("slices", "other")

    def connect(rows: pa.Table) -> pa.Table:
        links = _connect(rows, percent)
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})

    return dealt.groupBy("family", "i", "j").applyInArrow(connect, "u bigint, v bigint")


def linked_classes(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """ref and component of all classes (ref, first, sketch) that link with another."""
    keys = staged(_keys(classes), "minhash-keys")
    shared = keys.groupBy("key").agg(F.count("*").alias("_n")).filter("_n > 1").select("key")
    # A class that shares no key is a component of its own.
    keys = staged(keys.join(shared, "key").withColumn("component", F.col("ref")), "minhash-shared")
    wanted = keys.select("ref").distinct().join(classes, "ref")
    wanted = staged(wanted.select("ref", "first", "sketch"), "minhash-wanted")
    sets = staged(_sets(docs, wanted.select(F.col("first").alias("doc_id"), "ref"), width), "minhash-sets")
    links = docs.sparkSession.createDataFrame([], "u bigint, v bigint")
    for _ in range(ROUNDS):
        if keys.isEmpty():
            break
        center, pairs = _met(keys)
        near = staged(_agreeing(pairs, wanted), "minhash-near")
        links = links.union(staged(confirmed(near, sets, percent), "minhash-links"))
        labels = components(links).select(F.col("node").alias("ref"), "component")
        keys = staged(_rest(keys, center, labels), "minhash-rest")
    if not keys.isEmpty():
        links = links.union(staged(_family_links(keys, wanted, sets, percent), "minhash-links"))
        labels = components(links).select(F.col("node").alias("ref"), "component")
    elif links.isEmpty():
        labels = links.select(F.col("u").alias("ref"), F.col("v").alias("component"))
    return labels


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id: long, text).

    ``component_id`` is the smallest doc_id that links reach, the row's own included, and a row is kept if
    it is its own.  A NULL or empty text has no shingles and links with nothing; so does a row
    without a doc_id, whose component is NULL and which is kept.  Repeated rows are returned each, kept or not alike; of
    one doc_id with several texts each text links on its own.  An empty table gives no rows.  Other columns
    are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = staged(_measured(docs, width), "minhash-rows")
    linkable = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = linkable.groupBy("ref").agg(F.min("doc_id").alias("first"), F.first("sketch").alias("sketch"))
    classes = staged(classes, "minhash-classes")
    present = docs.filter("text IS NOT NULL AND doc_id IS NOT NULL")
    reach = classes.select("ref", "first").join(linked_classes(present, classes, width, percent), "ref", "left")
    reach = reach.select("ref", "first", F.coalesce("component", "ref").alias("component"))
    least = reach.groupBy("component").agg(F.min("first").alias("_component"))
    reach = reach.join(least, "component").select("ref", "_component")
    marked = rows.drop("sketch").join(reach, "ref", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("doc_id")))
    marked = marked.select("doc_id", "n_shingles", component.alias("component_id"))
    return marked.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` (doc_id: long, text, ...), all their columns as they are, that ``near_duplicates`` keeps.

    Rows equal in doc_id and text are one document, of which one stays.  Rows without a doc_id all stay.  Of one
    doc_id with several texts all stay if one is kept.
    """
    kept = near_duplicates(docs, width, percent).filter("kept").select("doc_id").distinct()
    # The row travels as one struct, so its columns' names meet no others.
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row")).withColumn("_id", F.col("_row.doc_id"))
    known = rows.filter("_id IS NOT NULL").join(kept.withColumnRenamed("doc_id", "_id"), "_id", "left_semi")
    known = known.withColumn("_copy", F.expr("row_number() OVER (PARTITION BY _id, _row.text ORDER BY 0)"))
    return known.filter("_copy = 1").select("_row.*").union(rows.filter("_id IS NULL").select("_row.*"))
