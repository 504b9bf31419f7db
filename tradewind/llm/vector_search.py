"""Exact top-k by inner product through distances to pivots.

Vectors become integers, floor(1024 * x).  With M the largest norm, x is
extended by sqrt(M^2 - |x|^2) and a query by 0; then the squared distance of
the two is |q|^2 + M^2 - 2 q.x, so the highest scores are the nearest vectors.

The index keys each vector by its nearest pivot and its distance to it, sorts
by that key over all tasks and packs runs of rows of one pivot into blocks:
annuli around the pivot.  A block holds few rows even where many vectors are
alike.  Each query is first answered within its own block, which gives a radius
that holds its k nearest.  By the triangle inequality only annuli whose distance
to the pivot differs from the query's by no more than that radius can hold
better ones; only those meet the query, in blocks, and its results are merged.

Scores and sums stay exact in doubles up to 2**53, and are 64-bit integers above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import cell
from tradewind.sources.shared import staged

SCALE = 1024
TOP = 10
EVERY = 100
#: Pivots are the vectors of the smallest hashed ids: a bounded sample.
PIVOTS = 64
BLOCK_ROWS = 1024
CHUNK_QUERIES = 512
# Slack for rounding in distances, relative to the largest norm.
_SLACK = 1e-6
_EXACT = 2.0**53


def _integers(vectors: DataFrame) -> DataFrame:
    """vec_id and the integer components of rows that take part."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("vec"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, shorter ones filled with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _scores(queries: np.ndarray, rows: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries @ rows.T


def _best(scores: np.ndarray, ids: np.ndarray, own: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Highest scores of one query and their ids, ties to smaller ids, its own id left out."""
    other = ids != own
    scores, ids = scores[other], ids[other]
    if len(scores) > top:
        least = np.partition(scores, len(scores) - top)[len(scores) - top]
        scores, ids = scores[scores >= least], ids[scores >= least]
    order = np.lexsort((ids, -scores))[:top]
    return scores[order], ids[order]


class _Space:
    """The pivots and the bound on norms, small and the same for all tasks."""

    def __init__(self, pivots: np.ndarray, squared: float, width: int) -> None:
        self.pivots, self.squared, self.width = pivots.astype(np.float64), squared, width
        self.exact = squared < _EXACT
        self.lift = np.sqrt(np.maximum(0, squared - (self.pivots**2).sum(1)))
        self.slack = _SLACK * (squared**0.5 + 1)

    def of_rows(self, rows: np.ndarray) -> np.ndarray:
        x = rows.astype(np.float64)
        lift = np.sqrt(np.maximum(0, self.squared - (x**2).sum(1)))
        return np.sqrt(np.maximum(0, 2 * self.squared - 2 * (x @ self.pivots.T + lift[:, None] * self.lift)))

    def of_queries(self, rows: np.ndarray) -> np.ndarray:
        x = rows.astype(np.float64)
        return np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] + self.squared - 2 * x @ self.pivots.T))

    def radius(self, query: np.ndarray, score: int) -> float:
        return float(np.sqrt(max(0.0, (query.astype(np.float64) ** 2).sum() + self.squared - 2.0 * score)))


_BLOCKS = "is_query boolean, pivot int, low double, high double, ids binary, vecs binary, radius double, floor bigint"


def _index(vectors: DataFrame, space: _Space, every: int, top: int) -> DataFrame:
    """Blocks of the index, and beside them the query rows with their first radius."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("vec"), space.width)
            far = space.of_rows(rows)
            nearest = far.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nearest, pa.int32()),
                    pa.array(far[np.arange(len(rows)), nearest]),
                    batch.column("vec_id"),
                    pa.array([cell(r) for r in rows], pa.binary()),
                ],
                ["pivot", "far", "vec_id", "vec"],
            )

    def pack(pivot: int, held: list[tuple[float, int, bytes]]) -> list[tuple]:
        # Equal rows stand next to each other and count once.
        held = [h for i, h in enumerate(held) if not i or h[1:] != held[i - 1][1:]]
        ids = np.array([h[1] for h in held], np.int64)
        rows = np.frombuffer(b"".join(h[2] for h in held), np.int64).reshape(len(held), space.width)
        out = [(False, pivot, held[0][0], held[-1][0], cell(ids), cell(rows), None, None)]
        asks = np.flatnonzero(ids % every == 0)
        if len(asks):
            scores = _scores(rows[asks], rows, space.exact)
            for place, row in zip(asks, scores, strict=True):
                own = int(ids[place])
                best, _ = _best(row, ids, own, top)
                full = len(best) == top
                radius = space.radius(rows[place], int(best[-1])) if full else float("inf")
                least = int(best[-1]) if full else None
                out.append((True, pivot, 0.0, 0.0, cell(ids[place : place + 1]), cell(rows[place]), radius, least))
        return out

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        names = [part.split()[0] for part in _BLOCKS.split(", ")]
        types = [pa.bool_(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.float64(), pa.int64()]

        def rows_of(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names)

        for batch in batches:
            for pivot, far, vec_id, vec in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if held and (pivot != at or len(held) == BLOCK_ROWS):
                    yield rows_of(pack(at, held))
                    held = []
                at = pivot
                held.append((far, vec_id, vec))
        if held:
            yield rows_of(pack(at, held))

    rows = vectors.mapInArrow(keyed, "pivot int, far double, vec_id bigint, vec binary")
    ordered = rows.repartitionByRange("pivot", "far", "vec_id").sortWithinPartitions("pivot", "far", "vec_id", "vec")
    blocks = ordered.mapInArrow(packed, _BLOCKS)
    return staged(blocks.withColumn("block", F.monotonically_increasing_id()), "annuli")


def _chunks(queries: DataFrame, space: _Space, count: int) -> DataFrame:
    """Query rows gathered to chunks, each with the distances it reaches around every pivot."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def out() -> pa.RecordBatch:
            rows = np.frombuffer(b"".join(h[1] for h in held), np.int64).reshape(len(held), space.width)
            radius = np.array([h[2] for h in held])
            far = space.of_queries(rows)
            reach = radius[:, None] + space.slack
            least = np.array([np.iinfo(np.int64).min if h[3] is None else h[3] for h in held], np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([b"".join(h[0] for h in held)], pa.binary()),
                    pa.array([cell(rows)], pa.binary()),
                    pa.array([cell(far)], pa.binary()),
                    pa.array([cell(radius)], pa.binary()),
                    pa.array([cell(least)], pa.binary()),
                    pa.array([(far - reach).min(0).tolist()]),
                    pa.array([(far + reach).max(0).tolist()]),
                ],
                ["q_ids", "q_vecs", "q_far", "q_radius", "q_floor", "from_", "upto"],
            )

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("ids", "vecs", "radius", "floor")), strict=True):
                held.append(row)
                if len(held) == CHUNK_QUERIES:
                    yield out()
                    held = []
        if held:
            yield out()

    tasks = max(1, -(-count // CHUNK_QUERIES))
    spread = queries.select("ids", "vecs", "radius", "floor", "pivot").repartitionByRange(tasks, "pivot", "radius", "ids")
    schema = "q_ids binary, q_vecs binary, q_far binary, q_radius binary, q_floor binary, from_ array<double>, upto array<double>"
    return staged(spread.mapInArrow(gather, schema).withColumn("chunk", F.monotonically_increasing_id()), "queries")


def top_k(vectors: DataFrame, every: int = EVERY, top: int = TOP, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` best of all other rows for each query.

    Queries are the rows whose vec_id is divisible by ``every``.  Rows without
    an id, NULL vectors and vectors with NULL or non-finite components take no part.
    Shorter vectors are filled with zeros.  Rows equal in id and vector count once;
    rows of a query's own id are never its candidates.  Equal scores go to the
    smaller id.  With fewer candidates than ``top`` all are returned, and an empty
    table gives no rows.  Other columns are not looked at.
    """
    spark = vectors.sparkSession
    whole = _integers(vectors)
    squares = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    stats = whole.agg(F.max(squares), F.max(F.size("vec"))).first()
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if stats[0] is None:
        return spark.createDataFrame([], schema)
    width = max(1, stats[1])
    chosen = whole.orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(pivots).collect()
    base = np.zeros((len(chosen), width), np.int64)
    for place, row in enumerate(chosen):
        base[place, : len(row.vec)] = row.vec
    space = _Space(base, stats[0], width)

    index = _index(whole, space, every, top)
    queries = index.filter("is_query")
    chunks = _chunks(queries, space, queries.count())
    blocks = index.filter(~F.col("is_query"))
    reach = chunks.select("chunk", F.posexplode(F.arrays_zip("from_", "upto")).alias("pivot", "at"))
    touched = (
        blocks.select("block", "pivot", "low", "high")
        .join(reach, "pivot")
        .filter((F.col("high") >= F.col("at.from_")) & (F.col("low") <= F.col("at.upto")))
        .select("block", "chunk")
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                rows = np.frombuffer(row["vecs"], np.int64).reshape(len(ids), width)
                q_ids = np.frombuffer(row["q_ids"], np.int64)
                asked = np.frombuffer(row["q_vecs"], np.int64).reshape(len(q_ids), width)
                far = np.frombuffer(row["q_far"], np.float64).reshape(len(q_ids), -1)[:, row["pivot"]]
                reach = np.frombuffer(row["q_radius"], np.float64) + space.slack
                least = np.frombuffer(row["q_floor"], np.int64)
                near = np.flatnonzero((row["high"] >= far - reach) & (row["low"] <= far + reach))
                if not len(near):
                    continue
                scores = _scores(asked[near], rows, space.exact)
                out: list[tuple[int, int, int]] = []
                for place, found in zip(near, scores, strict=True):
                    good = found >= least[place]
                    best, who = _best(found[good], ids[good], int(q_ids[place]), top)
                    out += [(int(q_ids[place]), int(i), int(s)) for s, i in zip(best, who, strict=True)]
                if out:
                    columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    small = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(small, "16")
    pairs = touched.join(blocks.select("block", "pivot", "low", "high", "ids", "vecs"), "block")
    pairs = pairs.join(chunks.drop("from_", "upto"), "chunk")
    found = pairs.mapInArrow(meet, "query_id bigint, vec_id bigint, score bigint").distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
