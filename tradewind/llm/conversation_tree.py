"""The prefix tree of conversations: who shares which first turns, and what storing them once saves.

A turn is a digest of role and text.  Turns are sorted over all tasks by conversation and place, and running sums
of a hash of digest and place name every prefix; sums go on across tasks by one number a task, so no
conversation has to fit into one.  Conversations with equal prefixes are the members of one node.

Nodes with the same members follow one another in one line, a chain, which its smallest member and the
number of members identify.  A conversation's path is the list of its chains.  Members become fewer along a path, so
a path of L chains needs L * L / 2 turns in all: paths are short even where conversations are long.

Sorted paths are dealt to shards, ranges of the order.  A shard writes its tree as balanced parentheses and keeps the
running excess of open ones in blocks under a tree of minima.  The parenthesis that closes a chain is the next place
of smaller excess; what lies between is its subtree.  Ranks over pairs ``()`` then count leaves, and
running sums over opened chains give what the subtree saves.  Only chains on a shard's first or last path, its spine, can
go on in another shard.  A shard hangs what it found beside the spine on it and passes the two paths on; a
last step merges all shards' spines, two paths each, into one tree of parentheses and sums it up the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.sources.shared import staged

#: Chains on the paths of a shard, unless one path holds more; places in a block; conv_ids in a piece of a list, as a power of 2.
SHARD_CHAINS = 1 << 19
BLOCK = 128
PIECE_BITS = 12
#: Turns a rebuilt conversation may take from its base, one less than the numbers to choose from, and how far bases lie apart.
HEADS, BASES = 9, 5

_MASK = (1 << 60) - 1
_TREE = "first bigint, n bigint, parent bigint, n_children bigint, n_leaves bigint, below bigint"
_SPINE = "firsts array<bigint>, ns array<bigint>, weights array<bigint>, leaves array<bigint>, hung array<bigint>, children array<bigint>"


# Running sums


def running(rows: DataFrame, key: str, order: list[str], sums: list[str]) -> DataFrame:
    """The rows with the columns ``sums`` (long, 60 bits) added up within ``key`` (long) along ``order``, in 60 bits.

    Rows are sorted by range over all tasks and written; of each task only its last row's sums are brought together.
    """
    schema = rows.schema.simpleString()[7:-1].replace(",", ", ")
    names = rows.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, start, at, before = TaskContext.get().partitionId(), None, None, np.zeros(len(sums), np.int64)
        held = None

        def tagged(columns: list, size: int, last: bool) -> pa.RecordBatch:
            ends = np.zeros(size, bool)
            ends[-1] = last
            extra = [pa.array(np.full(size, task, np.int32)), pa.array(np.full(size, start, np.int64)), pa.array(ends)]
            return pa.RecordBatch.from_arrays([*columns, *extra], [*names, "_task", "_start", "_last"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if held:
                yield tagged(*held, False)
            keys = batch.column(key).to_numpy()
            start = int(keys[0]) if start is None else start
            new = np.concatenate(([keys[0] != at], keys[1:] != keys[:-1]))
            heads = np.flatnonzero(new)
            columns = {n: batch.column(n) for n in names}
            total = []
            for place, name in enumerate(sums):
                # Wraps at 64 bits, of which the lower 60 are right whatever wraps.
                line = np.cumsum(batch.column(name).to_numpy().astype(np.int64))
                base = np.concatenate(([0], line))[heads] - 0
                run = np.cumsum(new) - 1
                taken = np.where(run >= 0, base[np.maximum(run, 0)] if len(heads) else 0, -before[place])
                line = (line - taken) & _MASK
                columns[name] = pa.array(line)
                total.append(line[-1])
            at, before = keys[-1], np.array(total, np.int64)
            held = (list(columns.values()), batch.num_rows)
        if held:
            yield tagged(*held, True)

    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(placed.mapInArrow(add, f"{schema}, _task int, _start bigint, _last boolean"), "running")
    # One row per task that wrote: bounded by the number of shuffle partitions.
    offsets, at, total = [], None, [0] * len(sums)
    for row in sorted(placed.filter("_last").select("_task", "_start", key, *sums).collect()):
        task, begin, end, *found = row
        if begin == at:
            offsets.append((task, begin, *total))
            found = [(a + b) & _MASK for a, b in zip(found, total)] if begin == end else found
        at, total = end, found
    if not offsets:
        return placed.select(names)
    fields = ", ".join(f"_add{i} bigint" for i in range(len(sums)))
    carried = rows.sparkSession.createDataFrame(offsets, f"_task int, {key} bigint, {fields}")
    joined = placed.join(F.broadcast(carried), ["_task", key], "left")
    more = {s: (F.col(s) + F.coalesce(f"_add{i}", F.lit(0))).bitwiseAND(F.lit(_MASK)) for i, s in enumerate(sums)}
    return joined.withColumns(more).select(names)


# Conversations as steps


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), one and two (digest) and n_bytes (of the text) of every turn.

    Turns are in the order of ``turn``, NULL first; equal ones in that of their digests.  A NULL role or text
    is empty; rows without a conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    lane = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("bigint")
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").isNotNull().alias("dated"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"),
        digest.alias("digest"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
    )
    turns = turns.select("conv_id", "dated", "turn", lane(1).alias("one"), lane(17).alias("two"), "n_bytes", F.lit(1).cast("bigint").alias("place"))
    placed = running(turns, "conv_id", ["conv_id", "dated", "turn", "one", "two"], ["place"])
    return placed.select("conv_id", "place", "one", "two", "n_bytes")


_STEP = ("conv_id", "place", "n_turns", "one", "two", "n_bytes")


def _rooted(steps: DataFrame, members: DataFrame) -> DataFrame:
    """The steps, and for each of the ``members`` (conv_id, n_turns) its step 0, which has no text."""
    zero = F.lit(0).cast("bigint")
    return steps.select(*_STEP).union(members.select("conv_id", zero, "n_turns", zero, zero, zero))


def own_steps(turns: DataFrame) -> DataFrame:
    """Conversations as they are: the numbered turns, each with n_turns, the length of its conversation."""
    members = turns.groupBy("conv_id").agg(F.max("place").alias("n_turns"))
    return _rooted(turns.join(members, "conv_id"), members)


def rebuilt_steps(turns: DataFrame, heads: int = HEADS, bases: int = BASES) -> DataFrame:
    """Conversations rebuilt on a base: its first h turns, then the own turns after the own first h.

    The base of conversation c is c - c % ``bases`` (no turns if there is none), h is crc32 of c's decimal, modulo ``heads``.
    """
    step = F.struct("place", "one", "two", "n_bytes")
    opening = turns.filter(F.col("place") < heads).groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("opening"))
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("own"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(heads)).cast("bigint")
    convs = convs.withColumns({"h": taken, "base": F.col("conv_id") - F.col("conv_id") % bases})
    convs = convs.join(opening.withColumnRenamed("conv_id", "base"), "base", "left")
    # No base at all is a single step 0, which is not taken; a base of fewer turns gives all it has.
    zero = F.lit(0).cast("bigint")
    none = F.array(F.struct(zero.alias("place"), zero.alias("one"), zero.alias("two"), zero.alias("n_bytes")))
    some = F.filter(F.coalesce("opening", none), lambda x: (x["place"] > 0) & (x["place"] <= F.col("h")))
    convs = convs.withColumn("head", some).withColumn("m", F.size("head").cast("bigint"))
    convs = convs.withColumn("n_turns", F.col("m") + F.greatest(F.col("own") - F.col("h"), zero))
    convs = staged(convs.select("conv_id", "h", "m", "n_turns", "head"), "rebuilt-plans")
    head = convs.select("conv_id", "n_turns", F.explode("head").alias("s")).select("conv_id", "s.place", "n_turns", "s.one", "s.two", "s.n_bytes")
    tail = turns.join(convs.drop("head"), "conv_id").filter("place > h")
    tail = tail.withColumn("place", F.col("place") - F.col("h") + F.col("m")).select(*_STEP)
    return _rooted(head.union(tail), convs)


# Parentheses


class Parentheses:
    """A tree as balanced parentheses, from paths in sorted order; equal paths are one."""

    def __init__(self, firsts: np.ndarray, ns: np.ndarray, lengths: np.ndarray) -> None:
        starts = np.concatenate(([0], np.cumsum(lengths)))
        line = np.repeat(np.arange(len(lengths)), lengths)
        level = np.arange(len(firsts)) - starts[line]
        before = np.where((line > 0) & (level < lengths[line - 1]), starts[line - 1] + level, -1)
        same = (before >= 0) & (firsts == firsts[before]) & (ns == ns[before])
        # Leading chains shared with the path before: the level of the first that is not.
        shared = np.minimum.reduceat(np.where(same, lengths[line], level), starts[:-1])
        new = level >= shared[line]
        #: The flat place of every chain of the tree, in preorder, and its level.
        self.flat = np.flatnonzero(new)
        self.level = level[new]
        closes = np.concatenate(([0], lengths[:-1] - shared[1:], lengths[-1:]))
        opens = np.concatenate((lengths - shared, [0]))
        self.bits = np.repeat(np.tile([-1, 1], len(closes)), np.stack((closes, opens), 1).ravel())
        self.excess = np.cumsum(self.bits)
        self.open = np.flatnonzero(self.bits > 0)
        self._blocks()
        self.close = self._find_close(self.open)
        #: Chains opened and pairs ``()`` begun before each place.
        self.opened = np.concatenate(([0], np.cumsum(self.bits > 0)))
        pair = (self.bits > 0) & (np.concatenate((self.bits[1:], [1])) < 0)
        self.pairs = np.concatenate(([0], np.cumsum(pair)))
        # The parent: the last chain one level up that was opened before.
        size = len(self.open)
        order = np.argsort(self.level, kind="stable")
        key = self.level[order] * size + order
        asked = (self.level - 1) * size + np.arange(size)
        found = order[np.maximum(np.searchsorted(key, asked) - 1, 0)]
        self.parent = np.where(self.level > 0, found, -1)

    def _blocks(self) -> None:
        count = -(-len(self.bits) // BLOCK)
        self.width = 1 << max(1, int(count - 1).bit_length())
        padded = np.full(self.width * BLOCK, np.iinfo(np.int64).max)
        padded[: len(self.excess)] = self.excess
        least = np.empty(2 * self.width, np.int64)
        least[self.width :] = padded.reshape(self.width, BLOCK).min(1)
        for node in (1 << k for k in reversed(range(self.width.bit_length() - 1))):
            pair = least[2 * node : 4 * node].reshape(-1, 2)
            least[node : 2 * node] = pair.min(1)
        self.least = least

    def _find_close(self, opens: np.ndarray) -> np.ndarray:
        """The place of the parenthesis that closes each: the next of an excess one less."""
        target, close = self.excess[opens] - 1, np.full(len(opens), -1)

        def scan(waiting: np.ndarray, at: np.ndarray) -> np.ndarray:
            """Looks on to the end of each one's block; returns who has not found."""
            end = np.minimum((at // BLOCK + 1) * BLOCK, len(self.excess))
            while len(waiting):
                inside = at < end
                hit = np.zeros(len(waiting), bool)
                hit[inside] = self.excess[at[inside]] <= target[waiting[inside]]
                close[waiting[hit]] = at[hit]
                lost.append(waiting[~inside])
                go = inside & ~hit
                waiting, at, end = waiting[go], at[go] + 1, end[go]
            return np.concatenate(lost) if lost else waiting

        lost: list[np.ndarray] = []
        everyone = np.arange(len(opens))
        # A place that begins a block is looked at there, unless it is the parenthesis itself.
        inside = (opens + 1) % BLOCK != 0
        left = scan(everyone[inside], opens[inside] + 1)
        left = np.concatenate((left, everyone[~inside]))
        node = opens[left] // BLOCK + 1 + self.width
        searching = self.least[node] > target[left]
        while searching.any():
            # Past this node: to the next one, which its parent stands for if it is a left child.
            step = node[searching]
            step = np.where(step % 2 == 0, step + 1, (step + 1) >> 1)
            node[searching] = step
            searching = self.least[node] > target[left]
        while (inner := node < self.width).any():
            below = 2 * node[inner]
            node[inner] = np.where(self.least[below] <= target[left[inner]], below, below + 1)
        lost.clear()
        scan(left, (node - self.width) * BLOCK)
        return close

    def leaves(self) -> np.ndarray:
        """Leaves in each chain's subtree, itself included."""
        return self.pairs[self.close] - self.pairs[self.open]

    def below(self, weights: np.ndarray) -> np.ndarray:
        """Sum of ``weights``, one a chain in preorder, over each chain's subtree without itself."""
        line = np.concatenate(([0], np.cumsum(weights)))
        return line[self.opened[self.close]] - line[self.opened[self.open] + 1]

    def children(self) -> np.ndarray:
        return np.bincount(self.parent[self.parent >= 0], minlength=len(self.open))


def _flat(batches: list[pa.RecordBatch], name: str) -> np.ndarray:
    return np.concatenate([b.column(name).flatten().to_numpy() for b in batches])


def _found(tree: Parentheses, firsts, ns, leaves, below, children, keep: np.ndarray) -> list[pa.Array]:
    own = tree.flat
    parent = np.where(tree.parent >= 0, firsts[own[tree.parent]], 0)
    cells = (firsts[own], ns[own], parent, children, leaves, below)
    return [pa.array(np.asarray(x)[keep], pa.int64()) for x in cells]


_NAMES = ["first", "n", "parent", "n_children", "n_leaves", "below"]
_SPINE_NAMES = ["firsts", "ns", "weights", "leaves", "hung", "children"]


def _shard(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finished chains of one shard, and its two spine paths with what hangs on them."""
    firsts, ns, weights = (_flat(batches, c) for c in ("firsts", "ns", "weights"))
    lengths = np.concatenate([b.column("firsts").value_lengths().to_numpy() for b in batches])
    tree = Parentheses(firsts, ns, lengths)
    heavy = weights[tree.flat]
    leaves, below, children = tree.leaves(), tree.below(heavy), tree.children()
    # The spine: all chains of the first and of the last path, which ends with the last chain opened.
    spine = np.zeros(len(tree.open), bool)
    first_path = np.arange(lengths[0])
    last_path = [len(tree.open) - 1]
    while tree.parent[last_path[-1]] >= 0:
        last_path.append(int(tree.parent[last_path[-1]]))
    last_path = np.array(last_path[::-1])
    spine[first_path] = spine[last_path] = True
    size = len(tree.open)
    beside = np.flatnonzero(~spine & spine[np.maximum(tree.parent, 0)] & (tree.parent >= 0))
    hung = [np.zeros(size, np.int64) for _ in range(3)]
    for total, amount in zip(hung, (leaves[beside], below[beside] + heavy[beside], np.ones(len(beside), np.int64))):
        np.add.at(total, tree.parent[beside], amount)
    none = pa.nulls(int((~spine).sum()), pa.list_(pa.int64()))
    done = _found(tree, firsts, ns, leaves, below, children, ~spine)
    yield pa.RecordBatch.from_arrays([*done, *[none] * 6], [*_NAMES, *_SPINE_NAMES])
    told, rows = np.zeros(size, bool), []
    for path in (first_path, last_path):
        # What hangs on a chain of both paths is told once.
        fresh = ~told[path]
        told[path] = True
        own = tree.flat[path]
        rows.append((firsts[own], ns[own], weights[own], *(h[path] * fresh for h in hung)))
    blank = [pa.nulls(2, pa.int64())] * 6
    cells = [pa.array([r[i].tolist() for r in rows], pa.list_(pa.int64())) for i in range(6)]
    yield pa.RecordBatch.from_arrays([*blank, *cells], [*_NAMES, *_SPINE_NAMES])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, chains = [], 0
    for batch in batches:
        ends = np.cumsum(batch.column("firsts").value_lengths().to_numpy())
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            end = min(int(np.searchsorted(ends, base + SHARD_CHAINS - chains)) + 1, batch.num_rows)
            held.append(batch.slice(start, end - start))
            chains += int(ends[end - 1] - base)
            start = end
            if chains >= SHARD_CHAINS:
                yield from _shard(held)
                held, chains = [], 0
    if held:
        yield from _shard(held)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All shards' spines, sorted: equal chains become one, with the sum of what hangs on them."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    firsts, ns, weights, leaves, hung, children = (_flat(held, c) for c in _SPINE_NAMES)
    lengths = np.concatenate([b.column("firsts").value_lengths().to_numpy() for b in held])
    tree = Parentheses(firsts, ns, lengths)
    # The chain that each flat place is: the last one opened on its level.
    starts = np.concatenate(([0], np.cumsum(lengths)))
    level = np.arange(len(firsts)) - np.repeat(starts[:-1], lengths)
    size = len(tree.open)
    order = np.argsort(tree.level, kind="stable")
    key = tree.level[order] * (len(firsts) + 1) + tree.flat[order]
    chain = order[np.searchsorted(key, level * (len(firsts) + 1) + np.arange(len(firsts)), side="right") - 1]
    sums = [np.zeros(size, np.int64) for _ in range(3)]
    for total, part in zip(sums, (leaves, hung, children)):
        np.add.at(total, chain, part)
    heavy = weights[tree.flat]
    total_children = tree.children() + sums[2]
    own = (total_children == 0).astype(np.int64) + sums[0]
    all_leaves = tree.below(own) + own
    below = tree.below(heavy + sums[1]) + sums[1]
    done = _found(tree, firsts, ns, all_leaves, below, total_children, np.ones(size, bool))
    yield pa.RecordBatch.from_arrays(done, _NAMES)


# The tree


def _ends(keyed: DataFrame) -> DataFrame:
    """one, two and ends_sha256 of every node at which conversations end.

    Ids are first brought together in pieces of at most 2 ** PIECE_BITS; a node's pieces pass through one digest in order.
    """
    ended = keyed.filter(F.col("place") == F.col("n_turns"))
    pieces = ended.groupBy("one", "two", F.shiftright("conv_id", PIECE_BITS).alias("piece"))
    pieces = pieces.agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select("one", "two", "piece", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            out = []
            for one, two, ids in zip(*(batch.column(c).to_pylist() for c in ("one", "two", "ids"))):
                if (one, two) == at:
                    state.update(b"," + ids.encode())
                    continue
                if at:
                    out.append((*at, state.hexdigest()))
                at, state = (one, two), hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["one", "two", "ends_sha256"])
        if at:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*at, state.hexdigest())], ["one", "two", "ends_sha256"])

    lined = pieces.repartition("one", "two").sortWithinPartitions("one", "two", "piece")
    return lined.mapInArrow(digest, "one bigint, two bigint, ends_sha256 string")


def prefix_tree(steps: DataFrame) -> DataFrame:
    """One row per node of the prefix tree of the conversations in ``steps`` (see ``own_steps``, ``rebuilt_steps``).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.  Two steps at one place
    are equal if their digests are.  A conversation without turns is a member of the root.  No steps give no rows,
    not even a root.
    """
    lane = lambda name, seed: F.xxhash64(F.lit(seed), name, "place").bitwiseAND(F.lit(_MASK))
    named = steps.withColumns({"one": lane("one", 1), "two": lane("two", 2), "upto": F.col("n_bytes")})
    keyed = staged(running(named, "conv_id", ["conv_id", "place"], ["one", "two", "upto"]), "tree-steps")
    nodes = keyed.groupBy("one", "two").agg(
        F.count("*").alias("n"),
        F.min("conv_id").alias("first"),
        F.max("place").alias("depth"),
        F.max("n_bytes").alias("n_bytes"),
        F.max("upto").alias("upto"),
    )
    nodes = staged(nodes, "tree-nodes")
    chains = nodes.groupBy("first", "n").agg(
        F.min("depth").alias("top"),
        F.max(F.struct("depth", "one", "two")).alias("end"),
        F.max("upto").alias("end_upto"),
        F.min(F.col("upto") - F.col("n_bytes")).alias("before"),
    )
    weight = (F.col("n") - 1) * (F.col("end_upto") - F.col("before"))
    chains = staged(chains.select("first", "n", "top", "end.depth", "end.one", "end.two", "end_upto", weight.alias("weight")), "tree-chains")
    on_path = keyed.select("conv_id", "place", "one", "two").join(chains.select("one", "two", "first", "n", "weight"), ["one", "two"])
    paths = on_path.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "first", "n", "weight"))).alias("path"))
    pick = lambda c: F.col(f"path.{c}")
    paths = paths.select("conv_id", pick("first").alias("firsts"), pick("n").alias("ns"), pick("weight").alias("weights"))
    lined = paths.repartitionByRange("firsts", "conv_id").sortWithinPartitions("firsts", "conv_id")
    parts = staged(lined.select("firsts", "ns", "weights").mapInArrow(_shards, f"{_TREE}, {_SPINE}"), "tree-shards")
    # Two paths a shard, whatever it holds: a small part of all paths, bounded by input over SHARD_CHAINS and tasks.
    spines = parts.filter("firsts IS NOT NULL").select(*_SPINE_NAMES).repartition(1).sortWithinPartitions("firsts")
    merged = spines.mapInArrow(_merge, _TREE)
    tree = parts.filter("first IS NOT NULL").select(*_NAMES).union(merged)
    known = chains.select("first", "n", "top", F.col("depth").alias("end"), "end_upto").join(tree, ["first", "n"])
    rows = nodes.join(known, ["first", "n"]).join(_ends(keyed), ["one", "two"], "left")
    ends = F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))
    parent: Column = F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") == F.col("top"), F.col("parent")).otherwise(F.col("first"))
    saved = (F.col("n") - 1) * (F.col("end_upto") - F.col("upto") + F.col("n_bytes")) + F.col("below")
    return rows.select(
        F.col("first").alias("conv_id"),
        "depth",
        parent.cast("bigint").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(F.col("depth") == F.col("end"), F.col("n_children")).otherwise(F.lit(1)).cast("bigint").alias("n_children"),
        "n_leaves",
        saved.alias("saved_tokens"),
        ends.alias("ends_sha256"),
    )


def conversation_tree(conversations: DataFrame) -> DataFrame:
    """The prefix tree of ``conversations`` (conv_id, turn, role, text) as they are; see ``numbered_turns`` and ``prefix_tree``.

    Repeated rows are turns of their own.  An empty table gives no rows.  Other columns are not looked at.
    """
    return prefix_tree(own_steps(numbered_turns(conversations)))


def rebuilt_tree(conversations: DataFrame) -> DataFrame:
    """The prefix tree of ``conversations`` rebuilt on their bases; see ``rebuilt_steps``, else like ``conversation_tree``."""
    return prefix_tree(rebuilt_steps(numbered_turns(conversations)))
