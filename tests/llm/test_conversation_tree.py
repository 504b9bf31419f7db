"""The prefix tree against one built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from tests.llm.conftest import SMALL
from tradewind.llm import conversation_tree as trees

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def turn_lists(rows):
    lists = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            lists[conv].append(((turn is not None, turn or 0, digest[:15], digest[16:31]), (role, text)))
    return {c: [t for _, t in sorted(x)] for c, x in lists.items()}


def rebuilt(lists):
    out = {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 9
        # Remainders keep the dividend's sign, as in SQL.
        base = c - (abs(c) % 5) * (1 if c > 0 else -1)
        out[c] = lists.get(base, [])[:h] + own[h:]
    return out


def plain_tree(lists):
    nodes = defaultdict(list)
    for c, turns in lists.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in nodes:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        below = children[path]
        leaves[path] = sum(leaves[b] for b in below) or 1
        size = len(path[-1][1].encode()) if path else 0
        saved[path] = (len(nodes[path]) - 1) * size + sum(saved[b] for b in below)
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(lists[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members), len(path), parent, len(members), len(children[path]), leaves[path], saved[path], digest))
    return sorted(out, key=str)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def branching(seed, conversations, turns, choices):
    rnd = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rnd.randrange(turns + 1)):
            rows.append((c * 3 - 40, t, "user" if t % 2 else "assistant", f"t{rnd.randrange(choices)}" * rnd.randrange(1, 3)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,conversations,turns,choices", [(1, 150, 6, 2), (2, 120, 12, 1), (3, 80, 4, 9), (4, 1, 5, 2)])
@pytest.mark.parametrize("limit", [1 << 19, 7])
def test_random_trees(spark, rows, monkeypatch, seed, conversations, turns, choices, limit):
    monkeypatch.setattr(trees, "SHARD_CHAINS", limit)
    data = branching(seed, conversations, turns, choices)
    frame = rows(SCHEMA, data).repartition(5)
    assert found(trees.conversation_tree(frame)) == plain_tree(turn_lists(data))
    assert found(trees.rebuilt_tree(frame)) == plain_tree(rebuilt(turn_lists(data)))


def test_one_hot_conversation_and_many_copies(rows):
    data = [(7, t, "user", f"turn {t}") for t in range(3000)]
    data += [(c, t, "user", f"same {t}") for c in range(100, 400) for t in range(4)]
    frame = rows(SCHEMA, data).repartition(6)
    assert found(trees.conversation_tree(frame)) == plain_tree(turn_lists(data))


def test_nulls_ties_and_clashing_columns(rows):
    data = [
        (1, None, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, None, None), (2, None, "user", "a"),
        (2, 1, "", ""), (None, 1, "user", "lost"), (3, 5, "user", None), (-4, 1, "é", "ü" * 50_000), (5, 1, "user", "a"), (8, None, None, None),
    ]
    frame = rows(SCHEMA, data)
    clashing = frame.selectExpr("*", "'x' AS place", "'x' AS one", "'x' AS _task", "'x' AS n", "'x' AS path")
    assert found(trees.conversation_tree(clashing)) == plain_tree(turn_lists(data))
    assert found(trees.rebuilt_tree(clashing)) == plain_tree(rebuilt(turn_lists(data)))


def test_empty_table(rows):
    assert trees.conversation_tree(rows(SCHEMA, [])).collect() == []
    assert trees.rebuilt_tree(rows(SCHEMA, [(None, 1, "user", "a")])).collect() == []


def test_sums_go_on_over_tasks(spark, rows):
    data = [(c, p, p * c) for c in (1, 2, 3) for p in range(1, 700)]
    frame = rows("conv_id bigint, place bigint, x bigint", data).repartition(4)
    got = {(r.conv_id, r.place): r.x for r in trees.running(frame, "conv_id", ["conv_id", "place"], ["x"]).collect()}
    assert got == {(c, p): c * p * (p + 1) // 2 for c, p, _ in data}


@pytest.mark.parametrize("seed", range(5))
def test_parentheses_close_where_they_should(seed):
    rng = np.random.default_rng(seed)
    paths = sorted({tuple(rng.integers(0, 3, rng.integers(1, 12)).tolist()) for _ in range(900)})
    lengths = np.array([len(p) + 1 for p in paths])
    firsts = np.concatenate([(0, *p) for p in paths])
    tree = trees.Parentheses(firsts, np.zeros(len(firsts), np.int64), lengths)
    stack, close = [], {}
    for at, bit in enumerate(tree.bits):
        if bit > 0:
            stack.append(at)
        else:
            close[stack.pop()] = at
    assert not stack and [close[o] for o in tree.open] == tree.close.tolist()
    known = {p[:k] for p in paths for k in range(len(p) + 1)}
    assert len(tree.open) == len(known)


def test_query(spark):
    frame = spark.read.parquet(f"{SMALL}/conversations.parquet")
    data = [(r.conv_id, r.turn, r.role, r.text) for r in frame.collect()]
    query = entry.queries()["op11_conversation_tree"](spark, SMALL)
    assert found(query) == plain_tree(rebuilt(turn_lists(data)))
