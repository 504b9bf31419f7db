"""Removed bytes against a set of all windows; the suffix sort against sorting the bytes."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from tests.llm.conftest import SMALL
from tradewind.llm import suffix_dedup


def plain(rows):
    """Documents in order of id, one without an id last; a repeated row is the same document."""
    last = 2**63 - 1
    first: dict[bytes, tuple[int, int]] = {}
    for doc_id, text in rows:
        b = (text or "").encode()
        key = last if doc_id is None else doc_id
        for k in range(len(b) - 99):
            at = (key, k)
            first[b[k : k + 100]] = min(at, first.get(b[k : k + 100], at))
    out = []
    for doc_id, text in rows:
        b = (text or "").encode()
        key = last if doc_id is None else doc_id
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 99):
            if first[b[k : k + 100]] < (key, k):
                gone[k : k + 100] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(frame):
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    got = [tuple(r)[:5] for r in suffix_dedup.remove_repeats(frame).collect()]
    assert sorted(got, key=str) == plain(rows)


@pytest.fixture(scope="module")
def passages():
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    passage = [" ".join(rnd.choices(words, k=n)) for n in (30, 45, 80)]
    out = []
    for i in range(120):
        own = " ".join(rnd.choices(words, k=rnd.randrange(5, 60)))
        more = " ".join(rnd.choices(words, k=rnd.randrange(5, 60)))
        out.append((i, f"{own}{'é' * (i % 3)} {passage[i % 3][i % 5 :]} {more}" + (passage[0] if i % 7 == 0 else "")))
    text = " ".join(rnd.choices(words, k=200))
    out += [(500 + i, text) for i in range(20)]
    out += [(600 + i, text[:300] + f" edit{i} " + text[320:]) for i in range(20)]
    out += [(700, "ab" * 400), (701, "ab" * 300 + "c"), (702, "a" * 99), (703, "a" * 100), (704, "a" * 101)]
    return out


def test_passages_copies_and_periods(documents, passages):
    check(documents(*passages).repartition(5))


def test_crowded_anchors_give_the_same(documents, passages, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MANY_BLOCKS", 1)
    check(documents(*passages).repartition(5))


def test_small_batches_give_the_same(documents, passages, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_TEXT_BYTES", 500)
    monkeypatch.setattr(suffix_dedup, "_HELD", 20)
    check(documents(*passages))


def test_awkward_rows(awkward, nothing):
    check(awkward)
    assert suffix_dedup.remove_repeats(nothing).collect() == []


def test_query_equals_all_windows(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = [tuple(r)[:5] for r in entry.queries()["op10_repeats"](spark, SMALL).collect()]
    assert sorted(got, key=str) == plain(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.text("ab", max_size=12).map(str.encode)), max_size=40))
def test_mergesort_orders_as_bytes_do(found):
    group = np.array([g for g, _ in found], np.int64)
    pieces = [p for _, p in found]
    order, common = suffix_dedup.Suffixes(pieces).sort(group)
    assert [(group[i], pieces[i]) for i in order] == sorted(found)
    for a, b, n in zip(order, order[1:], common[1:]):
        same = next((k for k, (x, y) in enumerate(zip(pieces[a], pieces[b])) if x != y), min(len(pieces[a]), len(pieces[b])))
        assert n == (same if group[a] == group[b] else -1)


def test_a_collision_of_hashes_is_caught(monkeypatch):
    monkeypatch.setattr(suffix_dedup.PrefixHash, "__call__", lambda self, start, length: np.zeros(len(start), np.uint64))
    pieces = [b"banana", b"anana", b"nana", b"ana", b"na", b"a", b""]
    order, common = suffix_dedup.Suffixes(pieces).sort(np.zeros(7, np.int64))
    assert [pieces[i] for i in order] == sorted(pieces)
    assert common.tolist() == [-1, 0, 1, 3, 0, 0, 2]


def test_blocks_that_agree_in_hash_bits_but_not_in_bytes_stay(documents):
    """Found by search: one anchor, and 40 equal bits of the blocks' polynomial hashes."""
    head = "hsreltpuscta pirhgwpr rpmuehueqmxavycfysbjya iptxmwznmxzsoeldbepgivnyujnq mslrsnshkvaitv"
    tails = ["imrhmcqjdvkp", "xcfrddpbpudk", "serzprlevazs", "aissrutdrtei", "cftmqfjnsgds", "phagzvdopcrh"]
    check(documents(*[(i, head + tail) for i, tail in enumerate(tails)]).repartition(3))


def test_crowded_windows_are_told_by_their_bytes(documents, passages):
    """What a window of a crowded anchor is dealt and compared by is a digest of all its bytes."""
    docs = documents(*passages).repartition(5)
    blocks = suffix_dedup.staged(docs.selectExpr("doc_id AS id", "doc_id", "text").filter("octet_length(text) >= 100"), "test-texts")
    told = suffix_dedup.staged(suffix_dedup._decided(suffix_dedup._sent_blocks(blocks.select("id", "text"), 4)), "test-blocks")
    open_ = told.filter("kind <> 0").selectExpr("id", "start", "windows", "offset", "CAST(2 AS TINYINT) AS kind", "anchor", "check")
    sent = suffix_dedup._with_bytes(blocks, open_, 4).filter("kind = 2").collect()
    text = dict(passages)
    assert sent
    for row in sent:
        window = text[row.id].encode()[row.start : row.start + 100]
        assert bytes(row.content) == hashlib.sha256(window).digest()[:16]


def test_texts_that_share_an_id_or_have_none(documents, monkeypatch):
    rnd = random.Random(9)
    text = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    a, b, c, d = text(60), text(70), text(80), text(90)
    rows = [(1, a), (None, a), (None, b), (None, b + a), (5, c), (5, d), (5, a + d), (5, text(200)), (6, d + c), (6, c), (None, text(300)), (7, b), (7, b)]
    check(documents(*rows))
    # Windows of crowded anchors take another way; several tasks find what repeats.
    monkeypatch.setattr(suffix_dedup, "MANY_BLOCKS", 1)
    check(documents(*rows).repartition(4))
    lost = {(r.doc_id, r.n_bytes): r.n_removed for r in suffix_dedup.remove_repeats(documents(*rows)).collect()}
    assert lost[None, len(rows[10][1])] == 0 and lost[5, len(rows[7][1])] == 0
