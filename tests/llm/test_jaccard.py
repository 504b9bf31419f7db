"""The similarity join against all pairs compared one by one."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.llm.conftest import SMALL
from tradewind.llm import jaccard
from tradewind.llm.shingles import set_marks, shingle_sets


def plain_components(rows):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and None not in (rows[a][0], rows[b][0]):
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    up[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(((d, len(sets[i]), None if d is None else least[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


def found(frame):
    return sorted(map(tuple, jaccard.near_duplicates(frame).collect()), key=str)


def family(seed, copies, edits, words=120):
    """Copies of one text, each with a few words changed: many pairs lie near the limit."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            text[rnd.randrange(words)] = f"n{rnd.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.fixture(scope="module")
def families():
    texts = [t for seed in range(6) for t in family(seed, 25, 6, 60 + 30 * seed)]
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{passage} " + " ".join(f"q{k}x{i}" for i in range(15 + k)) for k in range(30)]
    return list(enumerate(texts))


def test_families_and_common_passages(documents, families):
    assert found(documents(*families)) == plain_components(families)


def test_small_slices_give_the_same(documents, families, monkeypatch):
    monkeypatch.setattr(jaccard, "SLICE_BYTES", 4000)
    assert found(documents(*families)) == plain_components(families)


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(awkward) == plain_components(rows)


def test_empty_table(nothing):
    assert jaccard.near_duplicates(nothing).collect() == []


def test_query_equals_all_pairs(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    query = entry.queries()["op1_near_duplicates"](spark, SMALL)
    assert sorted(map(tuple, query.collect()), key=str) == plain_components(rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(5, 400), st.integers(0, 2**32), st.floats(0, 1))
def test_linked_sets_share_a_first_key(size, seed, frequent):
    """The pigeonhole: any two sets that link send an equal key in a common band."""
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2))
    most = len(a) // 9 + 1
    gone = rng.integers(0, most + 1)
    b = np.unique(np.concatenate((a[rng.permutation(len(a))[gone:]], rng.integers(0, 2**63, rng.integers(0, most + 1), dtype=np.uint64))))
    both = len(np.intersect1d(a, b))
    if 100 * both < 80 * (len(a) + len(b) - both):
        return
    known = lambda x: (x % np.uint64(1000)).astype(float) / 1000 < frequent
    bands = jaccard.Bands(80, 1000)
    keys = []
    for x in (a, b):
        n = np.array([len(x)])
        own = bands.of(n)
        some = [int(own[0])] + [int(own[0]) - 1] * bool(bands.reaches_below(n, own)[0])
        keys.append({int(k) for band in some if bands.differ[band] for k in jaccard._first_keys(band, x, ~known(x), int(bands.differ[band]), int(bands.spare[band]))})
    assert keys[0] & keys[1] or (len(a) == len(b) and (a == b).all())


@pytest.mark.parametrize("frequent", [0.9, 1.0])
def test_short_sets_of_common_shingles_share_a_first_key(frequent):
    """The pigeonhole again, where some sets have empty blocks among their first and others do not."""
    rng = np.random.default_rng(7)
    bands = jaccard.Bands(80, 1000)
    lost = linked = 0

    def keys(x):
        n = np.array([len(x)])
        own = bands.of(n)
        some = [int(own[0])] + [int(own[0]) - 1] * bool(bands.reaches_below(n, own)[0])
        rare = (x % np.uint64(1000)).astype(float) / 1000 >= frequent
        return {k for band in some if bands.differ[band] for k in jaccard._first_keys(band, x, rare, int(bands.differ[band]), int(bands.spare[band])).tolist()}

    for size in range(12, 26):
        for _ in range(3000):
            both = rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2)
            more = rng.integers(0, 2**63, rng.integers(1, size // 4 + 1), dtype=np.uint64)
            side = rng.integers(0, 2, len(more)).astype(bool)
            a, b = np.sort(np.concatenate((both, more[side]))), np.sort(np.concatenate((both, more[~side])))
            linked += 1
            lost += not keys(a) & keys(b)
    assert linked == 42_000 and lost == 0


def test_short_texts_and_marks():
    codes, sizes = shingle_sets([b"a b", b"A  b", b"b a", b"", None, b"a b c d e", b"a b c d e f"])
    assert sizes.tolist() == [1, 1, 1, 0, 0, 1, 2]
    marks = set_marks(codes, sizes)
    assert marks[0] == marks[1] != marks[2] and marks[3] == marks[4] == b""


def test_one_of_each_stays(documents, families):
    rows = [*families, families[0], (None, "left alone"), (None, "left alone")]
    kept = jaccard.keep_one_of_each(documents(*rows))
    heads = {c for _, _, c in plain_components(families)}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*heads, None, None], key=str)


def chained(count, width=80):
    """Texts of which each shares one half with the next, so that ties chain them and no two link."""
    passage = [[f"p{k}x{i}" for i in range(width)] for k in range(count + 1)]
    return [(k, " ".join([*passage[k], *passage[k + 1]])) for k in range(count)]


def test_a_chain_moves_each_set_a_few_times(documents, monkeypatch):
    """Of a family of many slices each set went to a cell for every slice."""
    rows = chained(200)
    rows += [(1000 + k, f"{text} more words") for k, text in rows[:20]]
    moved = []

    def links(sets, *rest, own=jaccard._links):
        moved.append(sets.agg(F.coalesce(F.sum("slices"), F.lit(0))).first()[0])
        return own(sets, *rest)

    monkeypatch.setattr(jaccard, "SLICE_BYTES", 4000)
    monkeypatch.setattr(jaccard, "_links", links)
    assert found(documents(*rows)) == plain_components(rows)
    assert sum(moved) <= 2 * len(rows)


def test_hot_values_of_a_large_family(documents, monkeypatch):
    """Texts that share a passage, some of which link with each other and not with the first of them."""
    passage = " ".join(f"p{i}" for i in range(30))
    bases = [f"{passage} " + " ".join(f"b{k}x{i}" for i in range(30)) for k in range(12)]
    rows = [(k + 100 * copy, f"{base} " + " ".join(f"c{k}x{copy}x{i}" for i in range(copy))) for k, base in enumerate(bases) for copy in range(4)]
    monkeypatch.setattr(jaccard, "SLICE_BYTES", 1500)
    assert found(documents(*rows)) == plain_components(rows)
