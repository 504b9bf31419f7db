"""The sketch join against all pairs compared one by one, and the sketches' guarantees."""

import random

import numpy as np
import pytest

import __spark_entry__ as entry
from tests.llm.conftest import SMALL
from tests.llm.test_jaccard import family
from tradewind.llm import minhash


def plain(rows, width=2):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set())
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
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = None if doc_id is None else least[root(i)]
        out.append((doc_id, len(sets[i]), component, doc_id is None or doc_id == component))
    return sorted(out, key=str)


def found(frame):
    return sorted(map(tuple, minhash.near_duplicates(frame).collect()), key=str)


@pytest.mark.parametrize("rounds,slice_bytes", [(minhash.ROUNDS, minhash.SLICE_BYTES), (0, 6000), (3, 6000)])
def test_families_chains_and_common_passages(documents, monkeypatch, rounds, slice_bytes):
    monkeypatch.setattr(minhash, "ROUNDS", rounds)
    monkeypatch.setattr(minhash, "SLICE_BYTES", slice_bytes)
    texts = [t for seed in range(5) for t in family(seed, 20, 9, 60 + 30 * seed)]
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{passage} " + " ".join(f"q{k}x{i}" for i in range(8 + k)) for k in range(25)]
    # A chain: each links with the next, the ends have nothing in common.
    texts += [" ".join(f"c{i}" for i in range(k, k + 60)) for k in range(0, 90, 5)]
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    assert found(documents(*rows).repartition(4)) == plain(rows)


def test_awkward_rows(awkward):
    assert found(awkward) == plain([(r.doc_id, r.text) for r in awkward.collect()])


def test_empty_table(nothing):
    assert minhash.near_duplicates(nothing).collect() == []
    assert minhash.keep_one_of_each(nothing).collect() == []


def test_ids_shared_by_texts(documents):
    rows = [(1, "a b c d e f"), (1, "g h i j k l"), (2, "g h i j k l"), (3, "a b c d e f")]
    assert found(documents(*rows)) == plain(rows)


def test_kept_rows_are_whole(awkward):
    clashing = awkward.selectExpr("*", "'mine' AS _copy", "'mine' AS _row", "'mine' AS _id")
    kept = minhash.keep_one_of_each(clashing)
    assert kept.columns == clashing.columns
    rows = kept.collect()
    # Document 1 once of two equal rows; 5 and 8 hold other pairs of words or too few in common to link.
    linked = {r.component_id for r in minhash.near_duplicates(awkward).collect() if r.doc_id is not None}
    assert sorted((r.doc_id for r in rows if r.doc_id is not None)) == sorted(linked)
    assert sum(r.doc_id is None for r in rows) == 2 and all(r._copy == r._row == r._id == "mine" and r.kept == "clash" for r in rows)


@pytest.mark.parametrize("size", [1, 2, 7, 40, 160, 800, 5000])
def test_every_coordinate_is_filled_and_estimates_hold(size):
    rng = np.random.default_rng(size)
    agreed = []
    for _ in range(60):
        union = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        both = union[: max(1, int(size * 0.8))]
        a, b = both, union
        rows = minhash.sketches(np.concatenate((a, b)), np.array([len(a), len(b)]))
        agreed.append((rows[0] == rows[1]).mean() - len(a) / len(union))
    # The mean of 60 estimates of 160 coordinates each; independent draws would have a deviation of 0.0041.
    assert abs(np.mean(agreed)) < 0.02 and np.std(agreed) < 0.045


def test_sketches_do_not_depend_on_the_batch():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (3, 900, 1, 50)]
    together = minhash.sketches(np.concatenate(sets), np.array([len(s) for s in sets]))
    for one, row in zip(sets, together):
        assert (minhash.sketches(one, np.array([len(one)]))[0] == row).all()


def test_links_share_a_key():
    """3,000 pairs on the threshold: by the bound of the bands none may be missed."""
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(3000):
        union = np.unique(rng.integers(0, 2**63, 25, dtype=np.uint64))
        sets += [union[:20], union]
    rows = minhash.sketches(np.concatenate(sets), np.array([len(s) for s in sets]))
    keys = minhash.band_keys(rows)
    assert (keys[0::2] == keys[1::2]).any(1).all()
    assert ((rows[0::2] == rows[1::2]).sum(1) >= minhash.AGREE).all()


def test_query_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert sorted(map(tuple, entry.queries()["op13_minhash"](spark, SMALL).collect()), key=str) == plain(rows)
