"""Scores against counts made in plain Python, and against the base score on held-out texts."""

import collections
import math
import zlib

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from tests.llm.conftest import SMALL
from tradewind.llm import language_model


def plain(rows):
    texts = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    counts = collections.Counter(w for i, ws in texts if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [
        (i, held(i), len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for i, ws in texts
    ]


def check(frame, rows):
    got = sorted((r for r in language_model.score_texts(frame).collect()), key=str)
    want = sorted(plain(rows), key=str)
    for g, w in zip(sorted(got, key=lambda r: (str(r.doc_id), r.n_tokens)), sorted(want, key=lambda r: (str(r[0]), r[2])), strict=True):
        assert tuple(g)[:5] == w[:5] and math.isclose(g.base_score, w[5], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isfinite(g.score) and g.score <= 0
    return got


def test_awkward_rows(awkward):
    check(awkward, [(r.doc_id, r.text) for r in awkward.collect()])


def test_empty_table(nothing):
    assert language_model.score_texts(nothing).collect() == []


def test_only_held_out_rows(documents):
    held = [i for i in range(100) if language_model.is_held_out(i)][:3]
    got = check(documents(*[(i, "a b") for i in held]), [(i, "a b") for i in held])
    assert all(r.train_tokens == 0 and r.base_score == 0 for r in got)


def test_query_beats_the_base_on_held_out_texts(spark):
    got = entry.queries()["op4_lm_scores"](spark, SMALL).collect()
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {r[0]: r for r in plain([tuple(r) for r in rows])}
    for r in got:
        assert tuple(r)[:5] == want[r.doc_id][:5] and math.isclose(r.base_score, want[r.doc_id][5], rel_tol=1e-9)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_many_batches_give_the_same_counts(documents, monkeypatch):
    monkeypatch.setattr(language_model, "BATCH_TOKENS", 20)
    rows = [(i, f"a b c{i % 5} d{i}") for i in range(200)]
    check(documents(*rows), rows)


@pytest.fixture
def weights():
    rng = np.random.default_rng(1)
    return language_model.Weights(rng.integers(0, 50, (language_model.CLASSES, language_model.MEMBERS)))


def test_probabilities_of_all_next_words_sum_to_one(weights):
    rng = np.random.default_rng(2)
    weights.by_kind += rng.normal(size=weights.by_kind.shape).astype(np.float32)
    weights.by_member += rng.normal(size=weights.by_member.shape).astype(np.float32)
    every = np.arange(language_model.CLASSES * language_model.MEMBERS, dtype=np.uint32)
    numbers = np.stack((np.full(len(every), 7), np.full(len(every), 300), every), axis=1).astype(np.uint32).ravel()
    each = weights.log10(numbers, np.full(len(every), 3))
    assert math.isclose((10 ** each[2::3]).sum(), 1, rel_tol=1e-4)


def test_learning_follows_the_history(weights):
    numbers = np.tile(np.array([5, 40], np.uint32), 4000)
    sizes = np.full(40, 200)
    before = weights.log10(numbers, sizes).sum()
    state = tuple(np.zeros(len(x), np.float32) for x in (weights.by_kind, weights.by_kind, weights.by_member, weights.by_member))
    for _ in range(3):
        weights.learn(numbers, sizes, state)
    assert weights.log10(numbers, sizes).sum() > before / 4


def test_sums_of_few_and_of_many_rows_are_those_of_reduceat(monkeypatch):
    rng = np.random.default_rng(3)
    sizes = np.concatenate(([1, 2, 7, 8, 9, 10, 300], rng.integers(1, 20, 200)))
    rows = rng.normal(size=(sizes.sum(), 32)).astype(np.float32)
    heads = np.cumsum(sizes) - sizes
    for few in (language_model._FEW_ROWS, 1):
        monkeypatch.setattr(language_model, "_FEW_ROWS", few)
        assert np.array_equal(language_model._sums(rows, heads), np.add.reduceat(rows, heads, axis=0))


def test_scores_are_logarithms_of_the_softmaxes(weights):
    rng = np.random.default_rng(4)
    weights.by_kind += rng.normal(size=weights.by_kind.shape).astype(np.float32)
    weights.by_member += rng.normal(size=weights.by_member.shape).astype(np.float32)
    numbers, sizes = rng.integers(0, 1024, 500).astype(np.uint32), np.array([1, 99, 400])
    rows, before = weights.features(numbers, sizes)
    kinds, members, each = (numbers // 32).astype(np.int64), numbers % 32, np.arange(500)
    x, y, _ = weights._softmax(rows, before, kinds)
    plain = weights.kind + weights.by_kind[rows].sum(1)
    plain = np.exp(plain - plain.max(1, keepdims=True))
    assert np.allclose(x, plain / plain.sum(1, keepdims=True), rtol=1e-5)
    assert np.array_equal(weights.log10(numbers, sizes), np.log10(x[each, kinds].astype(float)) + np.log10(y[each, members].astype(float)))


def plain_rarer_scores(rows):
    """Trains and scores the rarer words' softmax word by word; frequent words add nothing."""
    kind = lambda w: 0 if w is None else xxhash.xxh3_64_intdigest(w[-2:], 5) % language_model.CLASSES
    mark = lambda w: language_model._END if w is None else xxhash.xxh3_64_intdigest(w) & ~(language_model.CLASSES - 1) | kind(w)
    texts = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    pairs = [(i, [(w, language_model.CLASSES if k == 0 else kind(ws[k - 1])) for k, w in enumerate(ws)]) for i, ws in texts]
    learned = [p for i, ps in pairs if not language_model.is_held_out(i) for p in ps]
    counts, seen = collections.Counter(w for w, _ in learned), collections.Counter(learned)
    frequent = set()
    for c in range(language_model.CLASSES):
        ordered = sorted((w for w in counts if kind(w) == c), key=lambda w: (-counts[w], mark(w)))
        frequent.update(ordered[: language_model.MEMBERS - 1])
    rare = [w for w in counts if w not in frequent]
    total, weights = collections.Counter(), {}
    for (w, h), n in seen.items():
        if w not in frequent:
            total[kind(w), h] += n
            weights[w, h] = 0.0

    def whole(c, h):
        return 1 + sum((counts[w] + 1) * math.exp(weights.get((w, h), 0.0)) for w in rare if kind(w) == c)

    for _ in range(language_model.STEPS):
        sums = {cell: whole(*cell) for cell in total}
        for (w, h), old in list(weights.items()):
            expected = total[kind(w), h] * (counts[w] + 1) * math.exp(old) / sums[kind(w), h]
            step = (seen[w, h] - expected - language_model.DECAY * old) / (expected + language_model.DECAY)
            weights[w, h] = old + max(-1, min(1, step))
    sums = {(c, h): whole(c, h) for c in range(language_model.CLASSES) for h in range(language_model.HISTORIES)}
    one = lambda w, h: 0.0 if w in frequent else math.log10((counts[w] + 1) * math.exp(weights.get((w, h), 0.0)) / sums[kind(w), h])
    return weights, {i: sum(one(w, h) for w, h in ps) for i, ps in pairs}


def test_rarer_words_train_and_score_as_word_by_word(documents, spark, monkeypatch):
    monkeypatch.setattr(language_model, "BATCH_TOKENS", 60)
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{k}{'aa bb cc'.split()[k % 3]}" for k in rng.integers(0, 400, 30) * rng.integers(0, 2, 30) + rng.integers(0, 40, 30))) for i in range(60)]
    parts = 3
    batches = language_model._batches(documents(*rows))
    answers = language_model._counted(batches, parts)
    words = language_model.Vocabulary(answers)
    rarer = language_model.Rarer(answers, words)
    weights, want = plain_rarer_scores(rows)
    tables = [language_model.Words(r.asDict(), words) for r in answers.filter("marks IS NOT NULL").collect()]
    got = sorted(float(w) for part in tables for w, rare in zip(rarer.weights(part), part.rare[part.word]) if rare)
    # Sums carry 16 bits behind the point, so weights agree closely but not to the last digit.
    assert len(got) > 200 and np.allclose(got, sorted(weights.values()), atol=1e-4)
    scored = {}
    for row in language_model._measured(batches, answers, words, rarer, parts).collect():
        scored.update(zip(row.ids, np.frombuffer(row.rare), strict=True))
    assert scored.keys() == want.keys()
    assert all(math.isclose(scored[i], want[i], rel_tol=1e-4, abs_tol=1e-3) for i in want)


def test_every_training_word_has_weights_of_its_own(documents):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 900}" for k in range(40))) for i in range(200)]
    batches = language_model._batches(documents(*rows))
    answers = language_model._counted(batches, 2)
    words = language_model.Vocabulary(answers)
    tables = [language_model.Words(r.asDict(), words) for r in answers.filter("marks IS NOT NULL").collect()]
    own = sum(len(np.unique(t.word[t.rare[t.word]])) + int((~t.rare).sum()) for t in tables)
    assert own == words.types == sum(int((t.counts > 0).sum()) for t in tables)
    assert sum(int(t.counts.sum()) for t in tables) == words.tokens
