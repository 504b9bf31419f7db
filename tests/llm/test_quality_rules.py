"""Counts against plain Python; verdicts on labelled documents."""

import collections
import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from tests.llm.conftest import SMALL
from tradewind.llm import quality_rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {p for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


@pytest.fixture(scope="module")
def labels(rows):
    return rows("doc_id bigint, quality int, toxic int, text string", [(1, 1, 0, "x"), (5, 1, 0, "x"), (6, 0, 0, "x"), (None, 1, None, None), (9, None, 1, "x")])


def check(frame, labels):
    got = quality_rules.quality_rules(frame, labels).collect()
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    assert collections.Counter((r.doc_id, *tuple(r)[1:7]) for r in got) == collections.Counter((i, *plain(t)) for i, t in rows)
    assert not any(r.kept and r.base_failed for r in got)
    return got


def test_awkward_rows(awkward, labels):
    got = check(awkward, labels)
    assert all(r.score is None for r in got if r.n_words == 0)


def test_empty_tables(nothing, awkward, labels):
    assert quality_rules.quality_rules(nothing, labels).collect() == []
    got = check(awkward, labels.limit(0))
    assert all(r.kept is not r.base_failed for r in got)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "ab", "#", "é", " ", "\n", "\t", " "]), max_size=60).map("".join), min_size=1, max_size=20))
def test_counts_on_repetitive_texts(documents, labels, found):
    check(documents(*enumerate(found)), labels)


def test_query_keeps_good_documents(spark):
    got = {r.doc_id: r for r in entry.queries()["op6_quality"](spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        assert tuple(got[r.doc_id])[1:7] == plain(r.text)
    labelled = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    good = [got[r.doc_id] for r in labelled if r.quality == 1 and not got[r.doc_id].base_failed]
    bad = [got[r.doc_id] for r in labelled if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(r.kept for r in bad) <= 0.4 * len(bad)


def test_score_is_the_mean_log_ratio(documents, rows):
    """Two words told apart: one in trusted texts only."""
    good, other = " ".join(["fine"] * 60), " ".join(["poor"] * 60)
    frame = documents((1, good), (2, other))
    got = {r.doc_id: r.score for r in quality_rules.quality_rules(frame, rows("doc_id bigint, quality int", [(1, 1)])).collect()}
    cells = quality_rules.BUCKETS
    seen = 60 + 59
    up = [math.log((n + 1) / (seen + cells)) - math.log((n + 1) / (2 * seen + cells)) for n in (60, 59)]
    down = [math.log(1 / (seen + cells)) - math.log((n + 1) / (2 * seen + cells)) for n in (60, 59)]
    assert math.isclose(got[1], (60 * up[0] + 59 * up[1]) / seen, rel_tol=1e-9)
    assert math.isclose(got[2], (60 * down[0] + 59 * down[1]) / seen, rel_tol=1e-9)


def test_every_good_label_counts(spark):
    """All of many documents are trusted, so both multinomials are the same and no score is off zero."""
    ids = spark.range(40_000).selectExpr("id AS doc_id")
    frame = ids.selectExpr("doc_id", "concat('word', doc_id % 997, ' other', doc_id % 1009) AS text")
    scores = quality_rules.quality_rules(frame, ids.selectExpr("doc_id", "1 AS quality")).select("score").distinct().collect()
    assert [r.score for r in scores] == [0.0]
