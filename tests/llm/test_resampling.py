"""Importance resampling against plain counting, and the interning table against a dictionary."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from tests.llm.conftest import SMALL
from tradewind.llm import resampling


def plain_runs(text, low, high):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [" ".join(words[i : i + k]) for k in range(low, high + 1) for i in range(len(words) - k + 1)]


def plain_scores(docs, target, low=1, high=1, buckets=10_000, percent=10, least=20):
    bucket = lambda run: zlib.crc32(run.encode()) % buckets
    count = lambda texts: Counter(bucket(r) for t in texts for r in plain_runs(t, low, high)[1])
    s, t = count(x for _, x in docs), count(target)
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        words, runs = plain_runs(text, low, high)
        weight = sum(gain[bucket(r)] for r in runs) // len(runs) if runs else 0
        key = "" if doc_id is None else str(doc_id)
        h = int(hashlib.sha256(f"2024:{key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(runs), weight, score, None, len(words), hashlib.md5((text or "").encode()).hexdigest()])
    eligible = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[6]))
    for rank, row in enumerate(eligible[: percent * len(eligible) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def found(frame):
    return sorted((tuple(r)[:5] for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    words = [f"Word{i}" for i in range(60)] + ["é", "naïve", "3", "a_b", "x" * 90, "x" * 89 + "y", "İ"]
    docs = [(i // 2, " ".join(rnd.choice(words) for _ in range(rnd.randrange(60)))) for i in range(160)]
    return docs, [" ".join(rnd.choice(words[:20]) for _ in range(30)) for _ in range(9)] + [None, ""]


@pytest.mark.parametrize("runs,buckets,percent", [((1, 1), 10_000, 10), ((1, 3), 97, 25), ((2, 2), 10_000, 100)])
def test_against_plain_counts(documents, rows, texts, runs, buckets, percent):
    docs, target = texts
    wanted = rows("text string", [(t,) for t in target])
    got = resampling.importance_scores(documents(*docs).repartition(3), wanted, percent=percent, runs=runs, buckets=buckets)
    assert found(got) == plain_scores(docs, target, *runs, buckets=buckets, percent=percent)


def test_awkward_rows(awkward, rows):
    wanted = rows("text string", [("word1 word2",), (None,)])
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    got = resampling.importance_scores(awkward, wanted, percent=50)
    assert found(got) == plain_scores(docs, ["word1 word2"], percent=50)


def test_draw_returns_whole_rows(awkward, rows):
    wanted = rows("text string", [("word1 word2",)])
    clashing = awkward.selectExpr("*", "'mine' AS _key", "'mine' AS _n", "'mine' AS _row", "'mine' AS _copy")
    drawn = resampling.draw(clashing, wanted, percent=60)
    assert drawn.columns == clashing.columns
    source = Counter(map(tuple, clashing.collect()))
    got = Counter(map(tuple, drawn.collect()))
    ranked = resampling.importance_scores(awkward, wanted, percent=60).filter("rank IS NOT NULL")
    assert not got - source and sum(got.values()) == ranked.count() == 3
    assert Counter(r.doc_id for r in ranked.collect()) == Counter(r.doc_id for r in drawn.collect())


def test_empty_tables(nothing, documents, rows):
    wanted = rows("text string", [("a",)])
    assert resampling.importance_scores(nothing, wanted).collect() == []
    assert resampling.draw(nothing, wanted).collect() == []
    docs = [(1, "one two " * 20), (2, "three " * 30)]
    assert found(resampling.importance_scores(documents(*docs), rows("text string", []))) == plain_scores(docs, [])


@pytest.mark.parametrize("same_hash", [False, True])
def test_table_interns_like_a_dictionary(monkeypatch, same_hash):
    if same_hash:  # every run on one place: only its bytes tell it from others
        monkeypatch.setattr(resampling.xxhash, "xxh64_intdigest", lambda piece: 12)
    rng = random.Random(3)
    cells = [" ".join(f"w{rng.randrange(40)}" + "z" * rng.randrange(3) * 40 for _ in range(rng.randrange(90))).encode() for _ in range(9)]
    buffer, starts, lengths, owners, words = resampling.word_runs(cells, (1, 2))
    table = resampling.Interned(buffer, starts, lengths, 1000)
    pieces = [buffer[a : a + n] for a, n in zip(starts, lengths)]
    assert len(table.taken) == len(set(pieces))
    counts = Counter(pieces)
    for piece, slot in zip(pieces, table.slot):
        assert table.count[slot] == counts[piece] and table.bucket[slot] == zlib.crc32(piece) % 1000
    assert words.sum() == sum(len(c.split()) for c in cells) and len(np.unique(owners)) == sum(1 for c in cells if c)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert found(entry.queries()["op12_resampling"](spark, SMALL)) == plain_scores(docs, target)
