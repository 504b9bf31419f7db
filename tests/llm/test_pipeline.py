"""The corpus pipeline, stage by stage, against plain versions of the stages."""

import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.conftest import SMALL
from tests.llm.test_jaccard import plain_components
from tests.llm.test_secrets import plain as plain_secrets
from tradewind.llm import mixing
from tradewind.sources.shared import staged


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], SMALL), f"test-{name}"))
    return out


def test_stages_return_documents(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(s.columns == stages[0].columns for s in stages[:5])


def test_language_keeps_all_texts_in_a_language(stages):
    assert stages[1].count() >= 0.99 * stages[0].count()


def test_one_of_each_near_duplicate_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    heads = {c for _, _, c in plain_components(rows)}
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(heads)


def test_secrets_are_gone_and_clean_texts_untouched(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    after = {r.doc_id: r.text for r in stages[3].collect()}
    assert set(before) == set(after)
    for doc_id, text in before.items():
        assert not plain_secrets(after[doc_id])
        assert after[doc_id] == text or "[secret]" in after[doc_id]


def test_mix_takes_what_the_operator_says(stages):
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix_sources(stages[3]).collect() if r.size}
    copies = {r.doc_id: r["count"] for r in stages[4].groupBy("doc_id").count().collect()}
    assert {i: n for i, n in copies.items() if i in taken} == {i: n for i, n in taken.items() if n}


def test_pieces_are_the_librarys(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = {r.doc_id: r.text for r in stages[4].collect()}
    last = stages[5].collect()
    assert len(last) == stages[4].count()
    assert all(r.piece_ids == library.encode(text[r.doc_id]) for r in last)
    assert all(r.lossless == ("\u2581" not in (text[r.doc_id] or "")) for r in last)


def test_query_runs_all_stages(spark, stages):
    got = entry.queries()["pipeline"](spark, SMALL)
    assert got.exceptAll(stages[5]).isEmpty() and stages[5].exceptAll(got).isEmpty()


def test_awkward_rows(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, SMALL), f"awkward-{name}")
        docs.collect()


def test_clashing_columns_keep_their_values(spark, documents):
    """Columns named like the operators' own pass through the stages that return documents."""
    rows = [(i, f"password = abcDEF12345{i} and some plain words that go on here " * 4, "en", f"s{i % 2}") for i in range(12)]
    names = ["_row", "_copy", "_id", "_text", "_spans", "_masked", "_hash", "_mark", "_source", "_passes", "_copies", "size", "component_id"]
    docs = documents(*rows).selectExpr("*", *(f"concat('{n}', doc_id) AS {n}" for n in names))
    for name, stage in corpus_pipeline.STAGES[1:4]:
        docs = staged(stage(spark, docs, SMALL), f"clashing-{name}")
        found = docs.collect()
        assert found and all(r[n] == f"{n}{r.doc_id}" for r in found for n in names)


def test_sql_is_given_where_it_can_be():
    with_sql = {"op1_near_duplicates", "op3_mix", "op5_top_k", "op10_repeats", "op11_conversation_tree", "op12_resampling", "op13_minhash"}
    names = {n for n in entry.queries() if n.startswith("op") and n[2].isdigit() or n == "pipeline"}
    assert len(names) == 14 and with_sql <= names & set(entry.oracle_sql())
