"""Fused evidence on small corpora where the answer is known."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.llm.conftest import SMALL
from tradewind.llm import language_id

ENGLISH = "the quick brown fox jumps over the lazy dog while the other foxes think of something better to do with their time"
GERMAN = "der schnelle braune fuchs springt über den faulen hund und die anderen füchse denken an etwas besseres als nur zu rennen"
ROWS = "key bigint, text string, declared string, host string, suffix string, extra string"


@pytest.fixture(scope="module")
def model(rows):
    labelled = [(ENGLISH, "en"), (GERMAN, "de")] * 30 + [(None, "en"), (GERMAN, None)]
    return language_id.fit_language_model(rows("text string, lang string", labelled))


def verdicts(frame, model):
    return {r.key: r for r in language_id.identify(frame, "key", model).collect()}


def test_text_outweighs_a_wrong_declaration(rows, model):
    got = verdicts(rows(ROWS, [(1, ENGLISH, "de", "h", "org", "x"), (2, GERMAN, "de-AT", "h", "org", "x")]), model)
    assert (got[1].lang, got[2].lang) == ("en", "de")
    assert not got[1].rejected and got[1].posterior > 0.9


def test_host_and_declaration_decide_for_little_text(rows, model):
    data = [(i, GERMAN, "de", "de.example", "de", "x") for i in range(40)]
    data += [(100 + i, ENGLISH, "en", "en.example", "com", "x") for i in range(40)]
    data += [(200, "qzq", None, "de.example", "de", "x"), (201, "qzq", None, "en.example", "com", "x"), (202, "qzq", "de", None, "de", "x")]
    got = verdicts(rows(ROWS, data), model)
    assert (got[200].lang, got[201].lang, got[202].lang) == ("de", "en", "de")


def test_noise_is_rejected_and_texts_stay(rows, model):
    noise = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(400))
    got = verdicts(rows(ROWS, [(1, noise, "en", "h", "org", "x"), (2, "12 34 ?!", "en", "h", "org", "x"), (3, ENGLISH + " 4111 token", None, None, None, None)]), model)
    assert got[1].rejected and got[2].rejected and not got[3].rejected


def test_awkward_rows(rows, model):
    data = [(1, None, None, None, None, None), (2, "", "??", "h", None, None), (None, ENGLISH, "en", "h", "org", None), (3, "ab", "en", "h", "org", None)]
    got = language_id.identify(rows(ROWS, data * 2), "key", model).collect()
    assert len(got) == 8
    assert all(r.rejected and r.n_grams == 0 for r in got if r.key in (1, 2))
    assert language_id.identify(rows(ROWS, []), "key", model).collect() == []


def test_without_languages_all_is_rejected(rows):
    empty = language_id.fit_language_model(rows("text string, lang string", []))
    got = language_id.identify(rows(ROWS, [(1, ENGLISH, "en", "h", "org", "x")]), "key", empty).collect()
    assert [(r.lang, r.rejected) for r in got] == [(None, True)]


def test_a_rare_language_is_in_the_model(rows):
    labelled = [(f"{ENGLISH} number {i}", "en") for i in range(2000)] + [("12 34", "de")] * 300 + [(GERMAN, "de")]
    model = language_id.fit_language_model(rows("text string, lang string", labelled), sample_texts=20)
    assert model.languages == ["de", "en"]
    got = verdicts(rows(ROWS, [(1, GERMAN, "de", "h", "org", "x"), (2, ENGLISH, "en", "h", "org", "x")]), model)
    assert [(got[k].lang, got[k].rejected) for k in (1, 2)] == [("de", False), ("en", False)]


def test_many_languages_all_stay(rows):
    tags = [a + b for a in "abcdefghij" for b in "klmnopqrst"]
    said = {t: " ".join(t + c + t[::-1] for c in "uvwxyz") * 4 for t in tags}
    model = language_id.fit_language_model(rows("text string, lang string", [(x, t) for t, x in said.items()]))
    assert model.languages == tags
    data = [(i, said[t], t, "h", "org", "x") for i, t in enumerate(tags)]
    got = verdicts(rows(ROWS, data), model)
    assert [got[i].lang for i in range(len(tags))] == tags


def test_copies_of_a_text_count_once(rows):
    fit = lambda found: language_id.fit_language_model(rows("text string, lang string", found))
    once = [(ENGLISH, "en"), (ENGLISH + " more", "en"), (GERMAN, "de")]
    assert np.array_equal(fit(once).table, fit(once + once[:1] * 500).table)


def test_posterior_is_bayes_rule(rows, model):
    """One row against the rule worked out by hand."""
    data = [(1, ENGLISH, "en", "h1", "org", "x"), (2, GERMAN, "de", "h2", "org", "x"), (3, "then", "en", "h2", "org", "x")]
    got = verdicts(rows(ROWS, data), model)[3]
    ahead, _ = model([b"then"])
    best = [int(model([t.encode()])[0].argmax()) for _, t, *_ in data]
    size = len(model.languages)
    count = lambda places: np.bincount(places, minlength=size).astype(float)
    top = (count(best) + 1) / (count(best) + 1).sum()
    smooth = lambda n, above: (n + above * language_id.STRENGTH) / (n.sum() + language_id.STRENGTH)
    prior = smooth(count([best[1], best[2]]), smooth(count(best), top))
    matrix = np.full((size, size), 0.5)
    for (_, _, tag, *_), b in zip(data, best, strict=True):
        matrix[model.languages.index(tag), b] += 1
    score = ahead[0] * language_id.TEMPER + np.log(matrix / matrix.sum(0))[model.languages.index("en")] + np.log(prior)
    share = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
    assert got.lang == model.languages[int(score.argmax())] and math.isclose(got.posterior, share.max(), rel_tol=1e-6)


def test_page_evidence(rows):
    html = '<html data-x="1" lang="de-AT"><style>a b</style><script>var t="</p>";</script><!-- c --><p>Guten <b>Tag</b></p>'
    frame = rows("page_id bigint, url string, html string", [(1, "https://User@WWW.Example.de:80/a?b", html), (2, None, None), (3, "nonsense", "plain")])
    got = {r.page_id: r for r in language_id.page_evidence(frame).collect()}
    assert got[1].text.split() == ["Guten", "Tag"] and (got[1].declared, got[1].host, got[1].suffix) == ("de-AT", "www.example.de", "de")
    assert (got[2].text, got[2].declared, got[2].host) == (None, None, None) and (got[3].text, got[3].host) == ("plain", None)


def test_query_agrees_with_the_pages_paths(spark):
    """The synthetic pages carry their language in the path."""
    got = entry.queries()["op2_language"](spark, SMALL)
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    assert got.count() == pages.count()
    path = pages.select("page_id", F.regexp_extract("url", r"^[^/]*//[^/]*/([a-z]{2})/", 1).alias("path_lang"))
    known = got.join(path, "page_id").filter("path_lang <> ''")
    assert known.filter("lang = path_lang").count() >= 0.95 * known.count()


def test_kept_documents_keep_their_columns(documents, awkward):
    kept = language_id.keep_identified(documents((1, ENGLISH, "en", "s"), (2, None, "en", "s"), (1, ENGLISH, "en", "s")))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [(r.doc_id, r.lang) for r in kept.collect()] == [(1, "en"), (1, "en")]
    assert language_id.keep_identified(awkward).columns == awkward.columns
