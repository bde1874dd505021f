"""Scoring in the tasks of the documents: what is shuffled, and the forms beyond the broadcast's bound."""

import random

from sitesift.operators import search as SR
from sitesift.operators.index import build_index
from sitesift.operators.page import documents_as_index


def _index(spark, n=200):
    r = random.Random(4)
    words = [f"{a}{b}{a}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrt"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, " ".join(r.choices(words, weights, k=r.randrange(1, 30))), r.choice(["en", "de"]), "web") for i in range(n)]
    index = build_index(documents_as_index(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")), checkpoint=True)
    queries = [(i, " ".join(r.choices(words, weights, k=r.randrange(1, 8)))) for i in range(20)]
    return index, spark.createDataFrame(queries, "query_id long, q string")


def _exchanges(df):
    return [x.strip(" :+-") for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x or "Exchange range" in x]


def test_matches_are_not_shuffled(spark):
    index, queries = _index(spark)
    for opts in (SR.SearchOptions(), SR.SearchOptions(languages=["de"])):
        by = _exchanges(SR.hits_for(queries, index, opts))
        assert by and all("query_id" not in x and "word_no" not in x for x in by), by


def test_beyond_the_broadcast_bound(spark):
    index, queries = _index(spark)
    clauses = SR.full_text_clauses(queries)
    rows = lambda m: sorted((r["query_id"], r["path"], round(r["score"], 9)) for r in SR.score_hits(m).collect())
    want = rows(SR.clause_matches(clauses, index))
    assert len(want) > 1000
    for most in (0, 40, 300):  # no term, some frequent terms, more of them are broadcast
        assert rows(SR.clause_matches(clauses, index, max_rows=most)) == want
    assert rows(SR.clause_matches(clauses, index).drop("fbit")) == want


def test_tasks_grow_with_the_matches(spark):
    index, queries = _index(spark)
    ce = lambda: SR.full_text_clauses(queries).join(SR.expand_terms(SR.full_text_clauses(queries), index.term_df), ["field", "term", "min_sim"])
    expanded = SR.weighted_terms(ce().selectExpr("query_id", "word_no", "n_clauses", "field", "vterm", "df", "boost * weight AS qboost"), SR.F.lit(index.total))
    post = index.postings.selectExpr("field", "term AS vterm", "path", "sqrt(tf) * norm AS impact")
    parts = lambda n: SR.document_matches(post, expanded, per_task=n).rdd.getNumPartitions()
    assert parts(50) > 4 * parts(500) > 0


def test_pairs_are_scored_without_a_shuffle_of_matches(spark, monkeypatch):
    from sitesift.operators import topk as TK
    index, queries = _index(spark)
    impacts = TK.impact_index(index)
    lists = TK.query_lists(queries, impacts, SR.SearchOptions())
    every = SR.hits_for(queries, index)
    pairs = every.filter("xxhash64(path, query_id) % 3 = 0").select("query_id", "path")
    rows = lambda d: sorted((r["query_id"], r["path"], round(r["score"], 9)) for r in d.collect())
    want = rows(every.join(pairs, ["query_id", "path"], "left_semi"))
    for fits in (True, False):  # pairs within and beyond the broadcast's bound
        monkeypatch.setattr(SR, "fits_broadcast", lambda *_: fits)
        scored = TK.score_pairs(pairs, lists, impacts, 3)
        assert all("word_no" not in x and "query_id" not in x for x in _exchanges(scored)), _exchanges(scored)
        assert rows(scored) == want
