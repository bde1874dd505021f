"""Documents are shuffled for the postings, not the postings, whose keys are ten times as large."""

from sitesift.operators.index import build_postings


def test_postings_are_counted_where_their_document_is(spark):
    docs = spark.createDataFrame([("/a", ["x y x"], ["t"]), ("/b", ["y"], None), ("/a", ["x z"], None)], "path string, content array<string>, name array<string>")
    out = build_postings(docs)
    assert "hashpartitioning(field" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r["field"], r["term"], r["path"]): r["tf"] for r in out.collect()}
    assert got == {("content", "x", "/a"): 3, ("content", "y", "/a"): 1, ("content", "z", "/a"): 1, ("name", "t", "/a"): 1, ("content", "y", "/b"): 1}
