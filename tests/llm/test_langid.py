import random

from pyspark.sql import functions as F

from sitesift.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs.filter("doc_id % 2 = 0"))
    asked = docs.filter("doc_id % 2 = 1")
    wrong = sum(not n or model.languages[int(e[:-1].argmax())] != r["lang"] for r in asked.collect() for e, n in [model.evidence(r["text"])])
    assert wrong <= 0.01 * asked.count()


def test_documents_and_pages(spark):
    rows = langid.op10_language(spark, SF).collect()
    assert len(rows) == 1000 and all(r["accepted"] for r in rows)
    assert sum(r["language"] != r["lang"] for r in rows) <= 10
    pages = langid.language_of_pages(spark, SF).collect()
    assert len(pages) == 250 and {r["language"] for r in pages} == {"de", "en", "es", "fr"}


def test_odd_rows_and_evidence(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([
        (None, None, None, None, None), (5001, "", "en", "src0", 0), (5002, "%%% 123", "en", None, 3), (5003, "xqzk wvjq zzxk qqwj kkvz " * 10, "en", "src0", 3),
        (5004, "the and of with that", "de", "src1", 3), (5005, "der und die ist nicht", "xx", "http://www.x.de/a", 3),
        (5006, "the and of " * 50000, "en", "src1", 3), (5006, "the and of " * 50000, "en", "src1", 3)], docs.schema)
    found = langid.identify_documents(docs.unionByName(odd))
    got = [r for r in found.collect() if r["doc_id"] is None or r["doc_id"] > 5000]
    by = {r["doc_id"]: (r["language"], r["accepted"]) for r in got}
    assert len(got) == 8
    assert [by[i] for i in (None, 5001, 5002, 5003)] == [("und", False)] * 4
    assert by[5004] == ("en", True) and by[5005] == ("de", True) and by[5006] == ("en", True)


def test_rare_languages(spark):
    r = random.Random(2)
    finnish = "ja on ei että hän oli mutta kun niin se joka olla tämä myös voi mukaan vuonna kanssa jälkeen sitten talo järvi metsä yö työ".split()
    ukrainian = "і не що він але це як його для вона було також після років дуже їжа між"
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.substring("text", 1, 150).alias("text"), "lang", "source")
    docs = docs.crossJoin(spark.range(10).select("id")).drop("id")
    rare = [(20000 + i, " ".join(r.choices(finnish, k=25)), "fi", f"src{i}") for i in range(10)]  # 0.1 % of the rows
    rare += [(30000 + i, ukrainian, "uk", f"src{i}") for i in range(2)]  # too few for a model
    rare += [(40000, ukrainian, None, "src1"), (40001, ukrainian, "xx", "src1"), (40002, "the house and the river with the water of that", "uk", "src1")]
    found = langid.identify_documents(docs.unionByName(spark.createDataFrame(rare, docs.schema)))
    got = {x["doc_id"]: (x["language"], x["accepted"]) for x in found.filter("doc_id >= 20000").collect()}
    assert [got[20000 + i] for i in range(10)] == [("fi", True)] * 10
    assert got[30000] == got[30001] == ("uk", True)
    assert got[40000] == got[40001] == ("und", False) and got[40002] == ("en", True)


def test_empty_and_clashing(spark, odd_docs):
    assert langid.identify_documents(odd_docs.limit(0)).count() == 0
    clash = odd_docs.withColumnRenamed("pos", "language")
    assert langid.identify_documents(clash).columns.count("language") == 1
    assert langid.identify_documents(clash).count() == odd_docs.count()


def test_host_prior_is_smoothed(spark):
    model = langid.TextModel(["de", "en"], langid.np.zeros((langid.BUCKETS, 2), langid.np.float32))
    rows = spark.createDataFrame([("the", "en", "a.com", "com")] * 30 + [("die", "de", "b.com", "com")] + [("die", "de", "c.de", "de")], "_text string, _declared string, _host string, _suffix string")
    prior = {r["_key"]: r["_prior"] for r in langid.host_priors(rows, model).collect()}
    assert all(abs(sum(p) - 1) < 1e-9 for p in prior.values())
    assert prior["a.com"][1] > prior["b.com"][1] > prior["c.de"][1]  # language 1 is en


def test_evidence_parsers(spark):
    df = spark.createDataFrame([('<!doctype html><HTML class=x lang="de-AT">', "https://u@Www.X.de:80/a?b"), ("<p>", "nonsense"), (None, None)], "h string, u string")
    rows = df.select(langid.declared_in_markup(df["h"]), langid.host_of(df["u"]), langid.suffix_of(langid.host_of(df["u"]))).collect()
    assert [tuple(r) for r in rows] == [("de", "www.x.de", "de"), (None, None, None), (None, None, None)]
