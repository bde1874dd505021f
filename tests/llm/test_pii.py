import hashlib
import re

from pyspark.sql import functions as F

from sitesift.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
TEXTS = [None, "", "a@b.c_x@d.e a@b.c.@d.e", "é😀 me@x.org 1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.4 1.2.3.4.", "+1 (988) 555-2485 +1(2) + 1 +12345678901234567",
         "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 14111111111111111", "a.b" * 3000 + "@x.y " * 300, "1" * 5000 + " 12 " * 2000,
         "+" + "1(" * 2000, "x@y.z " * 1500, "4111111111111111,4111111111111111 1.1.1.1 " * 100, "@@ a@ @b.c a@b a@b. a@-.-", "q@w.e" * 50]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 14 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 10 <= len(digits) <= 15):
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for *_, x in sorted(out))


def test_base_spans_equal_brute_force(spark, odd_docs):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    docs = docs.unionByName(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    rows = pii.find_spans(docs).select("text", pii.spans_text(F.filter("spans", lambda s: s["rank"] < 4)).alias("s")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["s"] == brute(r["text"] or "")


def test_zero_parts_of_addresses(spark):
    texts = ["10.0.0.1", "0.0.0.0", "00.1.2.3", "127.0.0.1 192.168.0.12, 192.168.1.12", "255.255.255.0 256.0.0.0 000255.00.0.0256 0.0.0.260 1.00.000.099",
             " ".join(f"{n}.0.0.{n:04}" for n in range(300))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.find_spans(docs)
    for r in found.select("text", pii.spans_text(F.filter("spans", lambda s: s["rank"] < 4)).alias("s")).collect():
        assert r["s"] == brute(r["text"])
    redacted = {r["doc_id"]: r["text"] for r in pii.redact(found).collect()}
    assert [redacted[i] for i in range(4)] == ["<IP>", "<IP>", "<IP>", "<IP> <IP>, <IP>"]


def test_digest_columns(spark, tmp_path):
    spark.createDataFrame([(1, "me@x.org 1.2.3.4"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in pii.op9_pii(spark, str(tmp_path)).collect()}
    assert (rows[1]["n_email"], rows[1]["n_ip"], rows[1]["spans"]) == (1, 1, "email:0:8,ip:9:16")
    assert rows[1]["base_sha256"] == hashlib.sha256(b"email:0:8,ip:9:16").hexdigest()
    assert rows[2]["base_sha256"] == hashlib.sha256(b"").hexdigest() and rows[2]["spans"] == ""


def test_added_kinds_need_checks_and_context(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "DE88370400440532013000", "call 030 1234 5678", "030 1234 5678 apples"]
    rows = pii.find_spans(spark.createDataFrame(list(enumerate(texts)), "i long, text string")).collect()
    got = {r["i"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in rows}
    assert got == {0: [("iban", 5, 32)], 1: [("iban", 0, 22)], 2: [], 3: [("national_phone", 5, 18)], 4: []}


def test_redaction(spark, odd_docs):
    docs = spark.createDataFrame([(1, "mail me@x.org or 4111111111111111, +1 (988) 555-2485."), (2, None), (3, "é😀 a@b.c a@b.c")], "i long, text string")
    rows = {r["i"]: r["text"] for r in pii.redact(pii.find_spans(docs)).collect()}
    assert rows == {1: "mail <EMAIL> or <CARD>, <PHONE>.", 2: None, 3: "é😀 <EMAIL> <EMAIL>"}
    same = pii.redact(pii.find_spans(odd_docs)).select(*odd_docs.columns).collect()
    assert sorted(map(str, same)) == sorted(map(str, odd_docs.collect()))
    assert pii.find_spans(odd_docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = pii.op9_pii(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
