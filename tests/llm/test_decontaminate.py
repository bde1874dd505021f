import random

from sitesift.llm import decontaminate as D

SF = "/root/testdata/sf0.01"


def distance(item, text):
    """Least edits from the item to any run of the text, by the plain recurrence."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (w != x), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_exact_verification():
    r = random.Random(1)
    for _ in range(400):
        item = [r.randrange(4) for _ in range(r.randint(1, 70))]
        text = [r.randrange(4) for _ in range(r.randint(0, 90))]
        edits, end = D.edit_end(item, text)
        assert edits == distance(item, text) and distance(item, text[:end]) == edits


def test_recall_of_edited_passages(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    docs = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    index = D.PassageIndex([b["item_id"] for b in bench], [b["text"] for b in bench])
    r = random.Random(3)
    words = " ".join(docs[:100]).split()
    planted = []
    for k in range(400):
        i = r.randrange(len(bench))
        passage = bench[i]["text"].split()
        for _ in range(int(0.15 * len(passage)) * (k % 2)):
            at = r.randrange(len(passage))
            passage[at:at + r.randint(0, 1)] = r.choice([[], [r.choice(words)]])
        base = r.choice(docs).split()
        at = r.randint(0, len(base))
        planted.append((" ".join(base[:at] + passage + base[at:]), i))
    found = {(t, i) for t, i, *_ in index.find([D.plain(t) for t, _ in planted])}
    assert sum((k, i) in found for k, (_, i) in enumerate(planted)) >= 0.98 * len(planted)


def test_found_is_within_the_bound_and_exact_copies_are_found(spark):
    bench = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = D.op6_decontaminate(spark, SF).collect()
    for r in rows:
        item, text = D.plain(bench[r["item_id"]]).split(), D.plain(docs[r["doc_id"]]).split()
        assert r["edits"] == distance(item, text) <= 0.2 * len(item)
        assert distance(item, text[r["first_word"]:r["end_word"]]) == r["edits"]
    assert {(d, i) for d, t in docs.items() for i, b in bench.items() if b in t} <= {(r["doc_id"], r["item_id"]) for r in rows}


def test_odd_rows(spark, odd_docs):
    text = "the river of house and école with niño über water and x1 of the"
    bench = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "the river"), (None, text)], "item_id long, text string")
    hit = spark.createDataFrame([(700, f"Über, {text.upper()}!", "en", "a", 1, "p"), (None, text, None, None, None, None)], odd_docs.schema)
    docs = odd_docs.unionByName(hit)
    rows = D.find_passages(docs, bench).collect()
    assert sorted((str(r["doc"]), str(r["item"]), r["edits"]) for r in rows if r["edits"] == 0) == [
        ("700", "1", 0), ("700", "None", 0), ("None", "1", 0), ("None", "None", 0)]
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - len({r["doc"] for r in rows})
    assert D.decontaminate(docs, bench.limit(0)).count() == docs.count()
    assert D.find_passages(docs.limit(0), bench).count() == 0 and D.find_passages(docs, bench.limit(0)).count() == 0


def test_blocks_give_the_same(spark, monkeypatch):
    whole = D.op6_decontaminate(spark, "/root/testdata/sf0.001").collect()
    monkeypatch.setattr(D, "BLOCK_WORDS", 300)
    assert sorted(map(tuple, D.op6_decontaminate(spark, "/root/testdata/sf0.001").collect())) == sorted(map(tuple, whole))


def test_edits_side_by_side_at_every_length():
    r = random.Random(7)
    fresh = lambda n: [f"w{r.randrange(10 ** 9)}" for _ in range(n)]
    items = [fresh(n) for n in range(8, 61) for _ in range(4)]
    index = D.PassageIndex(list(range(len(items))), [" ".join(x) for x in items])
    texts = []
    for k, item in enumerate(items):
        e = len(item) // 5
        at = (0, (len(item) - e) // 2, len(item) - e, r.randint(0, len(item) - e))[k % 4]
        put = fresh(e) if k % 3 else []
        texts.append(" ".join(fresh(20) + item[:at] + put + item[at + e:] + fresh(20)))
    assert {(t, i) for t, i, *_ in index.find([D.plain(t) for t in texts])} == {(i, i) for i in range(len(items))}


def test_least_edits_equal_brute_force():
    r = random.Random(8)
    items = [[r.choice("abcdefgh") for _ in range(n)] for n in range(8, 31)]
    texts = [[r.choice("abcdefgh") for _ in range(n)] for n in (0, 1, 3, 30, 300)] + [
        [r.choice("abcdefgh")] * 3 + [w for w in x if r.random() > 0.1] for x in items]
    index = D.PassageIndex(list(range(len(items))), [" ".join(x) for x in items])
    want = {(t, i): e for t, x in enumerate(texts) for i, item in enumerate(items) if (e := distance(item, x)) <= 0.2 * len(item)}
    assert {(t, i): e for t, i, e, *_ in index.find([" ".join(x).encode() for x in texts])} == want


def test_short_items_and_scripts_without_spaces():
    r = random.Random(9)
    items = [" ".join(f"w{r.randrange(10 ** 9)}" for _ in range(n)) for n in range(3, 8) for _ in range(20)]
    items += ["水の沸点は何度ですか", "地球上最深的海沟叫什么名字", "เมืองหลวงของประเทศไทย", "水は"]
    texts = [f"some words before {x}, and after" for x in items[:100]] + [f"これは文書です。{x}。終わり" for x in items[100:]]
    index = D.PassageIndex(list(range(len(items))), items)
    found = {(t, i): e for t, i, e, *_ in index.find([D.plain(t) for t in texts])}
    assert found == {(i, i): 0 for i in range(len(items) - 1)}  # the last has two words
    edited = [items[100].replace("沸", "融"), items[101].replace("最", ""), items[101][:6]]
    assert [(t, i, e) for t, i, e, *_ in index.find([D.plain(t) for t in edited])] == [(0, 100, 1), (1, 101, 1)]
