"""Tour intervals against a walk of the tree, and robots rules against a matcher of their own."""

import random
import re

import pytest

from sitesift.operators.enrich import hidden_flag
from sitesift.operators.graph import robots_allowed
from sitesift.operators.index import build_index, read_index, write_index
from sitesift.operators.page import documents_as_index
from sitesift.operators.search import SearchOptions, match_all
from sitesift.operators.tree import tour_intervals
from sitesift.streaming.stream import scratch


def walk(rows):
    known = {n for n, _ in rows}
    children = {}
    for n, p in rows:
        children.setdefault(p if p in known else None, []).append(n)
    out, at = {}, [0]

    def visit(n):
        first = at[0]
        at[0] += 1
        for c in sorted(children.get(n, [])):
            visit(c)
        out[n] = (first, at[0] - 1)

    for n in sorted(children.get(None, [])):
        visit(n)
    return out


@pytest.mark.parametrize("shape", ["random", "line", "star", "forest"])
def test_intervals_are_a_depth_first_walk(spark, shape):
    r = random.Random(4)
    ids = r.sample(range(10_000), 90)
    if shape == "line":
        rows = list(zip(ids, [None] + ids[:-1]))
    elif shape == "star":
        rows = [(n, ids[0] if n != ids[0] else None) for n in ids]
    elif shape == "forest":
        rows = [(n, r.choice([None, 20_000, r.choice(ids[:i + 1])]) if i else None) for i, n in enumerate(ids)]
        rows = [(n, p if p != n else None) for n, p in rows]
    else:
        rows = [(n, ids[r.randrange(i)] if i else None) for i, n in enumerate(ids)]
    df = spark.createDataFrame(rows + [(None, ids[0]), rows[3]], "item_no long, parent_no long")
    got = {x["item_no"]: (x["enter"], x["leave"]) for x in tour_intervals(df).collect()}
    assert got == walk(rows)


def test_broken_trees(spark):
    make = lambda rows: tour_intervals(spark.createDataFrame(rows, "item_no long, parent_no long"))
    assert make([]).count() == 0
    with pytest.raises(ValueError, match="cycle"):
        make([(1, None), (2, 3), (3, 4), (4, 2)])
    with pytest.raises(ValueError, match="two parents"):
        make([(1, None), (2, 1), (3, 1), (3, 2)])


def test_a_written_index_prunes_by_interval(spark):
    docs = documents_as_index(spark.createDataFrame([(i, f"text {i}", "en", "web") for i in range(200)], "doc_id long, text string, lang string, source string"))
    docs = docs.selectExpr("*", "cast(substring(path, 6) as long) AS item_enter", "'web' AS db", "'' AS item_path")
    path = scratch(spark, "index")
    write_index(build_index(docs), path)
    index = read_index(spark, path)
    root = {"short_id": "X", "database": "web", "language": "en", "interval": (20, 29)}
    hits = match_all(index, SearchOptions(root_item=root))
    assert sorted(x["path"] for x in hits.collect()) == sorted(f"/doc/{i}" for i in range(20, 30))
    plan = index.docs.filter("item_enter BETWEEN 20 AND 29")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(item_enter,20)" in plan and "LessThanOrEqual(item_enter,29)" in plan


def fits(pattern, path):
    closed, body = pattern.endswith("$"), re.sub(r"\$$", "", pattern)
    return pattern != "" and re.match(".*".join(map(re.escape, body.split("*"))) + (r"\Z" if closed else ""), path, re.S) is not None


def test_robots_patterns(spark):
    r = random.Random(6)
    piece = lambda alphabet, most: "".join(r.choice(alphabet) for _ in range(r.randrange(most)))
    patterns = {"/" + piece("ab*/", 6) + r.choice(["", "$", "*"]) for _ in range(60)} | {"/", "*", "$", "/$", "*a", "/a$b", "/**a*$", "", "/(a|b)", r"/\E"}
    rules = [(h, p, r.random() < 0.5) for h in ("one.example", "TWO.example") for p in sorted(patterns)] + [("one.example", None, False), (None, "/", False)]
    paths = ["/" + piece("ab/", 7) for _ in range(80)] + ["", "/a$b", "/(a|b)", "/?a=b", "/" + "ab" * 500, r"/\E"]
    urls = [(i, f"http://{h}{p}") for h in ("one.example", "two.EXAMPLE", "three.example") for i, p in enumerate(paths)] + [(1, None), (2, "no url")]
    df = spark.createDataFrame(urls, "n long, url string")
    got = robots_allowed(df, "url", spark.createDataFrame(rules, "host string, prefix string, allow boolean")).collect()
    assert len(got) == len(urls)
    for x in got:
        if x["url"] is None or "://" not in x["url"]:
            assert x["allowed"]
            continue
        host, path = re.match(r"http://([^/?]*)(.*)", x["url"], re.S).groups()
        path = path if path.startswith("/") else "/" + path
        hits = [(len(p), a) for h, p, a in rules if h and p and h.lower() == host.lower() and fits(p, path)]
        assert x["allowed"] == (max(hits)[1] if hits else True), x


def test_many_rules_meet_a_url_by_equality(spark):
    rules = spark.createDataFrame([("h.example", f"/dir{i}/", i % 2 == 0) for i in range(3000)], "host string, prefix string, allow boolean")
    urls = spark.createDataFrame([(i, f"http://h.example/dir{i}/x") for i in range(500)], "n long, url string")
    out = robots_allowed(urls, "url", rules)
    assert all(x["allowed"] == (x["n"] % 2 == 0) for x in out.collect())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "StartsWith" not in plan.split("Join")[0] and "_start" in plan


def test_rounds_hand_on_no_size_estimates(spark):
    """Estimates that are products of the rounds before double their digits in every round."""
    line = spark.range(600).selectExpr("id AS item_no", "nullif(id, 0) - 1 AS parent_no", "id = 7 AS hidden", "cast(id AS string) AS item_id")
    for out in (tour_intervals(line), hidden_flag(line)):
        assert len(str(out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 60
        assert out.count() == 600
