import random

import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, empty and long texts, repeated rows and ids, and a clashing extra column."""
    r = random.Random(5)
    words = ["the", "and", "of", "with", "house", "river", "über", "école", "niño", "water.", "x1", "B", "😀"]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 40))), r.choice(["en", "de"]), r.choice(["a", "a", "a", "b"]), 0) for i in range(60)]
    rows += [(None, None, None, None, None), (None, "the river", "en", "a", 9), (100, None, "en", "a", 0), (101, "", "en", None, 0), (102, " \n\t ", None, "b", 3),
             (103, "of the", "en", "b", 6), (103, "of the", "en", "b", 6), (104, "the  river\n\n and\x1c", "en", "c", 1), (105, "water " * 30000, "en", "a", 5)]
    return spark.createDataFrame([(*x, "extra") for x in rows], "doc_id long, text string, lang string, source string, n_chars long, pos string")
