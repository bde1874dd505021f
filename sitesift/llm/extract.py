"""Operator 2: main text of pages, by gradient-boosted trees over block nodes and a hierarchical decoding.

A task builds each page's block tree, computes node features (subtree text and
link density, attribute tokens of the node, its ancestors and descendants, depth,
place among siblings) and gets each node's log-odds of standing on the main text.
The best consistent labelling is then found exactly: a node below a node that is
left out is left out too, and among all such labellings the one of largest
likelihood is taken, bottom-up and top-down. Pages are independent: one narrow
stage, no shuffle. The trees are trained once, on generated layouts (layouts.py),
and are a few kilobytes.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gbt
from .common import add_columns, table
from .dom import Page, features
from .layouts import LABEL, labelled_page

#: Generated pages to train on.
TRAINING_PAGES = 1000
_LIMIT = 12.0


@dataclass
class Extractor:
    odds: dict[str, float]
    trees: gbt.Boosted

    def texts(self, pages: list[str]) -> list[str]:
        trees = [Page(html) for html in pages]
        scores = self.trees.log_odds(np.concatenate([features(p, self.odds) for p in trees])) if trees else []
        out, at = [], 0
        for p in trees:
            kept = decode(p, scores[at:at + len(p.tags)])
            at += len(p.tags)
            out.append("\n".join(text for node, text in p.blocks if kept[node]))
        return out


def decode(page: Page, log_odds: np.ndarray) -> list[bool]:
    """The likeliest labels in which every main node but the root has a main parent."""
    n = len(page.tags)
    gain = np.clip(log_odds, -_LIMIT, _LIMIT).tolist()  # of labelling a node main instead of left out
    best = [0.0] * n  # of a node's subtree with the node main, over leaving it all out
    for i in range(n - 1, -1, -1):
        best[i] += gain[i]
        if i and best[i] > 0:
            best[page.parent[i]] += best[i]
    kept = [best[0] > 0] + [False] * (n - 1)
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and best[i] > 0
    return kept


def train(pages: int = TRAINING_PAGES, seed: int = 1) -> Extractor:
    built = [Page(labelled_page(seed * 1_000_003 + i), LABEL) for i in range(pages)]
    main, other = Counter(), Counter()
    for p in built:
        _spread(p)
        for tokens, label in zip(p.tokens, p.labels, strict=True):
            (main if label else other).update(set(tokens))
    odds = {t: float(np.log((main[t] + 0.5) / (other[t] + 0.5))) for t in main.keys() | other.keys() if main[t] + other[t] >= 5}
    x = np.concatenate([features(p, odds) for p in built])
    y = np.concatenate([np.array(p.labels, float) for p in built])
    # a node weighs by its own text, so that large blocks matter most
    w = np.concatenate([0.5 + np.log1p(np.array(p.counts)[:, 0]) / 4 for p in built])
    return Extractor(odds, gbt.fit(x, y, w))


def _spread(page: Page) -> None:
    """Unmarked nodes are main if something main is below them."""
    for i in range(len(page.tags) - 1, -1, -1):
        page.labels[i] = max(page.labels[i], 0)
        if i and page.labels[i]:
            page.labels[page.parent[i]] = 1


def extract_text(pages: DataFrame, extractor: Extractor, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text in ``out`` (empty if none).

    Blocks are joined in page order by a line feed, white space in a block is one
    blank, character references are decoded. A null or empty page has no text;
    repeated rows get equal texts; an empty table stays empty. Other columns are
    kept, one named ``out`` is replaced.
    """
    held = pages.sparkSession.sparkContext.broadcast(extractor)  # a few hundred kilobytes, whatever the input
    return add_columns(pages, {out: "string"}, html_col, lambda texts, _: {out: held.value.texts(texts)})


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return extract_text(pages, train()).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
