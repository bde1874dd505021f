"""Pages as block trees: an error-tolerant builder over the standard library's HTML tokenizer, and node features.

Nodes are block-level elements in page order; ``end`` is the place after a node's
last descendant, so sums over subtrees are differences of running sums. Text
belongs to the block element around it; inline elements only mark it (links).
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never shown or never prose.
SKIPPED = frozenset("script style noscript template svg math title iframe object canvas select textarea button audio video".split())
#: Skipped elements whose content is markup, not raw text: a self-closed one is empty, an unclosed one ends as the next block begins.
_LOOSE = SKIPPED - frozenset("script style noscript title iframe".split())
_ANY_LOOSE = re.compile(rf"(?i)<(?:{'|'.join(sorted(_LOOSE))})\b")
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike strong
 sub sup time tt u var rb rt rp nobr""".split())
#: Elements that a start tag of the key closes, if open within the nearest of the second set.
CLOSES = {
    "li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
_SCOPE = frozenset("html body table td th button object applet marquee caption".split())
TAGS = ("div", "p", "section", "article", "main", "nav", "header", "footer", "aside", "form", "ul", "ol", "li", "table", "td", "heading",
        "blockquote", "figure", "pre", "dl", "body", "html", "fieldset", "other")
_TAG = {t: i for i, t in enumerate(TAGS)} | {f"h{i}": TAGS.index("heading") for i in range(1, 7)} | {
    "menu": TAGS.index("ul"), "th": TAGS.index("td"), "dt": TAGS.index("dl"), "dd": TAGS.index("dl"), "figcaption": TAGS.index("figure")}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_COUNTS = ("chars", "linked", "words", "marks", "stops", "blocks", "inputs", "elements", "links", "long")


class _Unclosed(HTMLParser):
    """Which of a page's _LOOSE start tags, counted in page order, have no end tag within the element around them."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.found: set[int] = set()
        self._n = 0
        self._open: list[tuple[str, int]] = []
        self._held: Counter[str] = Counter()
        self.feed(html)
        self.close()
        self.found.update(n for _, n in self._open if n >= 0)

    def handle_starttag(self, tag, attrs) -> None:
        if tag not in VOID and tag not in INLINE:
            self._open.append((tag, self._n if tag in _LOOSE else -1))
            self._held[tag] += 1
        self._n += tag in _LOOSE

    def handle_startendtag(self, tag, attrs) -> None:
        self._n += tag in _LOOSE

    def handle_endtag(self, tag) -> None:
        while self._held[tag]:
            last, n = self._open.pop()
            self._held[last] -= 1
            if last == tag:
                return
            if n >= 0:
                self.found.add(n)


class Page(HTMLParser):
    """The block tree of one page. Attribute ``label_attr``, if given, is read as a node's label (training pages)."""

    def __init__(self, html: str, label_attr: str | None = None):
        super().__init__(convert_charrefs=True)
        self.tags: list[int] = []
        self.parent: list[int] = []
        self.end: list[int] = []
        self.depth: list[int] = []
        self.tokens: list[list[str]] = []
        self.labels: list[int] = []
        self.counts: list[list[int]] = []
        self.blocks: list[tuple[int, str]] = []
        self._label_attr = label_attr
        self._open: list[tuple[str, int]] = []  # (tag, node); inline elements carry the node of the block around them
        self._held: Counter[str] = Counter()  # open elements by tag
        self._skip: list[tuple[str, bool]] = []  # (tag, whether it is never closed); those never closed come first
        self._unclosed = _Unclosed(html).found if _ANY_LOOSE.search(html) else frozenset()
        self._n_loose = 0
        self._run: list[str] = []
        self._linked = 0
        self._node("html", [])
        self.feed(html)
        self.close()
        self._flush()
        while self._open:
            self._pop()
        self.end[0] = len(self.tags)

    def _at(self) -> int:
        return self._open[-1][1] if self._open else 0

    def _node(self, tag: str, attrs) -> int:
        node = len(self.tags)
        self.tags.append(_TAG.get(tag, len(TAGS) - 1))
        self.parent.append(self._at() if node else -1)
        self.depth.append(self.depth[self.parent[-1]] + 1 if node else 0)
        self.end.append(node + 1)
        named = [v or "" for k, v in attrs if k in ("class", "id", "role", "itemprop", "aria-label")]
        self.tokens.append([w.lower() for v in named for w in _WORDS.findall(v)])
        self.labels.append(int(dict(attrs).get(self._label_attr, -1)) if self._label_attr else -1)
        self.counts.append([0] * len(_COUNTS))
        return node

    def _flush(self) -> None:
        text = " ".join("".join(self._run).split())
        self._run.clear()
        if text:
            node = self._at()
            self.blocks.append((node, text))
            c = self.counts[node]
            c[0] += len(text)
            c[2] += text.count(" ") + 1
            c[3] += text.count(",") + text.count(";")
            c[4] += text.count(". ") + text.endswith((".", "!", "?"))
            c[5] += 1
            c[9] += len(text) >= 80

    def _pop(self) -> None:
        tag, node = self._open.pop()
        self._held[tag] -= 1
        if tag in INLINE:
            self._linked -= tag == "a"
        else:
            self.end[node] = len(self.tags)

    def _close(self, tags, until) -> None:
        """Close the outermost open element of ``tags`` above the last one of ``until``."""
        if not any(self._held[t] for t in tags):
            return
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] in until:
                break
            if self._open[i][0] in tags:
                last = i
                while i > 0 and self._open[i - 1][0] not in until:
                    i -= 1
                    if self._open[i][0] in tags:
                        last = i
                while len(self._open) > last:
                    self._pop()
                break

    def handle_starttag(self, tag, attrs) -> None:
        unclosed = tag in _LOOSE and self._n_loose in self._unclosed
        self._n_loose += tag in _LOOSE
        if self._skip and self._skip[-1][1] and tag in _TAG:
            self._skip.clear()
        if self._skip:
            if tag == self._skip[-1][0] and not unclosed or self._skip[-1][1] and tag in SKIPPED:
                self._skip.append((tag, unclosed))
            return
        if tag in SKIPPED:
            self.counts[self._at()][6] += tag in ("select", "textarea", "button")
            self._skip.append((tag, unclosed))
            return
        if tag in VOID:
            self.counts[self._at()][6] += tag == "input"
            if tag == "br":
                self._run.append(" ")
            elif tag == "hr":
                self._flush()
            return
        if tag in ("html", "head") or tag == "body" and self._held[tag]:
            return
        if tag in INLINE:
            self._open.append((tag, self._at()))
            self._held[tag] += 1
            self.counts[self._at()][7] += 1
            if tag == "a":
                self._linked += 1
                self.counts[self._at()][8] += 1
            return
        self._flush()
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        else:
            self._close({"p"}, _SCOPE | {"article", "section", "div", "main", "aside", "nav", "li", "blockquote"})
        while self._open and self._open[-1][0] in INLINE and tag != "ins":  # an inline element does not hold blocks here
            self._pop()
        self._open.append((tag, self._node(tag, attrs)))
        self._held[tag] += 1

    def handle_startendtag(self, tag, attrs) -> None:
        held = len(self._skip)
        self.handle_starttag(tag, attrs)
        if tag in _LOOSE:
            del self._skip[held:]
        if tag not in VOID and tag not in SKIPPED and not self._skip:
            self.handle_endtag(tag)

    def handle_endtag(self, tag) -> None:
        if self._skip:
            if tag == self._skip[-1][0]:
                self._skip.pop()
                return
            closed = self._skip[-1][0] in _LOOSE and not self._skip[-1][1]  # by an end tag yet to come
            if closed or tag in INLINE or not self._held[tag]:
                return
            self._skip.clear()  # the end of an element around an unclosed one
        if tag in VOID or not self._held[tag]:
            return
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                if tag not in INLINE:
                    self._flush()
                while len(self._open) > i:
                    self._pop()
                return
            if tag in INLINE and self._open[i][0] not in INLINE:
                return

    def handle_data(self, data) -> None:
        if self._skip:
            return
        self._run.append(data)
        if self._linked:
            self.counts[self._at()][1] += len(data.strip())


FEATURES = (*[f"is_{t}" for t in TAGS], *[f"parent_{t}" for t in ("nav", "header", "footer", "aside", "form", "article", "main", "li")],
            "depth", "place", "siblings", "same_siblings", "from_last", "log_chars", "share", "link_density", "mark_density", "stop_density",
            "words_per_block", "element_density", "input_density", "log_blocks", "long_share", "links_per_word", "token", "ancestor_token",
            "child_token", "offset", "inside_nav", "inside_article", "inside_form", "own_chars", "parent_link_density", "parent_share")


def features(page: Page, odds: dict[str, float]) -> np.ndarray:
    """One row per node, FEATURES in order; ``odds``: log-odds of attribute tokens to stand on main nodes."""
    n = len(page.tags)
    tags, parent, end = np.array(page.tags), np.array(page.parent), np.array(page.end)
    own = np.array(page.counts, np.float64)
    total = np.zeros((n + 1, own.shape[1]))
    np.cumsum(own, axis=0, out=total[1:])
    sub = total[end] - total[:n]
    chars, words = np.maximum(sub[:, 0], 1), np.maximum(sub[:, 2], 1)
    up = np.maximum(parent, 0)
    token = np.array([max((odds.get(t, 0.0) for t in ts), key=abs, default=0.0) for ts in page.tokens])
    above, nav, article, form = token.copy(), np.zeros(n), np.zeros(n), np.zeros(n)
    names = {t: i for i, t in enumerate(TAGS)}
    bad = {names[t] for t in ("nav", "footer", "aside")}
    good = {names[t] for t in ("article", "main")}
    place, count = np.zeros(n), np.zeros(n)
    same: dict[tuple[int, int], int] = {}
    for i in range(1, n):
        p = page.parent[i]
        t = page.tags[i]
        above[i] = min(above[p], token[i]) if token[i] <= 0 else above[p] if above[p] < 0 else max(above[p], token[i])
        nav[i] = nav[p] or t in bad
        article[i] = article[p] or t in good
        form[i] = form[p] or t == names["form"]
        place[i] = count[p]
        count[p] += 1
        same[p, t] = same.get((p, t), 0) + 1
    below = np.zeros(n)
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        mine = below[i] if abs(below[i]) > abs(token[i]) else token[i]
        if abs(mine) > abs(below[p]):
            below[p] = mine
    density = sub[:, 1] / chars
    share = sub[:, 0] / max(1.0, total[n, 0])
    cols = [tags[:, None] == np.arange(len(TAGS)), tags[up][:, None] == np.array([names[t] for t in (
        "nav", "header", "footer", "aside", "form", "article", "main", "li")])]
    rest = (np.array(page.depth), place, count[up], [same.get((p, t), 0) for p, t in zip(page.parent, page.tags, strict=True)],
            count[up] - place, np.log1p(sub[:, 0]), share, density, sub[:, 3] / words, sub[:, 4] / words, words / np.maximum(sub[:, 5], 1),
            sub[:, 7] / words, sub[:, 6] / words, np.log1p(sub[:, 5]), sub[:, 9] / np.maximum(sub[:, 5], 1), sub[:, 8] / words, token, above,
            below, total[:n, 0] / max(1.0, total[n, 0]), nav, article, form, np.log1p(own[:, 0]), density[up], share[up])
    return np.concatenate([*cols, np.stack([np.asarray(x, np.float64) for x in rest], axis=1)], axis=1).astype(np.float32)
