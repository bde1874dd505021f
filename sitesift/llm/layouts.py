"""Labelled pages for training the extractor: layouts put together at random, with every block marked main or not.

No labelled pages are given, so the trees learn from these. Roles and their usual
names are fixed values; which names, tags, order, nesting and texts a page has is
drawn anew for each page, often without any telling name at all.
"""

from __future__ import annotations

import random

LABEL = "data-main"

# Names that pages give to the parts of a layout.
NAMES = {
    "main": ["article", "article-body", "content", "main-content", "post", "post-content", "entry", "entry-content", "story", "story-body",
             "text", "body-text", "blog-post", "page-content", "main", "rich-text", "markdown", "prose"],
    "nav": ["nav", "menu", "main-menu", "navbar", "navigation", "topnav", "breadcrumb", "breadcrumbs", "tabs", "pagination", "pager", "toc-menu"],
    "header": ["header", "site-header", "masthead", "top", "branding", "logo", "page-header", "hero-bar", "topbar"],
    "footer": ["footer", "site-footer", "bottom", "copyright", "colophon", "legal", "page-footer", "credits"],
    "side": ["sidebar", "side", "aside", "widget", "widgets", "related", "related-posts", "popular", "recommended", "more-stories", "rail", "tags", "tagcloud",
             "author-box", "teaser-list", "trending"],
    "ad": ["ad", "ads", "advert", "advertisement", "adsbygoogle", "ad-slot", "banner-ad", "sponsored", "promo", "promotion", "sponsor", "commercial"],
    "notice": ["cookie", "cookie-notice", "cookie-banner", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "paywall", "subscribe",
               "newsletter", "signup", "announcement"],
    "form": ["form", "search", "search-form", "searchbox", "login", "contact-form", "signin", "subscribe-form", "filter"],
    "comments": ["comments", "comment", "comment-list", "responses", "discussion", "disqus", "replies", "reader-comments", "commentlist"],
    "share": ["share", "social", "share-buttons", "sharing", "follow-us", "social-links"],
}
SYLLABLES = "ba con de er fi gra hu in jo ka lo men ne or pe qui ra sta ti un ver wa xe yo zu th ing tion ly ou".split()


class Layout:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.named = self.r.random() < 0.75  # whether parts have telling names
        self.semantic = self.r.random() < 0.6  # whether parts have telling tags

    def word(self) -> str:
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(lo, hi)))

    def sentences(self, lo: int, hi: int) -> str:
        noise = self.r.random() < 0.06
        out = []
        for _ in range(self.r.randint(lo, hi)):
            ws = self.words(1, 18).split()
            if noise:
                ws = [w + self.r.choice(["%%%", "***", "&amp;&amp;", "###"]) for w in ws]
            out.append(", ".join([" ".join(ws[:5]), *([" ".join(ws[5:])] if len(ws) > 5 else [])]).capitalize() + ".")
        return " ".join(out)

    def attrs(self, role: str | None, label: int, extra: str = "") -> str:
        name = ""
        if role and self.named and self.r.random() < 0.85:
            name = f' {self.r.choice(["class", "class", "id"])}="{self.r.choice(NAMES[role])}"'
        elif self.r.random() < 0.25:
            name = f' class="{self.r.choice(["row", "col", "wrap", "box", "inner", "c1", "x-a9", "block", "container", "section", "item"])}"'
        return f'{name}{extra} {LABEL}="{label}"'

    def wrap(self, tag: str, role: str | None, label: int, inner: str) -> str:
        if self.r.random() < 0.15:
            inner = f"<div{self.attrs(None, label)}>{inner}</div>"
        return f"<{tag}{self.attrs(role, label)}>{inner}</{tag}>"

    def tag(self, semantic: str) -> str:
        return semantic if self.semantic else "div"

    def link(self, lo: int = 1, hi: int = 4) -> str:
        return f'<a href="/{self.word()}">{self.words(lo, hi)}</a>'

    def list_of_links(self, label: int, lo: int, hi: int, long: int = 3) -> str:
        n = self.r.randint(lo, hi)
        if self.r.random() < 0.75:
            return f"<ul{self.attrs(None, label)}>" + "".join(f"<li {LABEL}=\"{label}\">{self.link(1, long)}</li>" for _ in range(n)) + "</ul>"
        return self.r.choice([" | ", " ", " &gt; "]).join(self.link(1, long) for _ in range(n))

    # what is not the article
    def nav(self) -> str:
        return self.wrap(self.tag("nav"), "nav", 0, self.list_of_links(0, 2, 12))

    def header(self) -> str:
        inner = self.r.choice(["", f"<h1 {LABEL}=\"0\">{self.link()}</h1>", f"<div {LABEL}=\"0\">{self.words(1, 5)}</div>",
                               f"<p {LABEL}=\"0\">{self.sentences(1, 1)}</p>"])
        return self.wrap(self.tag("header"), "header", 0, inner + self.r.choice(["", self.nav(), self.form()]))

    def footer(self) -> str:
        inner = self.r.choice(["&copy; ", "Copyright ", ""]) + self.words(1, 4) + self.r.choice([" &middot; ", ". ", " | "]) + self.sentences(0, 3)
        return self.wrap(self.tag("footer"), "footer", 0, self.r.choice(["", self.list_of_links(0, 2, 8)]) + self.r.choice(
            [inner, f"<p {LABEL}=\"0\">{inner}</p>"]))

    def ad(self) -> str:
        return self.wrap(self.r.choice(["div", "div", "div", "aside", "section"]), "ad", 0, self.r.choice(
            [self.sentences(1, 3), f"<p {LABEL}=\"0\">{self.sentences(1, 4)}</p>", self.link(2, 8), self.words(1, 6)]))

    def notice(self) -> str:
        return self.wrap(self.r.choice(["div", "div", "section", "aside"]), "notice", 0, self.r.choice(
            ["", f"<h3 {LABEL}=\"0\">{self.words(1, 5)}</h3>"]) + self.r.choice([self.sentences(1, 4), f"<p {LABEL}=\"0\">{self.sentences(1, 4)}</p>"])
            + self.r.choice(["", self.link(), f"<button>{self.word()}</button>", f"<input type=text> <button>{self.word()}</button>"]))

    def form(self) -> str:
        fields = "".join(f"<{self.r.choice(['label', 'p', 'div'])} {LABEL}=\"0\">{self.words(1, 3)} <input name=a>" for _ in range(self.r.randint(1, 4)))
        return self.wrap("form", "form", 0, fields + self.r.choice(["", f"<p {LABEL}=\"0\">{self.sentences(1, 2)}</p>"]) + "<button>go</button>")

    def side(self) -> str:
        parts = []
        for _ in range(self.r.randint(1, 4)):
            body = self.r.choice([self.list_of_links(0, 3, 10, 9), f"<p {LABEL}=\"0\">{self.sentences(1, 3)}</p>", "".join(
                f"<div {LABEL}=\"0\"><h4 {LABEL}=\"0\">{self.link(3, 8)}</h4><p {LABEL}=\"0\">{self.sentences(1, 2)}</p></div>" for _ in range(self.r.randint(1, 5)))])
            parts.append(f"<h3 {LABEL}=\"0\">{self.words(1, 3)}</h3>{body}")
        return self.wrap(self.tag("aside"), "side", 0, "".join(parts))

    def share(self) -> str:
        return self.wrap("div", "share", 0, self.list_of_links(0, 2, 6, 1))

    def comments(self) -> str:
        each = []
        item = self.r.choice(["li", "div", "article"])
        for _ in range(self.r.randint(1, 8)):
            who = self.r.choice([f"<b>{self.words(1, 2)}</b>", f"<div {LABEL}=\"0\">{self.link(1, 2)} {self.r.randint(1, 28)}.{self.r.randint(1, 12)}.</div>",
                                 f"<h4 {LABEL}=\"0\">{self.words(1, 2)}</h4>"])
            each.append(self.wrap(item, "comments", 0, who + "".join(f"<p {LABEL}=\"0\">{self.sentences(1, 5)}</p>" for _ in range(self.r.randint(1, 2)))
                                  + self.r.choice(["", self.link(1, 1)])))
        head = self.r.choice(["", f"<h3 {LABEL}=\"0\">{self.words(1, 3)}</h3>"])
        body = f"<ol {LABEL}=\"0\">{''.join(each)}</ol>" if item == "li" else "".join(each)
        return self.wrap(self.r.choice(["section", "div", "div"]), "comments", 0, head + body + self.r.choice(["", self.form()]))

    # the article
    def article(self) -> str:
        parts = []
        heading = f"<h1 {LABEL}=\"1\">{self.words(2, 10)}</h1>"
        broken = self.r.random() < 0.15
        for _ in range(self.r.choice([1, 2, 3, 5, 8, 13])):
            kind = self.r.random()
            if broken and kind < 0.15:
                parts.append(f"<p {LABEL}=\"1\"><b>{self.sentences(1, 2)}<br>")
            elif kind < 0.72:
                text = self.r.choice([self.sentences(1, 1), self.sentences(1, 4), self.sentences(2, 9)])
                if self.r.random() < 0.2:
                    text += f" {self.link()} <em>{self.words(1, 3)}</em>. {self.sentences(0, 2)}"
                plain = self.r.random() < 0.08
                parts.append(f"{text}<br><br>" if plain else f"<p {LABEL}=\"1\">{text}</p>" if self.r.random() < 0.93 else f"<div {LABEL}=\"1\">{text}</div>")
            elif kind < 0.80:
                h = self.r.choice(["h2", "h3"])
                parts.append(f"<{h} {LABEL}=\"1\">{self.words(1, 7)}</{h}>")
            elif kind < 0.87:
                items = "".join(f"<li {LABEL}=\"1\">{self.r.choice([self.words(1, 6), self.sentences(1, 2)])}</li>" for _ in range(self.r.randint(2, 6)))
                t = self.r.choice(["ul", "ol"])
                parts.append(f"<{t} {LABEL}=\"1\">{items}</{t}>")
            elif kind < 0.91:
                parts.append(f"<blockquote {LABEL}=\"1\">{self.r.choice([self.sentences(1, 3), f'<p {LABEL}=\"1\">' + self.sentences(1, 3) + '</p>'])}</blockquote>")
            elif kind < 0.94:
                rows = "".join(f"<tr {LABEL}=\"1\">" + "".join(f"<td {LABEL}=\"1\">{self.words(1, 3)}</td>" for _ in range(3)) + "</tr>" for _ in range(self.r.randint(1, 4)))
                parts.append(f"<table {LABEL}=\"1\">{rows}</table>")
            elif kind < 0.96:
                parts.append(f"<pre {LABEL}=\"1\">{self.words(3, 15)}</pre>")
            else:
                parts.append(f"<figure {LABEL}=\"1\"><img src=a><figcaption {LABEL}=\"1\">{self.sentences(1, 1)}</figcaption></figure>")
        if self.r.random() < 0.35:
            parts.insert(self.r.randint(0, len(parts)), self.r.choice([self.ad, self.share, self.notice, self.ad, self.side])())
        if not any(f'{LABEL}="1"' in p for p in parts):
            parts.append(f"<p {LABEL}=\"1\">{self.sentences(1, 3)}</p>")
        inside = self.r.random()
        text = (heading if self.r.random() < 0.85 else "") + "".join(parts)
        if self.semantic and inside < 0.7:
            return self.wrap(self.r.choice(["article", "article", "main", "section"]), self.r.choice(["main", None]), 1, text)
        return self.wrap("div", "main", 1, text)

    def page(self) -> str:
        r = self.r
        maybe = lambda p, f: f() if r.random() < p else ""
        before = [maybe(0.5, self.header), maybe(0.6, self.nav), maybe(0.4, self.ad), maybe(0.25, self.notice), maybe(0.12, self.side)]
        r.shuffle(before)
        after = [maybe(0.3, self.comments), maybe(0.3, self.side), maybe(0.15, self.share), maybe(0.25, self.ad), maybe(0.12, self.form), maybe(0.15, self.notice)]
        r.shuffle(after)
        middle = self.article()
        if r.random() < 0.3:
            middle = f"<div{self.attrs(None, 1)}>{middle}{maybe(0.5, self.side)}{maybe(0.3, self.comments)}</div>"
        return "<html><body>" + "".join(before) + middle + "".join(after) + maybe(0.75, self.footer) + maybe(0.1, self.notice) + "</body></html>"


def labelled_page(seed: int) -> str:
    return Layout(seed).page()
