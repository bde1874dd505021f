"""Operator 9: personal data, by DataFrame functions alone.

Regular expressions propose spans, validators confirm them (Luhn for cards,
mod-97 for account numbers, ranges and digit counts for the others), and words
near a span adjust its score. Everything is one narrow projection per document:
no shuffle, no Python on the executors.

A match's place is found without searching again: the pieces between the matches
and the matches themselves are two arrays, and the running sum of their lengths
gives the starts. Running sums go by runs of 128, so that a document with very
many matches is not quadratic. Patterns use possessive repeats and look-behinds
where these cannot change a match, so that long runs of letters or digits take
linear time and no deep stack.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

RUN = 128
#: Code points on either side of a span in which context words count.
NEAR = 40
#: Score from which a span of an added kind is reported; the four base kinds are always.
THRESHOLD = 0.6
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "national_phone")

#: A number up to 255 after any zeros; it may be the zeros alone, as the proposing pattern assures a digit.
_OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]?)"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "national_phone": r"(?<![0-9+.-])\(?0[0-9]{1,4}\)?[\x20/-][0-9]{2,4}(?:[\x20-]?[0-9]{2,4}){1,3}(?![0-9])",
}
#: What a document must contain for a pattern to be tried; plain searches, far cheaper than the patterns.
HINTS = {"email": "@", "ip": ".", "phone": "+"}
#: Score of a confirmed span, and the context words that raise it by RAISE.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.8, "national_phone": 0.4}
RAISE = 0.25
CONTEXT = {
    "email": "e-?mail|contact|write|kontakt|correo|courriel",
    "ip": "address|server|host|login|adresse|servidor|serveur",
    "card": "card|visa|master|amex|payment|karte|tarjeta|carte",
    "phone": "phone|call|tel|fax|mobil|handy|whatsapp|appel",
    "iban": "iban|account|bank|konto|cuenta|compte",
    "national_phone": "phone|call|tel|fax|mobil|handy|whatsapp|appel",
}


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _before(values: Column, identity: Column, join) -> Column:
    """Array of the joined values before each place."""
    def of_runs(runs: Column) -> Column:
        return _let(F.transform(runs, lambda r: F.aggregate(r, identity, join)), lambda sums: F.flatten(F.zip_with(
            runs, F.transform(sums, lambda _, c: F.aggregate(F.slice(sums, F.lit(1), c), identity, join)),
            lambda r, b: F.transform(r, lambda _, i: join(b, F.aggregate(F.slice(r, F.lit(1), i), identity, join))))))

    def of(v: Column) -> Column:
        last = F.floor((F.greatest(F.size(v), F.lit(1)) - 1) / RUN).cast("int")
        return _let(F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(v, c * RUN + 1, F.lit(RUN))), of_runs)
    return _let(values, of)


def _luhn(digits: Column) -> Column:
    """Whether the digits' Luhn sum ends in 0."""
    def weighted(d: Column, i: Column) -> Column:
        doubled = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda k: F.substring(F.reverse(digits), k, F.lit(1)))
    return F.aggregate(F.transform(each, weighted), F.lit(0), lambda a, b: a + b) % 10 == 0


def _mod97(value: Column) -> Column:
    """Whether an account number leaves 1 modulo 97, its first four signs moved to the end and letters as 10 to 35."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    signs = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda k: F.ascii(F.substring(turned, k, F.lit(1))))
    return F.aggregate(signs, F.lit(0), lambda rest, c: F.when(c < 65, (rest * 10 + c - 48) % 97).otherwise((rest * 100 + c - 55) % 97)) == 1


def _confirmed(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        return match.rlike(rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z")
    if kind == "card":
        return F.when(F.length(match) > 40, False).otherwise(F.when(n.between(14, 19), _luhn(digits)).otherwise(False))
    if kind == "phone":
        return n.between(10, 15)
    if kind == "national_phone":
        return n.between(8, 13)
    if kind == "iban":
        return _mod97(match)
    return F.lit(True)


def _with_starts(matches: Column, pieces: Column) -> Column:
    """(m, start) of each match, from the matches and the lengths of the pieces around them."""
    def of(p: Column) -> Column:
        steps = F.zip_with(matches, p, lambda m, n: F.length(m) + n)
        return F.zip_with(F.zip_with(_before(steps, F.lit(0), lambda a, b: a + b), p, lambda a, b: a + b), matches,
                          lambda start, m: F.struct(m.alias("m"), start.alias("start")))
    return _let(F.slice(pieces, F.lit(1), F.size(matches)), of)


def _confirmed_spans(kind: str, rank: int) -> Column:
    """(start, rank, n) of the kind's confirmed matches."""
    return F.transform(F.filter(f"__m_{kind}", lambda x: _confirmed(kind, x["m"])), lambda x: F.struct(
        x["start"].alias("start"), F.lit(rank).alias("rank"), F.length(x["m"]).alias("n")))


def find_spans(docs: DataFrame, text_col: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with ``out``: array of (start, rank, end, kind, score), by start, then kind as listed in KINDS.

    Starts and ends count code points, the end is exclusive. Spans of one kind do
    not overlap, those of different kinds may. A null or empty text has no spans.
    All other columns are kept; one named ``out`` is replaced.
    """
    cols = [c for c in docs.columns if c != out]
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<string>")
    df = docs.select(*cols, text.alias("__text"))

    def tried(kind: str, found: Column) -> Column:
        return F.when(F.contains("__text", F.lit(HINTS[kind])), found).otherwise(none) if kind in HINTS else found

    df = df.withColumns({f"__m_{k}": tried(k, F.regexp_extract_all("__text", F.lit(p), F.lit(0))) for k, p in PATTERNS.items()})
    df = df.withColumns({f"__m_{k}": F.when(F.size(f"__m_{k}") > 0, _with_starts(
        F.col(f"__m_{k}"), F.transform(F.split("__text", p, -1), F.length))).otherwise(F.array().cast("array<struct<m: string, start: int>>"))
        for k, p in PATTERNS.items()})
    found = [_confirmed_spans(k, rank) for rank, k in enumerate(KINDS)]
    df = df.withColumn("__all", F.array_sort(reduce(lambda a, b: F.concat(a, b), found)))
    words = F.create_map(*[F.lit(x) for rank, k in enumerate(KINDS) for x in (rank, f"(?i)(?<![a-z])(?:{CONTEXT[k]})")])
    scores = F.array(*[F.lit(SCORES[k]) for k in KINDS])
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def scored(s: Column) -> Column:
        around = F.concat(F.substring("__text", F.greatest(s["start"] - NEAR, F.lit(0)) + 1, F.least(s["start"], F.lit(NEAR))), F.lit(" "),
                          F.substring("__text", s["start"] + s["n"] + 1, F.lit(NEAR)))
        score = F.get(scores, s["rank"]) + F.when(F.rlike(around, F.element_at(words, s["rank"])), RAISE).otherwise(0.0)
        return F.struct(s["start"].alias("start"), s["rank"].alias("rank"), (s["start"] + s["n"]).alias("end"),
                        F.get(kinds, s["rank"]).alias("kind"), F.least(score, F.lit(1.0)).alias("score"))

    spans = F.filter(F.transform("__all", scored), lambda s: (s["rank"] < len(BASE)) | (s["score"] >= THRESHOLD))
    return df.select(*cols, spans.alias(out))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with the spans of the text replaced by the kind in angle brackets; overlapping spans become one.

    A null text stays null, a text without spans stays as it is.
    """
    spans = F.col(spans_col)
    least, most = F.lit(-1), lambda a, b: F.greatest(a, b)
    reach = _before(F.transform(spans, lambda s: s["end"]), least, most)  # how far the spans before a span go
    heads = F.filter(F.zip_with(spans, reach, lambda s, r: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), r.alias("reach"))),
                     lambda h: h["start"] >= h["reach"])
    df = docs.withColumn("__heads", heads)
    cut = F.transform("__heads", lambda h, i: F.concat(
        F.when(i == 0, F.substring(text_col, F.lit(1), h["start"])).otherwise(F.substring(text_col, h["reach"] + 1, h["start"] - h["reach"])),
        F.lit("<"), F.upper(h["kind"]), F.lit(">")))
    whole = F.concat(F.array_join(cut, ""), F.substring(text_col, F.array_max(F.transform(spans, lambda s: s["end"])) + 1, F.length(text_col)))
    return df.withColumn(text_col, F.when(F.size(spans) > 0, whole).otherwise(F.col(text_col))).drop("__heads")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = find_spans(table(spark, sf_dir, "documents", "doc_id", "text"))
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return df.select("doc_id", *[of(k).alias(f"n_{k}") for k in BASE], F.sha2(spans_text(base), 256).alias("base_sha256"),
                     spans_text(F.col("spans")).alias("spans"), *[of(k).alias(f"n_{k}") for k in KINDS[len(BASE):]],
                     F.transform("spans", lambda s: s["score"]).alias("scores"))
