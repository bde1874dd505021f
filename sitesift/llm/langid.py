"""Operator 10: language identification by Bayesian evidence fusion.

The posterior of a row's language multiplies four pieces of evidence: the text's
likelihood under a model of letter trigrams for each language, the language that
its markup (or its label) declares, and the host's prior, which grouped
aggregation counts for hosts, smooths by the host's address suffix and that by
all rows. A further hypothesis, a uniform model, stands for "none of these"; if the declared language is a known code without a model, it
shares that likelihood.

The trigram models are learned from a bounded sample of labelled rows (whole
texts, chosen by a hash of the text). Host, suffix and overall counts cover all
rows; they are partial counts before any shuffle, so a host with a third of all
rows costs one row per task and language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, forget, table, written

UNKNOWN = "und"
#: Labelled rows sampled for each language (expected number).
SAMPLE = 1500
#: A label has a model if it has so many labelled rows, however many others there are, or this share of them (small tables).
LEAST_ROWS, LEAST_SHARE = 10, 0.005
#: ISO 639-1. A declaration of one of these counts without a model too.
CODES = frozenset("""aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu fa
 ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb
 lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si
 sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu""".split())
BUCKETS = 1 << 16
#: Added to each bucket's count, but over all buckets this share of a language's trigrams at most: a model of few rows is not a uniform one.
SMOOTH, SMOOTH_SHARE = 0.5, 0.25
#: Trigrams overlap and are not independent: their log-likelihood counts for this share.
TEMPER = 0.25
#: Chance that a declared language is wrong.
DECLARED_WRONG = 0.1
#: Weight, in rows, of the level above in the prior of a host and of a suffix.
HOST_WEIGHT, SUFFIX_WEIGHT = 20.0, 50.0
UNKNOWN_PRIOR = 0.02
ACCEPT = 0.5
BROADCAST_BYTES = 32 << 20
_BLOCK = 1 << 20
#: Not a letter: each such ASCII byte counts as a blank.
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Hashed trigrams of lower-case UTF-8 bytes around each letter, in blocks."""
    data = b" " + text.lower().encode().translate(_LETTERS) + b" "
    for at in range(0, len(data) - 2, _BLOCK):
        a = np.frombuffer(data[at:at + _BLOCK + 2], np.uint8).astype(np.uint32)
        codes = (a[:-2] * np.uint32(0x9E3779B1) + a[1:-1] * np.uint32(0x85EBCA77) + a[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(16)
        yield codes[a[1:-1] != 32]


@dataclass
class TextModel:
    """log-probabilities, one row per trigram bucket and one column per language."""

    languages: list[str]
    table: np.ndarray

    def evidence(self, text: str | None) -> tuple[np.ndarray, int]:
        """Tempered log-likelihood for each language and for none of them; the number of trigrams."""
        total, n = np.zeros(len(self.languages) + 1), 0
        for codes in trigrams(text or ""):
            total[:-1] += self.table[codes].sum(axis=0, dtype=np.float64)
            n += len(codes)
        total[-1] = -n * np.log(BUCKETS)
        return total * TEMPER, n


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> TextModel:
    """Trigram models from about ``sample`` rows of each language (256 KB each). Null texts and labels are not labelled rows."""
    rows = labelled.select(F.col(text_col).alias("text"), F.lower(lang_col).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    sizes = counts.filter((F.col("n") >= LEAST_ROWS) | (F.col("n") >= LEAST_SHARE * counts.agg(F.sum("n")).scalar())).collect()
    sizes = {r["lang"]: r["n"] for r in sizes}
    languages = sorted(sizes)
    if not languages:
        return TextModel([], np.zeros((BUCKETS, 0), np.float32))
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample / n))])
    chosen = rows.filter(F.expr("pmod(xxhash64(text, 7), 1000000) / 1000000.0D") < F.element_at(share, F.col("lang")))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                into = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for codes in trigrams(text):
                    into += np.bincount(codes, minlength=BUCKETS)
        for lang, n in held.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": n[at]})

    found = chosen.mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = found.toPandas()  # languages x buckets at most
    n = np.zeros((BUCKETS, len(languages)))
    n[found["bucket"].to_numpy(), [languages.index(x) for x in found["lang"]]] = found["n"].to_numpy()
    whole = n.sum(axis=0)
    smooth = np.minimum(SMOOTH, SMOOTH_SHARE * np.maximum(whole, 1) / BUCKETS)
    return TextModel(languages, np.log((n + smooth) / (whole + smooth * BUCKETS)).astype(np.float32))


def declared_in_markup(html: Column) -> Column:
    """Primary language that the html tag declares, lower-case; null if none."""
    lang = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    return F.when(lang != "", lang)


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def suffix_of(host: Column) -> Column:
    return F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -1))


def _fused(model: TextModel, texts, declared, priors=None) -> dict[str, list]:
    """Posterior's best language and its probability for each row; the text's own best."""
    names = [*model.languages, UNKNOWN]
    place = {x: i for i, x in enumerate(model.languages)}
    flat = np.log(np.r_[np.full(len(model.languages), (1 - UNKNOWN_PRIOR) / max(1, len(model.languages))), UNKNOWN_PRIOR])
    out = []
    for i, (text, said) in enumerate(zip(texts, declared, strict=True)):
        score, n = model.evidence(text)
        if not n or not model.languages:
            out.append((UNKNOWN, 1.0, UNKNOWN))
            continue
        own = names[int(score.argmax())]
        at = place.get(said)
        if at is not None:
            score += np.log(DECLARED_WRONG / len(names))
            score[at] += np.log((1 - DECLARED_WRONG) * len(names) / DECLARED_WRONG)
        score += flat if priors is None or priors[i] is None else np.log(np.asarray(priors[i], float))
        if at is None and said in CODES:  # half of "none of these" is the declared language
            score[-1] += np.log(0.5)
            score = np.r_[score + np.log(DECLARED_WRONG / len(names)), score[-1] + np.log(1 - DECLARED_WRONG)]
        p = np.exp(score - score.max())
        best = int(p.argmax())
        out.append((names[best] if best < len(names) else said, float(p[best] / p.sum()), own))
    return dict(zip(("language", "probability", "text_language"), (list(x) for x in zip(*out)), strict=True)) if out else {
        "language": [], "probability": [], "text_language": []}


def host_priors(rows: DataFrame, model: TextModel) -> DataFrame:
    """(_host, _suffix, _prior): prior of each language and of none, for every host.

    ``rows``: _text, _declared, _host, _suffix. A first pass by text and
    declaration alone gives each row's language; counts of hosts are smoothed by
    their suffix's shares, these by all rows' shares. Languages without a model count as none.
    """
    names = [*model.languages, UNKNOWN]

    def first(texts: list[str], batch: pa.RecordBatch) -> dict[str, list]:
        found = _fused(model, texts, batch.column("_declared").to_pylist())["language"]
        return {"language": [x if x in model.languages else UNKNOWN for x in found]}

    counted = (add_columns(rows, {"language": "string"}, "_text", first, drop=("_text", "_declared"))
               .groupBy("_host", "_suffix", "language").agg(F.count("*").alias("n")))
    each = [F.sum(F.when(F.col("language") == x, F.col("n")).otherwise(0)).cast("double").alias(f"n{i}") for i, x in enumerate(names)]
    hosts = written(counted.groupBy("_host", "_suffix").agg(*each), "hosts")
    sums = [F.sum(f"n{i}").alias(f"s{i}") for i in range(len(names))]
    suffixes = hosts.groupBy(F.col("_suffix").alias("_of")).agg(*sums).withColumn("_sum", F.aggregate(
        F.array(*[f"s{i}" for i in range(len(names))]), F.lit(0.0), lambda a, b: a + b))
    whole = hosts.agg(*[F.sum(f"n{i}") for i in range(len(names))]).first()
    total = sum(x or 0 for x in whole)
    overall = [((x or 0) + 1) / (total + len(names)) for x in whole]
    up = F.array(*[(F.col(f"s{i}") + SUFFIX_WEIGHT * overall[i]) / (F.col("_sum") + SUFFIX_WEIGHT) for i in range(len(names))])
    suffixes = suffixes.select("_of", up.alias("_up"))
    joined = hosts.join(suffixes, hosts["_suffix"].eqNullSafe(suffixes["_of"])).withColumn("_n", F.aggregate(
        F.array(*[f"n{i}" for i in range(len(names))]), F.lit(0.0), lambda a, b: a + b))
    prior = F.array(*[(F.col(f"n{i}") + HOST_WEIGHT * F.get("_up", i)) / (F.col("_n") + HOST_WEIGHT) for i in range(len(names))])
    return joined.select(F.coalesce("_host", F.lit("")).alias("_key"), prior.alias("_prior"))


def identify(rows: DataFrame, model: TextModel, text: Column, declared: Column, host: Column, suffix: Column) -> DataFrame:
    """``rows`` with language, probability, text_language and accepted.

    Every row is returned, with its other columns; columns of those four names
    are replaced. A text without letters (null, empty, signs only) is ``und``
    with probability 1. A missing declaration, or one that is neither a model's
    nor a known code, is no evidence; rows without a host share one prior. ``accepted``: a language was found with
    probability ACCEPT or more. No labelled rows, no languages: all ``und``.
    """
    cols = [c for c in rows.columns if c not in ("language", "probability", "text_language", "accepted")]
    work = rows.select(*cols, text.alias("_text"), F.lower(declared).alias("_declared"), host.alias("_host"), suffix.alias("_suffix"))
    priors = written(host_priors(work.select("_text", "_declared", "_host", "_suffix"), model), "priors")
    size = priors.agg(F.sum(F.octet_length("_key") + 8 * (len(model.languages) + 2))).first()[0] or 0
    work = work.withColumn("_key", F.coalesce("_host", F.lit(""))).join(
        F.broadcast(priors) if size <= BROADCAST_BYTES else priors, "_key", "left").drop("_key", "_host", "_suffix")
    fields = {"language": "string", "probability": "double", "text_language": "string"}

    def make(texts: list[str], batch: pa.RecordBatch) -> dict[str, list]:
        return _fused(model, texts, batch.column("_declared").to_pylist(), batch.column("_prior").to_pylist())

    return add_columns(work, fields, "_text", make, drop=("_text", "_declared", "_prior")).withColumn(
        "accepted", (F.col("language") != UNKNOWN) & (F.col("probability") >= ACCEPT))


def identify_documents(docs: DataFrame) -> DataFrame:
    """Documents: the label is the declaration, the source is the host; an address as source gives a suffix too."""
    host = F.coalesce(host_of(F.col("source")), F.lower("source"))
    return identify(docs, train(docs), F.col("text"), F.col("lang"), host, suffix_of(host))


def identify_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    """Pages: text without markup, the html tag's declaration, the address's host and suffix."""
    text = F.regexp_replace("html", r"(?is)<(script|style)\b[^>]*+>.*?</\1\s*+>|<[^>]*+>", " ")
    host = host_of(F.col("url"))
    return identify(pages, model, text, declared_in_markup(F.col("html")), host, suffix_of(host))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_documents(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")).drop("text", "source")


def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over `pages`, with the models learned from `documents`."""
    model = train(table(spark, sf_dir, "documents", "text", "lang"))
    return identify_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"), model).drop("html")
