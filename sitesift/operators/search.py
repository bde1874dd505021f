"""Ranked retrieval for a table of queries.

Plan, per `search_many`:
  queries → clauses (query, word, field, term, min_sim, boost)       narrow
  distinct clause terms ⋈ vocabulary on (length, segment no, segment)  equi-join;
      levenshtein with a threshold verifies; every match counts
  asked terms ⋈ postings on (field, term)                            postings that match
      any clause, of documents that pass the filters, are shuffled once, by path
  clause expansions ⋈ these on the term's number                     broadcast; the matches
      of a document arise in its task
  per (query, word, path) then per (query, path) sums with coord     hash aggregates, no shuffle
  totals: grouped count; page: top-k window or a distributed global rank
Scores follow SURVEY 2.11: w = sqrt(tf) * idf^2 * boost * fuzzy_weight * norm,
idf = 1 + ln(N / (df + 1)); coord per word (matched fields / 3) and per query
(matched clauses / all clauses).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as TX
from ..session import stored
from .index import SearchIndex
from .sizing import BROADCAST_MAX_ROWS, fits_broadcast

# Fixed values of the reference's full-text query: per-word field boosts, the
# whole query's extra boost when it has several words, and the minimum
# similarities.
CONTENT_BOOST = 1.0
NAME_BOOST = 1.5
DESCRIPTION_BOOST = 1.1
MULTI_WORD_EXTRA_BOOST = 0.7
WHOLE_QUERY_MIN_SIM = 0.5
WORD_MIN_SIM = 0.7

#: Matches (query, word, field, term, document) that a scoring task gets.
TASK_MATCHES = 1_000_000


@dataclass
class SearchOptions:
    min_sim: float = WHOLE_QUERY_MIN_SIM
    boost_title: float = NAME_BOOST
    stop_words: Sequence[str] = ()
    escape: bool = False  # quirk Q9: escape query syntax in the raw term
    fields: Sequence[tuple[str, float]] | None = None  # (field, base boost); None = the three defaults
    languages: Sequence[str] = ()
    template: str | None = None  # template short id
    # {"short_id", "database", "language", "section_short_id"}; with "interval" and "section_interval", the (enter,
    # leave) of tree.tour_intervals, documents that have an `item_enter` are filtered by range instead of by path
    root_item: dict | None = None
    show_hidden: bool = False
    ignore_editor_options: bool = False
    user: str | None = None
    user_boost: float = 1.0
    start: int | None = None
    count: int | None = None
    sort: Sequence[Column] | None = None
    extra_filters: Sequence[Column] = field(default_factory=tuple)


def _fields_col(opts: SearchOptions) -> Column:
    """Literal array of (field, base boost, gets the title boost), three by default."""
    if opts.fields is not None:
        rows = [(f, float(b), False) for f, b in opts.fields]
    else:
        rows = [("content", CONTENT_BOOST, False), ("name", opts.boost_title, True),
                ("description", DESCRIPTION_BOOST, False)]
    return F.array(*[F.struct(F.lit(f).alias("field"), F.lit(float(b)).alias("base_boost"), F.lit(t).alias("is_title"))
                     for f, b, t in rows])


def split_query(queries: DataFrame, q: str = "q", stop_words: Sequence[str] = ()) -> DataFrame:
    """(query_id, word_no 1.., word) for queries that contain a blank;
    words split on blanks, empties removed, stop words (lower case) dropped."""
    words = F.split(F.col(q), " ")
    if stop_words:
        stop = F.array(*[F.lit(w) for w in stop_words])
        keep = lambda x: (x != "") & ~F.array_contains(stop, F.lower(x))
    else:
        keep = lambda x: x != ""
    multi = queries.filter(F.col(q).contains(" "))
    return multi.select("query_id", F.posexplode(F.filter(words, keep)).alias("pos", "word")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("word_no"), "word")


def full_text_clauses(queries: DataFrame, opts: SearchOptions | None = None, q: str = "q") -> DataFrame:
    """(query_id, word_no, field, term, min_sim, boost, n_clauses).

    word 0 is the whole query (min .5, extra boost .7 when it has several
    words, default title boost); words 1.. are its words (min .7, no extra,
    the caller's title boost). Each word is OR-ed over three fields.
    """
    opts = opts or SearchOptions()
    qs = queries.filter(F.col(q).isNotNull() & (F.col(q) != ""))
    words = split_query(qs, q, opts.stop_words)
    n_words = words.groupBy("query_id").agg(F.count(F.lit(1)).alias("nw"))
    term = (lambda c: TX.escape_term(c)) if opts.escape else (lambda c: F.lower(c))
    multi = F.col(q).contains(" ")
    whole = qs.select(
        "query_id", F.lit(0).alias("word_no"), term(F.col(q)).alias("term"),
        F.lit(float(opts.min_sim)).alias("min_sim"),
        F.when(multi, F.lit(MULTI_WORD_EXTRA_BOOST)).otherwise(F.lit(0.0)).alias("extra"),
        F.lit(True).alias("is_whole"))
    per_word = words.select(
        "query_id", "word_no", term(F.col("word")).alias("term"), F.lit(WORD_MIN_SIM).alias("min_sim"),
        F.lit(0.0).alias("extra"), F.lit(False).alias("is_whole"))
    words_all = whole.unionByName(per_word)
    c = words_all.select("*", F.inline(_fields_col(opts)))
    boost = F.when(F.col("is_title") & F.col("is_whole"), F.lit(NAME_BOOST)).otherwise(F.col("base_boost")) + F.col("extra")
    c = c.select("query_id", "word_no", "field", "term", F.col("min_sim").cast("double"), boost.alias("boost"))
    c = c.join(n_words, "query_id", "left").withColumn(
        "n_clauses", (F.lit(1) + F.coalesce(F.col("nw"), F.lit(0))).cast("int")).drop("nw")
    return c


def _float(x) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("float")


def fuzzy_similarity_ok(dist: Column, len_a: Column, len_b: Column, min_sim: Column) -> Column:
    """sim = 1 - d / min(len) computed in single precision, accepted iff > min."""
    mn = F.least(len_a, len_b)
    sim = _float(F.lit(1.0)) - _float(dist / mn)
    return (dist >= 0) & (sim > _float(min_sim))


def _segments() -> Column:
    """Array of (no, start, size): the segments of a vocabulary term of `vlen` characters, one more than the
    `tau` edits that a match may have; starts count from 1."""
    parts = F.col("tau") + 1
    cut = lambda i: F.floor(i * F.col("vlen") / parts).cast("int")
    return F.transform(F.sequence(F.lit(0), F.col("tau")), lambda i: F.struct(
        i.alias("no"), (cut(i) + 1).alias("start"), (cut(i + 1) - cut(i)).alias("size")))


def _tau() -> Column:
    """Edits that a match with a vocabulary term of `vlen` characters has at most."""
    return F.least(F.floor((F.lit(1.0) - F.col("min_sim")) * F.col("vlen")).cast("int"), F.col("vlen") - 1)


def expand_terms(terms: DataFrame, term_df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Match clause terms (field, term, min_sim) to the vocabulary.

    Returns (field, term, min_sim, vterm, df, weight). A term whose length is
    at most 1/(1-min) can only match exactly (weight 1); longer terms match
    every vocabulary term v with levenshtein(term, v) <= k =
    int((1-min)*min(len)) and similarity > min, weight (sim-min)/(1-min). All
    matches are returned.

    Matching runs once over distinct terms, whatever their fields, as one
    equi-join for any length and any number of edits: a vocabulary term of
    length l that allows tau edits is cut into tau + 1 segments. Of a match one
    segment stands unchanged in the query term; segment i is shifted by at most
    i places counted from the left and tau - i from the right. The query terms
    give their substrings at those places for the lengths that the vocabulary
    has. `levenshtein` with threshold k verifies the candidates; matches then
    take their fields and document frequencies.
    """
    t = terms.select("field", "term", "min_sim").distinct().withColumn("L", F.length("term"))
    long_enough = F.coalesce(F.col("L").cast("double") > F.try_divide(F.lit(1.0), F.lit(1.0) - F.col("min_sim")), F.lit(False))  # never at 1.0
    t = t.withColumn("fuzzy", long_enough)
    vocab = term_df.select("field", F.col("term").alias("vterm"), "df")
    exact = (t.filter(~F.col("fuzzy")).join(vocab, (t.field == vocab.field) & (t.term == vocab.vterm))
             .select(t.field, "term", "min_sim", "vterm", "df", F.lit(1.0).alias("weight")))

    fz = t.filter("fuzzy").select("term", "min_sim", "L").distinct()
    sims = sorted(r[0] for r in fz.select("min_sim").distinct().collect())  # options of the call, not data
    if not sims:
        return exact
    words = vocab.select("vterm").distinct().withColumn("vlen", F.length("vterm"))
    pieces = words.withColumn("min_sim", F.explode(F.array(*[F.lit(x) for x in sims]))).withColumn("tau", _tau())
    pieces = pieces.select("vterm", "vlen", "min_sim", F.explode(_segments()).alias("s")).select(
        "vterm", "vlen", "min_sim", F.col("s.no").alias("no"), F.substring("vterm", F.col("s.start"), F.col("s.size")).alias("piece"))
    lengths = words.select("vlen").distinct()
    k = F.floor((F.lit(1.0) - F.col("min_sim")) * F.least("L", "vlen")).cast("int")
    reach = F.floor((F.lit(1.0) - F.col("min_sim")) * F.col("L")).cast("int")
    asked = fz.withColumn("vlen", F.explode(F.sequence(F.greatest(F.col("L") - reach, F.lit(1)), F.col("L") + reach)))
    asked = asked.join(F.broadcast(lengths) if fits_broadcast(lengths, max_rows) else lengths, "vlen").withColumn("k", k)
    asked = asked.filter(F.abs(F.col("L") - F.col("vlen")) <= F.col("k")).withColumn("tau", _tau())
    asked = asked.select("*", F.explode(_segments()).alias("s")).select("term", "min_sim", "L", "vlen", "k", "tau", "s.*")
    shift, right = F.col("L") - F.col("vlen"), F.col("tau") - F.col("no")
    lo = F.greatest(F.col("start") - F.col("no"), F.col("start") + shift - right, F.lit(1))
    hi = F.least(F.col("start") + F.col("no"), F.col("start") + shift + right, F.col("L") - F.col("size") + 1)
    asked = asked.withColumn("lo", lo).withColumn("hi", hi).filter(F.col("lo") <= F.col("hi"))
    asked = asked.select("term", "min_sim", "L", "vlen", "k", "no", F.explode(F.array_distinct(F.transform(
        F.sequence("lo", "hi"), lambda i: F.substring("term", i, F.col("size"))))).alias("piece"))
    cand = pieces.join(asked, ["min_sim", "vlen", "no", "piece"])
    cand = cand.withColumn("dist", F.call_function("levenshtein", F.col("term"), F.col("vterm"), F.col("k"))).filter(
        fuzzy_similarity_ok(F.col("dist"), F.col("L"), F.col("vlen"), F.col("min_sim")))
    sim = F.lit(1.0) - F.col("dist") / F.least("L", "vlen")
    found = cand.select("term", "min_sim", "vterm", ((sim - F.col("min_sim")) / (F.lit(1.0) - F.col("min_sim"))).alias("weight")).distinct()
    found = found.checkpoint(eager=True)
    fuzzy = t.filter("fuzzy").select("field", "term", "min_sim").join(found, ["term", "min_sim"]).join(vocab, ["field", "vterm"])
    return exact.unionByName(fuzzy.select(*exact.columns))


def weighted_terms(expanded: DataFrame, n_docs) -> DataFrame:
    """Clause expansions with `weight` in place of document frequency and boost: times a posting's impact it is a contribution."""
    idf = F.lit(1.0) + F.log(n_docs / (F.col("df") + F.lit(1)))
    return expanded.withColumn("weight", idf * idf * F.col("qboost")).drop("qboost")


def document_matches(postings: DataFrame, expanded: DataFrame, kept: DataFrame | None = None, dead: DataFrame | None = None,
                     max_rows: int = BROADCAST_MAX_ROWS, per_task: int = TASK_MATCHES, pairs: DataFrame | None = None) -> DataFrame:
    """One row (query_id, word_no, n_clauses, field, path, w) per expansion and posting, partitioned by path.

    ``postings``: (field, vterm, path, impact and, with ``dead``, seq); ``expanded``: (query_id, word_no, n_clauses,
    field, vterm, df, weight). Only the postings of the asked terms are shuffled, once, by document and under a number
    for the term; each then meets its expansions in the task of its document, so that neither the matches nor
    their sums are ever shuffled. Tasks get about ``per_task`` matches, whatever the size. Beyond the broadcast's
    bound the expansions of the most frequent terms are still broadcast; the others, with few postings each, meet theirs
    before the shuffle. Only the matches of the (query_id, path) in ``pairs`` count, if given.
    """
    spark = postings.sparkSession
    asked = expanded.groupBy("field", "vterm").agg(F.count("*").alias("_n"), F.first("df").alias("df"))
    asked = asked.withColumn("tno", F.monotonically_increasing_id()).checkpoint(eager=True)
    rows, matches = asked.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum(F.col("_n") * F.col("df")), F.lit(0))).first()
    frequent, rest = asked, None
    if rows > max_rows:
        # the terms in the order of their frequency, as many as have max_rows expansions
        at = asked.groupBy("df").agg(F.sum("_n").alias("_n")).select("df", F.sum("_n").over(Window.orderBy(F.desc("df"))).alias("_upto"))
        least = at.filter(F.col("_upto") <= max_rows).agg(F.min("df")).first()[0]
        common = F.lit(False) if least is None else F.col("df") >= least
        frequent, rest = asked.filter(common), asked.filter(~common)
    carried = ["path", "seq"] if dead is not None else ["path"]
    own = ["query_id", "word_no", "n_clauses", "weight"]
    terms = asked.select("field", "vterm", (F.col("tno") if rest is None else F.when(common, F.col("tno"))).alias("tno"))
    met = postings.join(F.broadcast(terms) if fits_broadcast(terms, max_rows) else terms, ["field", "vterm"])
    if rest is not None:
        met = met.join(expanded.join(rest.select("field", "vterm"), ["field", "vterm"], "left_semi").select("field", "vterm", *own), ["field", "vterm"], "left")
    else:
        met = met.select("*", *[F.lit(None).cast(expanded.schema[c].dataType).alias(c) for c in own])
    met = met.select(*carried, "field", "tno", "impact", *own)
    if dead is not None:
        # an anti join would be pushed below the join with the query's terms, to all postings
        met = met.join(dead.withColumn("_dead", F.lit(True)), carried, "left").filter(F.col("_dead").isNull()).drop("_dead", "seq")
    if kept is not None:
        met = met.join(kept, "path", "left_semi")
    cores = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(-(-matches // per_task), min(cores, -(-matches * 20 // per_task)), 1)
    met = met.repartition(parts, "path")
    here = expanded.join(frequent.select("field", "vterm", "tno"), ["field", "vterm"]).select("tno", *[F.col(c).alias(f"_{c}") for c in own]).checkpoint(eager=True)
    j = met.join(F.broadcast(here), "tno", "left")
    j = j.select("field", "path", "impact", *[F.coalesce(f"_{c}", c).alias(c) for c in own])
    if pairs is not None and fits_broadcast(pairs, max_rows):
        j = j.join(F.broadcast(pairs.select("query_id", "path")), ["query_id", "path"], "left_semi")
    elif pairs is not None:
        # a join on both columns would shuffle the matches; a document's queries meet it by path alone
        asking = pairs.groupBy("path").agg(F.collect_set("query_id").alias("_asking")).repartition(parts, "path")
        j = j.join(asking.hint("shuffle_hash"), "path").filter(F.array_contains("_asking", F.col("query_id")))
    fields = sorted(r[0] for r in asked.select("field").distinct().collect())  # options of the call, not data
    bits = F.array_position(F.array(*[F.lit(f) for f in fields]), F.col("field")) if fields else F.lit(1)
    fbit = [F.call_function("shiftleft", F.lit(1).cast("long"), (bits - 1).cast("int")).alias("fbit")] if len(fields) < 64 else []
    return j.select("query_id", "word_no", "n_clauses", "field", "path", (F.col("impact") * F.col("weight")).alias("w"), *fbit)


def clause_matches(clauses: DataFrame, index: SearchIndex, max_rows: int = BROADCAST_MAX_ROWS, kept: DataFrame | None = None) -> DataFrame:
    """G10/G11 input: one scored row per (query, word, field, expanded term, path), of the paths in ``kept`` if given;
    all rows of a path are in one partition."""
    exp = expand_terms(clauses, index.term_df, max_rows)
    ce = clauses.join(exp, ["field", "term", "min_sim"]).select(
        "query_id", "word_no", "n_clauses", "field", "vterm", "df", (F.col("boost") * F.col("weight")).alias("qboost"))
    n_docs = F.lit(index.total) if index.total is not None else index.n_docs.scalar()
    ce = weighted_terms(ce, n_docs).checkpoint(eager=True)
    version = ["path", "seq"] if index.dead is not None else ["path"]
    post = index.postings.select("field", F.col("term").alias("vterm"), *version, (F.sqrt("tf") * F.col("norm")).alias("impact"))
    return document_matches(post, ce, kept, index.dead, max_rows)


def score_hits(matches: DataFrame, n_fields: int = 3) -> DataFrame:
    """(query_id, path, score). SHOULD semantics: a document matching
    any clause is a hit; coord per word (matched fields / all) and per query
    (words / all).

    The matches of a path are in one partition, so the sums need no shuffle. A
    word's fields are the bits of `fbit`; without it they take a sum of their own.
    """
    if "fbit" in matches.columns:
        per_word = matches.groupBy("query_id", "path", "word_no").agg(
            F.sum("w").alias("sw"), F.bit_count(F.bit_or("fbit")).alias("nf"), F.first("n_clauses").alias("n_clauses"))
    else:
        per_field = matches.groupBy("query_id", "path", "word_no", "field").agg(
            F.sum("w").alias("sf"), F.first("n_clauses").alias("n_clauses"))
        per_word = per_field.groupBy("query_id", "path", "word_no").agg(
            F.sum("sf").alias("sw"), F.count(F.lit(1)).alias("nf"), F.first("n_clauses").alias("n_clauses"))
    per_word = per_word.withColumn("ws", F.col("sw") * F.col("nf") / F.lit(float(n_fields)))
    return per_word.groupBy("query_id", "path").agg(
        (F.sum("ws") * F.count(F.lit(1)) / F.first("n_clauses")).alias("score"))


def _below(cols: set[str], root: dict, item: str, interval: str) -> Column:
    """The document's item is the root's or below it: a range of tour numbers, or the id in the item's path."""
    if root.get(interval) is not None and "item_enter" in cols:
        return F.col("item_enter").between(*root[interval])
    return F.array_contains(F.split(F.lower(F.coalesce(F.col("item_path"), F.lit(""))), " "), root[item].lower())


def doc_filter(docs: DataFrame, opts: SearchOptions) -> Column:
    """G12-G16 as one predicate over document attributes."""
    cond = F.lit(True)
    cols = set(docs.columns)
    langs = [x.lower() for x in opts.languages]
    root = opts.root_item
    if root is not None:
        cond = cond & _below(cols, root, "short_id", "interval")
        cond = cond & (F.lower(F.col("db")) == root["database"].lower())
        if not langs:
            langs = [root["language"].lower()]
        if not opts.ignore_editor_options and root.get("section_short_id"):
            cond = cond & _below(cols, root, "section_short_id", "section_interval")
    if langs:
        cond = cond & F.lower(F.col("language")).isin(langs)
    if not opts.ignore_editor_options and not opts.show_hidden and "hidden" in cols:
        cond = cond & ~F.coalesce(F.col("hidden"), F.lit(False))
    if opts.template:
        cond = cond & (F.lower(F.col("template")) == opts.template.lower())
    for extra in opts.extra_filters:
        cond = cond & extra
    return cond


def filtered_docs(index: SearchIndex, opts: SearchOptions) -> DataFrame:
    d = index.docs
    out = d.filter(doc_filter(d, opts))
    keep = ["path"]
    if opts.user is not None and "creator" in d.columns:
        ub = (F.when(F.col("creator") == opts.user, opts.user_boost).otherwise(0.0)
              + F.when(F.col("editor") == opts.user, opts.user_boost).otherwise(0.0))
        out = out.withColumn("user_score", ub)
        keep.append("user_score")
    return out.select(*keep)


def rank_hits(hits: DataFrame, start: int | None, count: int | None, sort: Sequence[Column] | None = None) -> DataFrame:
    """Add 0-based `position` per query and keep the requested slice.

    A bounded slice (start and count given) is a per-query top-k: Spark turns
    the filter on the bare row number into a WindowGroupLimit, so at most
    start + count rows per query and task reach the shuffle. Otherwise every hit
    is numbered with a distributed global sort: range partitions over (query,
    score, path), row numbers inside a partition, and per-(partition, query)
    offsets from a small summary, so a query with a huge hit list is spread over
    many tasks; the hits are stored first, as the ranges are found in a pass of their own. Ties go by path, a caller's order included.
    """
    order = [*sort, F.col("path").asc()] if sort else [F.round("score", 9).desc(), F.col("path").asc()]
    if start is not None and count is not None:
        w = Window.partitionBy("query_id").orderBy(*order)
        r = hits.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= start + count)
        return r.withColumn("position", (F.col("_rn") - 1).cast("bigint")).filter(F.col("_rn") > start).drop("_rn")
    s = stored(hits).repartitionByRange("query_id", *order).sortWithinPartitions("query_id", *order)
    s = s.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    s = stored(s)
    summ = s.groupBy("_pid", "query_id").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    wq = Window.partitionBy("query_id").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("_before", F.coalesce(F.sum("_n").over(wq), F.lit(0)))
    summ = F.broadcast(summ) if fits_broadcast(summ) else summ
    r = s.join(summ, ["_pid", "query_id"]).withColumn("position", F.col("_mid") - F.col("_first") + F.col("_before"))
    r = r.drop("_pid", "_mid", "_first", "_n", "_before")
    if start is not None:
        r = r.filter(F.col("position") >= start)
    return r


def total_hits(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """(query_id, total) for every query; 0 for empty/null queries."""
    t = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("total"))
    return queries.select("query_id").join(t, "query_id", "left").select(
        "query_id", F.coalesce(F.col("total"), F.lit(0)).cast("bigint").alias("total"))


def _has_filter(opts: SearchOptions, docs: DataFrame) -> bool:
    return bool(opts.root_item is not None or opts.languages or opts.template or opts.extra_filters or opts.user is not None
                or (not opts.ignore_editor_options and not opts.show_hidden and "hidden" in docs.columns))


def hits_for(queries: DataFrame, index: SearchIndex, opts: SearchOptions | None = None, q: str = "q") -> DataFrame:
    """All hits (query_id, path, score) after filters, before paging. Without a filter no document is read."""
    opts = opts or SearchOptions()
    clauses = full_text_clauses(queries, opts, q)
    n_fields = len(opts.fields) if opts.fields is not None else 3
    if not _has_filter(opts, index.docs):
        return score_hits(clause_matches(clauses, index), n_fields)
    fdocs = filtered_docs(index, opts).checkpoint(eager=True)
    scores = score_hits(clause_matches(clauses, index, kept=fdocs.select("path")), n_fields)
    if "user_score" not in fdocs.columns:
        return scores
    return scores.join(fdocs, "path").withColumn("score", F.col("score") + F.col("user_score")).drop("user_score")


def result_rows(ranked: DataFrame, index: SearchIndex, totals: DataFrame) -> DataFrame:
    """(query_id, position, path, title, description, relevance, total).
    Only the paged hits meet the index's narrow result table. The reference's
    result 'Score' is the position; relevance is kept beside it."""
    return (ranked.select("query_id", "position", "path", "score").join(index.result_table, "path", "left").join(totals, "query_id")
            .select("query_id", "position", "path", "title", "description",
                    F.round("score", 6).alias("relevance"), "total"))


def search_many(queries: DataFrame, index: SearchIndex, opts: SearchOptions | None = None, q: str = "q") -> DataFrame:
    """The whole search for a table of queries (query_id, q). The hits are
    computed once, for totals and ranking. `opts.sort` may name document columns."""
    opts = opts or SearchOptions()
    hits = stored(hits_for(queries, index, opts, q))
    totals = total_hits(queries, hits)
    found = hits
    if opts.sort:
        found = hits.join(index.docs.drop("score", "query_id"), "path")
    return result_rows(rank_hits(found, opts.start, opts.count, opts.sort), index, totals)


def match_all(index: SearchIndex, opts: SearchOptions | None = None, query_id: int = 0) -> DataFrame:
    """One request without a text clause: every document passing the
    filters is a hit with score 1 (so the order is by path)."""
    opts = opts or SearchOptions()
    fdocs = filtered_docs(index, opts)
    hits = fdocs.select(F.lit(query_id).cast("bigint").alias("query_id"), "path", F.lit(1.0).alias("score"))
    totals = hits.groupBy("query_id").agg(F.count(F.lit(1)).cast("bigint").alias("total"))
    return result_rows(rank_hits(hits, opts.start, opts.count, opts.sort), index, totals)
