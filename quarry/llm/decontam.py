"""Benchmark decontamination by a positional inverted index.

Test phrases are the windows of ten consecutive words of each benchmark item
(the whole item if it is shorter).  One pass over the training texts counts how
long the posting list of each test term would be; the two rarest terms of each
phrase become its anchors, and a second pass stores the postings
``(term, document, position)`` of the anchor terms.  A phrase is looked up from
its rarest list: a posting at ``position`` with term offset ``o`` proposes a
start, the second list, shifted by its own offset, must hold the same start, and
the words around the posting then decide exactly.  ``proximity`` intersects the
same lists with a slack instead of an equal start.

The terms of the benchmark are broadcast to the scan only if their counted rows
stay under ``common.BROADCAST_ROWS``; beyond that the scan is joined by a
shuffle.  Posting lists of frequent terms are ordinary skewed join sides; no
list is ever gathered into a row.

Defined results: a null or empty text or item has no words; items without an id
are left out; items repeated under one id count once and all their phrases
belong to it; repeated rows of a document get the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower, materialize, null_safe, small_side, with_text_hash, words_of

#: Separators: everything but 0-9, a-z and non-ASCII, after lower-casing A-Z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASE = 10


def phrase_words(text: str):
    return words_of(ascii_lower(F.coalesce(F.col(text), F.lit(""))), SEPARATORS)


def test_phrases(benchmark: DataFrame, size: int = PHRASE) -> DataFrame:
    """``phrase, terms, item_id``: distinct phrases of each item."""
    items = benchmark.where("item_id is not null").select("item_id", phrase_words("text").alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    return (items.where(F.size("w") > 0).select("item_id", "w", F.explode(starts).alias("i"))
            .select("item_id", F.slice("w", F.col("i") + 1, size).alias("terms"))
            .select("item_id", "terms", F.array_join("terms", " ").alias("phrase")).distinct())


def anchors(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """Per phrase its length and its two rarest terms with their offsets.

    Phrases with a term that no document holds cannot occur and are left out.
    The second anchor of a one-word phrase is the first one again.
    """
    terms = phrases.select("phrase", "terms").distinct().select(
        "phrase", F.size("terms").alias("k"), F.posexplode("terms").alias("off", "term"))
    vocabulary = materialize(terms.select("term").distinct(), "test_terms")
    seen = docs.select(F.explode(phrase_words("text")).alias("term"))
    lengths = seen.join(small_side(vocabulary), "term").groupBy("term").agg(F.count("*").alias("n"))
    rarest = Window.partitionBy("phrase").orderBy(F.col("n").asc_nulls_first(), "term", "off")
    ranked = terms.join(lengths, "term", "left").select(
        "phrase", "k", F.struct("off", "term", "n").alias("a"), F.row_number().over(rarest).alias("rank"))
    return (ranked.groupBy("phrase", "k").agg(
        F.max(F.when(F.col("rank") == 1, F.col("a"))).alias("a1"), F.max(F.when(F.col("rank") == 2, F.col("a"))).alias("a2"))
        .where(F.col("a1.n").isNotNull())
        .select("phrase", "k", F.col("a1.term").alias("term1"), F.col("a1.off").alias("off1"),
                F.coalesce("a2.term", "a1.term").alias("term2"), F.coalesce("a2.off", "a1.off").alias("off2")))


def postings(docs: DataFrame, anchor: DataFrame, size: int = PHRASE) -> DataFrame:
    """``term, doc_id, th, pos, n, around`` of the anchor terms (a written table).

    ``around`` holds the words within a phrase length of a first anchor, from
    position ``lo``; it is null in lists that only serve as second anchors.
    """
    wanted = anchor.select(F.col("term1").alias("term"), F.lit(1).alias("first")).union(
        anchor.select("term2", F.lit(0))).groupBy("term").agg(F.max("first").alias("first"))
    wanted = materialize(wanted, "anchor_terms")
    w = with_text_hash(docs).select("doc_id", "th", phrase_words("text").alias("w"))
    found = w.select("doc_id", "th", "w", F.posexplode("w").alias("pos", "term")).join(small_side(wanted), "term")
    lo = F.greatest(F.col("pos") - (size - 1), F.lit(0))
    return materialize(found.select(
        "term", "doc_id", "th", "pos", F.size("w").alias("n"), lo.alias("lo"),
        F.when(F.col("first") == 1, F.slice("w", lo + 1, 2 * size - 1)).alias("around")), "postings")


def _lookup(docs: DataFrame, phrases: DataFrame, size: int):
    """``(anchor, index, first, second)``: proposed starts by the first lists, as
    narrow rows, and the second lists."""
    anchor = materialize(anchors(docs, phrases).withColumn("pid", F.monotonically_increasing_id()), "anchors")
    index = postings(docs, anchor, size)
    start = F.col("pos") - F.col("off1")
    first = index.where("around is not null").join(small_side(anchor, 200), F.col("term") == F.col("term1")).select(
        "doc_id", "th", "pid", "k", "n", "pos", "term2", "off2", start.alias("start"))
    second = index.select(F.col("term").alias("s_term"), F.col("doc_id").alias("s_id"), F.col("th").alias("s_th"),
                          F.col("pos").alias("s_pos"))
    return anchor, index, first, second


def exact_matches(docs: DataFrame, phrases: DataFrame, size: int = PHRASE) -> DataFrame:
    """``doc_id, th, phrase, start, k``: every exact occurrence of a phrase."""
    anchor, index, first, second = _lookup(docs, phrases, size)
    both = first.where("start >= 0 and start + k <= n").join(
        second, (F.col("term2") == F.col("s_term")) & F.col("doc_id").eqNullSafe(F.col("s_id"))
        & (F.col("th") == F.col("s_th")) & (F.col("start") + F.col("off2") == F.col("s_pos")), "left_semi")
    both = materialize(both.select("doc_id", "th", "pid", "start", F.col("pos").alias("b_pos")), "intersected")
    both = both.join(small_side(anchor, 200).select("pid", "phrase", "k", "term1"), "pid").select(
        F.col("doc_id").alias("b_id"), F.col("th").alias("b_th"), "phrase", "k", "term1", "start", "b_pos")
    # Only the survivors meet the words around their posting.
    words = small_side(both, 250)
    found = index.where("around is not null").join(
        words, (F.col("term") == F.col("term1")) & F.col("doc_id").eqNullSafe(F.col("b_id"))
        & (F.col("th") == F.col("b_th")) & (F.col("pos") == F.col("b_pos")))
    same = F.array_join(F.slice("around", F.col("start") - F.col("lo") + 1, F.col("k")), " ") == F.col("phrase")
    return found.where(same).select("doc_id", "th", "phrase", "start", "k").distinct()


def proximity_matches(docs: DataFrame, phrases: DataFrame, slack: int = 3, size: int = PHRASE) -> DataFrame:
    """``doc_id, th, phrase, start``: places where the two rarest terms of a
    phrase stand within ``slack`` words of their distance in it."""
    anchor, _, first, second = _lookup(docs, phrases, size)
    near = first.join(small_side(anchor, 200).select("pid", "phrase"), "pid").select(
        "doc_id", "th", "phrase", "start", "term2", F.explode(F.sequence(
        F.col("start") + F.col("off2") - slack, F.col("start") + F.col("off2") + slack)).alias("at"))
    return near.join(second, (F.col("term2") == F.col("s_term")) & F.col("doc_id").eqNullSafe(F.col("s_id"))
                     & (F.col("th") == F.col("s_th")) & (F.col("at") == F.col("s_pos")), "left_semi").select(
        "doc_id", "th", "phrase", "start").distinct()


def _hits(docs: DataFrame, benchmark: DataFrame, size: int):
    phrases = materialize(test_phrases(benchmark, size), "test_phrases")
    return phrases, materialize(exact_matches(docs, phrases, size), "phrase_hits")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = PHRASE) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    docs = docs.select("doc_id", "text")
    phrases, hits = _hits(docs, benchmark, size)
    # Words under occurrences: union of [start, start + k) per document.
    spans = hits.groupBy("doc_id", "th", "start").agg(F.max("k").alias("k"))
    before = Window.partitionBy("doc_id", "th").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("k")
    fresh = end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0)))
    covered = (spans.select("doc_id", "th", F.greatest(fresh, F.lit(0)).alias("fresh"))
               .groupBy("doc_id", "th").agg(F.sum("fresh").cast("long").alias("n_hit")))
    items = (hits.select("doc_id", "th", "phrase").distinct().join(phrases.select("phrase", "item_id"), "phrase")
             .select("doc_id", "th", F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy("doc_id", "th").agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item")).alias("items")))
    marked = materialize(covered.join(items, null_safe(covered, items, "doc_id", "th")).select(
        covered["doc_id"].alias("m_id"), covered["th"].alias("m_th"), "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("sha")), "contaminated")
    a = with_text_hash(docs).select("doc_id", "th", F.size(phrase_words("text")).cast("long").alias("n_words"))
    zero = F.lit(0).cast("long")
    return a.join(marked, a["doc_id"].eqNullSafe(marked["m_id"]) & (a["th"] == marked["m_th"]), "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = PHRASE) -> DataFrame:
    """Rows of ``docs`` without any test phrase."""
    _, hits = _hits(docs.select("doc_id", "text"), benchmark, size)
    bad = materialize(hits.select(F.col("doc_id").alias("m_id"), F.col("th").alias("m_th")).distinct(), "contaminated")
    a = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", F.xxhash64("text").alias("th"))
    bad = small_side(bad)
    return a.join(bad, a["doc_id"].eqNullSafe(bad["m_id"]) & (a["th"] == bad["m_th"]), "left_anti").select("doc.*")
