"""Quality rules: a learned decision list over text statistics.

``document_stats`` computes the statistics with built-in functions, inside each
row and without a shuffle.  ``learn_rules`` grows a decision list by sequential
covering: a rule is a conjunction of thresholds, grown by FOIL gain on two
thirds of the labelled rows, pruned on the remaining third, and kept only if it
is precise there; the rows it covers are then set aside.  Every step is one
grouped count over the labelled statistics, of which the driver sees
``features x cuts`` numbers.  ``verdict`` turns the list into one ordered Spark
conditional expression.

Defined results: a null or empty text has no words and fails the base rule;
labels without a quality or document are left out; a document with several
labels counts as bad if any of them says so; with no labelled rows the list is
empty and only the base rule decides; repeated rows get the same verdict.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize, small_side, total, with_text_hash, words_of

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share",
            "mark_share", "digit_share", "distinct_share", "words_per_line"]
WINDOW = 5


@dataclass(frozen=True)
class Condition:
    feature: str
    at_most: bool
    cut: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c <= F.lit(self.cut) if self.at_most else c > F.lit(self.cut)


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    bad: int
    good: int

    def column(self) -> Column:
        cond = self.conditions[0].column()
        for c in self.conditions[1:]:
            cond = cond & c.column()
        return cond


def document_stats(docs: DataFrame, text: str = "text", name: str = "_q") -> DataFrame:
    """``docs`` with a struct column ``name`` of base statistics and features.

    The row travels as one struct meanwhile, so no column of ``docs`` can clash
    with the working columns.
    """
    a = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                    F.coalesce(F.col(text), F.lit("")).alias("t"))
    a = a.withColumn("w", words_of(F.col("t")))

    def count_of(cls: str) -> Column:
        return F.char_length(F.regexp_replace("t", f"[^{cls}]+", "")).cast("long")

    a = a.select("doc", "w", F.transform("w", lambda w: F.xxhash64(w)).alias("h"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("l"),
                 F.char_length("t").alias("chars"), count_of("#*$%&|<>").alias("n_symbols"),
                 count_of("A-Z").alias("upper"), count_of("!?").alias("marks"), count_of("0-9").alias("digits"))
    # Windows of five words, as hashes of their words' hashes.
    last = F.size("h") - (WINDOW - 1)
    a = a.withColumn("win", F.when(last > 0, F.transform(
        F.slice("h", 1, F.greatest(last, F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get("h", i + k) for k in range(1, WINDOW)]))).otherwise(
        F.array().cast("array<bigint>")))
    # Only a text that repeats a window at all sorts its windows.
    a = a.withColumn("s", F.when(F.size(F.array_distinct("win")) < F.size("win"), F.sort_array(
        F.transform("win", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>")))
    a = a.withColumn("p", F.sort_array(F.transform(F.filter(
        "s", lambda x, i: (x["h"] == F.get("s", i - 1)["h"]) | (x["h"] == F.get("s", i + 1)["h"])),
        lambda x: x["i"])))
    repeated = total(F.transform("p", lambda x, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get("p", i + 1) - x, F.lit(WINDOW)))))
    a = a.select("doc", F.size("w").cast("long").alias("n_words"),
                 F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"), "n_symbols",
                 (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
                 repeated.alias("n_repeat_words"), F.size("l").alias("lines"), "chars", "upper", "marks", "digits",
                 F.size(F.array_distinct("h")).alias("distinct"))

    def share(x: str, of: str) -> Column:
        return F.col(x).cast("double") / F.greatest(F.col(of), F.lit(1))

    return a.select("doc.*", F.struct(
        *STATS, share("word_chars", "n_words").alias("mean_word"), share("n_symbols", "chars").alias("symbol_share"),
        share("n_dup_lines", "lines").alias("dup_line_share"), share("n_repeat_words", "n_words").alias("repeat_share"),
        share("upper", "chars").alias("upper_share"), share("marks", "chars").alias("mark_share"),
        share("digits", "chars").alias("digit_share"), share("distinct", "n_words").alias("distinct_share"),
        share("n_words", "lines").alias("words_per_line")).alias(name))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (n_repeat_words * 100 > n_words * 20)


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Features and the 0/1 label ``bad`` of the labelled documents.

    ``stats`` has ``doc_id`` and the features as columns.
    """
    lab = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
           .agg((F.min("quality") < 1).cast("int").alias("bad")))
    return stats.where("doc_id is not null").select("doc_id", *FEATURES).join(lab, "doc_id")


def _foil(p0: int, n0: int, p: int, n: int) -> float:
    if not p:
        return -1.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _with_margin(bad: DataFrame, conds: list[Condition]) -> tuple[Condition, ...]:
    """Cuts half way towards what the rule is about (the nearest twentieth of its
    bad rows), so that a value just past a quantile is not yet bad."""
    near = bad.agg(*[F.percentile_approx(c.feature, 0.95 if c.at_most else 0.05, 10_000).alias(str(i))
                     for i, c in enumerate(conds)]).first()
    cuts = {}
    for i, c in enumerate(conds):
        cut = (c.cut + float(near[str(i)])) / 2
        old = cuts.get((c.feature, c.at_most), cut)
        cuts[c.feature, c.at_most] = min(old, cut) if c.at_most else max(old, cut)
    return tuple(Condition(f, a, cut) for (f, a), cut in cuts.items())


def learn_rules(train: DataFrame, max_conditions: int = 4, cuts: int = 32,
                precision: float = 0.95, support: int = 5) -> list[Rule]:
    """The decision list that separates ``bad`` rows of ``train``.

    ``cuts`` bounds the thresholds tried per feature (quantiles of all rows and
    of the bad rows).  A rule enters the list if at least ``precision`` of what
    it covers on the pruning third is bad, and it covers ``support`` bad rows;
    the first rule that does not ends the list.  Counted, set aside and emitted is
    the rule with its margin, or without it if only that is precise and supported.
    """
    qs = [(i + 0.5) / cuts for i in range(cuts)]
    bad_only = [F.when(F.col("bad") == 1, F.col(f)) for f in FEATURES]
    got = train.agg(*[F.percentile_approx(c, qs, 10_000).alias(f"{k}{i}") for k, cols in
                      (("a", [F.col(f) for f in FEATURES]), ("b", bad_only)) for i, c in enumerate(cols)],
                    F.sum("bad").alias("bad"), F.count("*").alias("n")).first()
    if not got["n"] or not got["bad"] or got["bad"] == got["n"]:
        return []
    points = [sorted({float(v) for k in "ab" for v in got[f"{k}{i}"] or []}) for i in range(len(FEATURES))]

    # bin = number of cuts below the value: value <= cut[k] exactly if bin <= k.
    def bin_of(f: str, pts: list[float]) -> Column:
        return F.size(F.filter(F.array(*[F.lit(x) for x in pts]), lambda c: c < F.col(f)))

    bins = [bin_of(f, pts) for f, pts in zip(FEATURES, points)]
    rows = materialize(train.select(*FEATURES, F.array(*bins).alias("bins"), F.col("bad").cast("int").alias("bad"),
                                    (F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2).alias("grow")), "rule_rows")

    def test(f: int, at_most: bool, k: int) -> Column:
        b = F.col("bins")[f]
        return b <= k if at_most else b > k

    rules: list[Rule] = []
    while True:
        conds: list[tuple[int, bool, int]] = []
        inside = F.lit(True)
        while len(conds) < max_conditions:
            counts = (rows.where(inside & F.col("grow")).select("bad", F.posexplode("bins").alias("f", "b"))
                      .groupBy("f", "b").agg(F.sum("bad").alias("p"), F.count("*").alias("n")).collect())
            by = {}
            for r in counts:
                by.setdefault(r["f"], {})[r["b"]] = (r["p"], r["n"] - r["p"])
            p0 = sum(p for p, _ in by.get(0, {}).values())
            n0 = sum(n for _, n in by.get(0, {}).values())
            if not p0 or not n0:
                break
            best = (1e-9, None)
            for f in sorted(by):
                p = n = 0
                for k in range(len(points[f])):
                    dp, dn = by[f].get(k, (0, 0))
                    p, n = p + dp, n + dn
                    for gain, c in ((_foil(p0, n0, p, n), (f, True, k)), (_foil(p0, n0, p0 - p, n0 - n), (f, False, k))):
                        if gain > best[0]:
                            best = (gain, c)
            if best[1] is None:
                break
            conds.append(best[1])
            inside = inside & test(*best[1])
        if not conds:
            break
        # Prune: the prefix of the conditions that does best on the other third.
        prefixes, c = [], ~F.col("grow")
        for x in conds:
            c = c & test(*x)
            prefixes.append(c)
        seen = rows.agg(*[F.count_if(c & (F.col("bad") == v)).alias(f"{k}_{v}")
                          for k, c in enumerate(prefixes) for v in (0, 1)]).first()
        value = [(seen[f"{k}_1"] + 1) / (seen[f"{k}_1"] + seen[f"{k}_0"] + 2) for k in range(len(conds))]
        keep = max(range(len(conds)), key=lambda k: (round(value[k], 9), -k))
        covered = test(*conds[0])
        for x in conds[1:keep + 1]:
            covered = covered & test(*x)
        plain = [Condition(FEATURES[f], a, points[f][k]) for f, a, k in conds[:keep + 1]]
        tried = [Rule(_with_margin(rows.where(covered & (F.col("bad") == 1)), plain), 0, 0), Rule(tuple(plain), 0, 0)]
        seen = rows.where(~F.col("grow")).agg(*[F.count_if(r.column() & (F.col("bad") == v)).alias(f"{k}_{v}")
                                                for k, r in enumerate(tried) for v in (0, 1)]).first()
        tried = [Rule(r.conditions, seen[f"{k}_1"], seen[f"{k}_0"]) for k, r in enumerate(tried)]
        good = [r for r in tried if r.bad >= support and r.bad >= precision * (r.bad + r.good)]
        if not good:
            break
        rules.append(good[0])
        rows = materialize(rows.where(~good[0].column()), "rule_rows")
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds (from 1), null if none does."""
    out = None
    for i, r in enumerate(rules, 1):
        out = F.when(r.column(), F.lit(i)) if out is None else out.when(r.column(), F.lit(i))
    return F.lit(None).cast("int") if out is None else out


def quality_rules(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed``, ``kept`` and ``rule``."""
    stats = materialize(document_stats(docs.select("doc_id", "text")).select("doc_id", "_q.*"), "quality_stats")
    rules = learn_rules(labelled(stats, labels), **options)
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return (stats.withColumn("rule", verdict(rules)).select(
        "doc_id", *STATS, failed.alias("base_failed"), (~failed & F.col("rule").isNull()).alias("kept"), "rule"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that the base rule and the learned list keep.

    The texts are scored once; the rejected rows' keys are taken out of ``docs``,
    without moving a text while their counted number allows a broadcast.
    """
    stats = materialize(document_stats(with_text_hash(docs)).select("doc_id", "th", "_q.*"), "quality_stats")
    rules = learn_rules(labelled(stats, labels), **options)
    kept = ~base_failed(F.col("n_words"), F.col("n_repeat_words")) & verdict(rules).isNull()
    bad = materialize(stats.where(~kept).select(F.col("doc_id").alias("m_id"), F.col("th").alias("m_th")).distinct(),
                      "rejected")
    bad = small_side(bad, 24)
    a = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", F.xxhash64("text").alias("th"))
    return a.join(bad, a["doc_id"].eqNullSafe(bad["m_id"]) & a["th"].eqNullSafe(bad["m_th"]), "left_anti").select("doc.*")
