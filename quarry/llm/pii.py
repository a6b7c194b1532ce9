"""Personal data: base patterns, and bootstrapped contextual extraction.

Base matches of the four kinds are the seed entities.  A text is read as its
words, without punctuation at their ends, where a base match (or several that
overlap) stands as one unit.  The lexical patterns of a unit are the two words
before it, the two after it, and the word on either side, the same way for seeds
and candidates.  Whatever stands in a pattern is a candidate for it: any word, and
runs of words with digits and no letters (identifiers written with spaces).  A run
counts whole, whatever its length: beside a one-sided pattern all the bare digit
groups in a row, between two words all the words without letters that fill the gap.

Patterns and instances form a bipartite graph with one edge per distinct pair.  In
each round a pattern's confidence for a kind is the weight of that kind among all
its instances (smoothed, and only with enough different instances behind it), and
an instance is believed as far as its accepted patterns leave doubt (noisy or);
instances believed enough count in the next round, with all places they stand in.
Rounds end when one accepts no new instance.  Mentions of candidates believed at
the end become added spans; of words of letters alone only the mentions in an
accepted pattern, as the same word elsewhere is just a word.  Of overlapping
mentions the most believed stays, then the longer, then the first.  Base spans
always stay.

Everything runs on built-in functions.  The edges of all words are never laid out:
a round looks through the texts for what stands in the patterns that have got enough
instances since the last one, and for the instances accepted since then.  It does so
by slices of the values' hashes (``SLICES``), the first a small one: the distinct
values seen so far are a lower bound of how many stand in a pattern, so one whose
weight cannot reach ``pattern_floor`` over that bound is left, and looked at again
only when its weight has risen.  What is laid out of the others is in proportion to
their instances, and no value of an accepted pattern is ever left out.

Work grows with the length of a text, also where it has very many matches: places
are found by running sums over its words and merged by running maxima, and a text is
cut block by block.

The patterns match what the plain forms match: possessive quantifiers and the
look-behind only remove retries inside a run that cannot succeed, so that a very
long run of digits or letters costs linear time.

Defined results: a null or empty text has no spans; repeated rows have the same
spans each; rows need no ``doc_id``.  Rows are told apart, and patterns named, by
64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import SPACE_RUN, materialize, small_side

KINDS = ["email", "ip", "card", "phone"]
#: The base patterns.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Shares of the values (of 64) by which a round looks for what stands in patterns.
SLICES = (1, 7, 56)
#: Characters of a block of a text that is cut.
BLOCK = 8192
EDGES = ".,;:!?()[]{}\"'"
#: As an SQL literal.
EDGES_SQL = "'" + EDGES.replace("'", "\\'") + "'"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]+", "")


def valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.rlike(r"^0*+(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])?$"))
    if kind == "card":
        return F.char_length(_digits(m)).between(12, 19) & F.call_function("luhn_check", _digits(m))
    if kind == "phone":
        return F.char_length(_digits(m)).between(9, 15)
    return F.lit(True)


def _matches(kind: str) -> Column:
    """Matches of a kind in ``t`` with the length of the gap before each, as an
    array of structs."""
    p = F.lit(PATTERNS[kind])
    got, gap = F.regexp_extract_all("t", p, F.lit(0)), F.split("t", PATTERNS[kind], -1)
    out = F.transform(F.arrays_zip(got.alias("m"), gap.alias("g")), lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("nth"), F.char_length(x["g"]).alias("gap"),
        F.char_length(x["m"]).alias("size"), x["m"].alias("m")))
    out = F.filter(out, lambda x: x["m"].isNotNull())
    cue = {"email": F.contains("t", F.lit("@")), "phone": F.contains("t", F.lit("+"))}.get(kind, F.col("t").rlike("[0-9]"))
    return F.when(cue, out)


def base_matches(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, matches)``: the written rows ``row, th, doc_id``, and per valid base
    match ``row, th, kind, start, stop, m``; ``th`` is of id and text."""
    t = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.monotonically_increasing_id().alias("row"))
    empty = F.array().cast("array<struct<kind:string,nth:int,gap:int,size:int,m:string>>")
    found = F.concat(*[F.coalesce(_matches(k), empty) for k in KINDS])
    rows = materialize(t.select("row", F.xxhash64("doc_id", "t").alias("th"), "doc_id", found.alias("found")), "pii_rows")
    each = rows.select("row", "th", F.inline("found"))
    so_far = Window.partitionBy("row", "kind").orderBy("nth")
    each = each.repartition("row").withColumn("stop", F.sum(F.col("gap") + F.col("size")).over(so_far).cast("int"))
    each = each.withColumn("start", F.col("stop") - F.col("size"))
    ok = F.lit(False)
    for k in KINDS:
        ok = ok | ((F.col("kind") == k) & valid(k, F.col("m")))
    return rows, materialize(each.where(ok).select("row", "th", "kind", "start", "stop", "m"), "base_matches")


def _cut(start: str, stop: str) -> str:
    """SQL: the characters from ``start`` up to ``stop`` of the text in ``blocks``."""
    return f"""if({stop} <= {start}, '', array_join(transform(
        sequence(({start}) div {BLOCK}, ({stop} - 1) div {BLOCK}), k -> substring(get(blocks, cast(k as int)),
            cast(greatest({start} - k * {BLOCK}, 0) + 1 as int),
            cast(least({stop} - k * {BLOCK}, {BLOCK}) - greatest({start} - k * {BLOCK}, 0) as int))), ''))"""


def text_units(docs: DataFrame, matches: DataFrame) -> DataFrame:
    """``th, pieces``: each text cut at its base matches.  A piece is a text without
    a match, where it starts, and the seeds (``kind, value``) right after it."""
    in_order = Window.partitionBy("th").orderBy("start", "stop", "kind", "value")
    before = F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    spans = matches.select("th", "start", "stop", "kind", F.lower("m").alias("value")).distinct()
    # Matches that overlap are one unit.
    spans = spans.withColumn("first", F.coalesce(F.col("start") >= before, F.lit(True)).cast("int"))
    spans = spans.withColumn("nth", F.sum("first").over(in_order))
    units = spans.groupBy("th", "nth").agg(F.min("start").alias("a"), F.max("stop").alias("b"), F.transform(
        F.array_sort(F.collect_list(F.struct("start", "stop", "kind", "value"))),
        lambda x: F.struct(x["kind"].alias("kind"), x["value"].alias("value"))).alias("seeds"))
    units = units.groupBy("th").agg(F.array_sort(F.collect_list(F.struct("a", "b", "seeds"))).alias("u"))
    units = small_side(materialize(units, "base_units"), 400)
    t = docs.select(F.coalesce("text", F.lit("")).alias("t"), F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("th"))
    blocks = F.expr(f"transform(sequence(0, char_length(t) div {BLOCK}), k -> substring(t, k * {BLOCK} + 1, {BLOCK}))")
    t = t.join(units, "th", "left").select("th", "t", "u", F.when(F.col("u").isNotNull(), blocks).alias("blocks"),
                                           F.char_length("t").alias("size"))
    none = "cast(null as array<struct<kind:string,value:string>>)"
    whole = F.expr(f"array(named_struct('at', 0, 'p', t, 'seeds', {none}))")
    cut = F.expr(f"""concat(
        transform(u, (x, i) -> named_struct('at', coalesce(get(u, i - 1).b, 0),
            'p', {_cut('coalesce(get(u, i - 1).b, 0)', 'x.a')}, 'seeds', x.seeds)),
        array(named_struct('at', element_at(u, -1).b, 'p', {_cut('element_at(u, -1).b', 'size')}, 'seeds', {none})))""")
    return materialize(t.select("th", F.when(F.col("u").isNull(), whole).otherwise(cut).alias("pieces")), "pii_units")


def places(units: DataFrame) -> DataFrame:
    """``th, i, n, value, seeds, patterns``: every seed, word and run of number
    words, ``n`` units from the ``i``-th, with the patterns it stands in.  ``seeds``
    is null for candidates."""
    a = units.select("th", F.expr(rf"""flatten(transform(pieces, x -> concat(
        transform(filter(transform(split(lower(x.p), r'{SPACE_RUN}'), w -> btrim(w, {EDGES_SQL})), w -> w <> ''),
            w -> named_struct('v', w, 'seeds', cast(null as array<struct<kind:string,value:string>>))),
        if(x.seeds is null, array(), array(named_struct('v', x.seeds[0].value, 'seeds', x.seeds))))))""").alias("u"),
        F.exists("pieces", lambda x: x["p"].rlike(r"[0-9]\P{L}*[\x20\x09-\x0D]\P{L}*[0-9]")).alias("cue"))
    # 2: digits alone, 1: digits and no letter; only texts with two such words in a row have runs.
    a = a.select("th", "u", F.transform("u", lambda x: F.xxhash64(x["v"])).alias("h"), F.when(F.col("cue"), F.transform(
        "u", lambda x: F.when(x["seeds"].isNotNull() | ~x["v"].rlike(r"^\P{L}*[0-9]\P{L}*$"), 0).when(
            x["v"].rlike(r"^\+?[0-9]+$"), 2).otherwise(1))).alias("c"))

    def runs(least: int) -> str:
        """Where runs of at least two words of this kind start, and their last words."""
        start = f"filter(sequence(0, size(c) - 1), i -> get(c, i) >= {least} and coalesce(get(c, i - 1), 0) < {least})"
        last = f"filter(sequence(0, size(c) - 1), i -> get(c, i) >= {least} and coalesce(get(c, i + 1), 0) < {least})"
        pairs = f"zip_with({start}, {last}, (s, e) -> named_struct('s', s, 'e', e))"
        return f"if(c is null or size(c) < 2, cast(array() as array<struct<s:int,e:int>>), filter({pairs}, x -> x.e > x.s))"

    a = a.select("th", "u", "h", "c", F.expr(runs(2)).alias("bare"), F.expr(runs(1)).alias("run"))
    left, right = "xxhash64('L', coalesce(get(h, {i} - 2), 0L), get(h, {i} - 1))", "xxhash64('R', get(h, {i} + 1), coalesce(get(h, {i} + 2), 0L))"
    both = "xxhash64('B', coalesce(get(h, {s} - 1), 0L), coalesce(get(h, {e} + 1), 0L))"
    one = F.expr(f"""transform(u, (x, i) -> named_struct('i', i, 'n', 1, 'value', x.v, 'seeds', x.seeds, 'patterns', array(
        if(i = 0 or coalesce(get(c, i) = 2 and get(c, i + 1) = 2, false), null, {left.format(i='i')}),
        if(i + 1 = size(h) or coalesce(get(c, i) = 2 and get(c, i - 1) = 2, false), null, {right.format(i='i')}),
        if(size(h) = 1, null, {both.format(s='i', e='i')}))))""")
    no_seeds = "cast(null as array<struct<kind:string,value:string>>)"
    value = "array_join(transform(slice(u, x.s + 1, x.e - x.s + 1), y -> y.v), ' ')"
    beside = F.expr(f"""transform(bare, x -> named_struct('i', x.s, 'n', x.e - x.s + 1, 'value', {value}, 'seeds', {no_seeds},
        'patterns', array(if(x.s = 0, null, {left.format(i='x.s')}), if(x.e + 1 = size(h), null, {right.format(i='x.e')}),
            cast(null as bigint))))""")
    between = F.expr(f"""transform(run, x -> named_struct('i', x.s, 'n', x.e - x.s + 1, 'value', {value}, 'seeds', {no_seeds},
        'patterns', array(cast(null as bigint), cast(null as bigint),
            if(x.e - x.s + 1 = size(h), null, {both.format(s='x.s', e='x.e')}))))""")
    return a.select("th", F.inline(F.when(F.col("c").isNull(), one).otherwise(F.concat(one, beside, between))))


def _laid_out(spread: DataFrame, seeds: DataFrame, wanted: DataFrame, floor: float) -> tuple[DataFrame, DataFrame]:
    """``(edges, bounds)``: all values that stand in those of the ``wanted`` patterns
    (``pattern, weight``) that can still reach ``floor``, and for every wanted one
    ``pattern, least, whole``: a lower bound of its values, and whether it is all."""
    slice_of = F.pmod(F.xxhash64("value"), F.lit(sum(SLICES)))
    own_seeds = seeds.select("value", "pattern").join(wanted, "pattern", "left_semi").distinct()
    left, found, gone, at = wanted, None, None, 0
    for share in SLICES:
        part = spread.where(slice_of.between(at, at + share - 1)).select("value", F.explode("patterns").alias("pattern"))
        part = materialize(part.join(small_side(left.select("pattern"), 24), "pattern", "left_semi").distinct(), "pattern_edges")
        found = part if found is None else found.unionByName(part)
        at += share
        seen = found.unionByName(own_seeds).distinct().groupBy("pattern").agg(F.count("*").alias("least"))
        seen = materialize(left.join(seen, "pattern", "left").fillna(0, ["least"]), "pattern_bounds")
        weak = F.col("weight") / (F.col("least") + 1) < floor
        lost = seen.where(weak).select("pattern", "least", F.lit(at == sum(SLICES)).alias("whole"))
        gone = lost if gone is None else gone.unionByName(lost)
        left = seen.where(~weak).select("pattern", "weight")
    kept = seen.where(~weak).select("pattern", "least", F.lit(True).alias("whole"))
    bounds = materialize(gone.unionByName(kept), "pattern_bounds")
    return materialize(found.join(bounds.where("whole"), "pattern", "left_semi"), "whole_edges"), bounds


def discover(units: DataFrame, support: int = 3, pattern_floor: float = 0.6,
             accept: float = 0.7) -> DataFrame | None:
    """``th, i, n, kind, belief``: mentions that the accepted patterns make
    identifiers; none if there are none.

    ``support``: distinct believed instances a pattern needs; ``pattern_floor``:
    its least confidence; ``accept``: the least belief in an instance.
    """
    seeds = places(units.where(F.size("pieces") > 1)).where(F.col("seeds").isNotNull())
    seeds = seeds.select(F.explode("seeds").alias("s"), "patterns").select(
        "s.kind", "s.value", F.explode("patterns").alias("pattern")).where("pattern is not null").distinct()
    seeds = materialize(seeds.withColumn("belief", F.lit(1.0)), "seed_edges")
    spread = places(units).where("seeds is null")
    edges = bounds = mentions = believed = good = None
    while True:
        told = seeds
        if mentions is not None:
            told = told.unionByName(mentions.select("value", F.explode("patterns").alias("pattern")).where(
                "pattern is not null").distinct().join(believed, "value").select(*seeds.columns))
        weight = materialize(told.groupBy("pattern", "kind").agg(F.sum("belief").alias("weight"), F.count("*").alias("n"))
                             .where(F.col("n") >= support), "pattern_weights")
        fresh = weight.groupBy("pattern").agg(F.max("weight").alias("weight"))
        if bounds is not None:
            # Not those laid out whole, nor those whose weight is still too low for what is known of them.
            known = bounds.groupBy("pattern").agg(F.max("least").alias("least"), F.max("whole").alias("whole"))
            fresh = fresh.join(known, "pattern", "left").where(
                "whole is null or not whole").where(F.col("weight") / (F.coalesce("least", F.lit(0)) + 1) >= pattern_floor)
        fresh = materialize(fresh.select("pattern", "weight"), "active_patterns")
        if not fresh.isEmpty():
            beside, least = _laid_out(spread, seeds, fresh, pattern_floor)
            edges = beside if edges is None else edges.unionByName(beside)
            bounds = least if bounds is None else bounds.unionByName(least)
        if edges is None:
            return None
        size = edges.unionByName(seeds.select("value", "pattern")).distinct().groupBy("pattern").agg(F.count("*").alias("size"))
        whole = bounds.where("whole").select("pattern").distinct()
        good = weight.join(whole, "pattern", "left_semi").join(size, "pattern").withColumn("confidence", F.col("weight") / (F.col("size") + 1))
        good = materialize(good.where(F.col("confidence") >= pattern_floor).select("pattern", "kind", "confidence"), "accepted")
        belief = edges.join(good, "pattern").groupBy("value", "kind").agg(
            (1 - F.exp(F.sum(F.ln(1 - F.col("confidence"))))).alias("belief"))
        best = belief.where(F.col("belief") >= accept).groupBy("value").agg(F.max(F.struct("belief", "kind")).alias("b"))
        before = believed
        believed = materialize(best.select("value", "b.kind", "b.belief"), "believed")
        new = believed.select("value")
        new = materialize(new if before is None else new.join(before, "value", "left_anti"), "new_instances")
        if new.isEmpty():
            break
        at = materialize(spread.join(small_side(new), "value", "left_semi").select("th", "i", "n", "value", "patterns"), "mentions")
        mentions = at if mentions is None else mentions.unionByName(at)
    if mentions is None:
        return None
    named = mentions.join(believed, "value").distinct()
    plain = F.col("value").rlike(r"^\p{L}+$")
    here = named.where(plain).withColumn("pattern", F.explode("patterns")).join(good, ["pattern", "kind"], "left_semi")
    cols = ["th", "i", "n", "kind", "belief"]
    return named.where(~plain).select(cols).unionByName(here.select(cols)).distinct()


def _free(mentions: DataFrame) -> DataFrame:
    """``mentions`` without those that overlap one believed more, then longer, then
    earlier.  Only mentions linked by overlaps are compared."""
    in_order = Window.partitionBy("th").orderBy("i", "n", "kind")
    before = F.max(F.col("i") + F.col("n")).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    m = mentions.withColumn("first", F.coalesce(F.col("i") >= before, F.lit(True)).cast("int"))
    m = m.withColumn("cluster", F.sum("first").over(in_order))
    found = m.groupBy("th", "cluster").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("belief")).alias("doubt"), (-F.col("n")).alias("short"), "i", "n", "kind"))).alias("found"))
    free = F.expr("""aggregate(found, cast(array() as array<struct<doubt:double,short:int,i:int,n:int,kind:string>>), (acc, x) ->
        if(exists(acc, y -> x.i < y.i + y.n and y.i < x.i + x.n), acc, concat(acc, array(x))))""")
    return found.select("th", F.inline(free)).select("th", "i", "n", "kind")


def added_spans(units: DataFrame, mentions: DataFrame) -> DataFrame:
    """``th, kind, start, stop``: the places of ``mentions`` in their texts, without
    those that overlap one believed more."""
    free = materialize(_free(mentions), "added_mentions")
    own = free.select("th").distinct()
    a = units.join(small_side(materialize(own, "added_texts"), 24), "th", "left_semi").dropDuplicates(["th"])
    # One row a word, with what stands before it in its piece; seeds have no length here.
    words = a.select("th", F.posexplode("pieces").alias("k", "x")).select("th", "k", "x.at", F.expr(rf"""concat(
        transform(arrays_zip(split(x.p, r'{SPACE_RUN}'), regexp_extract_all(x.p, r'{SPACE_RUN}', 0)), y -> named_struct(
            'step', char_length(y.`0`) + coalesce(char_length(y.`1`), 0), 'core', char_length(btrim(y.`0`, {EDGES_SQL})),
            'lead', char_length(y.`0`) - char_length(trim(leading {EDGES_SQL} from y.`0`)), 'unit',
            char_length(btrim(y.`0`, {EDGES_SQL})) > 0)),
        if(x.seeds is null, array(), array(named_struct('step', 0, 'core', 0, 'lead', 0, 'unit', true))))""").alias("w"))
    words = words.select("th", "k", "at", F.posexplode("w").alias("j", "w")).select("th", "k", "j", "at", "w.*")
    piece, text = Window.partitionBy("th", "k").orderBy("j"), Window.partitionBy("th").orderBy("k", "j")
    words = words.repartition("th").withColumn("start", (F.col("at") + F.sum("step").over(piece) - F.col("step") + F.col("lead")).cast("int"))
    words = words.withColumn("i", (F.sum(F.col("unit").cast("int")).over(text) - 1).cast("int")).where("unit")
    words = materialize(words.select("th", "i", "start", (F.col("start") + F.col("core")).alias("stop")), "added_words")
    first = free.join(words.select("th", "i", "start"), ["th", "i"])
    return first.withColumn("i", F.col("i") + F.col("n") - 1).join(words.select("th", "i", "stop"), ["th", "i"]).select(
        "th", "kind", "start", "stop")


def _joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["rank"]), s["start"], s["stop"])), ",")


def personal_data(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``.

    The counts and the digest are of base spans; ``spans`` holds all.
    """
    docs = docs.select("doc_id", "text")
    rows, matches = base_matches(docs)
    spans = matches.select("row", "kind", "start", "stop", F.lit(True).alias("base"))
    units = text_units(docs, matches)
    found = discover(units, **options)
    if found is not None:
        added = materialize(added_spans(units, found), "added_spans")
        spans = spans.unionByName(rows.select("row", "th").join(added, "th").select(
            "row", "kind", "start", "stop", F.lit(False).alias("base")))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    one = F.struct("start", rank.alias("rank"), "stop")
    per = spans.groupBy("row").agg(
        *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS],
        F.count_if(~F.col("base")).alias("n_added"),
        F.collect_list(F.when(F.col("base"), one)).alias("b"), F.collect_list(one).alias("a"))
    per = per.select("row", *[f"n_{k}" for k in KINDS], "n_added", _joined(F.col("b")).alias("b"), _joined(F.col("a")).alias("a"))
    zero = F.lit(0).cast("long")
    return rows.select("row", "doc_id").join(per, "row", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", zero).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("b", F.lit("")), 256).alias("base_sha256"), F.coalesce("a", F.lit("")).alias("spans"),
        F.coalesce("n_added", zero).alias("n_added"))
