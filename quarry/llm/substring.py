"""Substring dedup: exact repeated word windows by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words.  Its minimiser is the smallest hash
among its runs of ``RUN`` words (leftmost of equals); windows in a row with the
same minimiser form one super-k-mer and travel as one packed string to the
minimiser's bucket.  Equal windows have equal minimisers at equal distances, so
they meet in one bucket, always from different super-k-mers.

* A first pass sends the minimisers alone; one that occurs in a single
  super-k-mer has no repeated window.  The repeated minimisers filter the
  super-k-mers before they travel while their counted rows stay under the
  broadcast bound; beyond it every super-k-mer travels.
* A bucket of up to ``BUCKET`` super-k-mers is sorted by the 128-bit hashes of
  its windows, where equal neighbours are repeats.
* A larger bucket (a passage that very many documents share) first counts its
  equal super-k-mers, whose windows are all repeated.  One of each kind is cut
  into windows, counted by a grouped aggregate with map-side sums; the repeated
  ones are looked up for the super-k-mers that occur once.

Words are compared as 48-bit hashes in the packed strings: two windows that
differ are taken for equal with a probability below 1e-14.

Defined results: a null or empty text has no words; a text shorter than a window
loses nothing; a repeated row is another place, so its windows are repeated;
rows without a ``doc_id`` take part like others.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize, ship_package, small_side
from quarry.llm.neardup import HASHES, mix

WINDOW, RUN = 35, 6
BUCKET = 2000
WORD_BYTES = 6
CHUNK_ROWS = 30_000
#: Words whose windows are hashed at a time, so that the arrays stay in cache.
PIECE = 16_384
SUPER = "g long, doc_id long, th long, start int, windows int, packed binary"
SPAN = "doc_id long, th long, start int, stop int"


def word_hashes(text: bytes | None) -> np.ndarray:
    words = text.split() if text else []
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def super_kmers(h: np.ndarray, window: int = WINDOW, run: int = RUN):
    """``(minimiser, first window, windows)`` arrays of a text's word hashes."""
    empty = np.empty(0, np.int64)
    if len(h) < window:
        return np.empty(0, np.uint64), empty, empty
    with np.errstate(over="ignore"):
        g = np.zeros(len(h) - run + 1, np.uint64)
        for j in range(run):
            g = g * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - run + 1 + j]
        g = mix(g)
    # The order is by the upper 32 bits of a run's hash, then by position, so that
    # equal windows choose the same run; the bucket is the whole hash.
    key = (g & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(g), dtype=np.uint64)
    wide, span = window - run + 1, 1
    while 2 * span <= wide:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < wide:
        key = np.minimum(key[:span - wide], key[wide - span:])
    at = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    count = len(at)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return g[at[first]], first, np.diff(first, append=count)


def _minimisers(batches):
    for b in batches:
        parts = [super_kmers(word_hashes(t.as_py()))[0] for t in b.column(0)]
        g = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64))], names=["g"])


def _packed(batches):
    names = ["g", "doc_id", "th", "start", "windows", "packed"]
    for b in batches:
        out: list[list] = [[] for _ in names]
        size = 0
        for doc_id, th, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            h = word_hashes(text.as_py())
            g, first, count = super_kmers(h)
            raw = h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES].tobytes()
            ends = (first + count + WINDOW - 1) * WORD_BYTES
            out[0].append(g.view(np.int64))
            out[1].extend([doc_id] * len(g))
            out[2].extend([th] * len(g))
            out[3].append(first)
            out[4].append(count)
            out[5].extend([raw[x:y] for x, y in zip((first * WORD_BYTES).tolist(), ends.tolist())])
            size += len(g)
            if size >= CHUNK_ROWS:
                yield _super_batch(out, names)
                out, size = [[] for _ in names], 0
        yield _super_batch(out, names)


def _super_batch(out, names):
    cat = [np.concatenate(out[k]) if out[k] else np.empty(0, np.int64) for k in (0, 3, 4)]
    return pa.RecordBatch.from_arrays(
        [pa.array(cat[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
         pa.array(cat[1].astype(np.int32)), pa.array(cat[2].astype(np.int32)), pa.array(out[5], pa.binary())], names=names)


def _run_hashes(v: np.ndarray, odd: np.uint64) -> np.ndarray:
    """Hashes of all runs of ``WINDOW`` of ``v``: runs of 1, 2, 4, ... words are
    joined in pairs, and those of the window's binary digits in a row."""
    def joined(a, b):
        x = (a ^ (a >> np.uint64(29))) * odd + b
        return x ^ (x >> np.uint64(31))

    n = len(v) - WINDOW + 1
    with np.errstate(over="ignore"):
        power, span, out, done = mix(v * odd), 1, None, 0
        while span <= WINDOW:
            if WINDOW & span:
                part = power[done:done + n]
                out = part if out is None else joined(out, part)
                done += span
            if 2 * span <= WINDOW:
                power = joined(power[:-span], power[span:])
            span *= 2
        return mix(out)


def window_hashes(packed, counts: np.ndarray):
    """128-bit hashes of all windows of packed super-k-mers, and their rows."""
    raw = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, WORD_BYTES)
    words = np.zeros((len(raw), 8), np.uint8)
    words[:, :WORD_BYTES] = raw
    v = words.view("<u8").ravel()
    sizes = counts + WINDOW - 1
    row = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(np.cumsum(sizes) - sizes, counts) + nth
    out = []
    for odd in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
        x = np.empty(max(len(v) - WINDOW + 1, 0), np.uint64)
        for i in range(0, len(x), PIECE):
            x[i:i + PIECE] = _run_hashes(v[i:i + PIECE + WINDOW - 1], np.uint64(odd))
        out.append(x[at])
    return out[0], out[1], row, nth


def _chunks(batches, rows: int = CHUNK_ROWS):
    """Whole buckets of a stream sorted by ``g``, some ``rows`` rows at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += b.num_rows
        if size >= rows:
            t = pa.Table.from_batches(held).combine_chunks()
            g = t.column("g").to_numpy()
            cut = int(np.flatnonzero(g != g[-1])[-1]) + 1 if g[0] != g[-1] else 0
            if cut:
                yield t.slice(0, cut)
            held = t.slice(cut).to_batches()
            size = len(g) - cut
    if size:
        yield pa.Table.from_batches(held)


def _sorted_buckets(batches):
    for t in _chunks(batches):
        counts = t.column("windows").to_numpy().astype(np.int64)
        x, y, row, nth = window_hashes(t.column("packed").to_pylist(), counts)
        order = np.lexsort((y, x))
        same = (x[order][1:] == x[order][:-1]) & (y[order][1:] == y[order][:-1])
        again = np.zeros(len(order), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        row, nth = row[again], nth[again]
        if not len(row):
            continue
        # The repeated windows of a super-k-mer overlap: their words are one span.
        lo = np.flatnonzero(np.diff(row, prepend=-1))
        hi = np.append(lo[1:], len(row)) - 1
        who = row[lo]
        start = t.column("start").to_numpy()[who]
        took = t.select(["doc_id", "th"]).take(pa.array(who))
        yield pa.RecordBatch.from_arrays(
            [took.column(0).combine_chunks(), took.column(1).combine_chunks(),
             pa.array((start + nth[lo]).astype(np.int32)), pa.array((start + nth[hi] + WINDOW).astype(np.int32))],
            names=["doc_id", "th", "start", "stop"])


def _cut_windows(batches):
    for b in batches:
        counts = b.column("windows").to_numpy().astype(np.int64)
        x, y, row, nth = window_hashes(b.column("packed").to_pylist(), counts)
        at = b.column("start").to_numpy()[row] + nth
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.view(np.int64)), pa.array(y.view(np.int64)), b.column("doc_id").take(pa.array(row)),
             b.column("th").take(pa.array(row)), pa.array(at.astype(np.int32)), b.column("single").take(pa.array(row))],
            names=["x", "y", "doc_id", "th", "start", "single"])


def _kept(batches):
    for b in batches:
        n, gone, sha = [], [], []
        for text, spans in zip(b.column(1), b.column(2).to_pylist()):
            words = (text.as_py() or b"").split()
            n.append(len(words))
            if spans:
                keep = np.ones(len(words), bool)
                for s in spans:
                    keep[s["start"]:s["stop"]] = False
                words = [words[i] for i in np.flatnonzero(keep)]
            gone.append(n[-1] - len(words))
            sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                          pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def repeated_spans(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, th, spans`` of the texts that hold a repeated window; the
    spans ``[start, stop)`` of words cover exactly its repeated windows."""
    ship_package(docs.sparkSession)
    text = docs.select("doc_id", F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text"))
    again = materialize(text.select("text").mapInArrow(_minimisers, "g long").groupBy("g").agg(
        F.count("*").alias("n")).where("n > 1"), "minimisers")
    travel = text.mapInArrow(_packed, SUPER).join(small_side(again, 24), "g")
    travel = materialize(travel, "super_kmers")
    small = travel.where(F.col("n") <= bucket).drop("n").repartition("g").sortWithinPartitions("g")
    spans = small.mapInArrow(_sorted_buckets, SPAN)
    cut = travel.where(F.col("n") > bucket).select(F.md5("packed").alias("same"), "doc_id", "th", "start", "windows", "packed")
    alike = materialize(cut.groupBy("same").agg(
        F.count("*").alias("copies"), F.first(F.struct("doc_id", "th", "start", "windows", "packed")).alias("one")), "alike")
    copied = materialize(alike.where("copies > 1").select("same"), "copied")  # a hot key's join can then be split
    spans = spans.union(cut.drop("packed").join(copied, "same").select(
        "doc_id", "th", "start", (F.col("start") + F.col("windows") + (WINDOW - 1)).alias("stop")))
    windows = materialize(alike.select("one.*", (F.col("copies") == 1).alias("single")).mapInArrow(
        _cut_windows, "x long, y long, doc_id long, th long, start int, single boolean"), "windows")
    twice = windows.groupBy("x", "y").agg(F.count("*").alias("n")).where("n > 1").select("x", "y")
    twice = materialize(twice, "repeated_windows")
    spans = spans.union(windows.where("single").join(twice, ["x", "y"]).select(
        "doc_id", "th", "start", (F.col("start") + WINDOW).alias("stop")))
    return spans.distinct().groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def substring_dedup(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = materialize(repeated_spans(docs, bucket), "repeated_spans").withColumnsRenamed({"doc_id": "s_id", "th": "s_th"})
    a = docs.withColumn("th", F.xxhash64("text"))
    both = a.join(spans, a["doc_id"].eqNullSafe(spans["s_id"]) & (a["th"] == spans["s_th"]), "left")
    return both.select("doc_id", F.col("text").cast("binary").alias("text"), "spans").mapInArrow(
        _kept, "doc_id long, n_words long, n_removed long, kept_sha256 string")
