"""Quality by the votes of nearest labelled texts in a latent-semantic space.

A text becomes counts of terms, hashed to ``DIM`` cells: its folded words; runs of
three characters of its shape, where letters of a case, digits and line ends
stand for themselves each; and marks for what repeats, word after word and over
the text, and for its length.  Counts are damped, weighted by inverse document
frequency and scaled to unit length.  A truncated singular value decomposition of
a bounded labelled sample gives the latent space; the sample's vectors there are
broadcast (``2 * PER_LABEL`` times ``RANK`` numbers).

Every text is compared with every vector of the sample by blocks of exact cosine
products.  Its ``NEIGHBOURS`` nearest, with all that tie with the last of them,
vote with their cosine, times their label's share of all labelled rows over its
share of the sample.  Texts are read whole, a slice at a time.

The sample has at most ``PER_LABEL`` labelled ids of each label, those with the
smallest hashes of their id, with the smallest text where an id has several.
Labels that are null or neither 0 nor 1 are no labels; an id with both counts
for both.  Only text is used to score.

Defined results: a null text is an empty text; repeated rows have equal scores; a
text without a neighbour of positive cosine gets the share of label 1 among the
labelled rows, and 0.5 without any labelled row.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize, ship_package

DIM = 1 << 13
RANK = 64
PER_LABEL = 2000
NEIGHBOURS = 15
THRESHOLD = 0.3
BLOCK = 256
SLICE = 1 << 20
#: Bytes of a text's shape: a, A and 0 for letters and digits, a for what is beyond ASCII.
SHAPE = bytes(97 if b >= 128 or chr(b).islower() else 65 if chr(b).isupper() else 48 if chr(b).isdigit() else
              32 if b in (9, 11, 12, 13) else b for b in range(256))
#: Cells of the marks; words and shapes hash to those from here on.
MARKS = 64
AGAIN, OLD, LENGTH = 0, 8, 16
#: Shares of words that repeat the one before, or an earlier one, from which on a mark is set.
STEPS = np.array([0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8, 0.95])
SPAN = DIM - MARKS


def text_cells(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Cells and damped counts of a text."""
    cells = np.zeros(DIM, np.float32)
    seen: Counter = Counter()
    again = total = at = 0
    last = b""
    while at < len(raw) or not at:
        end = len(raw) if len(raw) - at <= SLICE else raw.find(b" ", at + SLICE) + 1 or len(raw)
        part = raw[at:end]
        words = part.lower().split()
        seen.update(words)
        total += len(words)
        again += sum(map(bytes.__eq__, words, [last, *words]))
        last = words[-1] if words else last
        a = np.frombuffer(part.translate(SHAPE), np.uint8).astype(np.uint32)
        if len(a) > 2:
            h = (a[:-2] << np.uint32(14) | a[1:-1] << np.uint32(7) | a[2:]) * np.uint32(0x9E3779B1)
            cells += np.bincount(MARKS + (h >> np.uint32(8)) % np.uint32(SPAN), minlength=DIM)
        at = end
        if not raw:
            break
    if seen:
        n = np.fromiter(seen.values(), np.float32, len(seen))
        where = np.fromiter(map(zlib.crc32, seen), np.uint32, len(seen))
        cells += np.bincount(MARKS + where % np.uint32(SPAN), weights=n, minlength=DIM).astype(np.float32)
    if total:
        cells[AGAIN:OLD] = np.where(again / total >= STEPS, total, 0)
        cells[OLD:LENGTH] = np.where(1 - len(seen) / total >= STEPS, total, 0)
    cells[LENGTH + total.bit_length()] = 1
    used = np.flatnonzero(cells)
    return used, np.log1p(cells[used])


def unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=-1, keepdims=True)
    return m / np.where(norm == 0, 1, norm)


def matrix(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    out = np.zeros((len(rows), DIM), np.float32)
    for i, (cells, values) in enumerate(rows):
        out[i, cells] = values
    return out


def latent_axes(m: np.ndarray, rank: int, rounds: int = 4, seed: int = 7) -> np.ndarray:
    """The leading right singular vectors of ``m`` (columns), by subspace iteration."""
    rank = min(rank, *m.shape)
    q = np.random.default_rng(seed).standard_normal((m.shape[1], min(rank + 16, *m.shape))).astype(np.float32)
    for _ in range(rounds):
        q = np.linalg.qr(m.T @ (m @ q))[0]
    u = np.linalg.svd(m @ q, full_matrices=False)[2]
    return np.ascontiguousarray((q @ u.T)[:, :rank])


@dataclass
class Model:
    """``axes`` (cells by rank), the labelled vectors, their
    labels and the weights of their votes."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    votes: np.ndarray
    prior: float
    neighbours: int

    def project(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return unit(unit(matrix(rows) * self.idf) @ self.axes)

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The weighted vote of the nearest labelled vectors of each text."""
        if not len(self.vectors):
            return np.full(len(rows), self.prior)
        cos = self.project(rows) @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        least = np.partition(cos, -k, axis=1)[:, -k]
        vote = np.where((cos >= least[:, None] - 1e-5) & (cos > 0), cos, 0).astype(float) * self.votes
        weight = vote.sum(axis=1)
        good = vote @ self.labels
        return np.round(np.where(weight > 0, good / np.where(weight > 0, weight, 1), self.prior), 6)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], sizes: dict[int, int], rank: int = RANK,
        neighbours: int = NEIGHBOURS) -> Model:
    """``sizes``: labelled rows of each label, in the sample or not."""
    y = np.array(labels, float)
    drawn = Counter(labels)
    votes = np.array([sizes[x] / drawn[x] for x in labels])
    known = sum(sizes.values())
    prior = sizes.get(1, 0) / known if known else 0.5
    if not rows:
        return Model(np.ones(DIM, np.float32), np.zeros((DIM, 0), np.float32), np.zeros((0, 0), np.float32), y, votes,
                     prior, neighbours)
    m = matrix(rows)
    idf = (np.log((1 + len(m)) / (1 + (m > 0).sum(axis=0))) + 0.1).astype(np.float32)
    m = unit(m * idf)
    axes = latent_axes(m, rank)
    return Model(idf, axes, unit(m @ axes), y, votes, prior, neighbours)


def _sampled(batches):
    for b in batches:
        found = [text_cells(t or b"") for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([c.astype("<u2").tobytes() for c, _ in found], pa.binary()),
             pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())], names=["quality", "cells", "counts"])


def _scored(model):
    def run(batches):
        m: Model = model.value
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                scores = m.score([text_cells(t or b"") for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def learn(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, rank: int = RANK,
          neighbours: int = NEIGHBOURS) -> Model:
    """Fits on at most ``per_label`` of the given labelled ids of each label."""
    ship_package(docs.sparkSession)
    known = labels.where("doc_id is not null and quality in (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).distinct()
    known = materialize(known, "labelled")
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    drawn = None
    for y in (0, 1):
        few = known.where(F.col("quality") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        drawn = few if drawn is None else drawn.unionByName(few)
    # At most 2 * per_label rows.
    sample = _texts(docs).join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    got = sample.select("quality", "text").mapInArrow(_sampled, "quality int, cells binary, counts binary").collect()
    got = sorted((r["quality"], bytes(r["cells"]), bytes(r["counts"])) for r in got)  # whatever order they come in
    return fit([(np.frombuffer(c, "<u2"), np.frombuffer(v, "<f4")) for _, c, v in got], [y for y, *_ in got], sizes, rank,
               neighbours)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every text by a learned model."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return _texts(docs).mapInArrow(_scored(shared), "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted``; learns from ids that are not held out."""
    model = learn(docs, labels.where(~held_out(F.col("doc_id"))), **options)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= threshold).cast("int").alias("predicted"))
