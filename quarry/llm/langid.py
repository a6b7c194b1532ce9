"""Language identification by nearest centroid.

A text becomes the counts of its one-, two- and three-character runs, hashed to
``DIM`` cells, damped, weighted by inverse document frequency and scaled to unit
length.  Each language has up to ``CLUSTERS`` centroids, from a spherical k-means
over a bounded sample of its labelled texts (at most ``PER_LANGUAGE`` each, drawn
by a hash of the id); the nearest centroid by cosine gives the language.  A text
farther from its centroid than all but one in a hundred of the centroid's own
texts is marked as rejected; its nearest language is still named.

A prediction sees the text alone.  Whole texts are read, a slice at a time.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
without labelled texts every text is ``und``; labels may be null in any row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize, ship_package

DIM = 4096
CLUSTERS = 4
PER_LANGUAGE = 500
SLICE = 1 << 18
SALT = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def gram_counts(text: str) -> np.ndarray:
    """Hashed counts of character runs of the lower-cased text."""
    low = f" {text.lower()} "
    counts = np.zeros(DIM, np.int64)
    for i in range(0, len(low), SLICE):
        a = np.frombuffer(low[i:i + SLICE + 2].encode("utf-32-le", "surrogatepass"), np.uint32)
        n = min(SLICE, len(low) - i)
        x = np.zeros(len(a), np.uint32)
        for k, salt in enumerate(SALT):
            keep = max(0, len(a) - k)
            x = x[:keep] * np.uint32(31) + a[k:] + np.uint32(salt)
            y = x * np.uint32(0x27D4EB2F)
            counts += np.bincount((y ^ (y >> np.uint32(15)))[:n] & np.uint32(DIM - 1), minlength=DIM)
    return counts


def unit(weighted: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(weighted, axis=-1, keepdims=True)
    return weighted / np.where(norm == 0, 1, norm)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _sampled(batches):
    for b in batches:
        lang, vec = [], []
        for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if has_letter(text):
                lang.append(name)
                vec.append(np.log1p(gram_counts(text)).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(vec, pa.binary())], names=["lang", "vec"])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(-1, DIM)


def _frequency(t: pa.Table) -> pa.Table:
    m = _matrix(t.column("vec"))
    return pa.table({"n": [len(m)], "df": [(m > 0).sum(axis=0).astype("<i8").tobytes()]})


def centroids_of(m: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart starts; with the cosine that 99 of 100
    members of each cluster reach."""
    c = unit(m.mean(axis=0, keepdims=True))
    picks = [int((m @ c[0]).argmax())]
    while len(picks) < min(k, len(m)):
        near = (m @ m[picks].T).max(axis=1)
        if near.min() > 1 - 1e-6:
            break
        picks.append(int(near.argmin()))
    c = m[picks]
    for _ in range(rounds):
        who = (m @ c.T).argmax(axis=1)
        c = unit(np.stack([m[who == j].sum(axis=0) if (who == j).any() else c[j] for j in range(len(c))]))
    cos = m @ c.T
    who = cos.argmax(axis=1)
    used = [j for j in range(len(c)) if (who == j).any()]
    return c[used], np.array([np.quantile(cos[who == j, j], 0.01) for j in used])


def _clusters(idf: bytes, k: int):
    def run(t: pa.Table) -> pa.Table:
        m = unit(_matrix(t.column("vec")) * np.frombuffer(idf, "<f4"))
        order = np.lexsort(m[:, :16].T)  # the same start whatever the order of rows
        c, reach = centroids_of(m[order], k)
        return pa.table({"lang": [t.column("lang")[0].as_py()] * len(c),
                         "centroid": [x.astype("<f4").tobytes() for x in c], "reach": reach.astype(float)})

    return run


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, clusters: int = CLUSTERS):
    """``(languages, centroids, reach, idf)`` from the labelled texts given."""
    ship_package(docs.sparkSession)
    known = docs.where("lang is not null and text is not null")
    sizes = known.groupBy("lang").agg(F.count("*").alias("size"))
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)).cast("double") / float(1 << 40)
    # A hash draws the sample, `per_language` different texts each as expected.
    sample = known.join(F.broadcast(sizes) if sizes.count() <= 10_000 else sizes, "lang").where(
        drawn * F.col("size") < per_language).select("lang", "text").dropDuplicates()
    vectors = materialize(sample.mapInArrow(_sampled, "lang string, vec binary"), "language_sample")
    got = vectors.groupBy("lang").applyInArrow(_frequency, "n long, df binary").collect()
    if not got:
        return [], np.empty((0, DIM), np.float32), np.empty(0), np.ones(DIM, np.float32)
    n = sum(r["n"] for r in got)
    df = np.sum([np.frombuffer(r["df"], "<i8") for r in got], axis=0)
    idf = (np.log((1 + n) / (1 + df)) + 0.1).astype("<f4")
    rows = vectors.groupBy("lang").applyInArrow(_clusters(idf.tobytes(), clusters),
                                                "lang string, centroid binary, reach double").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["centroid"])))
    return ([r["lang"] for r in rows], np.stack([np.frombuffer(r["centroid"], "<f4") for r in rows]),
            np.array([r["reach"] for r in rows]), idf)


def _predicted(model):
    langs, centroids, reach, idf = model

    def run(batches):
        for b in batches:
            out, score, rejected = [], [], []
            for t in b.column(1):
                text = t.as_py()
                if not langs or not has_letter(text):
                    out.append("und")
                    score.append(0.0)
                    rejected.append(True)
                    continue
                cos = centroids @ unit(np.log1p(gram_counts(text)).astype(np.float32) * idf)
                j = int(cos.argmax())
                out.append(langs[j])
                score.append(float(min(1.0, max(0.0, cos[j]))))
                rejected.append(bool(cos[j] < reach[j]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, model) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` by a learned model."""
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _predicted(model), "doc_id long, lang_pred string, score double, rejected boolean")


def language_id(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected``; learns from documents
    that are not held out (a null ``doc_id`` is not)."""
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    model = learn(docs.select("doc_id", "text", "lang").where(~out), **options)
    return identify(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score", "rejected")
