"""Ranked search, neighbour voting and Orchard clustering against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import frame
from tests.llm.test_operators import lower, rows

from quarry.llm import neighbours, orchard, packing, retrieval
from quarry.llm.queries import tokenizer

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


# ---- op11
def ranked(docs, items, top=10):
    counts = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n, total = len(counts), sum(m for *_, m in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        asked, found = Counter(TERM.findall(lower(text))), []
        for i, c, size in counts:
            m = 100 - 75 + (75 * size * n) // total
            s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t, r in asked.items() if c[t])
            if s:
                found.append((-s, i is None, i))
        out += [{"item_id": item, "rank": k + 1, "doc_id": i, "score": -s}
                for k, (s, _, i) in enumerate(sorted(found, key=lambda x: (*x[:2], x[2] or 0))[:top])]
    return sorted(out, key=repr)


def texts_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


ASKED = [(1, "common W1 w2 shared licence"), (1, "common W1 w2 shared licence"), (2, None), (3, ""), (None, "é" * 30 + " a a a"),
         (4, "nowhere-to-be found"), (5, "same words here again and orphan, text"), (6, "Common " * 50)]


@pytest.mark.parametrize("postings", [retrieval.POSTINGS, 4])
def test_ranked_search(spark, edge, postings):
    items = spark.createDataFrame(ASKED, ITEMS).withColumn("doc_id", F.lit("x"))
    got = retrieval.ranked_search(edge, items, postings=postings)
    assert rows(got) == ranked(texts_of(edge), ASKED)


def test_ranked_search_ties_and_heaps(spark):
    rnd = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "Éta", "9", "zeta"]
    texts = [" ".join(rnd.choices(words, k=rnd.randrange(1, 12))) for _ in range(300)] + ["alpha beta"] * 60
    docs = frame(spark, texts, [x * 7 % 360 for x in range(360)]).repartition(7)
    asked = [(i, " ".join(rnd.choices(words, k=4))) for i in range(9)]
    want = ranked([(x * 7 % 360, t) for x, t in enumerate(texts)], asked)
    assert rows(retrieval.ranked_search(docs, spark.createDataFrame(asked, ITEMS))) == want


def test_search_blocks_of_scores():
    """Heaps are the same however the documents are cut into blocks."""
    rnd = np.random.default_rng(2)
    scores, docs = rnd.integers(0, 6, (200, 5)), rnd.permutation(200)
    whole, bits = retrieval.Heaps(5, 10), retrieval.Heaps(5, 10)
    whole.offer(scores, docs, np.zeros(200, bool))
    for a in range(0, 200, 7):
        bits.offer(scores[a:a + 7], docs[a:a + 7], np.zeros(len(docs[a:a + 7]), bool))
    assert [x.tolist() for x in whole.kept] == [x.tolist() for x in bits.kept]
    for j in range(5):
        best = sorted(zip(-scores[:, j], docs))[:10]
        own = whole.kept[0] == j
        assert list(zip(-whole.kept[1][own], whole.kept[3][own])) == [b for b in best if b[0]]


def test_search_terms_across_slices(monkeypatch):
    monkeypatch.setattr(retrieval, "SLICE", 16)
    raw = ("Word " * 40 + "x" * 100 + " tail,END é").encode()
    assert [t for part in retrieval.term_slices(raw) for t in part] == [t.encode() for t in TERM.findall(lower(raw.decode()))]


def test_search_empty_tables(spark, edge, nothing):
    none, some = spark.createDataFrame([], ITEMS), spark.createDataFrame(ASKED, ITEMS)
    for docs, items in ((nothing, some), (edge, none), (nothing, none)):
        got = retrieval.ranked_search(docs, items)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


# ---- op12
def labelled(spark, n=400):
    rnd = random.Random(5)
    words = ["the", "river", "stone", "walks", "over", "green", "hills", "today", "and", "sings"]
    texts, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        some = [rnd.choice(words) + (rnd.choice(["***", "$$$"]) if bad else "") for _ in range(rnd.randrange(4, 60))]
        texts.append(" ".join(some))
        labels.append((i, 0 if bad else 1, 0))
    return frame(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), texts, labels


def test_neighbour_scores_are_brute_force(spark):
    docs, labels, texts, marks = labelled(spark)
    got = {r["doc_id"]: r for r in neighbours.quality_scores(docs, labels).collect()}
    held = {i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert {i for i, r in got.items() if r["held_out"]} == held
    cells = [neighbours.text_cells(t.encode()) for t in texts]
    fitted = sorted((y, cells[i][0].astype("<u2").tobytes(), cells[i][1].astype("<f4").tobytes()) for i, y, _ in marks if i not in held)
    y = np.array([f[0] for f in fitted])
    m = neighbours.fit([(np.frombuffer(c, "<u2"), np.frombuffer(v, "<f4")) for _, c, v in fitted], y.tolist(),
                       dict(Counter(y.tolist())))
    for i in sorted(held):
        cos = [float(v @ m.project([cells[i]])[0]) for v in m.vectors]
        least = sorted(cos)[-neighbours.NEIGHBOURS]
        near = [(c, q) for c, q in zip(cos, y) if c >= least - 1e-5 and c > 0]
        want = sum(c * q for c, q in near) / sum(c for c, _ in near)
        assert got[i]["score"] == pytest.approx(want, abs=2e-3)
        assert got[i]["predicted"] == (got[i]["score"] >= 0.3)
    assert np.mean([got[i]["predicted"] == marks[i][1] for i in held]) >= 0.95


def test_neighbour_sample_is_bounded(spark):
    docs, labels, *_ = labelled(spark)
    m = neighbours.learn(docs, labels, per_label=20, rank=8)
    assert m.vectors.shape == (40, 8) and m.votes[m.labels == 1].sum() == pytest.approx(266)


def test_neighbour_odd_rows(spark, edge, nothing):
    odd = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (4, 1, 1), (7, None, 0), (None, 1, 0), (9, 5, 0), (3, 0, 0), (99, 1, 0),
                                 (10, 1, None)], "doc_id long, quality int, toxic int")
    got = neighbours.quality_scores(edge, odd).collect()
    assert len(got) == edge.count() and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
    same = [r["score"] for r in got if r["doc_id"] == 10]
    assert len(same) == 2 and same[0] == same[1]
    assert neighbours.quality_scores(nothing, odd).count() == 0
    free = neighbours.quality_scores(edge, odd.limit(0)).collect()
    assert {r["score"] for r in free} == {0.5} and len(free) == edge.count()


def test_neighbour_cells_of_long_texts(monkeypatch):
    text = ("some words here " * 300).encode()
    whole = neighbours.text_cells(text)
    monkeypatch.setattr(neighbours, "SLICE", 1000)
    bits = neighbours.text_cells(text)
    marks = [c for c in whole[0] if c < neighbours.MARKS]
    assert marks == [c for c in bits[0] if c < neighbours.MARKS]
    assert len(neighbours.text_cells(b"")[0]) == 1


# ---- op13
VECTORS = "vec_id long, embedding array<float>, label int"


def brute_clusters(vectors, k, rounds, dim):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in vectors
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    tag = sorted((i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest(), q) for i, q in kept)
    c = [q for *_, q in tag[:k]]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, x)), j) for j, x in enumerate(c))

    for _ in range(rounds):
        who = [near(q)[1] for _, q in kept]
        for j in range(len(c)):
            own = [q for (_, q), w in zip(kept, who) if w == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own)]
    out = [(i, *near(q)) for i, q in kept]
    total = Counter()
    for _, d, j in out:
        total[j] += d
    return sorted(({"vec_id": i, "cluster": j, "distance": d, "cluster_inertia": total[j], "inertia": sum(total.values()),
                    "centroid_sha256": hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest(), "centroid": c[j]}
                   for i, d, j in out), key=repr)


def test_orchard_clusters(spark):
    rnd = np.random.default_rng(4)
    near = rnd.normal(size=(6, 8))
    vectors = [(i, (near[i % 6] + rnd.normal(size=8) * 0.3).tolist()) for i in range(240)]
    vectors += [(i, vectors[0][1]) for i in range(1000, 1080)]  # a hot vector
    vectors += [(0, vectors[0][1]), (7, vectors[9][1]), (None, vectors[3][1]), (300, None), (301, []), (302, [1.0] * 7),
                (303, [1.0] * 7 + [None]), (304, [math.nan] * 8), (305, [math.inf] + [0.0] * 7), (306, [-0.001] * 8)]
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], VECTORS).repartition(5)
    df = df.withColumns({"cluster": F.lit("x"), "q": F.lit(1)})
    got = orchard.clusters(df, k=6, rounds=3, dim=8)
    assert rows(got) == brute_clusters(vectors, 6, 3, 8)


def test_orchard_search_is_exact_and_saves_distances():
    rnd = np.random.default_rng(8)
    c = rnd.integers(-60, 60, (40, 3))
    c[7], c[30] = c[3], c[12]  # equal centroids
    x = np.concatenate([c[rnd.integers(0, 40, 900)] + rnd.integers(-4, 5, (900, 3)), rnd.integers(-60, 60, (300, 3))])
    who, d, taken = orchard.Orchard(c).nearest(x)
    full = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (d == full.min(axis=1)).all() and (who == full.argmin(axis=1)).all()
    assert taken < 0.6 * full.size


def test_orchard_small_and_empty(spark):
    few = [(1, [0.5, 0.5]), (2, [0.1, -0.1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in few], VECTORS)
    assert rows(orchard.clusters(df, k=5, dim=2)) == brute_clusters(few, 5, 3, 2)
    none = orchard.clusters(spark.createDataFrame([], VECTORS))
    assert none.count() == 0 and none.columns[:3] == ["vec_id", "cluster", "distance"]
    with pytest.raises(Exception, match="too large"):
        orchard.clusters(spark.createDataFrame([(1, [1e30, 0.0], 0)], VECTORS), k=1, dim=2).count()


# ---- op6: ids by distinct chunks
def test_packing_ids_equal_the_tokenizer(monkeypatch):
    import pyarrow as pa

    cache = packing.ChunkIds(tokenizer("word_bpe_49k.json"))
    rnd = random.Random(9)
    words = ["Hello", "hello,", "WORLD.", "don't", "it's", "x2,", "3.", "***,", "naïve", "ÉTÉ.", "ß", "ǅ", "a.b", "…", "-", "İstanbul",
             "12,5", ",", ".", "ªº", "co-op.", "<|endoftext|>", "<|", "é", "　", "日本", "q" * 90, "\xa0x", "a\x85b"]
    texts = [" ".join(rnd.choices(words, k=n)) for n in (0, 1, 2, 5, 9, 30, 200)] * 3
    texts += [None, "", "  \n\t ", " lead", "tail ", "a  b\x0bc\x0cd\re", *words, "two\nlines, each.\n"]
    monkeypatch.setattr(packing.ChunkIds, "LIMIT", 5)
    for block in (packing.BLOCK, 40):
        monkeypatch.setattr(packing, "BLOCK", block)
        got = packing.texts_ids(pa.array(texts, pa.string()), cache)
        for t, ids in zip(texts, got):
            want = cache.tokenizer.encode(t or "", add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want, t
