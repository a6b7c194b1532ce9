"""Near-duplicate documents by a chosen-path set similarity join.

A document's set holds its distinct five-word shingles.  Documents with equal
sets form a class, found by a grouped minimum over 128-bit set digests; only one
document per class goes on.

* ``TREES`` independent trees.  The root of tree ``t`` branches by the ``t``-th
  minwise value of a set, so a pair of similarity ``s`` meets in a node of the
  tree with probability ``s``.
* A node that is too large to compare branches again by ``BRANCHES`` further
  minwise values chosen from the node's own path (a similar pair stays together
  in at least one child with probability ``1 - (1 - s)^BRANCHES``), down to
  ``DEPTH`` levels.  Nodes still too large after that are compared block against
  block on the full sets, so no pair of a node is ever given up.
* In a large node of copies most pairs say nothing new.  So first every member
  of every root node is compared with the node's head, the member that shares
  most nodes' worth of values with others; the confirmed links give components, and from then on only pairs from different components
  are compared, and nodes inside one component are finished.
* Comparing in a small node uses set sizes and 128 one-byte minwise samples; what
  could reach the similarity is confirmed on the full sets of 64-bit shingle
  hashes.  Blocks count all their intersections at once, as the product of the
  incidence matrix of shingles that occur twice with its transpose.

At similarity 0.75 a pair is missed by all ten trees with a probability of about
1e-6 in small nodes and 2e-6 at full depth; the sampled comparison asks for no
more than five standard deviations below 0.75.

Defined results: a document without words, or with a null text, has an empty set
and is linked with nothing.  Rows that share a ``doc_id`` are one document: their
sets are in one component.  A row without a ``doc_id`` takes part in no link;
its ``component_id`` is null and it is kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import giving_back, materialize, ship_package, small_side
from quarry.llm.graph import connected_components

TREES, EXTRA, BRANCHES, DEPTH = 10, 14, 3, 2
#: Members of a small node; members and shingles of a block of a large one.
NODE_LIMIT, BLOCK, BLOCK_SHINGLES = 64, 512, 250_000
BINS = 128
SHINGLE, PERCENT = 5, 75
#: A sample may fall short of the similarity by so many standard deviations.
DEVIATIONS = 5

PROFILE = "doc_id long, n_shingles long, sig binary, mins array<long>, sample binary"


class WordHash(dict):
    """64-bit hashes of words (bytes), kept while there are not too many."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 40:
            if len(self) >= self.LIMIT:
                self.clear()
            self[word] = h
        return h


HASHES = WordHash()


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes.  ``bytes.lower`` and
    ``bytes.split`` know only ASCII letters and the six ASCII spaces."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    k = min(size, len(h))
    with np.errstate(over="ignore"):
        x = np.full(len(h) - k + 1, np.uint64(k), np.uint64)
        for j in range(k):
            x = x * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - k + 1 + j]
            x ^= x >> np.uint64(29)
        return np.unique(mix(x))


def minwise(s: np.ndarray, seeds: np.ndarray, odd: np.ndarray) -> np.ndarray:
    out = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(s), 4096):
            y = (s[None, i:i + 4096] ^ seeds[:, None]) * odd[:, None]
            y ^= y >> np.uint64(32)
            y *= np.uint64(0x9E3779B97F4A7C15)
            np.minimum(out, y.min(axis=1), out=out)
    return out


def sample_of(s: np.ndarray) -> bytes:
    """One byte (not 0) of the smallest hash in each of ``BINS`` bins; 0: empty."""
    out = np.zeros(BINS, np.uint8)
    bins = (s >> np.uint64(57)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    out[bins[first]] = ((s[first] >> np.uint64(20)) % np.uint64(255)).astype(np.uint8) + 1
    return out.tobytes()


@giving_back
def _profiles(batches):
    rng = np.random.default_rng(20_240_501)
    n = TREES + EXTRA
    seeds = rng.integers(0, 2**63, n, dtype=np.uint64)
    odd = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sig", pa.binary()),
                        ("mins", pa.list_(pa.int64())), ("sample", pa.binary())])
    for batch in batches:
        size, sig, mins, sample = [], [], [], []
        for text in batch.column(1):
            s = shingle_set(text.as_py())
            size.append(len(s))
            sig.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            mins.append(minwise(s, seeds, odd).view(np.int64) if len(s) else None)
            sample.append(sample_of(s) if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(size, pa.int64()),
                                          pa.array(sig, pa.binary()), pa.array(mins, pa.list_(pa.int64())),
                                          pa.array(sample, pa.binary())], schema=schema)


@giving_back
def _sets(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(
            [shingle_set(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())], names=["id", "set"])


def may_link(n1, n2, s1: np.ndarray, s2: np.ndarray) -> np.ndarray:
    """Whether sizes and samples (rows of ``s1``, ``s2``) leave a link possible."""
    sizes = 100 * np.minimum(n1, n2) >= PERCENT * np.maximum(n1, n2)
    used = ((s1 | s2) != 0).sum(axis=-1)
    same = ((s1 == s2) & (s1 != 0)).sum(axis=-1)
    p = PERCENT / 100
    return sizes & (same >= p * used - DEVIATIONS * np.sqrt(p * (1 - p) * used))


def _samples(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BINS)


@giving_back
def _sampled_pairs(batches):
    for b in batches:
        c = {n: b.column(i) for i, n in enumerate(b.schema.names)}
        ok = may_link(c["na"].to_numpy(), c["nb"].to_numpy(), _samples(c["sa"]), _samples(c["sb"]))
        yield pa.RecordBatch.from_arrays([c["a"].filter(pa.array(ok)), c["b"].filter(pa.array(ok))], names=["a", "b"])


def _block_links(t: pa.Table) -> pa.Table:
    """Links between different components inside one pair of blocks."""
    ids, label = t.column("cid").to_numpy(), t.column("label").to_numpy()
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("set")]
    size = np.array([len(s) for s in sets])
    _, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), size)
    shared = count[inverse] > 1
    column = np.cumsum(count > 1)[inverse[shared]] - 1
    row = row[shared]
    both = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 8192):
        a, b = np.searchsorted(column, [lo, lo + 8192])
        m = np.zeros((len(sets), 8192), np.float32)
        m[row[a:b], column[a:b] - lo] = 1
        both += m @ m.T
    link = 100 * both >= PERCENT * (size[:, None] + size[None, :] - both)
    i, j = np.nonzero(np.triu(link & (label[:, None] != label[None, :]), 1))
    return pa.table({"a": np.minimum(ids[i], ids[j]), "b": np.maximum(ids[i], ids[j])})


@giving_back
def _node_pairs(batches):
    """All pairs of a small node that lie in different components and may be
    linked."""
    for b in batches:
        left, right = [], []
        for node in b.column(0).to_pylist():
            ids = np.array([m["cid"] for m in node], np.int64)
            label = np.array([m["label"] for m in node], np.int64)
            n = np.array([m["n"] for m in node], np.int64)
            s = np.frombuffer(b"".join(m["sample"] for m in node), np.uint8).reshape(-1, BINS)
            for i in range(len(ids) - 1):
                j = i + 1 + np.flatnonzero(label[i + 1:] != label[i])
                if len(j):
                    j = j[may_link(n[i], n[j], s[i], s[j])]
                    left.append(np.minimum(ids[i], ids[j]))
                    right.append(np.maximum(ids[i], ids[j]))
        cat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right)]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cat], names=["a", "b"])


@giving_back
def _confirmed(batches):
    for b in batches:
        keep = []
        for x, y in zip(b.column(2), b.column(3)):
            p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(p) + len(q) - both))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])


class _Sets:
    """Full shingle sets of the representatives asked for so far (written)."""

    def __init__(self, docs: DataFrame, repeated: bool):
        self.docs = docs.where("doc_id is not null")
        self.repeated = repeated  # whether rows repeat: else their sets are distinct as they are
        self.known: DataFrame | None = None

    def add(self, ids: DataFrame) -> DataFrame:
        if self.known is not None:
            ids = ids.join(self.known.select("id"), "id", "left_anti")
        ids = small_side(materialize(ids, "ids"), 16)
        text = self.docs.join(ids, self.docs["doc_id"] == ids["id"], "left_semi").select(
            "doc_id", F.col("text").cast("binary").alias("text"))
        text = text.dropDuplicates() if self.repeated else text
        new = materialize(text.mapInArrow(_sets, "id long, set binary"), "sets")
        self.known = new if self.known is None else self.known.unionByName(new)
        return self.known

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` whose full sets are similar enough."""
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        sets = self.add(ids)
        both = pairs.join(sets.withColumnsRenamed({"id": "a", "set": "set_a"}), "a").join(
            sets.withColumnsRenamed({"id": "b", "set": "set_b"}), "b").select("a", "b", "set_a", "set_b")
        return materialize(both.mapInArrow(_confirmed, "a long, b long"), "links")


def _labels_of(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    lab = labels.withColumnsRenamed({"id": "l_id", "label": "l_label"})
    return rows.join(lab, rows[key] == lab["l_id"], "left").drop("l_id")


def components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(profiles, labels)``: the written per-row profiles with the class
    representative ``cid``, and ``id, label`` of representatives with a link."""
    ship_package(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    prof = materialize(docs.select("doc_id", F.col("text").cast("binary").alias("text"))
                       .mapInArrow(_profiles, PROFILE), "profiles")
    live = prof.where("n_shingles > 0 and doc_id is not null")
    classes = materialize(live.groupBy("sig").agg(F.min("doc_id").alias("cid")), "classes")
    reps = materialize(live.join(classes.withColumnRenamed("sig", "c_sig"), (F.col("sig") == F.col("c_sig"))
                                 & (F.col("doc_id") == F.col("cid")), "left_semi")
                       .select(F.col("doc_id").alias("cid"), "sig", F.col("n_shingles").alias("n"), "mins", "sample")
                       .dropDuplicates(["cid", "sig"]), "representatives")
    light = reps.select("cid", "n", "sample")

    # Roots of the trees; nodes with one member have no pairs.
    rows = reps.select("cid", F.posexplode(F.slice("mins", 1, TREES)).alias("tree", "v")).select(
        F.xxhash64("tree", "v").alias("node"), "cid").distinct()
    rows = materialize(rows, "nodes")

    def shared(rows: DataFrame) -> DataFrame:
        nodes = rows.groupBy("node").agg(F.count("*").alias("members")).where("members > 1")
        # Written, so that the join's sides are plain exchanges and a hot node splits.
        return materialize(rows.join(materialize(nodes, "node_sizes"), "node"), "shared_nodes")

    cur = shared(rows)
    repeated = bool(live.groupBy("doc_id", "sig").count().where("count > 1").head(1))
    sets = _Sets(docs, repeated)
    # The original of a group of copies carries the values most of them share, so
    # it sits in the group's largest node of every tree: the heaviest member heads
    # a node, and its copies link to it even where they do not link to each other.
    weight = materialize(cur.groupBy("cid").agg(F.sum("members").alias("weight")), "weights")
    heads = cur.select("node", "cid").join(weight, "cid").groupBy("node").agg(
        F.max(F.struct("weight", (-F.col("cid")).alias("low"))).alias("top")).select(
        "node", (-F.col("top.low")).alias("head"))
    star = cur.select("node", "cid").join(materialize(heads, "heads"), "node")
    star = star.where("cid <> head").select(F.col("head").alias("a"), F.col("cid").alias("b")).distinct()
    star = star.join(light.withColumnsRenamed({"cid": "a", "n": "na", "sample": "sa"}), "a").join(
        light.withColumnsRenamed({"cid": "b", "n": "nb", "sample": "sb"}), "b")
    star = materialize(star.mapInArrow(_sampled_pairs, "a long, b long").distinct(), "star_pairs")
    labels = materialize(connected_components(sets.confirm(star)), "labels")

    found = None
    for level in range(DEPTH):
        cur = _labels_of(cur.select("node", "cid"), labels, "cid").select(
            "node", "cid", F.coalesce("l_label", "cid").alias("label"))
        mixed = cur.groupBy("node").agg(F.count("*").alias("members"), F.min("label").alias("lo"),
                                        F.max("label").alias("hi")).where("lo <> hi").select("node", "members")
        mixed = materialize(mixed, "node_sizes")
        cur = materialize(cur.join(mixed, "node"), "mixed_nodes")
        last = level == DEPTH - 1
        small = cur.where(F.col("members") <= NODE_LIMIT)
        large = cur.where(F.col("members") > NODE_LIMIT)
        member = small.join(light, "cid").groupBy("node").agg(
            F.collect_list(F.struct("cid", "label", "n", "sample")).alias("m")).select("m")
        pairs = materialize(member.mapInArrow(_node_pairs, "a long, b long"), "node_pairs")
        found = pairs if found is None else found.union(pairs)
        if last or not large.head(1):
            break
        path = [F.lit(TREES) + F.pmod(F.xxhash64("node") + 5 * i, F.lit(EXTRA)).cast("int") for i in range(BRANCHES)]
        deeper = large.select("node", "cid").join(reps.select("cid", "mins"), "cid")
        deeper = deeper.select("cid", F.explode(F.array(*[F.xxhash64("node", c, F.get("mins", c)) for c in path]))
                               .alias("node")).distinct()
        cur = shared(materialize(deeper, "nodes"))
    links = sets.confirm(materialize(found.where("a <> b").distinct(), "pairs"))
    if large.head(1):
        links = links.union(_blocks(large, light, sets))
    links = links.union(_one_document(prof, classes))
    # Contract the first components and join the new links' ends.
    ends = _labels_of(_labels_of(links, labels, "a").withColumnRenamed("l_label", "la"), labels, "b").select(
        F.coalesce("la", "a").alias("a"), F.coalesce("l_label", "b").alias("b"))
    merged = materialize(connected_components(ends), "labels")
    every = labels.select("id", "label").union(merged.select("id", F.col("id").alias("label"))).groupBy("id").agg(
        F.min("label").alias("label"))
    labels = _labels_of(every, merged, "label").select("id", F.coalesce("l_label", "label").alias("label"))
    prof = _labels_of(prof.select("doc_id", "n_shingles", "sig"), classes.select(
        F.col("sig").alias("id"), F.col("cid").alias("label")), "sig").withColumnRenamed("l_label", "cid")
    return prof, materialize(labels, "labels")


def _one_document(prof: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``a, b`` between the sets of rows that share a ``doc_id``."""
    own = classes.select(F.col("sig").alias("id"), F.col("cid").alias("label"))
    of = _labels_of(prof.where("doc_id is not null").select("doc_id", "sig"), own, "sig").where("l_label is not null")
    of = of.select("doc_id", F.col("l_label").alias("cid"))
    several = of.groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("b")).where("a <> b").select("doc_id", "a")
    several = small_side(materialize(several, "shared_ids"), 24)
    return of.join(several, "doc_id").where("cid <> a").select("a", F.col("cid").alias("b")).distinct()


def _blocks(large: DataFrame, light: DataFrame, sets: _Sets) -> DataFrame:
    """Links between components in nodes that no path could make small."""
    known = sets.add(large.select(F.col("cid").alias("id")).distinct())
    weighed = large.select("node", "cid", "label", "members").join(light.select("cid", "n"), "cid")
    total = materialize(weighed.groupBy("node").agg(F.sum("n").alias("total")), "node_sizes")
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("total") / BLOCK_SHINGLES)).cast("int")
    dealt = weighed.join(total, "node").select("node", "cid", "label", blocks.alias("blocks")).withColumn(
        "x", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    other = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda y: F.struct(
        F.least(y, F.col("x")).alias("x1"), F.greatest(y, F.col("x")).alias("x2")))
    parts = dealt.select("node", "cid", "label", F.inline(other)).join(
        known.withColumnRenamed("id", "cid"), "cid")
    return materialize(parts.groupBy("node", "x1", "x2").applyInArrow(_block_links, "a long, b long").distinct(), "links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    prof, labels = components(docs)
    out = _labels_of(prof, labels, "cid")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("l_label", "cid", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is the smallest of its component.  Of rows
    that are equal in all columns one stays; rows of one document that differ stay
    together, and so do rows without a ``doc_id``."""
    gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    gone = small_side(materialize(gone, "near_duplicates"), 16)
    doc = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id")
    stay = doc.join(gone, doc["doc_id"] == gone["gone_id"], "left_anti")
    again = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("again_id")).count().where("count > 1")
    again = materialize(again.select("again_id"), "repeated_ids")
    if again.isEmpty():
        return stay.select("doc.*")
    again = small_side(again, 16)
    repeated = stay["doc_id"] == again["again_id"]
    once = stay.join(again, repeated, "left_anti").select("doc")
    return once.unionByName(stay.join(again, repeated, "left_semi").select("doc").distinct()).select("doc.*")
