"""Best-fit packing of token sequences by fitted length patterns.

Documents become pieces of at most ``SEQUENCE`` tokens.  Only the histogram of
piece lengths (at most ``SEQUENCE`` numbers) reaches the driver, where

1. patterns of few documents (two to four coarse lengths that fill a sequence)
   are enumerated and their repeat counts are fitted to the coarse histogram by
   non-negative least squares, then rounded down;
2. each pattern takes its documents from the exact histogram, in runs of equal
   length, its smallest place as the longest length that still fits;
3. what is left goes, longest first, to the fullest place it fits in, whether
   left over in a pattern or in a new sequence.

All three work on runs of equal lengths, so the plan's size follows the number of
distinct lengths, not of documents.  A plan row gives places to the documents of
one length by their rank; ranks come from counts per partition and length, so no
task ever orders all documents of one length.

Defined results: a null or empty text is one piece with the end token alone;
repeated rows and rows without a ``doc_id`` are packed like any other row.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import give_back, materialize, ship_package

SEQUENCE = 4096
END_ID = 1
#: Patterns are enumerated over lengths rounded up to this many tokens.
GRID = 32
PIECE = ("doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long")


class ChunkIds(dict):
    """Token ids (little-endian uint32 bytes) of chunks of a text between white
    space.  The tokenizer folds white space, lower-cases and splits without
    looking past white space, so chunks stand for themselves.

    Two generations of about ``LIMIT`` chunks each are kept: when the younger is
    full it becomes the older, and what is still in use moves back."""

    LIMIT = 300_000
    #: Longer chunks are not kept.
    LONGEST = 64

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        super().__init__()
        self.older: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # For words that are folded already and stand between spaces.
        self.lean = Tokenizer(self.tokenizer.model)
        self.lean.normalizer = normalizers.Sequence([])
        self.lean.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        #: Whether a token id ends a word.
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        #: The ids of what stems may end in.
        self.comma, self.stop = (int.from_bytes(x, "little") for x in self.each([",", "."]))

    def each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: list[str]) -> dict[str, bytes]:
        """Lower-case words of letters, encoded in one call: each is one pre-token,
        and its last token is marked as a word's end."""
        if not words:
            return {}
        ids = np.array(self.lean.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        last = np.flatnonzero(self.ends[ids]) + 1
        if len(last) != len(words):
            return dict(zip(words, self.each(words)))
        raw, at = ids.tobytes(), [0, *(4 * last).tolist()]
        return dict(zip(words, [raw[a:b] for a, b in zip(at, at[1:])]))

    def learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Words of letters are encoded together, other chunks as they are."""
        plain = [c for c in chunks if c.isalpha()]
        rest = [c for c in chunks if not c.isalpha()]
        return self.words(plain) | dict(zip(rest, self.each(rest)))

    def of(self, chunks: list[str]) -> list[bytes]:
        """Ids of different chunks; those not seen before are encoded together."""
        if len(self) >= self.LIMIT:
            self.older = dict(self)
            self.clear()
        out = list(map(self.get, chunks))
        gone = [i for i, v in enumerate(out) if v is None]
        found = list(map(self.older.get, [chunks[i] for i in gone]))
        new = self.learn([chunks[i] for i, v in zip(gone, found) if v is None])
        for i, v in zip(gone, found):
            c = chunks[i]
            out[i] = v = new[c] if v is None else v
            if len(c) <= self.LONGEST:
                self[c] = v
        return out


#: Texts for which chunks are not safe go to the tokenizer whole: those with
#: separators that are white space to some only, with a dotted capital I (its lower
#: case is two characters), with characters from the combining marks on, or with a
#: special token's start.
UNSAFE = r"[\x1c-\x1f\x{85}\x{a0}\x{130}\x{300}-\x{10ffff}]|<\|"
SPACE = re.compile(r"[\x20\x09-\x0D]")
#: Bytes of texts that are taken together, and characters of a slice of a longer text.
BLOCK = 1 << 20
#: Rows of a batch whose ids are held at a time.
ROWS = 2000
_LOADED: dict[str, ChunkIds] = {}


def chunk_ids(path: str) -> ChunkIds:
    if path not in _LOADED:
        # A task has one core.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _LOADED[path] = ChunkIds(path)
    return _LOADED[path]


def _slices(text: str):
    """A text cut at white space."""
    at = 0
    while len(text) - at > BLOCK and (space := SPACE.search(text, at + BLOCK)):
        yield text[at:space.start()]
        at = space.start()
    yield text[at:]


def _placed(which: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of ``length[k]`` numbers one after the other: the places of the runs
    ``which``, and where each of those begins in the result (and the last ends)."""
    n = length[which]
    upto = np.concatenate([[0], np.cumsum(n)])
    begin = np.cumsum(length) - length
    return np.repeat(begin[which] - upto[:-1], n) + np.arange(upto[-1]), upto


def chunk_table(chunks: pa.Array, cache: ChunkIds) -> tuple[np.ndarray, np.ndarray]:
    """Ids of different chunks, one after the other, and their numbers.  A chunk is
    looked up in lower case, and without a comma or a full stop after a letter or a
    digit, which is a token of its own."""
    low = pc.utf8_lower(chunks)
    marked = pc.match_substring_regex(low, r"[\pL\pN][,.]$")
    stems = pc.if_else(marked, pc.utf8_slice_codeunits(low, 0, -1), low).dictionary_encode()
    distinct = stems.dictionary.to_pylist()
    values = [b"" if c == "" else v for c, v in zip(distinct, cache.of([c or "." for c in distinct]))]
    ids = np.frombuffer(b"".join(values), "<u4")
    place, upto = _placed(stems.indices.to_numpy(), np.fromiter(map(len, values), np.int64, len(values)) // 4)
    tail = np.asarray(marked)
    mark = np.where(np.asarray(pc.ends_with(low, ",")), cache.comma, cache.stop)
    return np.insert(ids[place], upto[1:][tail], mark[tail]), np.diff(upto) + tail


def block_ids(texts: pa.Array, cache: ChunkIds) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of safe texts, one after the other, and where each begins (and the
    last ends).  A chunk's ids are looked up once, however often it occurs."""
    lists = pc.ascii_split_whitespace(texts)
    chunks = lists.flatten().dictionary_encode()
    ids, length = chunk_table(chunks.dictionary, cache)
    place, upto = _placed(chunks.indices.to_numpy(), length)
    at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    return ids[place], upto[at]


def texts_ids(texts: pa.Array, cache: ChunkIds) -> list[bytes]:
    """Token ids of every text (null: none), as little-endian uint32 bytes."""
    texts = texts.fill_null("")
    out: list[bytes] = [b""] * len(texts)
    odd = np.asarray(pc.match_substring_regex(texts, UNSAFE))
    size = pc.binary_length(texts).to_numpy()
    for i in np.flatnonzero(odd):
        out[i] = cache.each([texts[i].as_py()])[0]
    for i in np.flatnonzero(~odd & (size > BLOCK)):
        out[i] = b"".join(block_ids(pa.array([part]), cache)[0].tobytes() for part in _slices(texts[i].as_py()))
    rest = np.flatnonzero(~odd & (size <= BLOCK))
    block = np.cumsum(size[rest]) // BLOCK
    for k in np.unique(block):
        own = rest[block == k]
        ids, at = block_ids(texts.take(pa.array(own)), cache)
        raw, at = ids.tobytes(), (4 * at).tolist()
        for i, a, b in zip(own.tolist(), at, at[1:]):
            out[i] = raw[a:b]
    return out


def _pieces(path: str, limit: int, end: int):
    def run(batches):
        cache = chunk_ids(path)
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        last = np.array([end], "<u4").tobytes()
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            out = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), texts_ids(batch.column(1), cache)):
                ids += last
                for i, at in enumerate(range(0, len(ids), 4 * limit)):
                    piece = ids[at:at + 4 * limit]
                    n = len(piece) // 4
                    seen[n] = seen.get(n, -1) + 1
                    out.append((doc_id, i, at // 4, n, zlib.crc32(piece), part, seen[n]))
            cols = list(zip(*out)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if k in (1, 5) else pa.int64()) for k, c in enumerate(cols)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])
            # Between blocks a third to a half of the worker's memory is free.
            give_back()

    return run


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """min |a x - b| with x >= 0, by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    for _ in range(rounds):
        w = a.T @ (b - a @ x)
        w[passive] = -np.inf
        j = int(np.argmax(w))
        if w[j] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        passive[j] = True
        while True:
            idx = np.flatnonzero(passive)
            z = np.linalg.lstsq(a[:, idx], b, rcond=None)[0]
            if len(z) == 0 or z.min() > 1e-12:
                break
            low = z <= 1e-12
            step = np.min(x[idx][low] / np.maximum(x[idx][low] - z[low], 1e-300))
            x[idx] += step * (z - x[idx])
            passive[idx[x[idx] <= 1e-12]] = False
            x[~passive] = 0
        x[:] = 0
        x[idx] = z
    return x


def patterns(cells: int, most: int = 4) -> list[tuple[int, ...]]:
    """Multisets of two to ``most`` cells (at least two each) that sum to ``cells``."""
    out: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], left: int, top: int) -> None:
        if left == 0 and len(head) > 1:
            out.append(head)
        elif left > 0 and len(head) < most:
            for c in range(min(top, left), 0, -1):
                grow((*head, c), left - c, c)

    grow((), cells, cells - 1)
    return out


def plan(histogram: dict[int, int], limit: int = SEQUENCE, grid: int = GRID) -> list[tuple[int, ...]]:
    """Rows ``(length, rank_lo, count, first sequence, sequences, offset)``: the
    ``count`` documents of a length from ``rank_lo`` on go round the sequences,
    one after the other from ``offset`` in each."""
    left = {n: c for n, c in histogram.items() if c > 0}
    taken = dict.fromkeys(left, 0)
    rows: list[tuple[int, ...]] = []
    space: dict[int, list[tuple[int, int]]] = {}  # free tokens: (first sequence, sequences)
    sequences = 0

    def put(n: int, count: int, first: int, bins: int, offset: int) -> None:
        rows.append((n, taken[n], count, first, bins, offset))
        taken[n] += count
        left[n] -= count
        if not left[n]:
            del left[n]

    if left.get(limit):
        put(limit, left[limit], 0, left[limit], 0)
        sequences = taken[limit]
    cells = limit // grid
    lengths = sorted(n for n in left)
    if cells > 2 and lengths:
        h = np.zeros(cells + 1)
        for n in lengths:
            h[-(-n // grid)] += left[n]
        pats = [p for p in patterns(cells) if all(h[c] for c in p)]
        if pats:
            a = np.zeros((cells, len(pats)))
            for j, p in enumerate(pats):
                for c in p:
                    a[c - 1, j] += 1
            repeats = np.floor(nnls(a, h[1:]) + 1e-9).astype(np.int64)
            own = {c: [n for n in reversed(lengths) if -(-n // grid) == c] for c in range(1, cells + 1)}
            for j in np.argsort(-repeats, kind="stable"):
                need = int(repeats[j])
                while need > 0:
                    # One run: the longest lengths left in the larger cells, the
                    # longest that fits beside them, as often as all allow.
                    pick = []
                    for c in pats[j][:-1]:
                        pick.append(next((n for n in own[c] if left.get(n, 0) > pick.count(n)), 0))
                    if not all(pick):
                        break
                    k = bisect_left(lengths, limit - sum(pick) + 1) - 1
                    while k >= 0 and left.get(lengths[k], 0) <= pick.count(lengths[k]):
                        k -= 1
                    if k < 0:
                        break
                    pick.append(lengths[k])
                    m = min(need, *(left[n] // pick.count(n) for n in pick))
                    at = 0
                    for n in pick:
                        put(n, m, sequences, m, at)
                        at += n
                    if limit - at:
                        space.setdefault(limit - at, []).append((sequences, m))
                    sequences += m
                    need -= m
    free = sorted(space)
    for n in sorted(left, reverse=True):
        while left.get(n):
            count = left[n]
            k = bisect_left(free, n)
            if k == len(free):
                per = limit // n
                first, bins, room = sequences, -(-count // per), limit
                sequences += bins
            else:
                room = free[k]
                per = room // n
                first, bins = space[room].pop()
                if not space[room]:
                    del space[room], free[k]
            full = min(bins, count // per)
            used = [(full, per)] if full else []
            if full < bins and count - full * per:
                used.append((1, count - full * per))
            done = 0
            for m, each in used:
                put(n, m * each, first + done, m, limit - room)
                _give(space, free, room - each * n, first + done, m)
                done += m
            _give(space, free, room, first + done, bins - done)
    return rows


def _give(space, free, room: int, first: int, bins: int) -> None:
    if room > 0 and bins > 0:
        if room not in space:
            free.insert(bisect_left(free, room), room)
            space[room] = []
        space[room].append((first, bins))


def _places(rows):
    """Places of a batch of ``(length, rank)`` by the plan, as arrays."""
    t = np.array(sorted(rows), np.int64).reshape(-1, 6)
    key = (t[:, 0] << np.int64(45)) + t[:, 1]

    def run(batches):
        for b in batches:
            n, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(key, (n << np.int64(45)) + rank, side="right") - 1
            i, bins = rank - t[at, 1], t[at, 4]
            keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array(t[at, 3] + i % bins), pa.array(t[at, 5] + i // bins * n)],
                names=[*keep, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, limit: int = SEQUENCE, end: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``.  ``tokenizer`` is the path of the vocabulary file."""
    ship_package(docs.sparkSession)
    pieces = materialize(docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, limit, end), PIECE), "pieces")
    counts = materialize(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece_counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = plan(histogram, limit)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(_places(rows), "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                            "sequence_id long, offset long")
