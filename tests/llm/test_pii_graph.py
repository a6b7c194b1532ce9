"""The whole bootstrapped graph of op1 against brute force, long numbers and long texts."""

import math
import random
import re
import time
from collections import defaultdict

from tests.llm.conftest import frame
from tests.llm.test_operators import base_spans, spans_of

from quarry.llm import pii

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def units_of(t):
    """Units as ``(value, start, stop, class, seeds)``."""
    merged = []
    for a, _, kind, b in base_spans(t):
        seed = (kind, t[a:b].lower())
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]), merged[-1][2] + [seed])
        else:
            merged.append((a, b, [seed]))
    out, at = [], 0
    for a, b, seeds in [*merged, (len(t), len(t), None)]:
        for m in re.finditer(r"[^\x20\x09-\x0D]+", t[at:a]):
            core = m[0].strip(pii.EDGES)
            if core:
                start = at + m.start() + m[0].index(core)
                bare = re.fullmatch(r"\+?[0-9]+", core)
                number = any(c in "0123456789" for c in core) and not any(c.isalpha() for c in core)
                out.append((core.lower(), start, start + len(core), 2 if bare else int(number), None))
        if seeds:
            out.append((seeds[0][1], a, b, 0, seeds))
        at = b
    return out


def places_of(u):
    n, c = len(u), [x[3] for x in u]
    v = lambda i: u[i][0] if 0 <= i < n else None
    left = lambda i: ("L", v(i - 2), v(i - 1)) if i else None
    right = lambda e: ("R", v(e + 1), v(e + 2)) if e + 1 < n else None
    both = lambda i, e: ("B", v(i - 1), v(e + 1)) if e - i + 1 < n else None
    for i in range(n):
        in_run = lambda j: 0 <= j < n and c[i] == 2 and c[j] == 2  # noqa: B023, E731
        yield i, 1, v(i), u[i][4], [None if in_run(i + 1) else left(i), None if in_run(i - 1) else right(i), both(i, i)]
    for least in (2, 1):
        i = 0
        while i < n:
            e = i
            while e < n and c[e] >= least:
                e += 1
            if e - i > 1:
                value = " ".join(v(j) for j in range(i, e))
                yield i, e - i, value, None, [left(i), right(e - 1), None] if least == 2 else [None, None, both(i, e - 1)]
            i = max(e, i + 1)


def added(texts, support=3, floor=0.6, accept=0.7):
    units = [units_of(t) for t in texts]
    spots = [(t, *p) for t, u in enumerate(units) for p in places_of(u)]
    seeds = {(k, val, p) for _, _, _, _, s, ps in spots for k, val in s or () for p in ps if p}
    edges = {(val, p) for _, _, _, val, s, ps in spots if s is None for p in ps if p}
    size = defaultdict(set)
    for val, p in edges | {(val, p) for _, val, p in seeds}:
        size[p].add(val)
    believed = {}
    while True:
        told = {(k, val, p): 1.0 for k, val, p in seeds}
        weight, n = defaultdict(float), defaultdict(int)
        extra = [((k, val, p), b) for val, (b, k) in believed.items() for v2, p in edges if v2 == val]
        for (k, _, p), b in [*told.items(), *extra]:
            weight[p, k] += b
            n[p, k] += 1
        good = {pk: w / (len(size[pk[0]]) + 1) for pk, w in weight.items() if n[pk] >= support}
        good = {pk: x for pk, x in good.items() if x >= floor}
        doubt = defaultdict(float)
        for val, p in edges:
            for k in pii.KINDS:
                if (p, k) in good:
                    doubt[val, k] += math.log(1 - good[p, k])
        best = defaultdict(lambda: (0.0, ""))
        for (val, k), x in doubt.items():
            if 1 - math.exp(x) >= accept:
                best[val] = max(best[val], (1 - math.exp(x), k))
        new = set(best) - set(believed)
        believed = dict(best)
        if not new:
            break
    out = []
    for t, u in enumerate(units):
        found = []
        for tt, i, m, val, s, ps in spots:
            if tt == t and s is None and val in believed:
                b, k = believed[val]
                if not all(x.isalpha() for x in val) or any((p, k) in good for p in ps if p):
                    found.append((-b, -m, i, m, k))
        kept = []
        for _, _, i, m, k in sorted(found):
            if all(i >= j + w or j >= i + m for j, w, _ in kept):
                kept.append((i, m, k))
        out.append({(k, u[i][1], u[i + m - 1][2]) for i, m, k in kept})
    return out


def spans(line):
    return {(k, int(a), int(b)) for k, a, b in (x.split(":") for x in line.split(",") if x)}


def corpus(seed):
    rnd = random.Random(seed)
    texts = []
    for _ in range(90):
        words = []
        for _ in range(rnd.randrange(2, 7)):
            words += rnd.choices(["call", "now", "the", "desk", "mail", "to", "ref", "17", "4 4", "due,", "(see", "x-1"], k=rnd.randrange(1, 3))
            kind = rnd.random()
            if kind < 0.3:
                words += ["dial", "line", rnd.choice([f"+1 234 555 0{rnd.randrange(10, 18)}{rnd.randrange(10)}", "555 0104",
                                                      "5 5 5 0 1 0 4 4 7 7", "555-0199", "Ext9"]), "for", "help"]
            elif kind < 0.5:
                words += ["write", "at", rnd.choice([f"u{rnd.randrange(6)}@ex.org", "bob(at)ex", "carol"]), "soon"]
        texts.append(" ".join(words))
    return texts


def test_pii_graph_equals_brute_force(spark):
    for seed, options in ((1, {}), (2, {"floor": 0.4, "accept": 0.5, "support": 2})):
        texts = corpus(seed)
        want = added(texts, **options)
        renamed = {"pattern_floor" if k == "floor" else k: v for k, v in options.items()}
        got = spans_of(spark, texts, **renamed)
        assert sum(map(len, want)) > 10
        for t, line, extra in zip(texts, got, want):
            assert spans(line) == extra | {(k, a, b) for a, _, k, b in base_spans(t)}, t


def test_pii_long_numbers_are_whole(spark):
    seeds = [f"kindly phone desk +1 234 555 67{i:02d} before noon" for i in range(12)]
    groups = "5 5 5 0 1 0 4 4 7 7"
    many = " ".join(str(i % 10) for i in range(60))
    got = spans_of(spark, [*seeds, f"kindly phone desk {groups} before noon", f"kindly phone desk {many} before noon"])
    assert got[12:] == [f"phone:18:{18 + len(groups)}", f"phone:18:{18 + len(many)}"]


def test_pii_texts_with_very_many_matches(spark):
    n = 40_000
    long = " ".join(f"write at u{i}@ex.org soon" for i in range(n)) + " write at bob(at)ex soon" * 3000
    docs = frame(spark, [long, "short text"])
    began = time.time()
    got = {r["doc_id"]: r for r in pii.personal_data(docs).select("doc_id", "n_email", "n_added").collect()}
    assert got[0]["n_email"] == n and got[0]["n_added"] == 3000
    assert time.time() - began < 90  # of this, a few seconds a job are Spark's own
    print("seconds", time.time() - began)
