"""Operators against brute force on small fixtures with awkward rows."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from tests.llm.conftest import frame

from quarry.llm import (decontam, langid, linedup, neardup, packing, pii, quality, sharding, substring, tokens)
from quarry.llm.queries import tokenizer

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def rows(df):
    return sorted((r.asDict() for r in df.collect()), key=repr)


def texts_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


# ---- op1
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (1 + i % 2)
        s += n - 9 * (n > 9)
    return s % 10 == 0


def base_spans(t):
    out = []
    for k, (kind, p) in enumerate(BASE.items()):
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (
                    12 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 9 <= len(d) <= 15):
                continue
            out.append((m.start(), k, kind, m.end()))
    return sorted(out)


TRICKY = ["a@b.c_d@e.f and x@y", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.0255", "4111111111111111 4111-1111-1111-1112",
          "+1 (234) 555-6789) +12 +123456789012345678", "é" * 3 + " ü@b.de x.y@z-q.co.uk.", "0" * 3000 + "@", "😀 a@b.cd 😀 1.1.1.1"]


def test_pii_base_spans(spark, edge):
    for docs in (edge, frame(spark, TRICKY)):
        want = Counter()
        for d, t in texts_of(docs):
            s = base_spans(t)
            line = ",".join(f"{k}:{a}:{e}" for a, _, k, e in s)
            want[(d, *[sum(x[2] == k for x in s) for k in BASE], hashlib.sha256(line.encode()).hexdigest())] += 1
        got = pii.personal_data(docs).collect()
        assert Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got) == want


def test_pii_discovers_in_believed_contexts(spark):
    seeds = [f"please dial hotline number +1 234 555 67{i:02d} for help now" for i in range(12)]
    docs = frame(spark, [*seeds, "please dial hotline number 234-555-9911 for help now", "version 2024 is out of date now"])
    got = {r["doc_id"]: r for r in pii.personal_data(docs).collect()}
    assert got[12]["spans"] == "phone:27:39" and got[12]["n_added"] == 1 and got[12]["n_phone"] == 0
    assert got[13]["spans"] == ""


def spans_of(spark, texts, **options):
    got = {r["doc_id"]: r for r in pii.personal_data(frame(spark, texts), **options).collect()}
    return [got[i]["spans"] for i in range(len(texts))]


def test_pii_candidates_need_no_digits(spark):
    mails = [f"please write to user{i}@example.org about your order" for i in range(12)]
    dials = [f"kindly phone desk +1 234 555 67{i:02d} before noon today" for i in range(12)]
    long = "x" * 70 + "@intranet"
    new = ["please write to jane@intranet about your order", "please write to jane(at)example.org, about your order",
           f"please write to {long} about your order", "kindly phone desk (555) 010 4477 before noon today",
           "jane@intranet came by and 555 stayed", "that was 555 010 4477 again"]
    got = spans_of(spark, mails + dials + new)
    assert got[24:] == ["email:16:29", "email:16:35", "email:16:95", "phone:19:32", "email:0:13", "phone:9:21"]


def test_pii_rounds_end_when_nothing_is_new(spark):
    texts = [f"hop0 left user{i}@example.org right end0" for i in range(3)]
    for k in range(5):
        texts += [f"hop{x} left key{k}x{j} right end{x}" for j in range(3) for x in ([k, k + 1] if k < 4 else [k])]
    got = spans_of(spark, texts, pattern_floor=0.2, accept=0.5)
    assert all(x.startswith("email:10:") for x in got)


def test_pii_context_is_the_words_beside(spark):
    seeds = [f"ref 17 10.0.0.{i} 400 due" for i in range(12)]
    far = [f"sum 9 {'w' * 60} u{i}@example.org 12 {'v' * 60}" for i in range(12)]
    got = spans_of(spark, [*seeds, *far, "ref 17 4455-667 400 due", f"sum 9 {'w' * 60} u77 12 {'v' * 60}"])
    assert got[24:] == ["ip:7:15", "email:67:70"]


# ---- op2
def brute_stats(t):
    w = SPACED.findall(t or "")
    seen, dup = set(), 0
    for x in (t or "").split("\n"):
        if SPACED.search(x):
            dup += x in seen
            seen.add(x)
    win = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if win[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(hit)


def test_quality_stats_and_rules(spark, edge):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (9, 0, 0), (9, None, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    extra = frame(spark, ["l a b\nl a b\nl a b\n\n \n&& #", "q w e r t y q w e r t z z z z z z z z"])
    for docs in (edge, extra):
        got = quality.quality_rules(docs, labels).collect()
        want = Counter((d, *brute_stats(t)) for d, t in texts_of(docs))
        assert Counter((r["doc_id"], *[r[c] for c in quality.STATS]) for r in got) == want
        for r in got:
            assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
            assert not (r["kept"] and r["base_failed"])
    kept = quality.keep_good(edge, labels)
    want = quality.quality_rules(edge, labels).where("kept")
    assert kept.columns == edge.columns and kept.count() == want.count()


def test_decision_list_separates_labels(spark):
    good = [" ".join(f"plain{i}x{j}" for j in range(30)) for i in range(60)]
    bad = [" ".join(f"noise{i}x{j} | & %" for j in range(30)) for i in range(60)]
    docs = frame(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in quality.quality_rules(docs, labels).where("kept").collect()}
    assert kept == set(range(60))


def test_rules_are_counted_and_set_aside_as_emitted(spark):
    share = "cast(0.5 + if(bad = 1, id, -id) / 4000 as double)"
    cols = [f"{share if f == 'digit_share' else '0.0D'} as {f}" for f in quality.FEATURES]
    train = spark.range(2000).selectExpr("id", "explode(array(0, 1)) as bad").selectExpr("2 * id + bad as doc_id", "bad", *cols)
    rules = quality.learn_rules(train)
    left = train.where("pmod(xxhash64(doc_id), 3) = 2")
    for r in rules:
        assert (r.bad, r.good) == tuple(left.where(r.column()).where(f"bad = {v}").count() for v in (1, 0))
        left = left.where(~r.column())
    # The lowest cut is the 1/64 quantile of the bad rows; what lies above it is all learned but for one rule's support.
    assert train.where("bad = 1 and digit_share > 0.508").where(quality.verdict(rules).isNull()).count() <= 20


# ---- op3
def words3(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))


def test_decontamination(spark, edge):
    bench = spark.createDataFrame([(1, " ".join(f"w{i} Common" for i in range(3, 20))), (2, "same words"), (2, "one"),
                                   (None, "orphan text"), (3, None), (4, ""), (30, "not there at all")], "item_id long, text string")
    items = {}
    for r in bench.collect():
        w = words3(r["text"])
        if w and r["item_id"] is not None:
            items.setdefault(r["item_id"], set()).update(tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9)))
    want = Counter()
    for d, t in texts_of(edge):
        w = words3(t)
        hit, got = set(), set()
        for item, wins in items.items():
            for x in wins:
                for i in range(len(w) - len(x) + 1):
                    if tuple(w[i:i + len(x)]) == x:
                        hit.update(range(i, i + len(x)))
                        got.add(str(item))
        want[(d, len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest(), bool(hit))] += 1
    got = decontam.decontaminate(edge, bench)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()) == want
    kept = decontam.drop_contaminated(edge, bench)
    assert kept.columns == edge.columns and kept.count() == sum(n for k, n in want.items() if not k[-1])


# ---- op4, op6
ODD = ["it's  we'll\n\n x", " lead", "tail ", "<|endoftext|>a<|endoftext|>", "日本語 text", "\xa0nbsp\x85", "é ́", "😀😀", "\x1c\x1d a"]


def test_token_counts(spark, edge):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    for docs in (edge, frame(spark, ODD)):
        want = Counter()
        for d, x in texts_of(docs):
            n = len(t.encode(x or "", add_special_tokens=False).ids)
            want[(d, len((x or "").encode()), n, n > 512)] += 1
        assert Counter(map(tuple, tokens.token_counts(docs, tokenizer("byte_bpe_50k.json")).collect())) == want


@pytest.mark.parametrize("limit", [64, 4096])
def test_packing(spark, edge, limit):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    for docs in (edge, frame(spark, ODD)):
        want = Counter()
        for d, x in texts_of(docs):
            ids = [*t.encode(x or "", add_special_tokens=False).ids, 1]
            for k, at in enumerate(range(0, len(ids), limit)):
                p = ids[at:at + limit]
                want[(d, k, at, len(p), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in p)))] += 1
        got = packing.pack(docs, path, limit=limit).collect()
        assert Counter(tuple(r)[:5] for r in got) == want
        bins = {}
        for r in got:
            bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for b in bins.values():
            at = 0
            for off, n in sorted(b):
                assert off == at
                at += n
            assert at <= limit


# ---- op5
def test_near_duplicates(spark, edge):
    base = [f"t{i}" for i in range(60)]
    more = [" ".join(base[:k] + ["new"] + base[k + 1:]) for k in (5, 20, 40)] + [" ".join(base), " ".join(base[:30])]
    for docs in (edge.where("doc_id is not null"), frame(spark, more)):
        sets = {}
        for d, t in texts_of(docs):
            w = SPACED.findall(lower(t))
            sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        root = {d: d for d in sets}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a in sets:
            for b in sets:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
        got = neardup.near_duplicates(docs).collect()
        assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
            (d, len(s), find(d), find(d) == d) for d, s in sets.items()}
        assert len(got) == docs.count()
    orphans = [r for r in neardup.near_duplicates(edge).collect() if r["doc_id"] is None]
    assert len(orphans) == 2 and all(r["component_id"] is None and r["kept"] for r in orphans)


def test_blocks_find_all_links():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 400, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool[:120], 100)) for _ in range(30)]
    t = pa.table({"node": [0] * 30, "cid": range(30), "label": range(30), "set": [s.tobytes() for s in sets]})
    got = {(a, b) for a, b in zip(*(c.to_pylist() for c in neardup._block_links(t).columns))}
    want = {(i, j) for i in range(30) for j in range(i + 1, 30)
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))}
    assert got == want


# ---- op7
def test_language_id(spark, nothing):
    words = {"xx": "kata maro lipu", "yy": "strength through brought"}
    texts, langs = [], []
    for i in range(90):
        lang = "xx" if i % 2 else "yy"
        w = words[lang].split()
        texts.append(" ".join(w[(i + j) % 3] for j in range(20 + i % 7)))
        langs.append(lang)
    docs = spark.createDataFrame([(i, t, x if i % 5 else None) for i, (t, x) in enumerate(zip(texts, langs))]
                                 + [(900, None, "xx"), (901, "12 34 !", None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.language_id(docs).collect()}
    assert all(got[i]["lang_pred"] == langs[i] and 0 <= got[i]["score"] <= 1 for i in range(90))
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(90))
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und"
    unlabelled = docs.withColumn("lang", docs["lang"].substr(99, 1)).where("false")
    assert langid.language_id(unlabelled).count() == 0


# ---- op8
def test_line_dedup(edge):
    named = edge.where("doc_id is not null")
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for d, t in texts_of(named):
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                holders.setdefault(key(x), set()).add(d)
    want = Counter()
    for d, t in texts_of(named):
        ls = (t or "").split("\n")
        kept = [x for x in ls if not (len(holders.get(key(x), ())) > 1 and d != min(holders[key(x)]))]
        want[(d, len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())] += 1
    assert Counter(map(tuple, linedup.line_dedup(named).collect())) == want
    out = linedup.drop_lines(edge)
    assert out.columns == edge.columns and out.count() == edge.count()


# ---- op9
@pytest.mark.parametrize("bucket", [2000, 1])
def test_substring_dedup(spark, edge, bucket):
    run = " ".join(f"p{i}" for i in range(50))
    more = frame(spark, [f"a b {run} c", f"{run} d", "z " * 60, " ".join(f"u{i}" for i in range(80)), run.upper()])
    for docs in (edge, more):
        every = Counter()
        data = [(d, SPACED.findall(t or "")) for d, t in texts_of(docs)]
        for _, w in data:
            every.update(tuple(w[i:i + 35]) for i in range(len(w) - 34))
        want = Counter()
        for d, w in data:
            gone = {j for i in range(len(w) - 34) if every[tuple(w[i:i + 35])] > 1 for j in range(i, i + 35)}
            kept = " ".join(x for i, x in enumerate(w) if i not in gone)
            want[(d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
        assert Counter(map(tuple, substring.substring_dedup(docs, bucket).collect())) == want


# ---- op10
def test_sharding(edge):
    got = sharding.shard_documents(edge, limit=600).collect()
    assert len(got) == edge.count()
    per = Counter()
    for r in got:
        per[r["shard"]] += r["n_bytes"]
    for r in got:
        assert r["shard_bytes"] == per[r["shard"]] and (per[r["shard"]] <= 600 or r["n_bytes"] > 600)
    one = sharding.shard_documents(edge, limit=1 << 30).collect()
    assert {(r["local_depth"], r["shard"]) for r in one} == {(0, "")}


# ---- empty tables
def test_empty_tables(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for df in (pii.personal_data(nothing), quality.quality_rules(nothing, labels), decontam.decontaminate(nothing, bench),
               tokens.token_counts(nothing, tokenizer("byte_bpe_50k.json")), neardup.near_duplicates(nothing),
               packing.pack(nothing, tokenizer("word_bpe_49k.json")), langid.language_id(nothing),
               linedup.line_dedup(nothing), substring.substring_dedup(nothing), sharding.shard_documents(nothing)):
        assert df.count() == 0
