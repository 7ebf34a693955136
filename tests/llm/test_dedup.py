"""Substring, suffix, line and SimHash dedup against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_fixtures import docs, none  # noqa: F401

from strata.llm import lines, simhash, substring, suffixes
from strata.llm.components import components


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=lambda x: (x[0] is None, x[0] or 0))


def brute_words(docs, window):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in docs]
    count = Counter(tuple(w[k:k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(docs, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if count[tuple(w[k:k + window])] > 1:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [35, 8, 1])
def test_substring(spark, docs, none, window):
    got = substring.remove_repeats(spark, docs, window, chunk_bytes=2000)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in got.collect()), key=repr) == brute_words(texts(docs), window)
    assert substring.remove_repeats(spark, none, window).count() == 0


def test_substring_of_words_with_equal_polynomials(spark):
    """Thue-Morse words over two letters and their complements: their polynomial hashes modulo 2**64 agree in every base."""
    def thue_morse(n, a, b):
        return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))
    shared = " ".join(f"w{i}" for i in range(34))
    table = [(i, f"{shared} {w}") for i, w in enumerate(f(n, *ab) for n in (1024, 2048, 4096) for f in (thue_morse,) for ab in ("ab", "ba"))]
    rnd = random.Random(8)
    table += [(10 + i, f"{shared} " + "".join(rnd.choice("ab") for _ in range(1500))) for i in range(6)]
    table += [(20, f"{shared} same"), (21, f"{shared} same")]
    got = substring.remove_repeats(spark, spark.createDataFrame(table, "doc_id long, text string"), 35)
    have = sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in got.collect()), key=repr)
    assert have == brute_words(table, 35)
    assert {x[0]: x[2] for x in have if x[2]} == {20: 35, 21: 35}


def test_cover():
    for v in (1, 3, 7, 13, 21, 31):
        c = substring.cover(v)
        assert {(a - b) % v for a in c for b in c} == set(range(v))
    assert substring.cover(21) and len(substring.cover(21)) == 5 and substring.modulus(35) == 21


def brute_bytes(docs, window):
    seen, out = set(), []
    for i, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - window + 1):
            if b[k:k + window] in seen:
                gone[k] += 1
                gone[k + window] -= 1
            seen.add(b[k:k + window])
        on = np.cumsum(gone[:-1]) > 0
        a = np.frombuffer(b, np.uint8)
        out.append((i, len(b), int(on.sum()), int((np.diff(np.r_[0, on.astype(int)]) == 1).sum()), a[~on].tobytes()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window,gram", [(100, 32), (20, 6), (9, 9)])
def test_suffixes(spark, docs, none, window, gram):
    got = suffixes.remove_repeats(spark, docs, window, gram, chunk_bytes=3000)
    have = sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.span_start), bytes(r.kept)) for r in got.collect()), key=repr)
    assert have == brute_bytes(texts(docs), window)
    assert suffixes.remove_repeats(spark, none, window, gram).count() == 0


@pytest.mark.parametrize("window,gram,hot", [(100, 32, 1), (20, 6, 3)])
def test_suffixes_hot_anchors(spark, docs, none, window, gram, hot):
    got = suffixes.remove_repeats(spark, docs, window, gram, chunk_bytes=3000, hot=hot)
    have = sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.span_start), bytes(r.kept)) for r in got.collect()), key=repr)
    assert have == brute_bytes(texts(docs), window)
    assert suffixes.remove_repeats(spark, none, window, gram, hot=hot).count() == 0


def test_common_phrase_is_spread(spark, monkeypatch):
    """A phrase in all documents, with differing surroundings: no bucket gets a context of each document."""
    r = random.Random(3)
    rest = lambda n: "".join(r.choice("abcdefghijklmnop ") for _ in range(n))
    phrase, twin = rest(60), rest(300)
    rows = [(k, rest(150) + phrase + rest(150)) for k in range(400)] + [(k, twin + phrase + twin) for k in (400, 401)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sent, found = [], suffixes._found
    monkeypatch.setattr(suffixes, "_found", lambda around, *a: sent.append((around, a[-1])) or found(around, *a))
    for hot in (40, 1 << 30):
        got = suffixes.remove_repeats(spark, df, chunk_bytes=20_000, hot=hot)
        have = sorted(((x.doc_id, x.n_bytes, x.n_removed, len(x.span_start), bytes(x.kept)) for x in got.collect()), key=repr)
        assert have == brute_bytes(rows, 100) and max(x[2] for x in have) == 660
    contexts, windows = [], []
    for around, groups in sent:
        sizes = [(x["bucket"], x["sum(n)"]) for x in around.groupBy("bucket").sum("n").collect()]
        contexts.append(max((n for b, n in sizes if b < groups), default=0))
        windows.append([n for b, n in sizes if b >= groups])
    assert contexts[0] < 100 < contexts[1] and not windows[1]       # a bucket has a few anchors of at most 40
    assert max(windows[0]) < sum(windows[0]) / 8


def test_anchors_fill_all_buckets():
    text = np.random.default_rng(6).integers(97, 123, 400_000).astype(np.uint8)
    a = suffixes.Anchors(text, np.array([0, len(text)]), 100, 32)
    share = np.bincount(suffixes.ex.bucket_of(a.hash, 32), minlength=32) / len(a.hash)
    assert share.max() < 2 / 32 and share.min() > 0.5 / 32


def test_deep_shallow_order():
    r = random.Random(5)
    strings = [bytes(r.choice(b"\x00ab") for _ in range(r.randint(0, 40))) for _ in range(400)] + [b"a" * 30 + bytes([k]) for k in range(50)]
    length = np.array([len(s) for s in strings])
    table = np.zeros((len(strings), 40), np.uint8)
    for k, s in enumerate(strings):
        table[k, :len(s)] = list(s)
    order, prefix = suffixes.deep_shallow(table, length)
    for depth in range(1, 41):     # strings that share a prefix stand together
        run = np.cumsum(prefix < depth)
        group = {}
        for slot, k in enumerate(order):
            if len(strings[k]) >= depth:
                group.setdefault(strings[k][:depth], set()).add(run[slot])
        assert all(len(g) == 1 for g in group.values()) and len({min(g) for g in group.values()}) == len(group)


def brute_lines(docs, m):
    seen, out = set(), []
    for i, t in docs:
        w = t.split("\n") if t is not None else []
        gone = set()
        for k in range(len(w) - m + 1):
            if tuple(w[k:k + m]) in seen:
                gone |= set(range(k, k + m))
            seen.add(tuple(w[k:k + m]))
        out.append((i, len(w), len(gone), None if t is None else "\n".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("m", [1, 2, 3, 5])
def test_lines(spark, docs, none, m):
    got = lines.remove_repeats(spark, docs, m)
    assert got.columns[:len(docs.columns)] == docs.columns
    have = got.collect()
    assert sorted(((r.doc_id, r.n_lines_, r.n_removed_, r.text) for r in have), key=repr) == brute_lines(texts(docs), m)
    assert all(sum(r.run_lines_) == r.n_removed_ for r in have)
    assert lines.remove_repeats(spark, none, m).count() == 0


@pytest.mark.parametrize("words,size", [(3, None), (None, 12), (3, 12)])
def test_lone_lines(spark, docs, none, words, size):
    foot = "read more about this on our site"
    more = [(100, f"one\n{foot}\nshort\ntwo"), (101, f"three\n{foot}\nfour\nshort"), (102, foot), (103, foot), (104, f"{foot}\n{foot}"), (105, "https://a/bcdef"),
            (106, "x\nhttps://a/bcdef\ny"), (None, f"five\n{foot}")]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    lone = lambda x: (words is not None and len(re.findall(r"[^\x20\x09-\x0D]+", x)) >= words) or (size is not None and len(x.encode()) >= size)
    pairs, seen, want = set(), set(), []
    for i, t in texts(rows):
        w = t.split("\n") if t is not None else []
        gone = set()
        for k, x in enumerate(w):
            if k + 1 < len(w):
                gone |= {k, k + 1} if (x, w[k + 1]) in pairs else set()
                pairs.add((x, w[k + 1]))
            gone |= {k} if lone(x) and x in seen else set()
            seen.add(x)
        want.append((i, len(w), len(gone), None if t is None else "\n".join(x for k, x in enumerate(w) if k not in gone)))
    got = lines.remove_repeats(spark, rows, 2, lone_words=words, lone_bytes=size)
    have = got.collect()
    assert sorted(((r.doc_id, r.n_lines_, r.n_removed_, r.text) for r in have), key=repr) == sorted(want, key=repr)
    assert all(sum(r.run_lines_) == r.n_removed_ for r in have)
    by_id = {r.doc_id: r.text for r in have}
    assert by_id[100] == f"one\n{foot}\nshort\ntwo" and (by_id[101], by_id[102], by_id[104]) == ("three\nfour\nshort", "", "")
    assert lines.remove_repeats(spark, none, 2, lone_words=words, lone_bytes=size).count() == 0


@pytest.mark.parametrize("m", [2, 3])
def test_lines_stage_little(spark, docs, monkeypatch, m):
    """Each staged table costs every executor its files' writers: two to begin, two a doubling, one for the first places."""
    names, stage = [], lines.stage
    monkeypatch.setattr(lines, "stage", lambda spark, df, name: (names.append(name), stage(spark, df, name))[1])
    assert lines.remove_repeats(spark, docs, m).agg({"n_removed_": "sum"}).first()[0] == sum(n for _, _, n, _ in brute_lines(texts(docs), m))
    assert names == ["line-docs", "lines", *["line-ranks", "line-pairs"] * (m - 1), "line-first"]


def brute_fingerprint(t):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    sh = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    return sum(1 << b for b in range(64) if 2 * sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in sh) > len(sh))


def test_fingerprints(spark, docs, none):
    got = sorted((r.fp & (1 << 64) - 1) for r in simhash.near_duplicates(spark, docs).collect())
    assert got == sorted(brute_fingerprint(t) for _, t in texts(docs))
    assert simhash.near_duplicates(spark, none).count() == 0


@pytest.mark.parametrize("small", [256, 1])
def test_links(spark, small, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    r = random.Random(small)
    base = [r.getrandbits(64) for _ in range(12)]
    fps = {b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 4))) for b in base for _ in range(12)} | {0, 3, 1 << 63}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    edges = simhash.links(spark, spark.createDataFrame([(f,) for f in signed], "fp long"), 2)
    assert all(0 < ((e.a ^ e.b) & (1 << 64) - 1).bit_count() <= 2 for e in edges.collect())
    root = {f: f for f in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in signed:
        for b in signed:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark, edges).collect()}
    assert {f: got.get(f, f) for f in signed} == {f: find(f) for f in signed}


def test_masks_cover_every_pair():
    for radius in (1, 2):
        m = [x & (1 << 64) - 1 for x in simhash.masks(radius)]
        for i in range(64):
            for j in range(i, 64 if radius == 2 else i + 1):
                d = (1 << i) | (1 << j)
                assert any(not d & x for x in m)


def test_keep_one(spark, docs, none):
    kept = simhash.keep_one(spark, docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {1, 3, 6, 8} <= set(ids) and not {4, 5, 16, None} & set(ids)
    assert simhash.keep_one(spark, none).count() == 0


def test_chain_component(spark):
    edges = spark.range(200).selectExpr("id as a", "id + 1 as b")
    assert {(r.root) for r in components(spark, edges).collect()} == {0}
