"""Divergence audit, ranked search and token counts against brute force."""

import math
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tokenizers
from llm_fixtures import docs, fixture_rows, none, passage  # noqa: F401

from strata.llm import counts, rank, stripes

WORDS = public_tokenizers.path("word_bpe_49k.json")
LOWER = {c: c + 32 for c in range(65, 91)}
ITEMS = "item_id string, text string, doc_id int, RID string"


# --- divergence audit

def brute_audit(rows, min_docs, top):
    """rows: (text, lang, source)."""
    docs_ = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER)), a or "", s or "") for t, a, s in rows]
    df, total, used, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), set()
    for words, a, s in docs_:
        groups.add((a, s))
        df[a].update(set(words))
        total[a].update(words)
        used[a, s].update(words)
    out = []

    def shares(c, terms):
        n = sum(c[t] for t in terms)
        return {t: 1 + 1_000_000_000 * (c[t] + 1) // (n + len(terms)) for t in terms}

    for a, s in groups:
        terms = [t for t, n in df[a].items() if n >= min_docs]
        p = shares(used[a, s], terms)
        pairs = []
        for b, other in groups:
            if b == a and other != s:
                q = shares(used[a, other], terms)
                pairs.append((-sum((p[t] - q[t]) ** 2 // q[t] for t in terms), other.encode(), other))
        q = shares(total[a], terms)
        far = sorted((-((p[t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in terms if used[a, s][t] and p[t] > q[t])[:top]
        out += [(a, s, part, item, -v, i + 1) for part, found in (("pair", sorted(pairs)), ("term", far)) for i, (v, _, item) in enumerate(found)]
    return sorted(out)


def audit_rows():
    rows = [(t, a, s) for _, t, a, s, *_ in fixture_rows()]
    rows += [(f"{passage(k % 5, 12)} Ünd ünd {'the ' * k}, it's é", ("en", "fr")[k % 2], f"s{k % 7}") for k in range(40)]
    rows += [("only once here", "xx", "s1"), (None, "xx", "s2"), ("\U0001F600 ￿ \U0001F600 ￿", "en", "s1")] + [("\U0001F600 ￿", "en", f"s{k}") for k in range(3)]
    return rows


def test_audit(spark, none, monkeypatch):
    rows = audit_rows()
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], "text string, lang string, source string, term string, DF int").repartition(5)
    for top in (200, 4):
        got = sorted(tuple(r) for r in stripes.audit(spark, table, 3, top).collect())
        assert got == brute_audit(rows, 3, top)
    for name, size in (("SPILL_ENTRIES", 20), ("BUCKET_ENTRIES", 150), ("SOURCE_BLOCK", 2), ("_CELLS", 8)):
        monkeypatch.setattr(stripes, name, size)
    assert sorted(tuple(r) for r in stripes.audit(spark, table, 3, 4).collect()) == brute_audit(rows, 3, 4)
    assert stripes.audit(spark, none, 3, 200).count() == 0


def test_spilled_stripes_merge():
    import pyarrow as pa
    import random
    r = random.Random(1)
    rows = sorted((r.choice("ab"), r.choice("xyzé"), r.randint(1, 3), [r.choice("stu")]) for _ in range(60))
    batches = [pa.RecordBatch.from_pylist([dict(zip(("lang", "term", "df", "sources", "counts"), (*x, [2]))) for x in rows[i:i + 7]], schema=stripes._ARROW) for i in range(0, 60, 7)]
    got = {(x["lang"], x["term"]): (x["df"], dict(zip(x["sources"], x["counts"]))) for b in stripes._merge(iter(batches)) for x in b.to_pylist()}
    want = defaultdict(lambda: [0, Counter()])
    for a, t, df, (s,) in rows:
        want[a, t][0] += df
        want[a, t][1][s] += 2
    assert got == {k: (df, dict(c)) for k, (df, c) in want.items()}


def test_share_beyond_64_bits():
    import numpy as np
    for count, total, terms in ((0, 0, 1), (7, 7, 1), (10**13, 3 * 10**13, 10**9), (999, 1000, 3)):
        assert stripes.share(np.array([count]), np.array([total]), terms)[0] == 1 + 10**9 * (count + 1) // (total + terms)


# --- ranked search

def brute_rank(rows, items, k):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    tokens = [(i, Counter(find(t))) for i, t in rows]
    n_docs, n_all = sum(bool(c) for _, c in tokens), sum(sum(c.values()) for _, c in tokens)
    df = Counter(t for _, c in tokens for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in tokens:
            if c:
                m = 100 - 75 + 75 * sum(c.values()) * n_docs // n_all
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in find(text))
                if score > 0:
                    found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def rank_items():
    t = {i: t for i, t, *_ in fixture_rows()}
    return [("a", " ".join(t[1].split()[:9])), ("b", "X x é-é SAME"), ("b", "x"), (None, t[6]), ("null", None), ("none", "?! --"), ("absent", "zzz9"), ("a", " ".join(t[1].split()[:9])),
            ("edge", "byte zero bytezero"), ("kK", "K k K")]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_rank(spark, docs, none, k):
    rows = [(i, t) for i, t, *_ in fixture_rows()]
    items = spark.createDataFrame([(*x, 1, "r") for x in rank_items()], ITEMS)
    want = brute_rank(rows, rank_items(), k)
    assert sorted((tuple(r) for r in rank.search(spark, docs.repartition(3), items, k).collect()), key=repr) == want
    if k == 3:
        assert sorted((tuple(r) for r in rank.search(spark, docs, items, k, item_bytes=450).collect()), key=repr) == want
        assert rank.search(spark, none, items, k).count() == 0
        assert rank.search(spark, docs, items.where("false"), k).count() == 0


def test_rank_in_small_steps(spark, docs, monkeypatch):
    monkeypatch.setattr(rank, "_CELLS", 1)
    items = spark.createDataFrame([(*x, 1, "r") for x in rank_items()], ITEMS)
    assert sorted((tuple(r) for r in rank.search(spark, docs, items, 2).collect()), key=repr) == brute_rank([(i, t) for i, t, *_ in fixture_rows()], rank_items(), 2)


# --- token counts

@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(WORDS)
    return lambda x: len(t.encode(x or "", add_special_tokens=False).ids)


ODD = ["J̌x ǰx", "Å å", "İ i̇ İ", "a ́b", "<|startoftext|> <|STARTOFTEXT|>", "a<|endoftext|>b", "<|ENDOFTEXT|>", "x y　z w", "'S 'RE we'll",
       "12345 6 7", " lead and trail \n", "\x0b\x0c\x1c\x1f\x85 \x00", "ΑΣ ΑΣ. ΣΑ", "ǅ ﬁ Å K", "a" * 3000, "日本語テキスト " * 40, "a \t\r\n b", "<| startoftext |>", "😀😀 !!??", "́", "<|startoftext|", "A<|B|>C"]


def test_counts_of_odd_texts(spark, library, tmp_dir):
    rows = list(enumerate(ODD))
    got = counts.token_counts(spark, spark.createDataFrame(rows, "doc_id long, text string"), WORDS, f"{tmp_dir}/cache").collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: library(t) for i, t in rows}


def test_counts_with_cache(spark, docs, none, library, tmp_dir, monkeypatch):
    cache = f"{tmp_dir}/cache"
    want = sorted(((i, len((t or "").encode()), library(t)) for i, t, *_ in fixture_rows()), key=repr)

    def run(table):
        return sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in counts.token_counts(spark, table, WORDS, cache).collect()), key=repr)

    assert counts.token_counts(spark, none, WORDS, cache).count() == 0
    assert run(docs.where("doc_id < 9")) == [x for x in want if x[0] is not None and x[0] < 9]
    held = spark.read.parquet(cache)
    before = held.count()
    assert before == held.select("content").distinct().count() > 3
    monkeypatch.setattr(counts, "BROADCAST_MISSES", 1)
    assert run(docs) == want  # some hit, some miss
    held = spark.read.parquet(cache)
    assert held.count() == held.select("content").distinct().count() > before
    # nothing is encoded that the cache knows: a wrong count in it comes back
    first = held.first()
    spark.createDataFrame([(first.content, 999_999, first.tokenizer)], counts._CACHE).write.mode("append").partitionBy("tokenizer").parquet(cache)
    assert any(n == 999_999 for _, _, n in run(docs))


def test_another_tokenizer_misses(spark, docs, library, tmp_dir):
    other = f"{tmp_dir}/other.json"
    data = open(WORDS, "rb").read()
    open(other, "wb").write(data + b"\n")
    assert counts.tokenizer_digest(data) != counts.tokenizer_digest(data + b"\n")
    for path in (WORDS, other):
        counts.token_counts(spark, docs, path, f"{tmp_dir}/cache").count()
    held = spark.read.parquet(f"{tmp_dir}/cache")
    n = held.select("content").distinct().count()
    assert sorted(r[0] for r in held.groupBy("tokenizer").count().select("count").collect()) == [n, n]


def test_words_and_pieces(library, monkeypatch):
    c = counts.Counter(tokenizers.Tokenizer.from_file(WORDS))
    text = " ".join(ODD * 3)
    text = re.sub(r"[ \t\n\r\f\x0B]+", " ", text).strip(" ")
    assert c.count(text) == library(text)
    monkeypatch.setattr(counts, "MEMO_WORDS", 4)
    monkeypatch.setattr(counts, "MEMO_CHARS", 2)
    assert " ".join(counts.pieces(text, 10)) == text
    monkeypatch.setattr(counts, "PIECE_CHARS", 10)
    assert c.count(text) == library(text)
