"""BPE, decontamination, toxicity, WARC, sharding and top-k against brute force."""

import base64
import pickle
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_fixtures import docs, none  # noqa: F401
from pyspark.sql import functions as F

from strata.llm import bpe, decontaminate, queries, sharding, topk, toxicity, warc

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@pytest.mark.parametrize("leaf", [1, 3, 512])
def test_encode(reference, leaf):
    c = bpe.codec(open(PATH, "rb").read(), public_tokenizers.PATTERN, leaf)
    for t in ["", "a", "it's we'll'll 've", "a  b   c \n\n d", "don't  stop's", "x" * 70, "  " * 30 + "é", "日本語 текст 123 45", "a 1 b2 ²x ½ y", "́a ́ b",
              "end ", " 'r e 'l l", "😀 😀a", "!!! ?? a!b", "aaa " * 50]:
        assert c.encode(t) == reference(t), t
        assert c.decode(c.encode(t)) == t.encode()


def test_long_texts(reference):
    c = bpe.codec(open(PATH, "rb").read(), public_tokenizers.PATTERN)
    for t in ["abc" * 2000, " " * 3000 + "x", "word and other " * 2000]:
        assert c.encode(t) == reference(t)


def test_encode_table(spark, docs, none, reference):
    got = bpe.encode_decode(spark, docs, PATH, public_tokenizers.PATTERN).collect()
    want = sorted((r.doc_id is None, r.doc_id or 0, reference(r.text or ""), (r.text or "").encode()) for r in docs.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in got) == want
    assert bpe.encode_decode(spark, none, PATH, public_tokenizers.PATTERN).count() == 0


def items(spark, docs):
    t = {r.doc_id: r.text for r in docs.collect()}
    w = t[1].split()
    return spark.createDataFrame([("i2", " ".join(w[20:45])), ("i1", " ".join(w[40:52])), ("short", "x"), ("none", "?!"), ("null", None), (None, t[6]), ("i1", " ".join(w[40:52])),
                                  ("absent", "never seen words anywhere here at all times ten eleven")], "item_id string, text string")


def brute_hits(docs, bench, size):
    win = {}
    for i, t in bench:
        w = decontaminate.words((t or "").encode())
        for k in range(max(1, len(w) - size + 1) if w else 0):
            win.setdefault(tuple(w[k:k + size]), set()).add(i or "")
    out = []
    for i, t in docs:
        w = decontaminate.words((t or "").encode())
        hit, found = set(), set()
        for n in {len(x) for x in win}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in win:
                    hit |= set(range(k, k + n))
                    found |= win[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("item_bytes", [1 << 20, 200])
def test_decontaminate(spark, docs, none, item_bytes):
    bench = items(spark, docs)
    got = decontaminate.find_spans(spark, docs, bench, 10, item_bytes=item_bytes, block_bytes=3000).collect()
    have = sorted(((r.doc_id, r.n_words_, sum(e - s for s, e in zip(r.span_start_, r.span_end_)), list(r.items_)) for r in got), key=repr)
    assert have == brute_hits([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()], 10)
    assert decontaminate.find_spans(spark, none, bench, 10).count() == 0
    empty = decontaminate.find_spans(spark, docs, bench.limit(0), 10).collect()
    assert len(empty) == docs.count() and not any(r.items_ for r in empty)


def test_remove_spans(spark, docs):
    bench = items(spark, docs).where("item_id in ('i1', 'i2')")
    before = {(r.doc_id, r.hit): r.text for r in docs.collect()}
    out = decontaminate.remove_spans(spark, docs, bench, 10)
    assert out.schema == docs.schema
    hits = {(i): n for i, _, n, _ in brute_hits([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()], 10)}
    for r in out.collect():
        assert (r.text == before[r.doc_id, r.hit]) == (hits[r.doc_id] == 0)
    left = decontaminate.find_spans(spark, out, bench, 10)
    assert left.where("size(items_) > 0").count() == 0


def test_remove_spans_keeps_a_row_id_column(spark, docs):
    """Several item blocks give the rows ids of their own; the table's columns RID, items_ and SPAN_START_ stay."""
    docs = docs.withColumn("items_", F.col("hit")).withColumn("SPAN_START_", F.col("hit"))
    bench = items(spark, docs).where("item_id in ('i1', 'i2')")
    one, many = (decontaminate.remove_spans(spark, docs, bench, 10, item_bytes=n) for n in (1 << 20, 100))
    assert many.schema == docs.schema
    assert sorted(map(tuple, many.collect()), key=repr) == sorted(map(tuple, one.collect()), key=repr)


def test_fm_index():
    rng = np.random.default_rng(3)
    seq = rng.integers(0, 4, 500)
    seq[-1] = 0
    seq[100:180] = seq[300:380]
    ix = decontaminate.FMIndex(seq, 3, sample=7)
    for _ in range(100):
        n = int(rng.integers(1, 6))
        p = rng.integers(1, 4, n)
        lo, hi = ix.find(p[None, :], np.array([n]))
        at = sorted(ix.locate(np.arange(lo[0], max(lo[0], hi[0]))).tolist())
        assert at == [k for k in range(len(seq) - n + 1) if (seq[k:k + n] == p).all()]


def test_toxicity(spark, none):
    r = random.Random(2)
    syllables = ["ther", "tion", "nd", "wh", "on", "an", "er", "st", "re", "ou", "he", "in", "ti", "es", "ha"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 3)))
    text = lambda: [word() if k % 9 else word() + "." for k in range(60)]
    clean = [" ".join(text()) for _ in range(80)]
    toxic = []
    for k in range(80):
        t = text()
        for at in (5, 23, 41):
            t[at] = ("idiot", "moron", "stupid")[(k + at) % 3]
        toxic.append(" ".join(t))
    m = toxicity.train(toxic, clean)
    p = m.probability([clean[0], "you are an idiot", "you id-i-ot", "such an i d i o t today", "an idixot said", "", "quite a moronn", "all is well"])
    assert (p[[1, 2, 3, 6]] >= 0.5).all() and (p[[0, 5, 7]] < 0.5).all()
    assert p[4] > p[[0, 5, 7]].max()    # a foreign letter inside: nearer to toxic than any clean text
    rows = [(k, t) for k, t in enumerate(toxic + clean)]
    docs = spark.createDataFrame([*rows, (None, None), (500, ""), (0, toxic[0])], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < len(toxic))) for k, _ in rows] + [(None, 1), (500, None), (1, 0)], "doc_id long, toxic int")
    model = toxicity.fit(spark, docs, labels)
    out = toxicity.score(spark, docs, model)
    assert out.columns == ["doc_id", "score"] and out.count() == docs.count()
    right = [(r.score >= 0.5) == (r.doc_id is not None and r.doc_id < len(toxic)) for r in out.collect()]
    assert np.mean(right) > 0.95
    assert toxicity.score(spark, none, model).count() == 0 and toxicity.fit(spark, docs, labels.limit(0)) is None
    assert toxicity.reject(spark, docs, None).count() == docs.count()
    held = {r.doc_id: r.h for r in docs.select("doc_id", toxicity.held_out(docs["doc_id"]).alias("h")).collect()}
    assert all(h == (zlib.crc32(str(k).encode()) % 5 == 0) for k, h in held.items() if k is not None)


def test_warc(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "<html lang='fr'><title> A\nB</title><p>x &amp;lt; y</p><script>no</script><!-- c --><br>z</html>", 1),
                                   (2, None, None, 2), (None, "http://b/", "plain", 3), (2, None, None, 2)], "page_id long, url string, html string, block int")
    out = warc.derive(warc.responses(pages))
    rows = out.collect()
    assert len(rows) == 8
    text = {r.page_id: r.block for r in rows if r.type == "conversion"}
    assert text == {1: "A\nB\nx &lt; y\nz", 2: "", None: "plain"}
    by_id = {r.record_id for r in rows}
    assert all(r.linked_to in by_id for r in rows if r.type == "conversion")
    meta = next(r.block for r in rows if r.page_id == 1 and r.type == "metadata")
    assert "title: A B\r\nlanguage: fr\r\n" in meta and "source-header: HTTP/1.1 200 OK" in meta and "source-payload-digest: sha256:" in meta
    warc.write_warc(out, str(tmp_path / "w"))
    back = warc.read_warc(spark, str(tmp_path / "w"))
    key = lambda r: (r.type, r.record_id, r.refers_to, r.linked_to, r.block, r.block_digest)
    assert sorted(map(key, back.collect()), key=repr) == sorted(map(key, rows), key=repr)
    assert back.where("not whole").count() == 0 and warc.derive(warc.responses(pages.limit(0))).count() == 0


def brute_shards(rows, shards):
    """doc_id to (shard, slot): a shuffle by md5 in each source, then fractional ranks, cut evenly."""
    import hashlib
    by = {}
    for i, s in rows:
        by.setdefault(s, []).append((hashlib.md5(f"strata\x1f{i}".encode()).hexdigest(), i))
    order = sorted(((2 * r + 1) / (2 * len(g)), s is None, s or "", i) for s, g in by.items() for r, (_, i) in enumerate(sorted(g)))
    out, n = {}, len(order)
    for pos, (*_, i) in enumerate(order):
        k = pos * shards // n
        out[i] = (k, pos - -(-k * n // shards))
    return out


def test_sharding_against_brute_force(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null when id % 2 = 0 then 'é' || id % 5 "
                                      "else 'one' || id end as source", "'x' as SHARD", "id as pos", "'y' as `row`", "1 as h")
    out = sharding.interleave(spark, df, 8)
    assert out.columns == [*df.columns, "shard_", "slot"]
    have = out.collect()
    assert {r.doc_id: (r.shard_, r.slot) for r in have} == brute_shards([(r.doc_id, r.source) for r in have], 8)
    assert all((r.SHARD, r.pos, r.row, r.h) == ("x", r.doc_id, "y", 1) for r in have) and len(have) == 3000


def test_sharding_ranges_stay_small(spark):
    """Sources of one row each share one fractional rank, and equal rows all their keys; neither is one task's work."""
    one_each = spark.range(4000).selectExpr("id as doc_id", "concat('s', id) as source")
    equal = spark.range(4000).selectExpr("1L as doc_id", "'s' as source")
    for df in (one_each, equal):
        staged = sharding.stage(spark, df.withColumn("f", F.lit(0.5)).withColumn("rid", F.monotonically_increasing_id()), "test-rows")
        order = [F.asc("f"), F.asc("source"), F.asc("rid")]
        out = sharding._numbered(spark, staged.repartition(16), order, "pos")
        assert sorted(r.pos for r in out.select("pos").collect()) == list(range(4000))
        # the ranges themselves, before Spark joins small neighbours
        sizes = [r["count"] for r in staged.repartitionByRange(8, *order).groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 1000
        shards = sharding.interleave(spark, df, 8).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m")).collect()
        assert sorted((r.n, r.m) for r in shards) == [(500, 499)] * 8


def test_sharding(spark, docs, none):
    rows = spark.range(200).selectExpr("id as doc_id", "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else concat('s', id % 5) end as source")
    for df, n in ((rows, 8), (docs.select("doc_id", "source"), 3), (docs.select("doc_id", "source").limit(2), 5)):
        out = sharding.interleave(spark, df, n).collect()
        sizes = [sorted(r.slot for r in out if r.shard == k) for k in range(n)]
        assert all(s == list(range(len(s))) for s in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
        assert sorted(((r.doc_id, r.source) for r in out), key=repr) == sorted(((r.doc_id, r.source) for r in df.collect()), key=repr)
    hot = [sum(r.source == "hot" and r.shard == k for r in sharding.interleave(spark, rows, 8).collect()) for k in range(8)]
    assert max(hot) - min(hot) <= 1
    assert sharding.interleave(spark, none.select("doc_id", "source"), 8).count() == 0


@pytest.mark.parametrize("shard,block", [(4096, 1024), (7, 2)])
def test_topk(spark, shard, block):
    rng = np.random.default_rng(1)
    vecs = rng.integers(-3, 4, (120, 5)) / 256
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vecs)] + [(50, [1.0] * 5), (None, [1.0] * 5), (200, None), (201, [1.0, None, 0.0, 0.0, 0.0]),
                                                                      (202, [float("nan")] * 5), (203, [float("inf")] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = topk.quantised(df, "vec_id", "embedding", 256).selectExpr("monotonically_increasing_id() as rid", "*").cache()
    got = topk.top_k(spark, v, v.where("vec_id % 50 = 0"), 5, shard, block).collect()
    have = sorted((r.query_rid, r.rank, r.vec_id, r.score) for r in got if r.vec_id is not None or True)
    all_rows = [(r.rid, r.vec_id, np.array(r.q).astype(int)) for r in v.collect()]
    want = []
    for rid, i, q in all_rows:
        if i is not None and i % 50 == 0:
            s = sorted((-int(q @ w), j is None, j or 0, k) for k, j, w in all_rows if k != rid)[:5]
            want += [(rid, n + 1, None if null else j, -x) for n, (x, null, j, _) in enumerate(s)]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    assert topk.search(spark, df.limit(0)).count() == 0


def test_every_operator_has_its_query():
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 11))


def brute_kernel(a, b):
    """Sums over common character triples of both words' gap weights, each word scaled by its length's norm, cubed."""
    def features(word):
        w = f"\x02{word}\x03"
        at = [(i, j, k) for i in range(len(w)) for j in range(i + 1, len(w)) for k in range(j + 1, len(w)) if k - i < toxicity.SPAN]
        norm = sum(toxicity.DECAY ** (2 * (k - i + 1)) for i, _, k in at) ** 0.5
        found = {}
        for i, j, k in at:
            t = w[i] + w[j] + w[k]
            found[t] = found.get(t, 0) + toxicity.DECAY ** (k - i + 1) / norm
        return found
    x, y = features(a), features(b)
    return sum(v * y.get(t, 0) for t, v in x.items()) ** 3


@pytest.mark.parametrize("cells", [1 << 23, 0])
def test_kernel_is_the_subsequence_kernel(monkeypatch, cells):
    monkeypatch.setattr(toxicity, "DIRECT_CELLS", cells)
    r = random.Random(3)
    words = ["a", "idiot", "idixot", "idiotidiot", "aaaa", "éü", "日本語日本", "x" * 24] + ["".join(r.choice("abcdi") for _ in range(r.randint(1, 12))) for _ in range(30)]
    kernel = pickle.loads(pickle.dumps(toxicity.Kernel(words[:20])))
    want = np.array([[brute_kernel(a, b) for b in words[:20]] for a in words])
    assert np.allclose(kernel(words), want, atol=1e-5)


def test_toxicity_of_unsegmented_text():
    """Thousands of different characters in use: the tables stay small."""
    r = random.Random(4)
    signs = [chr(0x4E00 + i) for i in range(2500)]
    clean = ["".join(r.choice(signs) for _ in range(60)) for _ in range(80)]
    toxic = ["".join(r.choice(signs) for _ in range(30)) + "。 蠢猪坏蛋 。" + "".join(r.choice(signs) for _ in range(20)) for _ in range(80)]
    m = toxicity.train(toxic, clean)
    assert len(pickle.dumps(m)) < 20 << 20
    p = m.probability(["天地玄黄 蠢猪坏蛋 宇宙", "天地玄黄宇宙洪荒"])
    assert p[0] > 0.5 > p[1]


def test_the_sample_is_drawn_from_usable_texts(spark):
    bad = [(i, "you are a stupid idiot and a fool") for i in range(1, 60)]
    good = [(i, f"the weather was fine on day {i} of the tour") for i in range(100, 160)]
    long = [(i, "x " * toxicity.SAMPLE_BYTES) for i in range(200, 400)]
    table = spark.createDataFrame([*bad, *good, *long, (500, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i < 60 or i >= 200)) for i, _ in [*bad, *good, *long]] + [(500, 1), (501, 1)], "doc_id long, toxic int")
    m = toxicity.fit(spark, table, marks, sample=30)
    assert m is not None and m.probability(["you stupid idiot"])[0] > 0.5 > m.probability(["the weather on the tour"])[0]
    with pytest.warns(UserWarning, match="no usable"):
        assert toxicity.fit(spark, table.where("doc_id >= 100"), marks) is None
