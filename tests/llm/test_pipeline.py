"""The pipeline over a small folder, against what its stages must do."""

import random

from llm_fixtures import docs  # noqa: F401

import corpus_pipeline


def test_pipeline(spark, docs, tmp_path):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda")], "item_id long, text string")
    r = random.Random(4)
    text = lambda: ["".join(r.choice(["ther", "tion", "nd", "wh", "on", "an", "er", "st", "re", "ou"]) for _ in range(r.randint(1, 3))) for _ in range(40)]
    toxic, clean = [text() for _ in range(60)], [text() for _ in range(60)]
    for k, t in enumerate(toxic):
        t[7] = t[31] = ("idiot", "stupid")[k % 2]
    insult = spark.createDataFrame([(100 + k, " ".join(t), "en", "s", 1, "r", k) for k, t in enumerate(toxic)]
                                   + [(200 + k, " ".join(t), "en", "s", 1, "r", k) for k, t in enumerate(clean)]
                                   + [(300, "before alpha beta gamma delta epsilon zeta eta theta iota kappa lambda after", "en", "s", 1, "r", 0)], docs.schema)
    docs.union(insult).write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(100 + k, 0, 1) for k in range(60)] + [(200 + k, 1, 0) for k in range(60)] + [(k, 1, 0) for k in range(1, 18)],
                          "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    frames, now = {}, spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        if name != "byte_bpe":
            assert out.columns == now.columns
        out.write.parquet(str(tmp_path / name))
        now = frames[name] = spark.read.parquet(str(tmp_path / name))
    ids = {n: {r.doc_id for r in f.select("doc_id").collect()} for n, f in frames.items()}
    assert not ids["toxicity"] & set(range(100, 160)) and {*range(200, 260), 1, 2, 6, 8, 300} <= ids["toxicity"]
    assert ids["line_dedup"] == ids["toxicity"] and ids["byte_bpe"] == ids["benchmark_decontamination"] == ids["simhash_near_dedup"]
    last = {r.doc_id: r.text for r in frames["benchmark_decontamination"].collect()}
    assert last[300].split() == ["before", "after"]
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()} == ids["byte_bpe"]


def test_pipeline_cuts_lone_lines(spark, tmp_path):
    foot = "this one line of ten words stands under every article"
    rows = [(1, f"first\n{foot}\nalpha", 6), (2, f"second\n{foot}\nbeta", 7), (3, foot, 8)]
    out = corpus_pipeline.drop_repeated_lines(spark, spark.createDataFrame(rows, "doc_id long, text string, n_chars long"), str(tmp_path))
    assert sorted(map(tuple, out.collect())) == [(1, rows[0][1], len(rows[0][1])), (2, "second\nbeta", 11), (3, "", 0)]


CLASH = ["n_removed_", "starts_", "N_LINES_", "alone_", "items_", "n_words_", "Span_Start_", "score", "RID", "rid_", "r", "at", "fp", "place"]


def test_stages_keep_columns_with_clashing_names(spark, tmp_path):
    """Every stage before the last keeps columns named like its own."""
    foot = "this one line of ten words stands under every article"
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    texts = [f"first\n{foot}\nalpha", f"second\n{foot}\nbeta", None, "", f"before {item} after"]
    rows = [(i, t, len(t or ""), *[f"{c}{i}" for c in CLASH]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH))
    spark.createDataFrame([("q1", item)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    want = {0: texts[0], 1: "second\nbeta", 2: None, 4: "before  after"}      # null and empty texts: one fingerprint
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, str(tmp_path))
        assert out.schema == df.schema, name
        out.write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
    have = {r.doc_id: r for r in df.collect()}
    assert {i: r.text for i, r in have.items()} == want
    assert all(r[c] == f"{c}{i}" for i, r in have.items() for c in CLASH)


def test_score_beside_a_column_of_that_name(spark):
    from strata.llm import toxicity
    df = spark.createDataFrame([(1, "a", 7)], "doc_id long, text string, SCORE int")
    out = toxicity.score(spark, df, None)
    assert out.columns == ["doc_id", "SCORE", "score_"] and tuple(out.first()) == (1, 7, 0.0)
