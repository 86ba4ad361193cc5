"""The pipeline on a small table, stage by stage, against plain Python."""

import corpus_pipeline


def test_stages(spark, tmp_path):
    en = lambda k: " ".join(f"the {w} and of {k}{i}" for i, w in enumerate(["cat", "house", "with", "that"] * 6))
    rows = [(1, None), (2, "123 ###"), (3, en("a")), (4, en("a") + " more"), (5, en("b")), (6, "bench " + " ".join(f"item{i}" for i in range(20))), (7, en("c") + "\nthis line is in three texts"), (8, en("d") + "\nthis line is in three texts"), (9, en("e") + "\nthis line is in three texts"), (None, en("f")), (3, en("a")), (None, "bench too " + " ".join(f"item{i}" for i in range(20)))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "extra") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, id string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(f"item{i}" for i in range(20)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = []
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == docs.columns, name
        frame = frame.cache()
        kept.append(sorted(-1 if r.doc_id is None else r.doc_id for r in frame.collect()))
    assert kept == [[-1, -1, 3, 3, 4, 5, 6, 7, 8, 9], [-1, -1, 3, 3, 4, 5, 6, 7, 8, 9], [-1, -1, 3, 3, 5, 6, 7, 8, 9], [-1, 3, 3, 5, 7, 8, 9]]
    text = {r.doc_id: (r.text, r.n_chars) for r in frame.collect()}
    assert text[7] == (en("c"), len(en("c"))) and text[9][0].endswith("three texts")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 7
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.read.parquet(f"{tmp_path}/benchmark.parquet").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
