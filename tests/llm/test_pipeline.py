import corpus_pipeline
from covenant.session import scratch_path, written
from tests.llm.corpora import documents, rows, words


def test_stages(spark, work):
    docs = documents(spark)
    tokens = dict((i, t) for i, t, *_ in rows() if i is not None)[12].split()
    benchmark = [(1, " ".join(tokens[50:80])), (2, None)]
    spark.createDataFrame(benchmark, "item_id bigint, text string").write.parquet(f"{work}/benchmark.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, work), scratch_path(spark, "test-stage"))
        if name != "packing":
            assert docs.columns == columns
            kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
    # No letters, no document; everything with letters in some language stays.
    assert all(any(c.isalpha() for c in t or "") for _, t in kept["language"])
    assert {12, 6, 7, 100} <= {i for i, _ in kept["language"]}
    # 4, 5, 14 and a row without an id are near copies of 3, of whose repeated rows one stays.
    ids = [i for i, _ in kept["near_duplicates"]]
    assert not {4, 5, 14} & set(ids) and ids.count(3) == 1 and None not in ids
    # The passage that 7, 13 and 20 share with 6 goes; what is not repeated stays as it was.
    cut = dict(kept["substrings"])
    before = dict(kept["near_duplicates"])
    assert cut[6] == before[6] and cut[12] == before[12]
    assert "Ünïcode" in cut[7] and len(words(cut[7])) < 60
    assert 12 not in dict(kept["decontamination"]) and 6 in dict(kept["decontamination"])
    assert {r.doc_id for r in docs.select("doc_id").collect()} == {i for i, _ in kept["decontamination"]}


def test_rows_with_clashing_ids(spark, work):
    def text(seed):
        return " ".join(f"w{seed}x{i}" for i in range(60))

    rows = [(1, text(1)), (1, text(2)), (1, text(2)), (2, text(2)), (3, text(3)), (None, text(3)), (None, text(4)), (None, text(4))]
    rows += [(5, text(5)), (5, None), (6, text(6)), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "s", "en", len(t or ""), "x") for i, t in rows], "doc_id bigint, text string, source string, lang string, n_chars int, __own_x string")
    kept = corpus_pipeline.near_duplicates(spark, docs, work)
    assert kept.columns == docs.columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    # Of every text one row stays, of text 3 the document with an id; of the rows without words none resembles another.
    assert sorted(t for _, t in found if t) == [text(i) for i in range(1, 7)]
    assert {(3, text(3)), (1, text(1)), (None, text(4)), (5, text(5)), (5, None), (6, text(6)), (None, None), (None, "")} < set(found)
    assert len(found) == 9


def test_empty_documents(spark, work):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{work}/benchmark.parquet")
    docs = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, work), scratch_path(spark, "test-stage"))
        assert docs.count() == 0
