"""The pipeline's stages: columns, order, and that each decision takes effect."""

import corpus_pipeline
from caretide.llm import jaccard, line_dedup, pii, queries, toxicity
from caretide.session import materialize


def test_stages(spark, small):
    docs = queries.table(spark, small, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, small), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == columns and docs.join(before, "doc_id", "left_anti").count() == 0
    source = queries.table(spark, small, "documents")
    scores = toxicity.score_toxicity(source, queries.table(spark, small, "labels"))
    assert {r.doc_id for r in kept["toxicity"].collect()} == {r.doc_id for r in scores.filter("predicted = 0").collect()}
    assert jaccard.near_duplicates(kept["ngram_jaccard"]).filter("n_links > 0").count() == 0
    assert all(not [s for s in r.spans if s.kind in ("email", "card")] for r in pii.find_pii(kept["pii"]).collect())
    assert {r.doc_id for r in kept["packing"].collect()} == {r.doc_id for r in kept["pii"].collect()}
    assert corpus_pipeline.run(spark, small).count() == kept["packing"].count()


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard", "pii", "packing"]
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


NAMES = ("n_lines", "n_removed", "__th", "__first", "__id", "__key", "th", "did", "row", "key", "copied", "removed", "class_id", "node", "a b")


def clashing(spark, rows):
    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{n}` string" for n in NAMES)
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *[f"{n}{i}" for n in NAMES]) for i, t in rows], kinds)


def test_columns_of_the_caller_are_kept(spark):
    block = "\n".join(f"a line of the common block, number {k}" for k in range(8))
    words = " ".join(f"word{k}" for k in range(60))
    rows = [(1, block), (2, f"own line, long enough for itself alone to count\n{block}\nend of the second"), (3, words), (4, words + " more"), (5, None), (None, words), (6, "")]
    docs = clashing(spark, rows)
    for step in (line_dedup.without_repeated_lines, line_dedup.drop_repeated_lines, jaccard.one_per_class, pii.redact):
        out = step(docs)
        assert out.columns == docs.columns
        for r in out.collect():
            assert [r[n] for n in NAMES] == [f"{n}{r.doc_id}" for n in NAMES]
    cut = {r.doc_id: r.text for r in line_dedup.without_repeated_lines(docs).collect()}
    assert cut[2] == "own line, long enough for itself alone to count\nend of the second" and cut[1] == block
    stayed = {r.doc_id for r in jaccard.one_per_class(docs).collect()}
    assert stayed - {None} == {1, 2, 5, 6} | (stayed & {3, 4}) and len(stayed & {None, 3, 4}) == 1


def test_stages_take_empty_tables_and_null_texts(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows in ([], [(1, None), (2, ""), (None, None), (2, "")]):
        docs = clashing(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == clashing(spark, []).columns
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert sum(p.length for p in packed) == docs.count()
