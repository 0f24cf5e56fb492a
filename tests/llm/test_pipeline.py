"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline
from cairn.llm import common


def test_stages_in_turn(spark, sf_dir, rows):
    docs, kept, columns = spark.read.parquet(f"{sf_dir}/documents.parquet"), [], list(corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), "test-stage")
        assert docs.columns == columns
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    everyone, toxic, clean = {i for i, _ in rows}, set(range(400, 440)), set(range(60))
    assert set(kept[0]) == everyone - toxic
    near = {*range(200, 206), *range(210, 213)}
    assert len(near & set(kept[1])) == 1 and set(kept[1]) >= set(kept[0]) - near - {500, 501, 502}
    assert set(kept[2]) == set(kept[1])
    assert all(kept[2][k] == kept[1][k] for k in clean)
    assert sum(len(kept[2][100 + k].split()) < 80 for k in range(6)) == 6
    assert set(kept[3]) == set(kept[2]) - {300, 301, 302}
    last = {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert last == set(kept[3])


def test_no_documents(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0
