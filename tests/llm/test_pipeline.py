"""The pipeline's stages one after the other on a small table."""

from collections import Counter

import corpus_pipeline


def test_stages(spark, corpus, rows, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "secrets", "mix", "pack"]
    docs, seen = corpus, {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, "").write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs
        if name != "pack":
            assert docs.columns == corpus.columns
    lang = Counter(r.doc_id for r in seen["language_id"].collect())
    assert not {400, 401, 402, 403} & set(lang) and lang[7] == 3
    near = Counter(r.doc_id for r in seen["near_duplicates"].collect())
    assert near[7] == 1 and near[5] == 1 and not any(near[300 + i] for i in range(30))
    assert set(near) <= set(lang) and near[1] == 1
    clean = {r.doc_id: r.text for r in seen["secrets"].collect()}
    assert set(clean) == set(near) and "Zx81" not in clean[500]
    mixed = Counter(r.doc_id for r in seen["mix"].collect())
    assert set(mixed) <= set(near) and max(mixed.values()) <= 3
    packed = seen["pack"].collect()
    assert {r.doc_id for r in packed} == set(mixed) and all(len(r.ids) == r.length for r in packed)


def test_empty_table(spark, empty, tmp_path):
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, "").write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.count() == 0
