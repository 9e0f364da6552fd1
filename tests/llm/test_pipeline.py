import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline


def test_stages_take_effect(spark, docs, prose, tmp_path):
    item = prose(900, 14, 10**6)
    clean = [prose(k, 120, 10**6) for k in range(30)]
    texts = clean + ["too short", clean[0], clean[1] + " more", f"{prose(70, 100, 10**6)} {item}", f"{prose(71, 100, 10**6)} token = abcdef123456"]
    docs(texts).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    folder, found = str(tmp_path), spark.read.parquet(str(tmp_path / "documents.parquet"))
    expected = [set(range(30)) | {31, 32, 33, 34}, set(range(30)) | {33, 34}, set(range(30)) | {34}, set(range(30)) | {34}]
    for (name, stage), ids in zip(corpus_pipeline.STAGES, expected):
        found = stage(spark, found, folder)
        assert found.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert {r["doc_id"] for r in found.select("doc_id").collect()} == ids, name
    masked = found.where("doc_id = 34").first()
    assert masked["text"].endswith("[REDACTED]") and masked["n_chars"] == len(masked["text"])

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = corpus_pipeline.run(spark, folder).collect()
    tokens = {r["doc_id"]: r["doc_tokens"] for r in rows}
    kept = {r["doc_id"]: r["text"] for r in found.collect()}
    assert tokens == {k: len(whole.encode(t, add_special_tokens=False).ids) + 1 for k, t in kept.items()}


def test_stages_of_an_empty_table(spark, docs, tmp_path):
    docs([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
