"""The pipeline's stages on a small corpus: columns, decisions, empty input, and registration."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from govlens.llm import queries
from tests.llm.test_near_dups import plain_fingerprint
from tests.llm.test_langid import language_docs


def corpus(spark, path, rows, items):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, tmp_path):
    item = "a rather special passage which no other document would hold by chance at all"
    docs = language_docs(150, 11)
    rows = [(i, t, k, "s", len(t)) for i, t, k in docs]
    rows += [(200 + i, f"Shared Line\n{docs[i][1]} tail{i}", docs[i][2], "s", 1) for i in range(12)]
    rows += [(300, docs[5][1], docs[5][2], "s", 1), (301, None, "aa", "s", 0), (302, "123 %%", "bb", "s", 1), (303, f"the of and {item.upper()} to in", "aa", "s", 1)]
    d = corpus(spark, tmp_path, rows, [(1, item)])
    step = spark.read.parquet(f"{d}/documents.parquet")
    columns, seen = step.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = corpus_pipeline.written(stage(spark, step, d), name)
        assert step.columns == columns
        seen[name] = {r.doc_id: r for r in step.collect()}
    first = seen["language_id"]
    assert not {301, 302} & set(first) and len(first) >= len(rows) - 4     # clean documents stay
    assert set(seen["line_dedup"]) == set(first) and all("Shared" not in r.text and r.n_chars == len(r.text) for r in seen["line_dedup"].values())
    left = seen["line_dedup"]
    prints = {i: plain_fingerprint(r.text) for i, r in left.items()}
    up = {i: min(j for j in prints if (prints[i] ^ prints[j]).bit_count() <= 3) for i in prints}
    for _ in prints:
        up = {i: up[j] for i, j in up.items()}
    assert set(seen["simhash_near_dedup"]) == set(up.values()) and 300 not in up.values()
    assert set(seen["simhash_near_dedup"]) - set(seen["benchmark_decontamination"]) == {303}
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = corpus_pipeline.STAGES[-1][1](spark, step, d).collect()
    length = {}
    for r in packed:
        length[r.doc_id] = length.get(r.doc_id, 0) + r.length
    assert length == {i: len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in seen["benchmark_decontamination"].items()}
    assert sorted((r.doc_id, r.piece) for r in corpus_pipeline.run(spark, d).collect()) == sorted((r.doc_id, r.piece) for r in packed)


def test_empty_corpus(spark, tmp_path):
    d = corpus(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, d).count() == 0


def test_registered():
    assert [n.split("_")[0] for n in queries.REGISTRY] == [f"op{i}" for i in range(1, 14)]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
