"""The corpus pipeline: every stage against brute force on its own input."""

import pytest
from samples import ROWS, documents
from test_duplicates import LOWER, brute_components
from test_screens import brute_hits

import corpus_pipeline
from shroud.llm import catalog
from shroud.llm.quality import quality_scores

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages(spark, results):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_duplicates", "near_duplicates", "benchmark_free", "tokens"]
    assert all(r.columns == COLUMNS for r in results[:-1])
    before, after = results[0], results[1]
    scores = quality_scores(before, spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 1")
    assert [i for i, _ in rows_of(after)] == sorted((r.doc_id for r in scores.collect()), key=str)
    last = {}
    for i, t in sorted(rows_of(results[1])):
        last[t.translate(LOWER)] = max(i, last.get(t.translate(LOWER), i))
    assert [i for i, _ in rows_of(results[2])] == sorted(last.values(), key=str)
    assert sorted(i for i, _ in rows_of(results[3])) == sorted({c for _, _, c in brute_components(rows_of(results[2]))})
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    given = rows_of(results[3])
    hits = brute_hits(given, items)
    assert rows_of(results[4]) == [r for k, r in enumerate(given) if not hits[k]]
    assert results[5].columns == [*COLUMNS, "token_ids", "n_tokens"]
    assert rows_of(results[5]) == rows_of(results[4])


def test_token_ids(results):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=catalog.tokenizer_file("piece_bpe_32k.model"))
    for r in results[5].collect():
        assert r.token_ids == library.encode(r.text) and r.n_tokens == len(r.token_ids)


def test_run_is_the_stages(spark, results):
    got = catalog.pipeline(spark, SF)
    assert got.columns == results[5].columns and rows_of(got) == rows_of(results[5])


def test_stages_take_odd_rows(spark):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= len(ROWS)
        assert stage(spark, documents(spark, []), SF).count() == 0
    final = corpus_pipeline.tokens(spark, docs, SF)
    assert final.count() == len(ROWS) and final.columns == [*docs.columns, "_token_ids", "_n_tokens"]
