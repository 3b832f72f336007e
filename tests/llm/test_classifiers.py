"""Language identification and quality classifier: held-out accuracy and defined cases."""

import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from samples import EXTRA, ROWS, documents

from shroud.llm import catalog, language_id, quality
from shroud.llm.language_id import languages
from shroud.llm.quality import good_documents, quality_scores

SF = "/root/testdata/sf0.01"
ROOT = Path(__file__).parents[2]


def test_language_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = catalog.op6_language_id(spark, SF).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert np.mean(held) >= 0.97


def test_windows_tile_the_text():
    texts = ["", "a" * 127, "b" * 128, "c" * 129, "é" * 300]
    codes, row, size = language_id.windows_of(*language_id.utf8(pa.array(texts)))
    for i, t in enumerate(texts):
        raw = b"".join(bytes(c[:n].astype(np.uint8)) for c, r, n in zip(codes, row, size, strict=True) if r == i)
        assert raw == t.encode()


@pytest.mark.parametrize("block", [1, 2, 7, 300])
def test_features_in_blocks_are_those_of_the_whole_text(monkeypatch, block):
    texts = ["one two  two\tthree ", None, "", " ", "a", "word" * 90, "ab " * 150, "日本語 の テキスト\n" * 20, " x y"]
    column = pa.array(texts * 2)

    def counted():
        bucket, row = quality.features(column)
        return Counter(zip(row.tolist(), bucket.tolist(), strict=True))

    whole = counted()
    monkeypatch.setattr(quality, "BLOCK_BYTES", block)
    assert counted() == whole
    row, bucket, count = quality.feature_counts(column)
    assert list(zip(row.tolist(), bucket.tolist(), strict=True)) == sorted(whole)
    assert count.tolist() == [whole[k] for k in sorted(whole)]


def worker_peak(code):
    """Peak memory in MB of a fresh Python process that runs ``code``, above one that only imports."""
    def peak(body):
        lines = ("import numpy as np, pyarrow as pa, resource", "from shroud.llm import language_id, quality", body,
                 "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)")
        return int(subprocess.run([sys.executable, "-c", "\n".join(lines)], capture_output=True, text=True,
                                  check=True, cwd=ROOT).stdout)
    return peak(code) - peak("")


def test_memory_for_one_very_long_text():
    text = "text = pa.array(['some words of a very long text ' * 3_200_000])"  # 100 MB
    model = "quality.Model(np.ones((quality.BUCKETS, 2)), np.eye(2), np.zeros(2))"
    assert worker_peak(f"{text}; {model}.scores(text)") < 900
    places = "data, offsets = language_id.utf8(text); row, start, left = language_id.window_places(offsets)"
    assert worker_peak(f"{text}; {places}; language_id.window_codes(data, start[:512], left[:512])") < 900


def brute_pooled(network, text):
    """The network's probabilities for one short text, by loops."""
    codes = [*text.encode(), *[256] * 200]
    wide = len(language_id.WIDTHS) * language_id.FILTERS
    weight = network.filters.reshape(max(language_id.WIDTHS), language_id.EMBEDDING, wide)
    hidden = []
    for f in range(wide):
        best = max(sum(float(network.embed[codes[at + k]] @ weight[k, :, f]) for k in range(weight.shape[0]))
                   for at in range(language_id.WINDOW))
        hidden.append(max(best + float(network.shift[f]), 0.0))
    logits = [sum(h * float(network.out[f, c]) for f, h in enumerate(hidden)) + float(network.bias[c])
              for c in range(len(network.languages))]
    top = np.exp(np.array(logits) - max(logits))
    return top / top.sum()


def test_language_scores_are_brute_force():
    network = language_id.Network(["de", "en", "fr"], seed=3)
    for text in ("a", "Ein kurzer Satz.", "un été à la mer", "x" * 120):
        want = brute_pooled(network, text)
        names, score = network.predict(pa.array([text]))
        assert names == [network.languages[int(want.argmax())]] and abs(score[0] - want.max()) < 1e-5


def test_the_whole_text_counts(spark):
    en = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en'").limit(30).collect()]
    de = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'de'").limit(30).collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    network = language_id.fit(docs)
    long_german = en[0][:200] + " " + " ".join(de)
    assert network.predict(pa.array([long_german]))[0] == ["de"]


def test_training_ignores_held_out_rows_and_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"
    spoiled = docs.selectExpr("doc_id", "text", f"case when {held} then 'xx' else lang end as lang").repartition(5)
    a, b = language_id.fit(docs), language_id.fit(spoiled)
    assert a.languages == b.languages and np.allclose(a.out, b.out) and np.allclose(a.embed, b.embed)


def test_language_edges(spark):
    got = languages(documents(spark)).collect()
    assert len(got) == len(ROWS)
    for r in got:
        if r.doc_id in (2, 3, 6):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        if r.doc_id in (4, 5, 7):
            assert r.lang_pred == "en"
    without = documents(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in languages(without).collect()} == {"und"}
    assert languages(documents(spark, [])).count() == 0


def test_every_language_is_learned(spark):
    many = [(i, f"some plain words {i}", "en" if i % 2 else "de") for i in range(3000)]
    few = [(5000 + i, "日本語のテキスト", "ja") for i in range(12)] + [(6000, "ελληνικά", None)] * 5
    docs = spark.createDataFrame(many + few * 2, "doc_id bigint, text string, lang string")
    assert language_id.fit(docs, sample_rows=40).languages == ["de", "en", "ja"]


def test_language_sample_is_bounded_and_shared(spark):
    drawn = spark.createDataFrame(
        [(i * 2 ** 50 - 2 ** 63, "en", f"t{i}") for i in range(16000)] + [(2 ** 62 + 1, "ja", "x")] * 900
        + [(2 ** 62 + i, "ko", f"k{i}") for i in range(5)], "mix bigint, lang string, text string")
    rows = language_id._sample(drawn, 50)
    assert [r.mix for r in rows if r.lang == "en"] == [i * 2 ** 50 - 2 ** 63 for i in range(23)]
    assert sum(r.lang == "ja" for r in rows) == 1 and sum(r.lang == "ko" for r in rows) == 5


def test_quality_accuracy(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = catalog.op10_quality(spark, SF).collect()
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([p == t for p, t in held]) >= 0.95
    assert np.mean([p == 0 for p, t in held if t == 1]) <= 0.02


def test_quality_features_are_brute_force():
    texts = ["Aa bb  bb cc", "", None, "zz\n\té x", "bb"]
    bucket, row = quality.features(pa.array(texts))
    again = [quality.features(pa.array([t], pa.string())) for t in texts]
    for i, (b, r) in enumerate(again):
        assert sorted(bucket[row == i].tolist()) == sorted(b.tolist()) and not r.any()
    spaced = "Aa bb  bb cc".encode()
    grams = sum(1 for n in (3, 4) for i in range(len(spaced) - n + 1) if b" " not in spaced[i + 1:i + n - 1])
    assert (row == 0).sum() == 4 + 3 + grams
    assert not (row == 1).any() and not (row == 2).any()


def test_quality_ignores_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    spoiled = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 "
                                "then 1 - quality else quality end as quality").repartition(3)
    a, b = quality.fit(docs, labels), quality.fit(docs.repartition(7), spoiled)
    assert np.allclose(a.weight, b.weight) and a.bias == b.bias


def test_quality_trains_on_one_row_of_a_repeated_id(spark):
    docs = [(i, f"text number {i} " + ("good words" if i % 2 else "bad stuff") * (i % 5 + 1)) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    hot = next(i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1)
    once, often = (spark.createDataFrame(docs + [docs[hot]] * n, "doc_id bigint, text string") for n in (0, 400))
    a, b = quality.fit(once, labels), quality.fit(often.repartition(6), labels)
    assert np.allclose(a.weight, b.weight) and np.allclose(a.bias, b.bias)


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 1), (5, None), (None, 1), (6, 7), (8, 0), (8, 0)],
                                   "doc_id bigint, quality int")
    got = quality_scores(documents(spark), labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1
    none = quality_scores(documents(spark), labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    out = good_documents(documents(spark), labels)
    assert out.columns == documents(spark).columns
    assert all(r[n] == f"x{j}" for r in out.collect() for j, n in enumerate(EXTRA))
    assert quality_scores(documents(spark, []), labels).count() == 0
