"""Quality classifier on supervised subword embeddings.

A text's features are its words, the pairs of neighbouring words (a word that
follows itself is one pair, whatever the word) and the byte n-grams of its
words (with one byte of white space on either side), hashed into ``BUCKETS``
buckets.  Every
bucket has a learned vector; a document is the mean of its features' vectors,
and a softmax over it gives the classes.  Vectors and output weights are
trained together by numpy stochastic gradient descent.

Training reads a sample of ``SAMPLE_ROWS`` labelled rows at most (the ones
with the smallest hash of their id, hence the same for any input order);
executors turn their whole texts into feature counts, and only those reach
the driver.  Labels with held-out ids are never read.  Scoring covers every
whole text in one pass without a shuffle: the mean of vectors followed by a
linear map is the mean of one number for each bucket, so a text of any length
needs one look-up for each feature.  A long text is worked through in blocks
of about ``BLOCK_BYTES`` that end at white space, with the same features as in
one piece; memory beside the text follows the block (or a longer word).

NULL and empty texts have no features and get the model's score without any
(the bias).  Without any labelled row every score is 0.5.  Labels other than
0 and 1 are ignored; a row labelled twice counts twice.  Of several documents
with a labelled id one is trained on, the one with the smallest hash of its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shroud.llm.buffers import Substrings, mix, slices, utf8, word_spans
from shroud.llm.common import fresh, id_remainder

BUCKETS = 1 << 14
GRAMS = (3, 4)
REPEATED = np.uint64(1)  # the hash of a word pair whose words are equal
DIMENSIONS = 8
SAMPLE_ROWS = 4000
EPOCHS = 12
SLICE_BYTES = 1_000_000
BLOCK_BYTES = 1_000_000
MODULUS, HELD_OUT = 3, 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _blocks(space: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of blocks of the buffer, ``BLOCK_BYTES`` long at least but for the last one.

    They end between texts or behind a white space, with which the next one begins again; so every
    word, and every n-gram with white space at its ends only, lies in one block."""
    start, n = 0, len(space)
    while start < n:
        end = start + BLOCK_BYTES
        if end >= n:
            yield start, n
            return
        border = int(offsets[np.searchsorted(offsets, end)])  # of the text that the block would cut
        cut = end
        while cut < border and not space[cut]:
            found = np.flatnonzero(space[cut:min(cut + BLOCK_BYTES, border)])
            cut = cut + int(found[0]) if len(found) else min(cut + BLOCK_BYTES, border)
        yield start, min(cut + 1, border)
        start = cut


def feature_blocks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of every feature of a text column, by blocks of its bytes."""
    data, offsets = utf8(column)
    space = _SPACE[data]
    last_word, last_row = np.empty(0, np.uint64), np.empty(0, np.int32)
    for start, end in _blocks(space, offsets):
        blank, inside = space[start:end], np.clip(offsets, start, end) - start
        starts, ends = word_spans(~blank, inside)
        hashes = Substrings(data[start:end])
        text_of = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(inside))
        word, word_row = hashes.hashes(starts, ends), text_of[starts]
        # neighbours, the last word of the block before among them
        chain, chain_row = np.r_[last_word, word], np.r_[last_row, word_row]
        with np.errstate(over="ignore"):
            pair = mix(chain[:-1] * np.uint64(3) + chain[1:])
        pair[chain[:-1] == chain[1:]] = REPEATED
        together = chain_row[:-1] == chain_row[1:]
        last_word, last_row = chain[-1:], chain_row[-1:]
        buckets, rows = [word, pair[together]], [word_row, chain_row[1:][together]]
        spaces = np.r_[0, np.cumsum(blank)]
        for size in GRAMS:
            at = np.arange(max(0, end - start - size + 1))
            # inside one text, and white space at its first or last byte only
            inner = spaces[at + size - 1] - spaces[at + 1]
            at = at[(inner == 0) & (text_of[at] == text_of[at + size - 1])]
            buckets.append(hashes.hashes(at, at + size))
            rows.append(text_of[at])
        yield (np.concatenate(buckets) >> np.uint64(40)).astype(np.int64) % BUCKETS, np.concatenate(rows)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every feature of a text column."""
    none = np.empty(0, np.int64), np.empty(0, np.int32)
    bucket, row = zip(none, *feature_blocks(column), strict=True)
    return np.concatenate(bucket), np.concatenate(row)


def feature_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of the distinct features of each text, in this order."""
    codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for bucket, row in feature_blocks(column):
        new, times = np.unique(row.astype(np.int64) * BUCKETS + bucket, return_counts=True)
        codes, place = np.unique(np.r_[codes, new], return_inverse=True)
        counts = np.bincount(place, np.r_[counts, times], len(codes)).astype(np.int64)
    return codes // BUCKETS, codes % BUCKETS, counts


class Model:
    """Per-bucket class-1 logits, and the bias; ``None`` stands for no labelled rows."""

    def __init__(self, vectors: np.ndarray, out: np.ndarray, bias: np.ndarray):
        logits = vectors @ out
        self.weight = (logits[:, 1] - logits[:, 0]).astype(np.float64)
        self.bias = float(bias[1] - bias[0])

    def scores(self, column: pa.Array) -> np.ndarray:
        total, count = np.zeros(len(column)), np.zeros(len(column), np.int64)
        for bucket, row in feature_blocks(column):
            total += np.bincount(row, self.weight[bucket], len(column))
            count += np.bincount(row, minlength=len(column))
        return 1.0 / (1.0 + np.exp(-(total / np.maximum(count, 1) + self.bias)))


def _clipped(gradient: np.ndarray, most: float = 1.0) -> np.ndarray:
    """The gradient, shortened to a norm of ``most``, so that no batch makes the model diverge."""
    return gradient * min(1.0, most / max(float(np.linalg.norm(gradient)), 1e-12))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS,
          batch: int = 64, rate: float = 0.5, seed: int = 7) -> Model | None:
    """Fit vectors and softmax on (buckets, shares) rows by stochastic gradient descent."""
    if not len(labels):
        return None
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.5, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    target = np.eye(2, dtype=np.float32)[labels]
    # shares are small numbers; this factor lets one rate serve vectors and output
    gain = 20.0
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), batch):
            some = order[lo:lo + batch]
            dense = np.zeros((len(some), BUCKETS), np.float32)
            for i, r in enumerate(some):
                dense[i, rows[r][0]] = rows[r][1]
            hidden = dense @ vectors
            logit = gain * hidden @ out + bias
            logit -= logit.max(1, keepdims=True)
            p = np.exp(logit)
            p /= p.sum(1, keepdims=True)
            error = (p - target[some]) / len(some)
            back = gain * error @ out.T
            out -= step * _clipped(gain * hidden.T @ error)
            bias -= step * error.sum(0)
            vectors -= step * _clipped(50.0 * (dense.T @ back))
    return Model(vectors, gain * out, bias)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Train on the labelled rows that aren't held out."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter(F.col("id").isNotNull() & F.col("label").isin(0, 1)
                         & (id_remainder("id", MODULUS) != HELD_OUT))
    sample = known.orderBy(F.xxhash64("id"), "id", "label").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    times = sample.groupBy("id", "label").agg(F.count(F.lit(1)).alias("times"))
    rows = texts.join(F.broadcast(times), "id").select(
        "id", "label", "times", "text", F.xxhash64("text").alias("mix"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for some in slices(part, "text", SLICE_BYTES):
                of, bucket, count = feature_counts(some.column("text"))
                total = np.bincount(of, count, some.num_rows)
                cuts = np.searchsorted(of, np.arange(some.num_rows + 1))
                offsets = pa.array(cuts.astype(np.int32))
                share = (count / np.maximum(total[of], 1)).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), some.column("label"), some.column("times"), some.column("mix"),
                     pa.ListArray.from_arrays(offsets, pa.array(bucket.astype(np.int16))),
                     pa.ListArray.from_arrays(offsets, pa.array(share))],
                    names=["id", "label", "times", "mix", "bucket", "share"])

    kind = dict(rows.dtypes)["id"]
    made = rows.mapInArrow(
        batches, f"id {kind}, label int, times bigint, mix bigint, bucket array<smallint>, share array<float>")
    # repeated ids meet here, combined before the shuffle: at most sample_rows rows reach the driver
    got = made.groupBy("id", "label", "times").agg(F.min_by(F.struct("bucket", "share"), "mix").alias("f"))
    got = got.select("id", "label", "times", "f.bucket", "f.share").toArrow()
    got = got.combine_chunks().sort_by([("id", "ascending"), ("label", "ascending")])
    sparse = [(np.asarray(b.values), np.asarray(s.values))
              for b, s in zip(got.column("bucket"), got.column("share"), strict=True)]
    each = np.repeat(np.arange(len(sparse)), got.column("times").to_numpy())
    return train([sparse[i] for i in each], got.column("label").to_numpy().astype(np.int64)[each])


def with_scores(docs: DataFrame, model: Model | None, score_name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the model's score of each whole text (0 to 1; higher: label 1 is likelier)."""
    field = T.StructField(score_name, T.DoubleType(), False)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for some in slices(part, text_col, SLICE_BYTES):
                score = np.full(some.num_rows, 0.5) if model is None else model.scores(some.column(text_col))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(score)],
                                                 names=[*some.schema.names, score_name])

    return docs.mapInArrow(batches, T.StructType([*docs.schema.fields, field]))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", **options) -> DataFrame:
    """One row for each document: (doc_id, held_out, score, predicted)."""
    model = fit(docs, labels, id_col, text_col, **options)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_scores(rows, model, "score").select(
        "doc_id", (id_remainder("doc_id", MODULUS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that the classifier rejects; all columns stay as they are."""
    name = fresh("quality_score", docs.columns)
    model = fit(docs, labels, id_col, text_col, **options)
    return with_scores(docs, model, name, text_col).filter(F.col(name) >= 0.5).drop(name)
