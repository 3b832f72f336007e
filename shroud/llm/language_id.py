"""Language identification with a byte convolutional network.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes (the last one
padded).  The network embeds bytes, applies filters of several widths, takes
the maximum of each filter over the window, and ends in a softmax over the
languages.  A text's probabilities are the mean over all its windows, weighted
by their bytes, so the whole text counts.  Filters of all widths are one
matrix (narrower ones have zeros), hence one product for a batch of windows.

Training is numpy stochastic gradient descent (Adam) on windows of
``SAMPLE_ROWS`` rows at most with a language and an id that isn't held out.
Every language of these rows gets an equal share of the sample (what small ones
leave goes to the others, and each has one row at least): the rows with the
smallest hashes of their ids, one for each hash, hence the same for any input
order.  One window is drawn from each text at a place that the id's hash gives.  Only these windows reach the driver.  Languages, sources and ids are
never inputs of a prediction.

A text that is NULL or has no letter is ``und`` with score 0, and so is every
text if no row has a language.  Repeated rows give repeated rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shroud.llm.buffers import slices, utf8
from shroud.llm.common import id_remainder

WINDOW = 128
EMBEDDING = 8
WIDTHS = (2, 3, 4)
FILTERS = 10
SAMPLE_ROWS = 6000
EPOCHS = 8
SLICE_BYTES = 300_000
MODULUS, HELD_OUT = 4, 2
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_WIDEST = max(WIDTHS)
_PAD = 256


def window_places(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, bytes left in the text) of the windows that tile each text."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), count)
    start = offsets[:-1][row] + WINDOW * (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
    return row, start, offsets[1:][row] - start


def window_codes(data: np.ndarray, start: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Byte codes [window, WINDOW + widest - 1]; a window also sees the first bytes after it,
    so that no n-gram is lost at a border."""
    span = WINDOW + _WIDEST - 1
    at = start[:, None] + np.arange(span)
    codes = np.full(at.shape, _PAD, np.int64)
    inside = np.arange(span) < left[:, None]
    codes[inside] = data[at[inside]]
    return codes


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, row, bytes) of all windows."""
    row, start, left = window_places(offsets)
    return window_codes(data, start, left), row, np.minimum(left, WINDOW)


class Network:
    """Byte embedding, filters of several widths, max pooling, softmax."""

    def __init__(self, languages: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.languages = languages
        n = FILTERS * len(WIDTHS)
        self.embed = rng.normal(0, 0.5, (_PAD + 1, EMBEDDING)).astype(np.float32)
        self.embed[_PAD] = 0
        self.mask = np.zeros((_WIDEST, EMBEDDING, n), np.float32)
        for i, width in enumerate(WIDTHS):
            self.mask[:width, :, i * FILTERS:(i + 1) * FILTERS] = 1
        self.mask = self.mask.reshape(-1, n)
        self.filters = self.mask * rng.normal(0, 0.3, self.mask.shape).astype(np.float32)
        self.shift = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.2, (n, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def pooled(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pooled activations, place of each maximum, patches)."""
        x = self.embed[codes]
        patches = np.concatenate([x[:, k:k + WINDOW] for k in range(_WIDEST)], axis=2)
        raw = (patches.reshape(-1, patches.shape[2]) @ self.filters).reshape(len(codes), WINDOW, -1)
        place = raw.argmax(1)
        top = np.take_along_axis(raw, place[:, None, :], 1)[:, 0] + self.shift
        return np.maximum(top, 0), place, patches

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        x = self.embed[codes]
        patches = np.concatenate([x[:, k:k + WINDOW] for k in range(_WIDEST)], axis=2)
        raw = (patches.reshape(-1, patches.shape[2]) @ self.filters).reshape(len(codes), WINDOW, -1)
        return _softmax(np.maximum(raw.max(1) + self.shift, 0) @ self.out + self.bias)

    def train(self, codes: np.ndarray, target: np.ndarray, epochs: int = EPOCHS, batch: int = 64,
              rate: float = 0.005, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        names = ("embed", "filters", "shift", "out", "bias")
        state = {k: [np.zeros_like(getattr(self, k)), np.zeros_like(getattr(self, k))] for k in names}
        goal = np.eye(len(self.languages), dtype=np.float32)[target]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(codes))
            for lo in range(0, len(order), batch):
                some = order[lo:lo + batch]
                top, place, patches = self.pooled(codes[some])
                error = (_softmax(top @ self.out + self.bias) - goal[some]) / len(some)
                back = (error @ self.out.T) * (top > 0)
                at_max = np.take_along_axis(patches[:, :, None, :], place[:, None, :, None], 1)[:, 0]
                grad = {"out": top.T @ error, "bias": error.sum(0), "shift": back.sum(0),
                        "filters": self.mask * np.einsum("nfk,nf->kf", at_max, back, optimize=True)}
                to_patch = (back[:, :, None] * self.filters.T[None]).reshape(len(some), -1, _WIDEST, EMBEDDING)
                bytes_at = codes[some][np.arange(len(some))[:, None, None], place[:, :, None] + np.arange(_WIDEST)]
                grad["embed"] = np.zeros_like(self.embed)
                np.add.at(grad["embed"], bytes_at.ravel(), to_patch.reshape(-1, EMBEDDING))
                grad["embed"][_PAD] = 0
                step += 1
                for k in names:
                    m, v = state[k]
                    m += 0.1 * (grad[k] - m)
                    v += 0.001 * (grad[k] ** 2 - v)
                    change = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
                    setattr(self, k, getattr(self, k) - change.astype(np.float32))

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text of a column."""
        data, offsets = utf8(column)
        row, start, left = window_places(offsets)
        size = np.minimum(left, WINDOW)
        total = np.zeros((len(column), len(self.languages)))
        for lo in range(0, len(row), 512):  # only these windows are built at a time
            codes = window_codes(data, start[lo:lo + 512], left[lo:lo + 512])
            p = self.probabilities(codes) * size[lo:lo + 512, None]
            np.add.at(total, row[lo:lo + 512], p)
        weight = np.bincount(row, size, len(column))
        total /= np.maximum(weight, 1)[:, None]
        best = total.argmax(1)
        spoken = np.fromiter((t is not None and _LETTER.search(t) is not None for t in column.to_pylist()),
                             bool, len(column))
        names = [self.languages[b] if s else UNKNOWN for b, s in zip(best.tolist(), spoken.tolist(), strict=True)]
        return names, np.where(spoken, np.clip(total[np.arange(len(best)), best], 0, 1), 0.0)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def _shares(counts: dict[str, int], total: int) -> dict[str, int]:
    """How many of ``total`` rows each language gets: equal shares, unless it has fewer."""
    out, left = {}, total
    for done, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[lang] = max(1, min(n, left // (len(counts) - done)))
        left = max(left - out[lang], 0)
    return out


def _sample(drawn: DataFrame, sample_rows: int) -> list:
    """Rows (lang, mix, text) of ``drawn``: of each language its share, by the smallest hashes."""
    counts = {r["lang"]: r["n"] for r in drawn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = _shares(counts, sample_rows)
    rows, width = [], dict.fromkeys(share, 4.0)
    while share:
        # the smallest hashes lie below a bound that about ``width`` times as many
        # rows reach, so tasks only send those; repeated ids may make it miss
        part = {lang: min(1.0, width[lang] * n / counts[lang]) for lang, n in share.items()}
        bounds = drawn.sparkSession.createDataFrame(
            [(lang, min(int(-(1 << 63) + p * ((1 << 64) - 1)), (1 << 63) - 1), share[lang])
             for lang, p in part.items()],
            "lang string, bound bigint, share int")
        near = drawn.join(F.broadcast(bounds), "lang").filter("mix <= bound")
        near = near.groupBy("lang", "share", "mix").agg(F.min("text").alias("text"))
        order = Window.partitionBy("lang").orderBy("mix")
        got = near.withColumn("place", F.row_number().over(order)).filter("place <= share").collect()
        found = Counter(r["lang"] for r in got)
        done = {lang for lang, n in share.items() if found[lang] >= n or part[lang] >= 1.0}
        rows += [r for r in got if r["lang"] in done]
        share = {lang: n for lang, n in share.items() if lang not in done}
        width = {lang: 16 * width[lang] for lang in share}
    return sorted(rows, key=lambda r: (r["mix"], r["lang"], r["text"]))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_rows: int = SAMPLE_ROWS) -> Network | None:
    """Train on rows that have a language and aren't held out; None if there are none."""
    known = docs.filter(F.col(lang_col).isNotNull() & (id_remainder(id_col, MODULUS) != HELD_OUT))
    known = known.select(F.col(id_col).alias("id"), F.xxhash64(id_col).alias("mix"),
                         F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    known = known.filter(F.length("text") > 0)
    # the id's hash also says where the window begins
    span = F.greatest(F.length("text") - F.lit(WINDOW), F.lit(0)) + 1
    begin = F.pmod(F.shiftright("mix", 20), span).cast("int") + 1
    drawn = known.select("mix", "lang", F.substring(F.col("text"), begin, F.lit(WINDOW)).alias("text"))
    rows = _sample(drawn, sample_rows)
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    network = Network(languages)
    codes, row, _ = windows_of(*utf8(pa.array([r.text for r in rows], pa.string())))
    target = np.array([languages.index(r.lang) for r in rows])[row]
    network.train(codes, target)
    return network


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              lang_col: str = "lang", **options) -> DataFrame:
    """One row for each document: (doc_id, held_out, lang_pred, score)."""
    network = fit(docs, id_col, text_col, lang_col, **options)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       (id_remainder(id_col, MODULUS) == HELD_OUT).alias("held_out"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for some in slices(part, "text", SLICE_BYTES):
                if network is None:
                    names, score = [UNKNOWN] * some.num_rows, np.zeros(some.num_rows)
                else:
                    names, score = network.predict(some.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                    names=["doc_id", "held_out", "lang_pred", "score"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(batches, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
