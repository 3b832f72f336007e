"""Periodic runs of words: stretches that repeat with a period (free style, Arrow + numpy).

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and at least ``max(MIN_LENGTH, 2 * q)`` words that no
neighbouring word extends.  On the diagonal of lag q (each word against the
one q places before) a run is a row of at least ``max(MIN_LENGTH - q, q)``
matches.

The diagonals are walked sparsely.  Lags below 8 are few and are compared word
by word.  For lags from m to 2m - 1 (m = 8, 16, 32, ...) a run has m matches in
a row, so the m words that end at some place of it occur already at that lag:
words are looked up with the m - 1 words before them, which leaves few earlier
occurrences to follow.  Going through the words in order, an occurrence whose
lag is active only counts the match on; another one opens its diagonal, whose
match length grows word against word (no hash decides) to where the row of
matches ends, and a row that is long enough is emitted there.

Texts made of one short period have very many occurrences.  So only a place
whose m words did not already end up to m / 2 words before follows its
occurrences.  No run is lost: if every place of a run of lag q had such a near
occurrence, the run would have a period of m / 2 at most.  With that, a place
has few occurrences to follow on average, and the work for a text of n words is
about n log n whatever the text.  A multiple of the smallest period gives the
same stretch; the smallest one is kept.

Each task works on slices of about ``SLICE_BYTES`` of text (a longer text
alone); nothing is shuffled, and a lost task is computed again from its input.

NULL and empty texts have no words and no runs, and an empty collapsed text;
repeated rows give repeated rows; an empty table gives no rows.  Only the two
named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shroud.llm.buffers import mix, slices
from shroud.llm.common import whole_text

MIN_LENGTH = 12
SLICE_BYTES = 4 << 20
TRIAL = 32  # words by which short rows of matches grow together
DENSE_LAGS = 8  # lags below are compared word by word
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _streaks(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) of the rows of True."""
    edge = np.diff(np.r_[0, same.view(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _matches(ids: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places from ``at`` on, in direction ``step``, hold the same word as ``lag`` before."""
    found, size = 0, 32
    while True:
        if step > 0:
            new, old = ids[at:at + size], ids[at - lag:at - lag + size]
            old = old[:len(new)]
        else:
            low = max(at - size + 1, lag)
            new, old = ids[low:at + 1][::-1], ids[low - lag:at + 1 - lag][::-1]
        differ = new != old
        if differ.any():
            return found + int(differ.argmax())
        found += len(new)
        if len(new) < size:
            return found
        at, size = at + step * size, size * 4


def _hopeful(ids: np.ndarray, first: np.ndarray, last: np.ndarray, lag: np.ndarray) -> np.ndarray:
    """Which rows of matches [first, last] may grow to ``lag`` matches: all rows grow together by up to
    ``TRIAL`` words on each side; those that have stopped on both sides and are short are out."""
    out = np.ones(len(first), bool)
    grown = last - first + 1
    stuck = np.zeros(len(first), np.int8)
    for edge, step in ((last + 1, 1), (first - 1, -1)):
        going, at = np.flatnonzero(grown < lag), edge
        for _ in range(TRIAL):
            here = at[going]
            same = (here < len(ids)) & (here - lag[going] >= 0)
            inside = np.where(same, here, lag[going])
            same &= ids[inside] == ids[inside - lag[going]]
            stuck[going[~same]] += 1
            going = going[same]
            if not len(going):
                break
            grown[going] += 1
            at[going] += step
            going = going[grown[going] < lag[going]]
    out[(stuck == 2) & (grown < lag)] = False
    return out


def _occurrences(alive: np.ndarray, key: np.ndarray, m: int, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, lags, repeated): the lags from m to 2m - 1 at which the words of a place
    that leads (see the module) have occurred; ``repeated`` are the places whose key is not unique."""
    order = np.argsort(key, kind="stable")
    place, sorted_key = alive[order], key[order]
    new = np.r_[True, sorted_key[1:] != sorted_key[:-1]]
    group = np.cumsum(new) - 1
    alone = new & np.r_[new[1:], True]
    where = group * total + place  # ascending
    near = np.r_[False, (place[1:] - place[:-1] <= m // 2)] & ~new
    lead = np.flatnonzero(~near & ~new)
    base = group[lead] * total
    low = np.searchsorted(where, base + np.maximum(place[lead] - 2 * m + 1, 0))
    high = np.searchsorted(where, base + np.maximum(place[lead] - m, -1), side="right")
    count = np.maximum(high - low, 0)
    who = np.repeat(lead, count)
    first = np.repeat(np.cumsum(count) - count, count)
    earlier = np.repeat(low, count) + np.arange(len(who)) - first
    return place[who], place[who] - place[earlier], np.sort(place[~alone])


def diagonal_runs(ids: np.ndarray, text: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of word numbers, by start, then period.

    ``text`` numbers the text of each place; after each text stands a place
    with a number that occurs once, so that no match crosses it."""
    total = len(ids)
    found: dict[tuple[int, int], int] = {}

    def emit(first: int, last: int, lag: int) -> None:
        if last - first + 1 >= max(min_length - lag, lag):
            span = (first - lag, last + 1)
            found[span] = min(lag, found.get(span, lag))

    for lag in range(1, min(DENSE_LAGS, total)):
        first, last = _streaks(ids[lag:] == ids[:-lag])
        long = last - first + 1 >= max(min_length - lag, lag)
        for a, b in zip(first[long].tolist(), last[long].tolist(), strict=True):
            emit(a + lag, b + lag, lag)

    with np.errstate(over="ignore"):
        state = mix(ids.astype(np.uint64) * _STEP + np.uint64(1))  # of the word that ends here
        salt = mix(text.astype(np.uint64) + _STEP)
        alive, m = np.arange(total), 1
        while m < DENSE_LAGS:
            alive = alive[m:] if m == 1 else alive[alive >= 2 * m - 1]
            state[alive] = mix(state[alive - m] * _STEP + state[alive])
            m *= 2
        alive = alive[text[alive] == text[alive - m + 1]] if len(alive) else alive
        while len(alive):
            key = state[alive] ^ salt[alive]
            if m == DENSE_LAGS:  # most words are alone: sort only those that may not be
                slot = (key & np.uint64((1 << 22) - 1)).astype(np.int64)
                maybe = np.bincount(slot, minlength=1 << 22)[slot] > 1
                alive, key = alive[maybe], key[maybe]
            if not len(alive):
                break
            place, lag, alive = _occurrences(alive, key, m, total)
            by = np.lexsort((place, lag))
            place, lag = place[by], lag[by]
            opens = np.flatnonzero(np.r_[len(place) > 0, (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)])
            active: dict[int, int] = {}  # lag -> where its row of matches ends
            closes = np.r_[opens[1:], len(place)][:len(opens)] - 1
            opens = opens[_hopeful(ids, place[opens] - m + 1, place[closes], lag[opens])]
            for i in opens[np.argsort(place[opens], kind="stable")].tolist():
                here, q = int(place[i]), int(lag[i])
                if here <= active.get(q, -1):
                    continue
                last = here + _matches(ids, here + 1, q, 1)
                first = here - _matches(ids, here, q, -1) + 1
                active[q] = last
                if first <= here:
                    emit(first, last, q)
            # twice as many words: both halves must have occurred
            again = np.zeros(total, bool)
            again[alive] = True
            alive = alive[alive >= 2 * m - 1]
            alive = alive[again[alive - m] & (text[alive] == text[alive - 2 * m + 1])]
            state[alive] = mix(state[alive - m] * _STEP + state[alive])
            m *= 2
    return sorted((start, end - start, lag) for (start, end), lag in found.items())


def runs_of(texts: list[bytes], min_length: int = MIN_LENGTH) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(number of words, runs, collapsed text) of each text."""
    words: list[bytes] = []
    sizes = []
    for text in texts:
        before = len(words)
        words += text.split()
        sizes.append(len(words) - before)
    size = np.array(sizes, np.int64)
    numbers = pa.array(words, pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(len(texts)), size + 1)
    start = np.r_[0, np.cumsum(size + 1)]
    ids = np.empty(len(text), np.int64)
    inside = np.ones(len(text), bool)
    inside[start[1:] - 1] = False
    ids[inside] = numbers
    ids[~inside] = -1 - np.arange(len(texts))
    per_text: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for at, length, lag in diagonal_runs(ids, text, min_length):
        i = int(text[at])
        per_text[i].append((at - int(start[i]), length, lag))
    out, first = [], 0
    for n, runs in zip(sizes, per_text, strict=True):
        own = words[first:first + n]
        first += n
        if runs:
            keep = np.ones(n, bool)
            for at, length, lag in runs:
                keep[at + lag:at + length] = False
            own = [own[i] for i in np.flatnonzero(keep).tolist()]
        out.append((n, runs, b" ".join(own)))
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str | Column = "text",
                  min_length: int = MIN_LENGTH) -> DataFrame:
    """One row for each document: (doc_id, n_words, runs, collapsed).

    ``runs`` is an array of (start, length, period) by start, then period;
    ``collapsed`` the words that no run contains after its first period,
    joined by one space."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for piece in slices(part, "text", SLICE_BYTES):
                done = runs_of([t.as_buffer().to_pybytes() for t in piece.column("text")], min_length)
                flat = np.array([r for _, runs, _ in done for r in runs], np.int64).reshape(-1, 3)
                ends = np.cumsum([0] + [len(runs) for _, runs, _ in done])
                struct = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)],
                                                    names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array([n for n, _, _ in done], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct),
                     pa.array([c for _, _, c in done], pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(batches, f"doc_id {kind}, n_words bigint, "
                           "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def run_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str | Column = "text") -> DataFrame:
    """The runs of each document as (doc_id, n_runs, start, length, period, exponent_milli,
    runs_sha256, collapsed_sha256); the single run is the longest (ties: smallest start, then period)."""
    found = periodic_runs(docs, id_col, text_col)
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n")))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("best"),
                         F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    length = -F.col("best.shorter")
    return found.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(length * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


def with_planted_repeat(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text with a repeat planted where 10 divides h, the crc32 of the id as text (a NULL id: of the
    empty text): from word a = g % n on, word i becomes word a + (i - a) % p, with g = floor(h / 10) and
    p = 1 + floor((n - a) / (3 + g % 8)).  Other texts stay as they are."""
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.array_remove(F.split(whole_text(text_col), "[\\x20\\x09-\\x0D]+"), "")

    def planted(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        rest = (n - a).cast("int")
        p = (F.floor(rest / (g % 8 + 3)) + 1).cast("int")
        times = F.ceil(rest / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)), F.lit(1), rest)
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), tail), " ")

    # the lambda binds the words, so that a text is split once
    return F.when(h % 10 == 0, F.transform(F.array(words), planted)[0]).otherwise(whole_text(text_col))
