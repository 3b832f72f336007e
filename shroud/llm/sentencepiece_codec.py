"""SentencePiece encoding and decoding in batched numpy.

A text becomes words (a run of the space mark and what follows it; no piece
reaches across such a border).  Each distinct word of a task is encoded once;
words of equal length advance together as one matrix.  All their substrings
up to the longest piece are hashed from prefix sums and probed in the sorted
hashes of the pieces, which gives the lattice of pieces; byte pieces stand in
for characters that have no piece.

Viterbi then picks the segmentation: for every end position the best score
over all last pieces is a vectorised maximum, and its length is the
back-pointer.  Which last pieces compete depends on the model's kind:

* unigram: all of them; the best sum of scores wins.
* BPE: those that are stable after the piece that the back-pointer of their
  start holds, that is, merging the two texts as one gives these two pieces
  again; others score minus infinity.  A sequence is what merging gives if and
  only if each neighbouring pair is stable, since merges inside pieces don't
  depend on what stands beyond the border, so one piece is left at every end.
  A pair is tested by undoing the merges at its border from the last to the
  first: at no time may a merge across the border have come before the next
  one inside.  Verdicts are kept in a table of fixed size.

A BPE model in which some piece isn't built by merges of falling scores (the
test above needs that) merges the best pair of each word step by step instead.
Words longer than ``MATRIX_CHARS`` characters are merged one by one with a
heap (BPE), or in matrices of their own, one row each (unigram), so that
memory follows the length of a word, not its square.

Decoding maps ids to bytes with one gather, turns space marks into spaces and
drops the one that encoding put first.  Decoding an encoding gives the text
back, unless the text itself holds the space mark U+2581 (it becomes a space).

NULL and empty texts have no ids; repeated rows give repeated rows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shroud.llm.buffers import mix, powers, slices
from shroud.llm.common import fresh

SPACE = "▁"
MATRIX_CHARS = 48
TABLE_WORDS = 200_000
SLICE_BYTES = 2_000_000
# Words, and the finer words that are used if every piece lies within one of them.
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_FINE_WORDS = re.compile(f"{SPACE}*(?:[{_LATIN}]+|[^{SPACE}{_LATIN}]+)|{SPACE}+")
_NONE = -1
PAIR_SLOTS = 1 << 20


class Vocabulary:
    """Pieces and scores as arrays, sorted by the hash of a piece's characters."""

    def __init__(self, pieces: list[str], scores: list[float], unigram: bool,
                 normal: list[bool], byte_ids: dict[int, int], unknown: int):
        self.unigram, self.unknown = unigram, unknown
        usable = [i for i, ok in enumerate(normal) if ok and pieces[i]]
        self.longest = max([1, *(len(pieces[i]) for i in usable)])
        self.ids_of = {pieces[i]: i for i in usable}
        self.score = np.array(scores, np.float64)
        self.floor = float(min((scores[i] for i in usable), default=0.0)) - 10.0  # an unknown character's score
        self.pow = powers(self.longest + 1)
        codes = np.zeros((len(usable), self.longest), np.uint64)
        for row, i in enumerate(usable):
            points = [ord(c) + 1 for c in pieces[i]]
            codes[row, :len(points)] = points
        lengths = np.array([len(pieces[i]) for i in usable], np.uint64)
        with np.errstate(over="ignore"):
            keys = mix((codes * self.pow[:self.longest]).sum(1, dtype=np.uint64) + lengths)
        self.total = np.zeros(len(pieces), np.uint64)
        self.total[usable] = (codes * self.pow[:self.longest]).sum(1, dtype=np.uint64)
        self.length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(usable, np.int32)[order]
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces share a hash")
        self.maybe = np.zeros(1 << 20, bool)  # most probes end here, before the sorted keys
        self.maybe[(keys & np.uint64(0xFFFFF)).astype(np.int64)] = True
        fine = all(_FINE_WORDS.fullmatch(pieces[i]) for i in usable)
        self.words = (_FINE_WORDS if fine else _WORDS).findall
        self.byte_ids = byte_ids
        self.by_borders = not unigram and self._learn_merges(usable, pieces)
        raw = []
        of_byte = {i: b for b, i in byte_ids.items()}
        for i, p in enumerate(pieces):
            if i in of_byte:
                raw.append(bytes([of_byte[i]]))
            else:
                raw.append(p.replace(SPACE, " ").encode() if normal[i] else b"")
        if unknown >= 0:
            raw[unknown] = " ⁇ ".encode()
        self.raw_len = np.fromiter(map(len, raw), np.int64, len(raw))
        self.raw_at = np.r_[0, np.cumsum(self.raw_len)[:-1]]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)

    @classmethod
    def load(cls, model_file: str) -> Vocabulary:
        """From a .model file; only its tables are read, the library's encoder isn't used."""
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as model

        spec = model.ModelProto()
        spec.ParseFromString(SentencePieceProcessor(model_file=model_file).serialized_model_proto())
        if spec.normalizer_spec.name != "identity" or spec.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models with identity normalisation are supported")
        pieces = [p.piece for p in spec.pieces]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            raise ValueError("a piece reaches across a word border")
        kind = model.ModelProto.SentencePiece
        byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == kind.BYTE}
        unknown = next((i for i, p in enumerate(spec.pieces) if p.type == kind.UNKNOWN), -1)
        return cls(pieces, [p.score for p in spec.pieces], spec.trainer_spec.model_type == 1,
                   [p.type == kind.NORMAL for p in spec.pieces], byte_ids, unknown)

    def _learn_merges(self, usable: list[int], pieces: list[str]) -> bool:
        """The last merge of every piece that merging its characters gives: its two parts and when it
        comes (``made``, the score; infinite for a character).  False if the border test can't rest on them."""
        self.left, self.right = np.zeros((2, len(pieces)), np.int64)
        self.made = np.full(len(pieces), np.nan)  # NaN: merging never gives this piece
        ids = np.array(usable, np.int64)
        self.made[ids[self.length[ids] == 1]] = np.inf
        for length in range(2, self.longest + 1):
            some = ids[self.length[ids] == length]
            if not len(some):
                continue
            text = "".join([pieces[i] for i in some.tolist()])
            chars = np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(-1, length)
            for rows, _, parts in self.merges(chars, until=2):
                if parts.shape[1] != 2:
                    continue
                if (parts == _NONE).any():
                    return False
                self.left[some[rows]], self.right[some[rows]] = parts.T
                self.made[some[rows]] = self.score[some[rows]]
        built = ids[(self.length[ids] > 1) & ~np.isnan(self.made[ids])]
        parts_made = np.minimum(self.made[self.left[built]], self.made[self.right[built]])
        self.pair_keys = np.full(PAIR_SLOTS, -1, np.int64)
        self.pair_stable = np.zeros(PAIR_SLOTS, bool)
        return bool((parts_made >= self.made[built]).all())

    def _pair_score(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Scores of the pieces that are ``a`` and ``b`` joined; minus infinity where there is none."""
        length = self.length[a] + self.length[b]
        with np.errstate(over="ignore"):
            keys = mix(self.total[a] + self.total[b] * self.pow[self.length[a]] + length.astype(np.uint64))
        out = np.full(len(a), -np.inf)
        like = np.flatnonzero((length <= self.longest) & self.maybe[(keys & np.uint64(0xFFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, keys[like]), len(self.keys) - 1)
        hit = self.keys[at] == keys[like]
        out[like[hit]] = self.score[self.key_ids[at[hit]]]
        return out

    def _borders_hold(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging piece ``a`` followed by piece ``b`` as one text keeps the border, for each pair."""
        holds = np.ones(len(a), bool)
        rows = np.arange(len(a))
        bound, equal = np.full(len(a), -np.inf), np.zeros(len(a), bool)
        while len(rows):
            across = self._pair_score(a, b)
            merged = (across > bound) | (equal & (across == bound))
            holds[rows[merged]] = False
            later_b = self.made[b] <= self.made[a]  # of equal merges the left one comes first
            bound = np.where(later_b, self.made[b], self.made[a])
            go = ~merged & (bound < np.inf)
            rows, bound, equal, a, b = rows[go], bound[go], later_b[go], a[go], b[go]
            a, b = np.where(equal, a, self.right[a]), np.where(equal, self.left[b], b)
        return holds

    def _stable(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether ``piece`` may follow ``before`` (-1: a character without a piece, or the start of the word)."""
        out = (piece == _NONE) | ~np.isnan(self.made[piece])
        ask = np.flatnonzero(out & (before != _NONE) & (piece != _NONE))
        keys = before[ask] * len(self.made) + piece[ask]
        slot = (mix(keys.astype(np.uint64)) % np.uint64(PAIR_SLOTS)).astype(np.int64)
        known = self.pair_keys[slot] == keys
        out[ask[known]] = self.pair_stable[slot[known]]
        if not known.all():
            new, first, back = np.unique(keys[~known], return_index=True, return_inverse=True)
            holds = self._borders_hold(*np.divmod(new, len(self.made)))
            out[ask[~known]] = holds[back]
            slot = slot[~known][first]
            _, one = np.unique(slot, return_index=True)  # a slot holds one pair
            self.pair_keys[slot[one]], self.pair_stable[slot[one]] = new[one], holds[one]
        return out

    def lattice(self, chars: np.ndarray) -> np.ndarray:
        """Piece ids of all substrings: [word, start, length - 1], -1 where there is none."""
        n, size = chars.shape
        most = min(self.longest, size)
        out = np.full((n, size, most), _NONE, np.int32)
        total = np.zeros((n, size), np.uint64)
        codes = chars.astype(np.uint64) + np.uint64(1)
        for length in range(1, most + 1):
            starts = size - length + 1
            with np.errstate(over="ignore"):
                total = total[:, :starts] + codes[:, length - 1:] * self.pow[length - 1]
                keys = mix(total + np.uint64(length))
            w, s = np.nonzero(self.maybe[(keys & np.uint64(0xFFFFF)).astype(np.int64)])
            probe = keys[w, s]
            at = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
            hit = self.keys[at] == probe
            out[w[hit], s[hit], length - 1] = self.key_ids[at[hit]]
        return out

    def _emit(self, word: str, cuts: list[int], ids: list[int]) -> list[int]:
        """Ids of a segmentation; characters without a piece become bytes, or unknown."""
        out: list[int] = []
        start = 0
        for end, i in zip(cuts, ids, strict=True):
            if i != _NONE:
                out.append(i)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in word[start:end].encode())
            else:
                out.append(self.unknown)
            start = end
        return out

    def viterbi(self, chars: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, cuts, ids) by number of pieces for words of equal length: the best sums of scores,
        for a BPE model over the paths whose neighbouring pieces are stable."""
        n, size = chars.shape
        pieces = self.lattice(chars)
        by_end = np.full((size, n, pieces.shape[2]), _NONE, np.int32)
        for k in range(pieces.shape[2]):
            by_end[k:, :, k] = pieces[:, :size - k, k].T
        there = by_end != _NONE
        there[:, :, 0] = True  # a character without a piece
        place, word, shorter = np.nonzero(there)  # ascending by end, word, length
        piece = by_end[place, word, shorter].astype(np.int64)
        value = np.where(piece == _NONE, self.floor, self.score[piece])
        first = np.searchsorted(place, np.arange(size + 1))
        best = np.zeros((n, size + 1))
        back = np.zeros((n, size + 1), np.int64)
        last = np.full((n, size + 1), _NONE, np.int64)  # the piece that ends there
        for end in range(1, size + 1):
            some = slice(first[end - 1], first[end])
            row, ending, length = word[some], piece[some], shorter[some] + 1
            start = end - length
            reach = best[row, start] + value[some]
            if self.by_borders:
                reach[~self._stable(last[row, start], ending)] = -np.inf
            lead = np.searchsorted(row, np.arange(n))  # each word's shortest last piece
            best[:, end] = np.maximum.reduceat(reach, lead)
            top = np.flatnonzero(reach == best[row, end])[::-1]  # of equals the shortest is written last
            back[row[top], end] = length[top]
            last[row[top], end] = ending[top]
        rows, end, path = np.arange(n), np.full(n, size), []
        while len(rows):  # follow the back-pointers of all words at once
            path.append((rows, end))
            end = end - back[rows, end]
            rows, end = rows[end > 0], end[end > 0]
        steps = np.zeros(n, np.int64)
        for rows, _ in path:
            steps[rows] += 1
        for k in np.unique(steps).tolist():
            rows = np.flatnonzero(steps == k)
            cuts = np.zeros((len(rows), k), np.int64)
            for depth in range(k):
                of, end = path[depth]
                cuts[:, k - 1 - depth] = end[np.searchsorted(of, rows)]
            yield rows, cuts, self._pieces_at(pieces, rows, cuts)

    @staticmethod
    def _pieces_at(pieces: np.ndarray, rows: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        starts = np.c_[np.zeros(len(cuts), np.int64), cuts[:, :-1]]
        return pieces[rows[:, None], starts, cuts - starts - 1]

    def merges(self, chars: np.ndarray, until: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, cuts, ids) by number of pieces: BPE merges, one in each word of equal length a step,
        down to ``until`` pieces."""
        n, size = chars.shape
        pieces = self.lattice(chars)
        most = pieces.shape[2]
        score = np.where(pieces == _NONE, -np.inf, self.score[np.maximum(pieces, 0)])
        alive = np.arange(n)
        ends = np.tile(np.arange(1, size + 1), (n, 1))
        while len(alive) and ends.shape[1] > until:
            starts = np.c_[np.zeros(len(ends), np.int64), ends[:, :-2]]
            length = ends[:, 1:] - starts
            pair = np.where(length <= most, score[alive[:, None], starts, np.minimum(length, most) - 1], -np.inf)
            pick = pair.argmax(1)
            can = pair[np.arange(len(pair)), pick] > -np.inf
            if not can.all():
                yield alive[~can], ends[~can], self._pieces_at(pieces, alive[~can], ends[~can])
                alive, ends, pick = alive[can], ends[can], pick[can]
            keep = np.ones(ends.shape, bool)
            keep[np.arange(len(ends)), pick] = False
            ends = ends[keep].reshape(len(ends), ends.shape[1] - 1)
        if len(alive):
            yield alive, ends, self._pieces_at(pieces, alive, ends)

    def merge_long(self, word: str) -> tuple[list[int], list[int]]:
        """The same merges for one long word, with a heap of candidate pairs."""
        n = len(word)
        end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), [*range(1, n), -1]
        live = [True] * n
        heap: list[tuple[float, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            i = self.ids_of.get(word[left:end[right]]) if end[right] - left <= self.longest else None
            if i is not None:
                heapq.heappush(heap, (-self.score[i], left, right, end[right]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, left, right, reach = heapq.heappop(heap)
            if not (live[left] and live[right]) or after[left] != right or end[right] != reach:
                continue
            live[right], end[left], after[left] = False, reach, after[right]
            if after[right] >= 0:
                before[after[right]] = left
                offer(left, after[right])
            if before[left] >= 0:
                offer(before[left], left)
        starts = [i for i in range(n) if live[i]]
        cuts = [end[i] for i in starts]
        return cuts, [self.ids_of.get(word[a:b], _NONE) for a, b in zip(starts, cuts, strict=True)]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word); words of equal length go through the matrices together."""
        found: list[tuple[np.ndarray, np.ndarray]] = []  # places, ids: a row for each place
        odd: list[tuple[int, list[int]]] = []
        size = np.fromiter(map(len, words), np.int64, len(words))
        for length in np.unique(size).tolist():
            places = np.flatnonzero(size == length)
            if length > MATRIX_CHARS and not self.unigram:
                odd += [(at, self._emit(words[at], *self.merge_long(words[at]))) for at in places.tolist()]
                continue
            most = max(1, 4_000_000 // (length * min(length, self.longest) * 16))
            for lo in range(0, len(places), most):
                some = places[lo:lo + most]
                text = "".join([words[i] for i in some.tolist()])
                chars = np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(-1, length)
                for rows, cuts, ids in (self.viterbi if self.unigram or self.by_borders else self.merges)(chars):
                    whole = (ids != _NONE).all(1)
                    found.append((some[rows[whole]], ids[whole]))
                    for row, c, i in zip(some[rows[~whole]].tolist(), cuts[~whole].tolist(),
                                         ids[~whole].tolist(), strict=True):
                        odd.append((row, self._emit(words[row], c, i)))
        found += [(np.array([at]), np.array([ids], np.int32)) for at, ids in odd]
        count = np.zeros(len(words), np.int64)
        for places, ids in found:
            count[places] = ids.shape[1]
        start = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int32)
        for places, ids in found:
            out[start[places][:, None] + np.arange(ids.shape[1])] = ids
        return out, count


class _Places(dict):
    """Word -> number, given in order of first sight; ``new`` holds the words not yet encoded."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        at = self[word] = len(self)
        return at


class Codec:
    """Encodes and decodes batches of texts; holds the distinct words seen so far, boundedly."""

    def __init__(self, vocabulary: Vocabulary, table_words: int = TABLE_WORDS):
        self.vocabulary, self.table_words = vocabulary, table_words
        self._reset()

    def _reset(self) -> None:
        self.place = _Places()
        self.word_ids = np.empty(0, np.int32)
        self.word_len = np.empty(0, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of text i are ids[offsets[i]:offsets[i + 1]]."""
        if len(self.place) > self.table_words:
            self._reset()
        number, order, counts = self.place.__getitem__, [], []
        for text in texts:
            words = self.vocabulary.words(SPACE + text.replace(" ", SPACE)) if text else []
            counts.append(len(words))
            order.extend(map(number, words))
        if self.place.new:
            ids, count = self.vocabulary.encode_words(self.place.new)
            self.word_ids, self.word_len = np.r_[self.word_ids, ids], np.r_[self.word_len, count]
            self.place.new = []
        word_at = np.cumsum(self.word_len) - self.word_len
        at = np.array(order, np.int64)
        length = self.word_len[at]
        out = np.r_[0, np.cumsum(length)]
        ids = self.word_ids[np.arange(out[-1]) + np.repeat(word_at[at] - out[:-1], length)]
        return ids, out[np.r_[0, np.cumsum(counts, dtype=np.int64)]]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of such ids; bytes that aren't UTF-8 become U+FFFD."""
        v = self.vocabulary
        length = v.raw_len[ids]
        out = np.r_[0, np.cumsum(length)]
        data = v.raw[np.arange(out[-1]) + np.repeat(v.raw_at[ids] - out[:-1], length)].tobytes()
        ends = out[offsets].tolist()
        texts = []
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            text = data[a:b].decode("utf-8", "replace")
            texts.append(text[1:] if text.startswith(" ") else text)
        return texts


def encode_documents(docs: DataFrame, model_file: str, text_col: str = "text",
                     ids_name: str = "token_ids", decoded_name: str | None = None) -> DataFrame:
    """``docs`` with the ids of each whole text, and the text decoded from them if a name is given.

    A new column whose name is taken gets leading underscores."""
    ids_name = fresh(ids_name, docs.columns)
    extra = [T.StructField(ids_name, T.ArrayType(T.IntegerType(), False), False)]
    if decoded_name is not None:
        decoded_name = fresh(decoded_name, [*docs.columns, ids_name])
        extra.append(T.StructField(decoded_name, T.StringType(), False))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(Vocabulary.load(model_file))
        for part in parts:
            for some in slices(part, text_col, SLICE_BYTES):
                ids, offsets = codec.encode(some.column(text_col).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                columns = [*some.columns, lists]
                if decoded_name is not None:
                    columns.append(pa.array(codec.decode(ids, offsets), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*some.schema.names, *(f.name for f in extra)])

    return docs.mapInArrow(batches, T.StructType([*docs.schema.fields, *extra]))


def decode_documents(rows: DataFrame, model_file: str, ids_col: str = "token_ids",
                     text_name: str = "decoded") -> DataFrame:
    """``rows`` with the text of each id list (NULL: empty); ids must be of the model."""
    text_name = fresh(text_name, rows.columns)
    field = T.StructField(text_name, T.StringType(), False)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(Vocabulary.load(model_file))
        for part in parts:
            for at in range(0, part.num_rows, 256):
                some = part.slice(at, 256)
                lists = [x or [] for x in some.column(ids_col).to_pylist()]
                ids = np.fromiter((i for x in lists for i in x), np.int64)
                offsets = np.r_[0, np.cumsum([len(x) for x in lists], dtype=np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(codec.decode(ids, offsets), pa.string())],
                    names=[*some.schema.names, text_name])

    return rows.mapInArrow(batches, T.StructType([*rows.schema.fields, field]))
