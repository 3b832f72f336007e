"""Token counts of whole texts under a byte-level BPE tokenizer.

A text's tokens are the pieces of its pre-tokens, so a pre-token is encoded
once and its count is joined to the documents' pre-token frequencies; token
ids are never built for a text.  Each task does this for the rows it reads:
it finds the pre-tokens of every document, encodes those that its count table
doesn't hold yet, and sums frequency times count.  The count table has
``TABLE_ROWS`` rows at most and starts anew when it is full (entries are only
computed again), so memory is bounded and nothing is shuffled.

Pre-tokens are found by the published pattern of byte-level BPE.  Outside the
Latin blocks, where Unicode versions differ, a text is split by the tokenizer
library itself.  A special token's string in a text counts as that one token
(the library's default).

NULL and empty texts have no tokens; repeated rows give repeated rows.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.llm.common import whole_text

LIMIT = 512
TABLE_ROWS = 200_000
_LATIN_END = 0x250
_BEYOND_LATIN = re.compile(f"[^\\x00-{chr(_LATIN_END - 1)}]")


def _latin_class(major: str) -> str:
    """The characters below U+0250 of one major Unicode category, as the inside of a class."""
    return "".join(re.escape(chr(i)) for i in range(_LATIN_END) if unicodedata.category(chr(i))[0] == major)


def _pretoken_pattern() -> re.Pattern:
    """The pattern of byte-level BPE, with the classes spelt out for the Latin blocks."""
    letter, number, space = _latin_class("L"), _latin_class("N"), "\t-\r \x85\xa0"
    return re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
                      rf"|[{space}]+(?![^{space}])|[{space}]+")


def _byte_letters() -> list[str]:
    """The character that byte-level BPE writes for each byte: itself where it prints, else from U+0100 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return [chr(b) if b in prints else chr(256 + others.index(b)) for b in range(256)]


class PieceCounter:
    """Counts the pieces of texts with one tokenizer file."""

    def __init__(self, tokenizer_file: str, table_rows: int = TABLE_ROWS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        before = json.loads(self.tokenizer.to_str())["pre_tokenizer"]
        if before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"]:
            raise ValueError("only byte-level tokenizers with the usual pattern are supported")
        self.find = _pretoken_pattern().findall
        self.letters = dict(enumerate(_byte_letters()))
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special]
        special.sort(key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.table: dict[str, int] = {}
        self.table_rows = table_rows

    def pretokens(self, text: str) -> tuple[Counter, int]:
        """(pre-token frequencies, special tokens) of a text."""
        parts, found = [text], 0
        if self.special is not None:
            parts = self.special.split(text)
            found = len(parts) - 1
        freq: Counter = Counter()
        for part in parts:
            if _BEYOND_LATIN.search(part):
                freq.update(part[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part))
            else:
                freq.update(self.find(part))
        return freq, found

    def learn(self, pretokens) -> None:
        """Count the pieces of the pre-tokens that the table doesn't hold."""
        missing = [p for p in pretokens if p not in self.table]
        if len(self.table) + len(missing) > self.table_rows:
            self.table.clear()
            missing = list(pretokens)
        pieces = self.tokenizer.model.tokenize
        for p in missing:
            self.table[p] = len(pieces(p.encode().decode("latin-1").translate(self.letters)))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        freq, found = self.pretokens(text)
        if not freq.keys() <= self.table.keys():
            self.learn(freq)
        table = self.table
        return found + sum(n * table[p] for p, n in freq.items())


def token_counts(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row for each document: (doc_id, n_bytes, n_tokens, over_limit)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(tokenizer_file)
        for part in parts:
            n = np.fromiter((counter.count(t.as_py()) for t in part.column("text")), np.int64, part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("n_bytes"), pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(batches, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
