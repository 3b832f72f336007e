"""SentencePiece codec and token counts against the libraries and brute force."""

import itertools

import numpy as np
import pytest
from samples import EXTRA, LONG, ROWS, documents

from shroud.llm import catalog
from shroud.llm.sentencepiece_codec import Codec, Vocabulary, decode_documents, encode_documents
from shroud.llm.token_counts import PieceCounter, token_counts

MODEL = catalog.tokenizer_file("piece_bpe_32k.model")
BPE = catalog.tokenizer_file("byte_bpe_50k.json")
ODD = ["", " ", "   x  y   ", "a\nb\r\n\tc", "日本語のテキスト、長い文。" * 20, "a" * 300, "ab" * 120 + "  x",
       "\x00\x01 x", "🙂🙃 ok", "http://" + "q1w2e3" * 40, "don't we'll 12³ ½ ٠١", "x\x1cy\x85z\xa0 q",
       "naïve ÅÉ ǅ ɏɐ", "<s> </s> <unk> <0x41>", "'s 't '", "!'s", "a<|endoftext|>b <|endoftext|> c"]


def sample_texts(spark, sf="sf0.001", n=200):
    rows = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").orderBy("doc_id").limit(n).collect()
    return [r.text for r in rows]


def test_bpe_ids_are_the_librarys(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    codec = Codec(Vocabulary.load(MODEL), table_words=500)
    texts = [*ODD, LONG, *sample_texts(spark)]
    for lo in range(0, len(texts), 40):
        some = texts[lo:lo + 40]
        ids, at = codec.encode(some)
        for i, t in enumerate(some):
            assert ids[at[i]:at[i + 1]].tolist() == library.encode(t), t[:50]
        assert codec.decode(ids, at) == some


def random_bpe(rng, letters="abcd", pieces=40, falling=True):
    """A vocabulary grown by joining pieces at random; scores fall with age, or are shuffled."""
    names = ["<unk>", *letters]
    while len(names) < pieces:
        joined = names[rng.integers(1, len(names))] + names[rng.integers(1, len(names))]
        if joined not in names and len(joined) <= 9:
            names.append(joined)
    scores = [-float(i) for i in range(len(names))]
    if not falling:
        scores = [0.0, *rng.permutation(scores[1:]).tolist()]
    return Vocabulary(names, scores, False, [p != "<unk>" for p in names], {}, 0)


@pytest.mark.parametrize("falling", [True, False])
def test_stable_pairs_give_the_merges(falling):
    rng = np.random.default_rng(8)
    by_borders = 0
    for _ in range(25):
        vocabulary = random_bpe(rng, falling=falling)
        by_borders += vocabulary.by_borders
        words = ["".join(rng.choice(list("abcdx"), size=rng.integers(1, 30))) for _ in range(150)]
        got = vocabulary.encode_words(words)
        want = [vocabulary._emit(w, *vocabulary.merge_long(w)) for w in words]
        assert got[1].tolist() == [len(x) for x in want]
        assert got[0].tolist() == [i for x in want for i in x]
    assert by_borders > 0 if falling else by_borders < 25


def test_the_public_model_goes_through_the_lattice_path(spark, monkeypatch):
    import sentencepiece

    vocabulary = Vocabulary.load(MODEL)
    assert vocabulary.by_borders
    monkeypatch.setattr(Vocabulary, "merges", None)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    words = sorted({w for t in sample_texts(spark, "sf0.01", 2000) for w in (t or "").split()})
    codec = Codec(vocabulary)
    ids, at = codec.encode(words)
    assert [ids[a:b].tolist() for a, b in itertools.pairwise(at.tolist())] == library.encode(words)


def test_pair_slots_may_collide(monkeypatch):
    from shroud.llm import sentencepiece_codec

    monkeypatch.setattr(sentencepiece_codec, "PAIR_SLOTS", 3)
    test_stable_pairs_give_the_merges(True)


def test_space_mark_in_a_text_becomes_a_space():
    codec = Codec(Vocabulary.load(MODEL))
    assert codec.decode(*codec.encode(["a▁b"])) == ["a b"]


def brute_best(word, scores, floor):
    """Best sum over all segmentations."""
    best = -np.inf
    for cut in itertools.product((0, 1), repeat=len(word) - 1):
        places = [0, *[i + 1 for i, c in enumerate(cut) if c], len(word)]
        total = 0.0
        for a, b in itertools.pairwise(places):
            piece = word[a:b]
            if piece not in scores and b - a > 1:
                total = -np.inf
                break
            total += scores.get(piece, floor)
        best = max(best, total)
    return best


def test_viterbi_finds_the_best_sum():
    rng = np.random.default_rng(3)
    scores = {"<unk>": 0.0}
    for n in (1, 2, 3, 4):
        for letters in itertools.product("▁abc", repeat=n):
            piece = "".join(letters)
            if "▁" not in piece[1:] and rng.random() < (1.0 if n == 1 and piece != "c" else 0.4):
                scores[piece] = float(rng.normal(-5, 3))
    names = list(scores)
    vocabulary = Vocabulary(names, [scores[p] for p in names], True, [p != "<unk>" for p in names], {}, 0)
    pieces = {p: s for p, s in scores.items() if p != "<unk>"}
    words = ["".join(rng.choice(list("abc"), size=rng.integers(1, 8))) for _ in range(60)]
    ids, count = vocabulary.encode_words(words)
    start = 0
    for word, n in zip(words, count.tolist(), strict=True):
        got = ids[start:start + n].tolist()
        start += n
        total = sum(vocabulary.floor if i == 0 else scores[names[i]] for i in got)
        assert total == pytest.approx(brute_best(word, pieces, vocabulary.floor)), word


def test_documents_round_trip_and_keep_their_columns(spark):
    docs = documents(spark)
    coded = encode_documents(docs, MODEL)
    assert coded.columns[:-1] == docs.columns and coded.columns[-1] == "_token_ids"
    back = decode_documents(coded, MODEL, "_token_ids", "decoded").collect()
    assert len(back) == len(ROWS)
    for r in back:
        assert r["_decoded"] == (r.text or "")
        assert all(r[n] == f"x{j}" for j, n in enumerate(EXTRA))
    assert encode_documents(documents(spark, []), MODEL).count() == 0


def test_op1_query(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in catalog.op1_sentencepiece(spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.doc_id].token_ids == library.encode(r.text)
        assert got[r.doc_id].n_tokens == len(got[r.doc_id].token_ids) and got[r.doc_id].round_trip


def test_token_counts_are_the_librarys(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    counter = PieceCounter(BPE, table_rows=300)
    for t in [*ODD, LONG, *sample_texts(spark)]:
        assert counter.count(t) == len(library.encode(t, add_special_tokens=False).ids), t[:50]


def test_latin_classes_agree_with_the_library():
    counter = PieceCounter(BPE)
    split = counter.tokenizer.pre_tokenizer.pre_tokenize_str
    for i in range(0x250):
        for text in (f"a{chr(i)}1 {chr(i)} {chr(i)}b", f"{chr(i)}{chr(i)}'s"):
            want = [text[a:b] for _, (a, b) in split(text)]
            assert counter.find(text) == want, hex(i)


def test_token_count_rows(spark):
    got = token_counts(documents(spark), BPE, limit=3).collect()
    assert len(got) == len(ROWS)
    by = sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got)
    assert (True, 2, 0, 0, False) in by and (True, 3, 0, 0, False) in by
    assert sum(x[1] == 1 for x in by) == 2 and all(x[4] == (x[3] > 3) for x in by)
    assert (True, 5, len(ROWS[7][1].encode())) == next(x[:3] for x in by if x[1] == 5)
    assert token_counts(documents(spark, []), BPE).count() == 0


def test_op2_query(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    got = {r.doc_id: r for r in catalog.op2_token_counts(spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        n = len(library.encode(r.text, add_special_tokens=False).ids)
        assert (got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (n, n > 512)
        assert got[r.doc_id].n_bytes == len(r.text.encode())
