"""Token counts, encoding and decoding against the tokenizers library."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sheafspark.llm import bpe, queries
from sheafspark.llm.arrow_text import row_slices, white_space_blocks
from sheafspark.llm.bpe import MergeTable, WordBpe, encode_decode
from sheafspark.llm.token_counts import LengthEncoder, drops_white_space, token_counts

PATH = queries.WORD_BPE
LIBRARY = Tokenizer.from_file(PATH)
BPE, LENGTHS = WordBpe(PATH), LengthEncoder(PATH)
SPECIAL = st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|endoftext", "'s", "'LL", "ΣΑΣ", "İ", "é", " ", " ", "😀"])
TEXTS = st.lists(st.one_of(SPECIAL, st.text(max_size=12), st.sampled_from([" ", "\n", "the ", "9a"])), max_size=12).map("".join)


def whole(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=6))
def test_tokens_are_the_librarys(texts):
    ids, sizes = BPE.encode([t.encode() for t in texts])
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [whole(t) for t in texts]
    assert LENGTHS.lengths(pa.array(texts)).to_pylist() == [len(whole(t)) for t in texts]


def test_all_characters():
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000][::37]
    texts = [f"a{c}b {c}1{c}{c}" for c in points]
    ids, sizes = BPE.encode([t.encode() for t in texts])
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [whole(t) for t in texts]


def test_kept_words_start_over(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 20)
    coder = WordBpe(PATH)
    for n in range(5):
        texts = [f"the w{n}x{i} of word {i}" for i in range(30)]
        for batch in (texts, [texts[3], "the", f"zebra{n} the 'S", ""], [" ".join(reversed(texts)) + f" new{n}"]):
            ids, sizes = coder.encode([t.encode() for t in batch])
            assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [whole(t) for t in batch]


def test_more_words_than_a_task_keeps(documents):
    words = [f"w{i:x}" for i in range(bpe.KEPT_WORDS + 40_000)]
    texts = [" ".join(words[i : i + 20_000]) for i in range(0, len(words), 10_000)]
    for r in encode_decode(documents(texts).coalesce(1), PATH).collect():
        assert r.ids == whole(r.text) and r.decoded == LIBRARY.decode(r.ids, skip_special_tokens=False)


def test_merge_rounds_equal_single_merges():
    vocab = {s: i for i, s in enumerate(["a", "b", "c", "aa", "ab", "bc", "aab", "abc", "aaaa"])}
    merges = [["a", "a"], ["b", "c"], ["a", "b"], ["aa", "b"], ["a", "bc"], ["aa", "aa"]]
    table, random = MergeTable(vocab, merges), np.random.default_rng(3)
    words = ["".join(random.choice(list("abc"), random.integers(1, 12))) for _ in range(300)]

    def slow(word):
        parts = list(word)
        while True:
            ranks = [(merges.index([x, y]), i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if [x, y] in merges]
            if not ranks:
                return [vocab[p] for p in parts]
            _, i = min(ranks)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    symbols = np.array([vocab[c] for w in words for c in w])
    tokens, sizes = table.merge(symbols, np.array(list(map(len, words))))
    assert [x.tolist() for x in np.split(tokens, np.cumsum(sizes)[:-1])] == [slow(w) for w in words]


def test_long_texts_are_cut_at_white_space_only():
    text = b" ".join(b"w%d" % i for i in range(5000)) + b"\n" + b"z" * 5000
    blocks = list(white_space_blocks(text, 1000))
    assert b"".join(blocks) == text and len(blocks) > 20
    assert [w for b in blocks for w in b.split()] == text.split()
    column = pa.array([b"abc", b"", b"d" * 30, b"e"], pa.binary())
    assert list(row_slices(column, 4)) == [(0, 2), (2, 3), (3, 4)]


def test_which_tokenizers_drop_white_space():
    assert drops_white_space(PATH)
    assert not drops_white_space(f"{queries.TOKENIZERS}/byte_bpe_50k.json")
    assert not drops_white_space(f"{queries.TOKENIZERS}/piece_bpe_32k.model")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_encode_whole_texts(name):
    path = f"{queries.TOKENIZERS}/{name}"
    texts = ["Two  words\n", "", "a  b c" * 50, "É 東京"]
    if name.endswith(".json"):
        want = [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) for t in texts]
    else:
        import sentencepiece

        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    assert LengthEncoder(path, batch_bytes=10).lengths(pa.array(texts)).to_pylist() == want


def test_odd_rows(odd_documents, no_documents):
    rows = token_counts(encode_decode(odd_documents, PATH), PATH).collect()
    assert len(rows) == odd_documents.count() and {"score", "row", "n_tokens", "ids", "decoded"} <= set(rows[0].asDict())
    for r in rows:
        text = r.text or ""
        assert r.ids == whole(text) and r.n_tokens == len(r.ids) and r.n_bytes == len(text.encode())
        assert r.over_limit == (r.n_tokens > 2048)
        assert r.decoded == LIBRARY.decode(r.ids, skip_special_tokens=False)
    assert token_counts(no_documents, PATH).collect() == [] and encode_decode(no_documents, PATH).collect() == []


def test_queries_against_the_library(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    counted = {r.doc_id: r for r in queries.op7_token_counts(spark, sf_dir).collect()}
    coded = queries.op9_bpe(spark, sf_dir).collect()
    assert len(docs) == len(counted) == len(coded)
    for r in coded:
        ids = whole(docs[r.doc_id])
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids) == counted[r.doc_id].n_tokens
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
