import hashlib
import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from conftest import rows
from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def by_tree(text, size):
    tool = bpe.codec(PATH)
    out = []
    for part in tool.parts(text) or [""]:
        leaves = [np.frombuffer(tool.encode(part[i : i + size]), dtype="<u4") for i in range(0, max(1, len(part)), size)]
        out += tool.concatenate(part, leaves, size).tolist()
    return out


PIECES = st.sampled_from(
    ["a", "the ", " ", "  ", "\n", "\n\n ", "'s", "'re", "'", "''", "!", "?!", "1", "2024", "é", "日本語", "🙂", "᠎ ", "\x1c ",
     "internationalization", "xqzj", "<|endoftext|>", "<|endof", "aaaaaaaa", "    ", "\t", "ß", "́", "\xa0 "]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=120), st.sampled_from([5, 17, 40, 64]))
def test_tree_equals_whole_encoding(pieces, size):
    text = "".join(pieces)
    assert by_tree(text, size) == plain(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(PIECES, st.integers(1, 300)), min_size=1, max_size=6), st.sampled_from([33, 128, 500]))
def test_tree_equals_whole_encoding_of_repeats(pieces, size):
    text = "".join(piece * n for piece, n in pieces)
    assert by_tree(text, size) == plain(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_words_equal_whole_encoding(text):
    assert np.frombuffer(bpe.codec(PATH).encode(text), dtype="<u4").tolist() == plain(text)


def test_long_unsplit_letters():
    rng = random.Random(1)
    for letters in ("ab", "abcdefghijklmnopqrstuvwxyz", "01", " ", "éñ"):
        text = "".join(rng.choice(letters) for _ in range(5000))
        assert by_tree(text, 256) == plain(text)


def test_documents(spark):
    rng = random.Random(2)
    texts = ["", None, "one", "x" * 3000, " ".join(rng.choice(["the", "Größe", "a,b", "12"]) for _ in range(2000)), "a<|endoftext|>" * 500, "<|endoftext|>"]
    docs = [*enumerate(texts), (3, texts[3]), (None, texts[4]), (None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS ids", "'p' AS part")
    found = rows(bpe.token_digest(bpe.decode(bpe.encode(df, PATH, leaf=512), PATH)))
    expected = []
    for doc_id, text in docs:
        ids = plain(text)
        assert PLAIN.decode(ids, skip_special_tokens=False) == (text or "")
        digest = [hashlib.sha256(b).hexdigest() for b in (np.array(ids, dtype="<u4").tobytes(), (text or "").encode())]
        expected.append((doc_id, len(ids), *digest))
    assert found == sorted(expected, key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(df, PATH), PATH).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" a", "  ", " ", "\xa0", "  b", " é", " 'll", " 12", " !", "\n x", "\t y", "\x1c z", " <|endoftext|>", "日 本", " ̈a", "᠎ c"]), max_size=40))
def test_words_encoded_apart_equal_whole_encoding(pieces):
    text = "".join(pieces)
    tool = bpe.codec(PATH)
    assert tool.by_words and np.frombuffer(tool.encode(text), dtype="<u4").tolist() == plain(text)


def test_words_are_merged_once_and_memory_is_bounded(monkeypatch):
    tool = bpe.Codec(PATH)
    sent, inner = [], tool.tokenizer

    class Counting:
        def encode_batch_fast(self, texts, **more):
            sent.extend(texts)
            return inner.encode_batch_fast(texts, **more)

    tool.tokenizer = Counting()
    monkeypatch.setattr(bpe, "KNOWN", 50)
    text = "some words " * 1000 + "x" * 500
    for _ in range(3):
        assert np.frombuffer(tool.encode(text), dtype="<u4").tolist() == plain(text)
    # The text is 11,500 characters; its few words reach the merges once, the long one is not kept.
    assert sum(map(len, sent)) < 2500 and max(map(len, tool.known)) <= bpe.LONGEST
    for i in range(40):
        many = " ".join(f"w{i}n{j}" for j in range(20))
        assert np.frombuffer(tool.encode(many), dtype="<u4").tolist() == plain(many)
    assert len(tool.known) <= 50 + 21
