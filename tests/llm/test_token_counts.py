import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from almanac.llm import token_counts


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(token_counts.TOKENIZER))


def whole(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


PARTS = ["word ", "  ", "\n\n", " ", "é", "日本語", "<|endoftext|>", "x" * 40, "it's", "123", "\t \t", "\x1c", "\x85 ", " ", "😀", "! "]


def test_huge_texts(tokenizer):
    rng = random.Random(9)
    for _ in range(400):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 80)))
        chunk, overlap = rng.choice([(16, 4), (30, 9), (64, 8)])
        assert token_counts.count_huge(tokenizer, text, chunk, overlap) == whole(tokenizer, text), repr(text)


def test_no_stable_place(tokenizer):
    for text in ["a" * 3000, " " * 3000, "日本" * 1500, "a" * 500 + " " + "b" * 900 + " c"]:
        assert token_counts.count_huge(tokenizer, text, 64, 8) == whole(tokenizer, text)


def test_long_chunks(tokenizer):
    rng = random.Random(10)
    text = " ".join("".join(rng.choice("abcdeté") for _ in range(rng.randrange(1, 12))) for _ in range(60000))
    assert token_counts.count_huge(tokenizer, text) == whole(tokenizer, text)


def test_spark(spark, docs_of, tokenizer):
    texts = [None, "", "hello world", "<|endoftext|>", "é" * 10, "two words " * 20000]
    docs = docs_of(*texts, (None, "x"), (1, "again")).selectExpr("*", "1 as n_tokens", "2 as n_bytes")
    got = sorted(tuple(map(str, r)) for r in token_counts.count_tokens(docs).collect())
    rows = [*enumerate(texts), (None, "x"), (1, "again")]
    want = [(i, len((t or "").encode()), whole(tokenizer, t), whole(tokenizer, t) > 1024) for i, t in rows]
    assert got == sorted(tuple(map(str, w)) for w in want)
    assert token_counts.count_tokens(docs_of()).count() == 0
