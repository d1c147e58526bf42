"""Token counts against the tokenizers library on whole texts."""

import random
import time

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vigil.llm import token_counts as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def expect(lib, text):
    return len(lib.encode(text or "", add_special_tokens=False).ids)


def texts(seed):
    r = random.Random(seed)
    alphabets = ["ab", "abc de ", "é ü\n", " \t\n\r", "0123 ", "'s'll'd ", "<|endoftext|>", "a <|endoftext|> b", "漢字かな。、", "!?#%", "x1-",
                 "a\x0b\x0c\x85\xa0  b", "\x1c\x1d !", "😀👍🏽 ", "٣٤ ab", "​᠎ a", "'", "ꟊꟋ a"]
    out = ["", " ", "\n\n", "a ", " a", "\xa0 \xa0a", "don't  stop\t\tit's", "  <|endoftext|>  ", "<|endoftext|>" * 90]
    for _ in range(150):
        pool = "".join(r.sample(alphabets, r.randint(1, 4)))
        out.append("".join(r.choice(pool) * r.choice([1, 1, 1, 2, 9]) for _ in range(r.randint(1, 120))))
    return out


@pytest.mark.parametrize("part", [2, 5, 1024])
def test_parts_are_safe(lib, part, monkeypatch):
    monkeypatch.setattr(T, "PART", part)
    counter = T.TokenCounter(PATH)
    assert counter.cuts
    given = texts(part)
    for t in given:
        assert "".join(counter.parts(t)) == t
        assert "".join(counter.pieces(t, 30)) == t
        assert sum(counter.counts(list(counter.pieces(t, 30)))) == expect(lib, t), t
    assert counter.counts(given) == [expect(lib, t) for t in given]


def test_rows(spark, lib):
    given = [*texts(7), None, "same words", "same words", "one two three " * 4000, "漢字、かな。" * 3000, "x" * 30000]
    df = spark.createDataFrame([(i if i else None, t, 9, "p") for i, t in enumerate(given)], "doc_id long, text string, n_tokens int, piece string")
    for long_bytes in (1 << 20, 200):
        got = {r["doc_id"]: tuple(r)[1:] for r in T.token_counts(df, PATH, 100, long_bytes).collect()}
        want = {(i if i else None): (len((t or "").encode()), expect(lib, t), expect(lib, t) > 100) for i, t in enumerate(given)}
        assert got == want


def test_other_pretokenizers_are_not_cut():
    counter = T.TokenCounter(public_tokenizers.path("word_bpe_49k.json"))
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert not counter.cuts
    given = ["Some Words, here", "", "a  b<|endoftext|>c"]
    assert counter.counts(given) == [len(lib.encode(t, add_special_tokens=False).ids) for t in given]


def test_long_run_without_blanks(lib):
    counter = T.TokenCounter(PATH)
    began = time.time()
    assert counter.counts(["ab1," * 100_000]) == [expect(lib, "ab1," * 1000) * 100]
    assert counter.counts(["a" * 200_000]) == [expect(lib, "a" * 200_000)]
    assert time.time() - began < 30


def test_kept_lengths_stay_bounded(lib, monkeypatch):
    monkeypatch.setattr(T, "KEPT", 50)
    counter = T.TokenCounter(PATH)
    for i in range(20):
        given = [f"w{i}x{j} and " + "y" * 80 for j in range(30)]
        assert counter.counts(given) == [expect(lib, t) for t in given]
        assert len(counter.known) <= 50 + 62 and max(map(len, counter.known)) <= 64


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert T.token_counts(df, PATH).collect() == []
