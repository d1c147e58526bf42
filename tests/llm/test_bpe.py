"""Tree-concatenated BPE against the tokenizers library."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from vigil.llm import bpe

PATH = bpe.vocabulary_path()


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def nasty_texts(seed=1):
    r = random.Random(seed)
    alphabets = ["ab", "abcdefgh ", "é ü\n", " \t\n", "0123456789", "'s'll'd", "<|endoftext|>", "a<|endoftext|>b ", "漢字かな", "!?#%", "x1-", "   a", "😀👍🏽"]
    out = ["", " ", "  ", "\n\t ", "'s", "a" * 5000, " " * 4000 + "b", "\t\n" * 3000 + "x", "ab" * 4000 + "'ll " + "9" * 3000]
    for _ in range(60):
        pool = "".join(r.sample(alphabets, r.randint(1, 3)))
        out.append("".join(r.choice(pool) * r.choice([1, 1, 1, 7, 300]) for _ in range(r.randint(1, 200))))
    out.append("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9000)))
    return out


def expect(lib, text):
    ids = lib.encode(text or "", add_special_tokens=False).ids
    back = lib.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_encode_matches_library(lib):
    c = bpe.Codec(PATH)
    for t in nasty_texts():
        assert c.encode(t) == lib.encode(t, add_special_tokens=False).ids, t[:80]


@pytest.mark.parametrize("size", [16, 50, 333])
def test_leaves_and_tree_match_library(lib, size):
    c = bpe.Codec(PATH)
    for t in nasty_texts(size):
        pieces = c.leaves(t, size)
        assert "".join(p for p, _ in pieces) == t
        glued = [g for _, g in pieces] + [False]
        nodes = [(*c.leaf(p, glued[i], glued[i + 1]), glued[i]) for i, (p, _) in enumerate(pieces)]
        assert c.tree(nodes) == lib.encode(t, add_special_tokens=False).ids, (size, t[:80])


def test_query_rows(spark, lib):
    texts = nasty_texts(3) + [None, "same", "same"]
    df = spark.createDataFrame([(i if i else None, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    got = {r["doc_id"]: tuple(r)[1:4] for r in bpe.encode_decode(df, PATH, leaf_chars=256).collect()}
    assert got == {(i if i else None): expect(lib, t) for i, t in enumerate(texts)}
    one = bpe.encode_decode(df.where("doc_id = 1"), PATH, with_ids=True).first()
    assert one["decoded"] == texts[1]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_decode(df, PATH).collect() == []
