"""Byte-pair encoding and decoding by tree concatenation.

Texts are encoded with a byte-level BPE vocabulary file of the ``tokenizers``
library. A text longer than ``leaf_chars`` is cut into leaves that separate
tasks encode. Cuts fall between pre-tokens wherever there is such a place; in
text that the pre-tokenizer does not split, the cut falls inside one pre-token
and the two sides are joined: the last tokens of the left and the first tokens
of the right side are decoded, their bytes are encoded again, and the window
grows until its first and its last token agree with both sides. BPE output is
determined pair by pair (a sequence is the encoding of its bytes if and only if
each adjacent pair is the encoding of that pair's bytes), so one agreeing token
at each end makes the joined sequence the exact encoding. Joins run as a tree
over the leaves of a text. Inside a leaf, unsplit pieces of more than
``PIECE`` bytes are halved and joined in the same way.

Cases: a null or empty text has no tokens (hash of the empty string); rows are
independent, so repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEAF_CHARS = 32768
PIECE = 1024
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
# Fixed value: the pre-tokenizer pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable
    bytes stand for themselves, the others follow from code point 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str) -> None:
        import re

        import regex
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.bpe = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = special
        self.names = [str(i) for i in range(self.bpe.max_token_value + 1)]
        self.pretoken = regex.compile(PATTERN)
        self.unsplit = re.compile(rf"\S{{{PIECE}}}|\s{{{PIECE}}}")
        self.splitter = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    # --- one unsplit piece ---------------------------------------------------
    def piece(self, data: bytes) -> list[int]:
        """Tokens of one pre-token's bytes: halves, then a join."""
        if len(data) <= PIECE:
            return self.bpe._encode_single_piece(data)
        half = len(data) // 2
        return self.join(self.piece(data[:half]), self.piece(data[half:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of two encoded byte strings put together: re-encode a window
        around the join that grows until both sides agree."""
        k = 4
        while True:
            a, b = min(k, len(left)), min(k, len(right))
            tokens = self.bpe._encode_single_piece(self.bpe.decode_bytes(left[len(left) - a:] + right[:b]))
            start = a == len(left) or tokens[0] == left[len(left) - a]
            end = b == len(right) or tokens[-1] == right[b - 1]
            if start and end:
                return left[:len(left) - a] + tokens + right[b:]
            k *= 2

    # --- texts ---------------------------------------------------------------
    def encode(self, text: str) -> list[int]:
        if not self.unsplit.search(text):
            return self.bpe.encode(text, allowed_special="all")
        out: list[int] = []
        for part in self.splitter.split(text) if self.splitter else [text]:
            if part in self.special:
                out.append(self.special[part])
                continue
            for m in self.pretoken.finditer(part):
                out += self.piece(m.group().encode())
        return out

    def decode(self, ids: list[int]) -> bytes:
        return self.bpe.decode_bytes(ids)

    def digest(self, ids: list[int]) -> tuple[int, str, str]:
        names = self.names
        return (len(ids), hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest(),
                hashlib.sha256(self.decode(ids).decode("utf-8", "replace").encode()).hexdigest())

    # --- leaves --------------------------------------------------------------
    @staticmethod
    def kind(c: str) -> int:
        import unicodedata

        if c.isspace() and c not in "\x1c\x1d\x1e\x1f":
            return 0
        return {"L": 1, "N": 2}.get(unicodedata.category(c)[0], 3)

    def leaves(self, text: str, size: int) -> list[tuple[str, bool]]:
        """Cut a text into leaves of about ``size`` characters; the flag says
        that the cut before the leaf lies inside one pre-token."""
        out, at, glued = [], 0, False
        while len(text) - at > size:
            cut, inside = self.cut(text, at, at + size)
            out.append((text[at:cut], glued))
            at, glued = cut, inside
        out.append((text[at:], glued))
        return out

    def cut(self, text: str, low: int, at: int) -> tuple[int, bool]:
        """A cut in (low, at]: the last place that surely lies between two
        pre-tokens, or else one well inside a run of one kind."""
        for p in range(at, max(low + (at - low) // 2, low + 8), -1):
            before, after = text[p - 1], text[p]
            if before.isspace() or (before == "'" and not after.isspace()) or self.kind(before) == self.kind(after):
                continue
            if not self.in_special(text, p):
                return p, False
        # all of one kind, or quotes and blanks only: far from the run's ends
        for p in range(at, low + 8, -1):
            kinds = {self.kind(c) for c in text[p - 4:p + 3]}
            if len(kinds) == 1 and "'" not in text[p - 4:p + 3] and len(text) - p > 3 and not self.in_special(text, p):
                return p, True
        return len(text), False  # no place to cut: one leaf

    def in_special(self, text: str, p: int) -> bool:
        return any(text.find(s, max(0, p - len(s) + 1), p + len(s) - 1) >= 0 for s in self.special)

    def leaf(self, text: str, glued_left: bool, glued_right: bool) -> tuple[list[int], int, int]:
        """Tokens of a leaf, and how many of them make its first and its last
        pre-token where those are cut (0 where they are whole)."""
        ids = self.encode(text)
        head = self.count(ids, len(self.pretoken.match(text).group().encode())) if glued_left else 0
        tail = 0
        if glued_right:
            # the run that reaches the end, as the pre-tokenizer sees it
            start = len(text) - 1
            while start > 0 and self.kind(text[start - 1]) == self.kind(text[-1]):
                start -= 1
            last = list(self.pretoken.finditer(text, max(0, start - 4)))[-1].group()
            tail = self.count(ids[::-1], len(last.encode()))
        return ids, head, tail

    def count(self, ids: list[int], size: int) -> int:
        """How many of the first tokens make ``size`` bytes."""
        n = total = 0
        while total < size:
            total += len(self.bpe.decode_single_token_bytes(ids[n]))
            n += 1
        return n

    def tree(self, nodes: list[tuple[list[int], int, int, bool]]) -> list[int]:
        """Join the leaves of a text pairwise until one sequence is left.
        Nodes are (tokens, head, tail, glued to the one before)."""
        while len(nodes) > 1:
            nodes = [self.pair(*nodes[i:i + 2]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
        return nodes[0][0] if nodes else []

    def pair(self, left, right):
        (a, a_head, a_tail, glued), (b, b_head, b_tail, joins) = left, right
        if not joins:
            return a + b, a_head, b_tail, glued
        middle = self.join(a[len(a) - a_tail:], b[:b_head])
        # a side that is one cut piece passes the other side's share on
        head = len(middle) if a_head and a_tail == len(a) else a_head
        tail = len(middle) if b_tail and b_head == len(b) else b_tail
        return a[:len(a) - a_tail] + middle + b[b_head:], head, tail, glued


def codec(path: str) -> Codec:
    """The codec of a vocabulary file, made once in each Python worker."""
    import sys

    made = sys.modules.setdefault("_vigil_codecs", type(sys)("_vigil_codecs")).__dict__
    if path not in made:
        made[path] = Codec(path)
    return made[path]


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                  leaf_chars: int = LEAF_CHARS, with_ids: bool = False) -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256 and decoded_sha256, and
    with ``with_ids`` also ``ids`` and ``decoded``.

    ``vocabulary`` must be readable at the same path on every executor. Texts
    up to ``leaf_chars`` are encoded where they are read; longer ones are cut,
    their leaves are dealt to all tasks, and only their tokens meet again."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = SCHEMA + (", ids array<int>, decoded string" if with_ids else "")
    size = F.char_length("text")

    def result(ids_of):
        """Rows of (doc_id, tokens) as a record batch."""
        c = codec(vocabulary)
        out = [(d, *c.digest(ids), *((ids, c.decode(ids).decode("utf-8", "replace")) if with_ids else ())) for d, ids in ids_of]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), *([pa.list_(pa.int32()), pa.string()] if with_ids else [])]
        names = [x.split()[0] for x in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)

    def short(batches):
        c = codec(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                yield result((d, c.encode(t)) for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()))

    def cut(batches):
        c = codec(vocabulary)
        for batch in batches:
            for i in range(batch.num_rows):
                row, d, text = batch.slice(i, 1).to_pylist()[0].values()
                pieces = c.leaves(text, leaf_chars)
                glued = [g for _, g in pieces] + [False]
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array([row] * len(pieces), pa.int64()), "doc_id": pa.array([d] * len(pieces), pa.int64()),
                    "leaf": pa.array(range(len(pieces)), pa.int32()), "text": pa.array([p for p, _ in pieces], pa.string()),
                    "glued": pa.array(glued[:-1], pa.bool_()), "glues": pa.array(glued[1:], pa.bool_())})

    def encode_leaves(batches):
        c = codec(vocabulary)
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                ids, head, tail = c.leaf(r["text"], r["glued"], r["glues"])
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array([r["row"]], pa.int64()), "doc_id": pa.array([r["doc_id"]], pa.int64()),
                    "leaf": pa.array([r["leaf"]], pa.int32()), "ids": pa.array([ids], pa.list_(pa.int32())),
                    "head": pa.array([head], pa.int32()), "tail": pa.array([tail], pa.int32()), "glued": pa.array([r["glued"]], pa.bool_())})

    def join_leaves(batches):
        c = codec(vocabulary)
        for batch in batches:
            for i in range(batch.num_rows):  # Python lists of one text's tokens at a time
                r = batch.slice(i, 1).to_pylist()[0]
                nodes = [(x["ids"], x["head"], x["tail"], x["glued"]) for x in r["leaves"]]
                yield result([(r["doc_id"], c.tree(nodes))])

    whole = rows.where(size <= leaf_chars).mapInArrow(short, schema)
    # the key of a long text: its place in the scan, which a repeated task gives again
    long = rows.where(size > leaf_chars).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    leaves = (long.mapInArrow(cut, "row long, doc_id long, leaf int, text string, glued boolean, glues boolean")
              .repartition("row", "leaf")
              .mapInArrow(encode_leaves, "row long, doc_id long, leaf int, ids array<int>, head int, tail int, glued boolean"))
    joined = (leaves.groupBy("row", "doc_id")  # one group is one text
              .agg(F.sort_array(F.collect_list(F.struct("leaf", "ids", "head", "tail", "glued"))).alias("leaves"))
              .mapInArrow(join_leaves, schema))
    return whole.unionByName(joined)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: token count and digests."""
    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary_path())


QUERIES = {"op7_bpe_tree": op7_bpe_tree}
ORACLE: dict[str, str] = {}
