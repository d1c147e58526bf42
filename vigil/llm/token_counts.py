"""Token counts of whole texts, as a ``tokenizers`` file gives them.

Arrow functions encode in batches and keep lengths only. Texts are cut at safe
boundaries, where the tokens of both sides are those of the whole: with the
byte-level pre-tokenizer a blank belongs to what follows it, so a cut after a
non-blank and before a space, tab or line break never lies inside a pre-token,
and no special string holds a blank. The parts of a text are mostly words that
were met before: each distinct part of a batch of texts is encoded once, in
batches of at most ``BATCH`` bytes, and a text's count is the sum over its
parts. A part of more than ``PART`` characters (text without blanks) is cut
further where a letter, a number or another sign meets one of another kind.

Texts over ``long_bytes`` are cut into pieces at such boundaries, the pieces
are dealt to all tasks, and their counts are summed; shorter ones are counted
where they are read.

Cases: a null or empty text has 0 tokens; rows are independent, so repeated
rows are counted each; a run of one kind of character without blanks, however
long, is one pre-token and is encoded as a whole, in memory that grows with the
run; a file with another pre-tokenizer, with a normalizer, or with special
strings that hold blanks or strip them is used on uncut texts; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.text import text_slices

LIMIT = 512
LONG_BYTES = 1 << 20
PART = 1024
BATCH = 1 << 16
KEPT = 1 << 18  # distinct parts whose lengths are kept

# A part: blanks, then everything up to the next blank. A blank that other
# white space precedes is no boundary.
PARTS = re.compile(r"[ \t\n\r]*[^ \t\n\r]+(?:(?<=[^\S \t\n\r])[ \t\n\r]+[^ \t\n\r]*)*|[ \t\n\r]+")


def kind(c: str) -> str:
    """Letter, number or other sign; "" for blanks, controls, and characters
    that Unicode versions may see differently."""
    now, then = unicodedata.category(c)[0], unicodedata.ucd_3_2_0.category(c)[0]
    return {"L": "letter", "N": "number", "P": "other", "S": "other", "M": "other"}.get(now, "") if now == then else ""


class TokenCounter:
    """Counts tokens with one vocabulary file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        before, added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
        self.special = [t["content"] for t in added]
        self.cuts = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before["add_prefix_space"] and not spec["normalizer"]
                     and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in added))
        self.known: dict[str, int] = {}

    def boundary(self, text: str, p: int) -> bool:
        """Whether a cut before character ``p`` is safe inside a blankless run."""
        a, b = kind(text[p - 1]), kind(text[p])
        return bool(a and b and a != b and text[p - 1] != "'"
                    and not any(text.find(s, max(0, p - len(s) + 1), p + len(s) - 1) >= 0 for s in self.special))

    def fine(self, part: str) -> Iterator[str]:
        """A long part, cut at the first safe place after each ``PART`` characters."""
        at, p = 0, PART
        while p < len(part):
            if self.boundary(part, p):
                yield part[at:p]
                at, p = p, p + PART
            else:
                p += 1
        yield part[at:]

    def parts(self, text: str) -> list[str]:
        """A text cut at safe boundaries."""
        if not self.cuts:
            return [text] if text else []
        found = PARTS.findall(text)
        if max(map(len, found), default=0) > PART:
            found = [x for part in found for x in (self.fine(part) if len(part) > PART else (part,))]
        return found

    def pieces(self, text: str, size: int) -> Iterator[str]:
        """A text cut at safe boundaries into pieces of about ``size`` characters."""
        held, n = [], 0
        for part in self.parts(text):
            held.append(part)
            n += len(part)
            if n >= size:
                yield "".join(held)
                held, n = [], 0
        if held:
            yield "".join(held)

    def lengths(self, parts: list[str]) -> Iterator[tuple[str, int]]:
        """(part, tokens), encoded in batches of about ``BATCH`` bytes."""
        batch, size = [], 0
        for i, part in enumerate(parts):
            batch.append(part)
            size += 4 * len(part)  # no character has more bytes
            if size >= BATCH or i + 1 == len(parts):
                yield from zip(batch, map(len, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)))
                batch, size = [], 0

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        cut = [self.parts(t) for t in texts]
        if len(self.known) > KEPT:
            self.known.clear()
        new = set().union(*cut) - self.known.keys()
        self.known.update(self.lengths(list(new)))
        out = [sum(map(self.known.__getitem__, parts)) for parts in cut]
        for part in new:
            if len(part) > 64:  # seldom met again
                del self.known[part]
        return out


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT, long_bytes: int = LONG_BYTES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, and whether it has more
    than ``limit`` tokens. ``vocabulary`` must be readable at the same path on
    every executor."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")

    def count(batches):
        """The batch with ``n_tokens`` in the place of ``text``."""
        counter = TokenCounter(vocabulary)
        for batch in text_slices(batches, "text"):
            n = counter.counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], [*batch.schema.names[:-1], "n_tokens"])

    def cut(batches):
        """Pieces of long texts, one text at a time."""
        counter = TokenCounter(vocabulary)
        for batch in batches:
            for i in range(batch.num_rows):
                row, doc, n_bytes, text = batch.slice(i, 1).to_pylist()[0].values()
                for n, piece in enumerate(counter.pieces(text, long_bytes)):
                    yield pa.RecordBatch.from_pydict({"row": pa.array([row], pa.int64()), "doc_id": pa.array([doc], pa.int64()),
                                                      "n_bytes": pa.array([n_bytes], pa.int64()), "piece": pa.array([n], pa.int64()), "text": [piece]})

    short = rows.where(F.col("n_bytes") <= long_bytes).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    # the key of a long text is its place in the scan, which a repeated task gives again
    long = rows.where(F.col("n_bytes") > long_bytes).select(F.monotonically_increasing_id().alias("row"), "*")
    pieces = long.mapInArrow(cut, "row long, doc_id long, n_bytes long, piece long, text string").repartition("row", "piece")
    counted = pieces.mapInArrow(count, "row long, doc_id long, n_bytes long, piece long, n_tokens long")
    summed = counted.groupBy("row", "doc_id", "n_bytes").agg(F.sum("n_tokens").alias("n_tokens")).drop("row")
    return short.unionByName(summed).withColumn("over_limit", F.col("n_tokens") > limit)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    import public_tokenizers

    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op12_token_counts": op12_token_counts}
ORACLE: dict[str, str] = {}
