"""Bounded samples of labelled documents for training on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.tables import saved

PIECE_CHARS, PIECES = 20_000, 8  # a longer text is represented by so many random pieces


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``fold``; a null
    id belongs to no held-out row."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(folds)) == fold, F.lit(False))


def drawn_text(text: Column, key: Column, piece_chars: int, pieces: int) -> Column:
    """A text of up to ``pieces * piece_chars`` characters whole; of a longer
    one so many pieces from random places (by ``key``), in lines."""
    size = F.char_length(text)
    at = [F.pmod(F.xxhash64(key, F.lit(k)), size - piece_chars + 1).cast("int") + 1 for k in range(pieces)]
    return F.when(size <= pieces * piece_chars, text).otherwise(F.concat_ws("\n", *[F.substring(text, a, F.lit(piece_chars)) for a in at]))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, folds: int, fold: int, per_class: int, budget_chars: int,
                    piece_chars: int = PIECE_CHARS, pieces: int = PIECES) -> list[tuple[str, int]]:
    """(text, label) of up to ``per_class`` documents of each class 0 and 1 that
    are not held out, in the order of the hashes of their ids, until a class has
    ``budget_chars`` characters. Texts of any length take part: a very long one
    is represented by random pieces of it. A document that is labelled twice
    takes the larger label; a repeated id gives one text."""
    known = (labels.select(F.col("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    known = known.join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = [known.where(F.col("label") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    ids = saved(chosen[0].unionByName(chosen[1]))  # 2 * per_class rows at most
    texts = rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    drawn = saved(texts.select("doc_id", "label", drawn_text(F.col("text"), F.col("doc_id"), piece_chars, pieces).alias("text")))
    before = Window.partitionBy("label").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)  # per_class rows
    within = drawn.select("doc_id", F.coalesce(F.sum(F.char_length("text")).over(before), F.lit(0)).alias("before")).where(F.col("before") < budget_chars)
    found = drawn.join(F.broadcast(within.select("doc_id")), "doc_id").select("text", "label", "doc_id").collect()
    return [(r["text"], r["label"]) for r in sorted(found, key=lambda r: r["doc_id"])]
