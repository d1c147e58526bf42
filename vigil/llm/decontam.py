"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is contained in a document when the document holds at least ``share``
of the item's distinct word shingles. Words are lower-cased (A-Z) runs of
non-blank bytes; shingles take five words (an item of fewer words is one
shingle of all its words).

Plain MinHash banding fails for a short item in a long document, because their
Jaccard similarity is close to zero whatever the item's containment. So, as in
size-partitioned ensembles, items are partitioned by size, and each partition
has its own sketch: the k smallest MinHash values of the item's shingles, with
k = n - ceil(share * n) + 1 for an item of n shingles. A document that holds
ceil(share * n) of them must hold one of any k, so the search misses nothing.
Documents are partitioned by size too: one with fewer shingles than a partition
needs never opens it. Candidates are then verified by exact shingle
containment, comparing the shingles' words themselves.

The items are the stated query set; they are read in blocks of about
``block_chars`` characters, each broadcast and searched in one pass over the
documents, so nothing broadcast grows with either table.

Cases: a null or empty document holds nothing; an item without words is never
contained; repeated documents and items are all reported; a pair appears once
per (document row, item row); an empty table on either side gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import namedtuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.text import Powers, byte_values, column_bytes, gram_hashes, text_slices, word_hashes, word_spans

WORDS = 5
SHARE_PERCENT = 80
BLOCK_CHARS = 4_000_000
SCHEMA = "doc_id long, item_id long, n_shared long, n_item long"
SEED = 6


def lower_words(text: str) -> list[bytes]:
    """Words of one text, A-Z in lower case (``bytes.lower`` and
    ``bytes.split`` work on ASCII only, on just these blanks)."""
    return (text or "").encode().lower().split()


def shingles(words: list[bytes], n: int) -> set[bytes]:
    return {b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}


def hash_of(shingle: bytes, n: int, table: np.ndarray, pows: Powers) -> int:
    data = np.frombuffer(shingle, np.uint8)
    s, e, _ = word_spans(data, np.array([0, len(data)]))
    return int(gram_hashes(word_hashes(data, s, e, [table], pows)[0], n)[0])


Index = namedtuple("Index", "ids shingles need width classes")


def index_of(items: list[tuple[int, str]], percent: int) -> tuple:
    """Index of one block of items: ids, shingles, needed shingles and shingle
    width of each, and for each shingle width and size class (width, least
    shingles needed, sorted hashes of the sketches, items of each hash). A
    plain tuple, which executors read without this package."""
    table, pows = byte_values(SEED, lower=True), Powers()
    ids, own_shingles, needs, widths = [], [], [], []
    classes: dict[tuple[int, int], dict[int, list[int]]] = {}
    for item, text in items:
        words = lower_words(text)
        if not words:
            continue
        n = min(WORDS, len(words))
        own = shingles(words, n)
        need = -(-percent * len(own) // 100)
        sketch = sorted(hash_of(s, n, table, pows) for s in own)[:len(own) - need + 1]
        i = len(ids)
        ids.append(item)
        own_shingles.append(own)
        needs.append(need)
        widths.append(n)
        by_hash = classes.setdefault((n, int(math.log2(len(own)))), {})
        for h in sketch:
            by_hash.setdefault(h, []).append(i)
    found = [(n, min(needs[i] for v in d.values() for i in v), np.array(sorted(d), np.uint64), [d[h] for h in sorted(d)]) for (n, _), d in classes.items()]
    return ids, own_shingles, needs, widths, found


def candidates(block: Index, words: np.ndarray, first: np.ndarray) -> dict[int, set[int]]:
    """Document (by place) -> items whose sketch it meets. ``words`` are word
    hashes, ``first`` the first word of each document."""
    found: dict[int, set[int]] = {}
    grams: dict[int, np.ndarray] = {}
    size = np.diff(first)
    for n, need, hashes, items in block.classes:
        if not len(words) or not (size - n + 1 >= need).any():
            continue
        if n not in grams:
            grams[n] = gram_hashes(words, n)
        low = np.zeros(1 << 18, bool)
        low[hashes & np.uint64((1 << 18) - 1)] = True
        at = np.flatnonzero(low[grams[n] & np.uint64((1 << 18) - 1)])
        slot = np.minimum(np.searchsorted(hashes, grams[n][at]), len(hashes) - 1)
        hit = hashes[slot] == grams[n][at]
        at, slot = at[hit], slot[hit]
        doc = np.searchsorted(first, at, "right") - 1
        # the run of words lies in one document that has enough shingles
        ok = (at + n <= first[doc + 1]) & (size[doc] - n + 1 >= need)
        for d, s in set(zip(doc[ok].tolist(), slot[ok].tolist())):
            found.setdefault(d, set()).update(items[s])
    return found


def item_blocks(items: DataFrame, item_col: str, item_text_col: str, percent: int, block_chars: int):
    """Broadcast indexes of the items, of about ``block_chars`` characters each."""
    queries = items.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    total = queries.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    for b in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()  # about block_chars characters
        yield items.sparkSession.sparkContext.broadcast(index_of([tuple(r) for r in part], percent))


def held_items(block: Index, data: np.ndarray, offsets: np.ndarray, percent: int, table: np.ndarray, pows: Powers):
    """(document by place, item, shared shingles) of some texts, verified."""
    starts, ends, first = word_spans(data, offsets)
    found = candidates(block, word_hashes(data, starts, ends, [table], pows)[0], first)
    for d, some in sorted(found.items()):
        words = bytes(data[offsets[d]:offsets[d + 1]]).lower().split()
        held: dict[int, set[bytes]] = {}
        for i in sorted(some):
            n = block.width[i]
            if n not in held:
                held[n] = shingles(words, n)
            shared = len(held[n] & block.shingles[i])
            if 100 * shared >= percent * len(block.shingles[i]):
                yield d, i, shared


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", percent: int = SHARE_PERCENT, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item) for each item of which a document
    holds at least ``percent`` of the shingles."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for index in item_blocks(items, item_col, item_text_col, percent, block_chars):

        def search(batches, index=index):
            block, table, pows = Index(*index.value), byte_values(SEED, lower=True), Powers()
            for batch in text_slices(batches, "text"):
                pairs = [(batch.column(0)[d].as_py(), block.ids[i], shared, len(block.shingles[i]))
                         for d, i, shared in held_items(block, *column_bytes(batch.column(1)), percent, table, pows)]
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in range(4)],
                                                 ["doc_id", "item_id", "n_shared", "n_item"])

        found = rows.mapInArrow(search, SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out


def without_items(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  percent: int = SHARE_PERCENT, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Documents that contain none of the items, all columns as they are.
    Documents are read once and pass the blocks of items one after the other,
    within their task, so no text is shuffled."""
    at = docs.columns.index(text_col)
    for index in item_blocks(items, item_col, item_text_col, percent, block_chars):

        def keep(batches, index=index):
            block, table, pows = Index(*index.value), byte_values(SEED, lower=True), Powers()
            for batch in text_slices(batches, at):
                stays = np.ones(batch.num_rows, bool)
                stays[[d for d, _, _ in held_items(block, *column_bytes(batch.column(at)), percent, table, pows)]] = False
                yield batch.filter(pa.array(stays))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def op6_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item contained in any document."""
    return contained_items(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = r"""
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark),
item AS (
  SELECT DISTINCT id, n, array_to_string(w[p : p + n - 1], ' ') AS s
  FROM (SELECT id, w, least(len(w), 5) AS n, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS p FROM words WHERE side = 'i' AND len(w) > 0)),
doc AS (
  SELECT DISTINCT id, n, array_to_string(w[p : p + n - 1], ' ') AS s
  FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM words, (SELECT DISTINCT n FROM item) WHERE side = 'd' AND len(w) >= n)),
size AS (SELECT id, count(*) AS n_item FROM item GROUP BY id)
SELECT doc.id AS doc_id, item.id AS item_id, count(*) AS n_shared, any_value(n_item) AS n_item
FROM doc JOIN item USING (s, n) JOIN size ON size.id = item.id
GROUP BY doc.id, item.id HAVING 100 * count(*) >= 80 * any_value(n_item)
"""

QUERIES = {"op6_containment": op6_containment}
ORACLE = {"op6_containment": SQL}
