"""Substring dedup by relative Lempel-Ziv parsing over word runs.

Every document is parsed against the reference made of all documents with a
smaller id. The index (see ``repeats``) names, for each window of ``width`` words
that may be a copy, the place where it starts first: a seed. The words of the
reference around it are kept in blocks of ``BLOCK_WORDS``; each document gets the
blocks its seeds name, and a lookup compares words, not hashes, and takes the
longest match, which may reach beyond the seed to the ends of the blocks. The
parse is greedy: at each place the match that reaches farthest becomes a factor
(start, length, reference document, start there). Where a factor ends, the
windows that straddle its boundary are parsed next, so a run copied from several
references is found whole. Words in factors are removed, and no others; matches
shorter than a window are no factors.

Cases: a null or empty text has no words; a text of fewer than ``width`` words
keeps all; repeats inside one document, or among rows that share an id, are
kept; a null id comes after all others; repeated rows are parsed each; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import repeats as R
from vigil.llm.tables import saved
from vigil.llm.text import Powers, byte_values, column_bytes, mix, text_slices, word_hashes, word_spans

WIDTH = 50
INNER = 8
BLOCK_WORDS = 64  # words of a reference block
GROUP = 256  # documents parsed together, about
FACTORS = "array<struct<start:int,length:int,ref_id:long,ref_start:int>>"
FACTOR_LIST = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref_id", pa.int64()), ("ref_start", pa.int32())]))
SEEDS = "array<struct<start:int,n:int,ref_id:long,ref_key:long,ref_start:int>>"


def word_reader():
    """Function from a record batch with ``text`` to pieces of it: (batch,
    word hashes, first word of each text)."""
    table, pows = byte_values(10), Powers()

    def read(batch):
        for part in text_slices([batch], "text"):
            data, offsets = column_bytes(part.column("text"))
            starts, ends, first = word_spans(data, offsets)
            yield part, word_hashes(data, starts, ends, [table], pows)[0], first

    return read


def blocks_maker(width: int, inner: int):
    def make():
        read, hasher = word_reader(), R.Hasher()

        def blocks(batch):
            for part, words, first in read(batch):
                ids, keys = part.column("id").to_numpy(), part.column("key").to_numpy()
                for a, b, bounds, docs, at in R.segments(first, width):
                    found = R.blocks_of(words[a:b], mix(words[a:b], 3), bounds, width, inner, hasher)
                    doc = found.pop("doc")
                    found["flag"] = np.zeros(len(doc), np.uint8)  # repeats inside a document don't matter here
                    yield found | {"id": ids[docs[doc]], "key": keys[docs[doc]], "start": found["start"] + at[doc]}

        return blocks

    return make


def windows_maker(width: int):
    """All windows of the contested blocks (column ``spans``) of documents."""

    def make():
        read, hasher = word_reader(), R.Hasher()

        def windows(batch):
            for part, words, first in read(batch):
                bounds, spans = R.list_column(part.column("spans"), ["start", "n"])
                doc = np.repeat(np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), spans["n"])
                begin = np.cumsum(spans["n"]) - spans["n"]
                start = np.arange(len(doc)) - np.repeat(begin, spans["n"]) + np.repeat(spans["start"], spans["n"])
                at = first[doc] + start
                ids, keys = part.column("id").to_numpy(), part.column("key").to_numpy()
                yield {"pick": hasher.range(hasher.totals(words), at, at + width, 1), "content": hasher.range(hasher.totals(mix(words, 3)), at, at + width, 2),
                       "id": ids[doc], "key": keys[doc], "start": start, "n": np.ones(len(doc), np.int64), "flag": np.zeros(len(doc), np.uint8)}

        return windows

    return make


def factor(start: np.ndarray, n: np.ndarray, ref_id: np.ndarray, ref_start: np.ndarray, width: int) -> list[dict]:
    """Greedy parse of one document from its matches: runs of ``n`` windows
    from ``start`` that also start at ``ref_start`` in document ``ref_id``."""
    order = np.lexsort((ref_start, ref_id, -n, start))
    out, at, best, k = [], -1, None, 0  # at: the first window not parsed yet
    hits = [(int(start[i]), int(start[i] + n[i]), int(ref_id[i]), int(ref_start[i])) for i in order]
    while k < len(hits) or best:
        while k < len(hits) and hits[k][0] <= at:
            if best is None or hits[k][1] > best[1]:
                best = hits[k]
            k += 1
        if best and best[1] > at:
            s, end, ref, ref_at = best
            last = out[-1] if out else None
            if last and (last["ref_id"], last["ref_start"] - last["start"]) == (ref, ref_at - s) and last["start"] + last["length"] - width + 1 == at:
                last["length"] += end - at  # the same copy goes on
            else:
                out.append({"start": at, "length": end - at - 1 + width, "ref_id": ref, "ref_start": ref_at + at - s})
            at, best = end, None
        elif k < len(hits):
            at, best = hits[k][0], None
        else:
            break
    return out


def seeds_of(hits: DataFrame) -> DataFrame:
    """(id, key, seeds): the hits of a document, those that go on in one
    reference document as one seed."""

    def merge(batches):
        for batch in batches:
            bounds, s = R.list_column(batch.column("spans"), ["start", "n", "from_id", "from_key", "from_start"])
            doc = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            order = np.lexsort((s["start"], s["from_start"] - s["start"], s["from_key"], s["from_id"], doc))
            s, doc = R.pick_rows(s, order), doc[order]
            end, new = s["start"] + s["n"], np.ones(len(doc), bool)
            new[1:] = (np.diff(doc) != 0) | (s["start"][1:] > end[:-1])
            for c in (s["from_id"], s["from_key"], s["from_start"] - s["start"]):
                new[1:] |= c[1:] != c[:-1]
            lead = np.flatnonzero(new)
            n = (np.maximum.reduceat(end, lead) if len(lead) else end) - s["start"][lead]
            seeds = pa.StructArray.from_arrays([pa.array(x, t) for x, t in ((s["start"][lead], pa.int32()), (n, pa.int32()), (s["from_id"][lead], pa.int64()), (s["from_key"][lead], pa.int64()),
                                                                            (s["from_start"][lead], pa.int32()))], ["start", "n", "ref_id", "ref_key", "ref_start"])
            offsets = np.searchsorted(doc[lead], np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.ListArray.from_arrays(pa.array(offsets), seeds)], ["id", "key", "seeds"])

    lists = hits.groupBy("id", "key").agg(F.collect_list(F.struct("start", "n", "from_id", "from_key", "from_start")).alias("spans"))
    return lists.mapInArrow(merge, f"id long, key long, seeds {SEEDS}")


def reference_blocks(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The blocks of ``BLOCK_WORDS`` words that ``wanted`` (id, key, blocks)
    names: (ref_id, ref_key, block, words)."""

    def cut(batches):
        for batch in batches:
            for part in text_slices([batch], "text"):
                data, offsets = column_bytes(part.column("text"))
                ref_id, ref_key, block, out = [], [], [], []
                for d, (i, k, blocks) in enumerate(zip(part.column("id").to_pylist(), part.column("key").to_pylist(), part.column("blocks").to_pylist())):
                    words = bytes(data[offsets[d]:offsets[d + 1]]).split()
                    out += [b" ".join(words[b * BLOCK_WORDS:(b + 1) * BLOCK_WORDS]) for b in blocks]
                    ref_id += [i] * len(blocks)
                    ref_key += [k] * len(blocks)
                    block += blocks
                yield pa.RecordBatch.from_arrays([pa.array(ref_id, pa.int64()), pa.array(ref_key, pa.int64()), pa.array(block, pa.int32()), pa.array(out, pa.binary())],
                                                 ["ref_id", "ref_key", "block", "words"])

    return texts.join(wanted, ["id", "key"]).mapInArrow(cut, "ref_id long, ref_key long, block int, words binary")


def longest(words: np.ndarray, start: int, ref: np.ndarray, ref_start: int, width: int) -> list[tuple[int, int]]:
    """Longest matches of ``width`` words and more (start, end) of a document's
    words with a stretch of the reference, where ``start`` lies on ``ref_start``."""
    a, shift = max(0, start - ref_start), ref_start - start
    end = min(len(words), len(ref) - shift)
    if end - a < width:
        return []
    edge = np.flatnonzero(np.diff(words[a:end] == ref[a + shift:end + shift], prepend=False, append=False)) + a
    return [(s, e) for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()) if e - s >= width]


def parse_group(docs: pa.Table, blocks: pa.Table, width: int) -> pa.Table:
    """Factors of the documents (id, key, text, seeds) of a group, parsed
    against the reference blocks (ref_id, ref_key, block, words) they name."""
    vocabulary: dict[bytes, int] = {}

    def numbers(words: bytes) -> np.ndarray:
        words = words.split()
        return np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in words), np.int64, len(words))

    names = zip(*(blocks.column(c).to_pylist() for c in ("ref_id", "ref_key", "block")))
    index = {name: numbers(words) for name, words in zip(names, blocks.column("words").to_pylist())}
    out = []
    texts = docs.column("text").cast(pa.large_binary()).to_pylist()
    for text, seeds in zip(texts, docs.column("seeds").to_pylist()):
        words, found = numbers(text), []
        for s in seeds:
            first, last = s["ref_start"] // BLOCK_WORDS, (s["ref_start"] + s["n"] + width - 2) // BLOCK_WORDS
            ref = np.concatenate([index[s["ref_id"], s["ref_key"], b] for b in range(first, last + 1)])
            at = s["ref_start"] - first * BLOCK_WORDS
            found += [(a, b - a - width + 1, s["ref_id"], a - s["start"] + s["ref_start"]) for a, b in longest(words, s["start"], ref, at, width)]
        out.append(factor(*np.array(found, np.int64).reshape(-1, 4).T, width))
    return pa.table([docs.column("id"), docs.column("key"), pa.array(out, FACTOR_LIST)], ["id", "key", "factors"])


def factors_of(texts: DataFrame, hits: DataFrame, width: int) -> DataFrame:
    """(id, key, factors) of the documents with hits. Groups of about ``GROUP``
    documents ask for each reference block once, so a block that a third of
    all documents copy is sent to groups, not to documents."""
    seeds = saved(seeds_of(hits), free=True)
    groups = max(1, -(-seeds.count() // GROUP))
    seeds = seeds.withColumn("grp", F.pmod(F.xxhash64("id", "key"), F.lit(groups)))
    last = F.expr(f"(s.ref_start + s.n + {width - 2}) DIV {BLOCK_WORDS}")
    asks = (seeds.select("grp", F.explode("seeds").alias("s"))
            .select("grp", "s.ref_id", "s.ref_key", F.explode(F.sequence(F.expr(f"s.ref_start DIV {BLOCK_WORDS}"), last).cast("array<int>")).alias("block")).distinct())
    asks = saved(asks, free=True)
    wanted = asks.groupBy(F.col("ref_id").alias("id"), F.col("ref_key").alias("key")).agg(F.sort_array(F.collect_set("block")).alias("blocks"))
    blocks = reference_blocks(texts, saved(wanted))
    sent = asks.join(blocks, ["ref_id", "ref_key", "block"])
    docs = texts.join(seeds, ["id", "key"]).select("grp", "id", "key", "text", "seeds")

    def parse(left: pa.Table, right: pa.Table) -> pa.Table:
        return parse_group(left, right, width)

    return docs.groupBy("grp").cogroup(sent.groupBy("grp")).applyInArrow(parse, f"id long, key long, factors {FACTORS}")


def parse_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, inner: int = INNER) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, ``factors`` and
    ``kept`` (the words that stay, joined by one space)."""
    rows = R.keyed(docs, id_col, text_col)
    once = R.distinct_rows(rows.select("key", "id", "text"))
    packed = R.block_table(once, blocks_maker(width, inner), same_document=False)
    open_ = R.with_spans(once, R.contested_of(packed), ["start", "n"], "inner")
    single = saved(R.single_windows(open_, windows_maker(width), same_document=False), free=True)
    factors = saved(factors_of(once, R.repeats_of(packed).unionByName(R.repeats_of(single)), width), free=True)
    schema = f"doc_id long, n_words long, n_removed long, factors {FACTORS}, kept string"

    def cut(batches):
        for batch in batches:
            for part in text_slices([batch], "text"):
                data, offsets = column_bytes(part.column("text"))
                bounds, f = R.list_column(part.column("factors"), ["start", "length"])
                n_words, n_removed, kept = [], [], []
                for d in range(part.num_rows):
                    words = bytes(data[offsets[d]:offsets[d + 1]]).split()
                    own = slice(bounds[d], bounds[d + 1])
                    n_words.append(len(words))
                    if bounds[d] < bounds[d + 1]:
                        gone = R.covered(f["start"][own], f["length"][own], 1, len(words))
                        words = [words[i] for i in np.flatnonzero(~gone)]
                    n_removed.append(n_words[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), part.column("factors"),
                                                  pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "factors", "kept"])

    none = F.array().cast(FACTORS)
    return rows.join(factors, ["id", "key"], "left").select("doc_id", "text", F.coalesce("factors", none).alias("factors")).mapInArrow(cut, schema)


def op10_rlz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its runs of 50 words that occur in an earlier document."""
    out = parse_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(doc_id, 9223372036854775807) AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT row, id, unnest(words) AS word, unnest(range(len(words))) AS i, len(words) AS n FROM d),
g AS (SELECT row, id, i, n, word, md5_number(string_agg(word, ' ') OVER (PARTITION BY row ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) AS gram FROM w),
f AS (SELECT gram, min(id) AS first FROM g WHERE i + 50 <= n GROUP BY gram),
h AS (SELECT g.*, i + 50 <= n AND first < id AS hit FROM g LEFT JOIN f USING (gram)),
c AS (SELECT row, i, word, bool_or(coalesce(hit, false)) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM h),
k AS (SELECT row, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (row)
"""

QUERIES = {"op10_rlz": op10_rlz}
ORACLE = {"op10_rlz": SQL}
