"""Suffix-array dedup with longest-previous-factor arrays.

Every byte that lies in a ``width``-byte string which also starts earlier
(smaller id, or same document and earlier start) is removed; the first copy
stays. Blocks of windows that are equal as a whole are settled by ``repeats``.
Contested blocks (the same minimizer in different surroundings) meet in one
task, where a sparse suffix array is built over their window starts, sorted by
their first ``width`` bytes. Neighbours in suffix order with a common prefix of
``width`` bytes form runs; the previous and the next smaller position in suffix
order tell whether the longest previous factor at a start has ``width`` bytes.

Suffix arrays take minimizers with at most ``MAX_PIECES`` contested blocks, all
of at most ``MAX_RUN`` windows. The rest (a passage whose edges stand in
different surroundings in very many documents, or a long periodic run) is
settled exactly as single windows dealt by their 128-bit fingerprints.

Cases: a null or empty text has no bytes; texts shorter than ``width`` stay
whole; rows that share an id count as one document (equal starts are not
earlier), a null id comes after all others; repeated rows get equal results; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import repeats as R
from vigil.llm.tables import saved
from vigil.llm.text import byte_values, column_bytes, text_slices

WIDTH = 100
INNER = 20
MAX_PIECES = 256
MAX_RUN = 256
CHUNK = 50_000  # windows sorted at once
PIECES = 3  # kind of packed rows that carry blocks with their bytes
PIECE = [("pick", "<u8"), ("id", "<i8"), ("key", "<i8"), ("start", "<i4"), ("n", "<i4")]


def blocks_maker(width: int, inner: int):
    def make():
        one, two, hasher = byte_values(81), byte_values(82), R.Hasher()

        def blocks(batch):
            for part in text_slices([batch], "text"):
                data, offsets = column_bytes(part.column("text"))
                ids, keys = part.column("id").to_numpy(), part.column("key").to_numpy()
                for a, b, bounds, docs, at in R.segments(offsets, width):
                    found = R.blocks_of(one[data[a:b]], two[data[a:b]], bounds, width, inner, hasher)
                    doc = found.pop("doc")
                    yield found | {"id": ids[docs[doc]], "key": keys[docs[doc]], "start": found["start"] + at[doc]}

        return blocks

    return make


def stretch(start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, number) of all numbers in the ranges start:start+n."""
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)


def suffix_order(text: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sparse suffix array: the given starts in the order of their suffixes'
    first ``width`` bytes, and for each whether it shares all of them with the
    one before."""
    prefix = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, width)[starts]).view(f"S{width}").ravel()
    order = np.argsort(prefix, kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = prefix[order[1:]] == prefix[order[:-1]]
    return order, same


def longest_previous(order: np.ndarray, same: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes in ``order``: whether a smaller position stands before or
    after them within their run of equal prefixes, so that their longest
    previous factor reaches the full width, and the suffix with the smallest
    position of the run. ``position`` holds ranks; equal ones are one place."""
    m = len(order)
    rank, run = position[order].astype(np.int64), np.cumsum(~same) - 1
    high = int(rank.max(initial=0)) + 1
    # running minima that start anew in each run: later runs lie lower
    before = np.minimum.accumulate(rank - run * high) + run * high
    after = (np.minimum.accumulate((rank - (run[-1:] - run) * high)[::-1])[::-1] + (run[-1:] - run) * high) if m else rank
    least = np.lexsort((rank, run))[np.flatnonzero(~same)][run] if m else rank
    return np.minimum(before, after) < rank, least


def lpf_repeats(pieces: dict[str, np.ndarray], text: np.ndarray, width: int) -> dict[str, np.ndarray]:
    """Repeated windows among blocks given with their bytes (block i has
    n[i] - 1 + width bytes, one after the other), as spans."""
    begin = np.concatenate([[0], np.cumsum(pieces["n"].astype(np.int64) - 1 + width)])[:-1]
    by_pick = np.argsort(pieces["pick"], kind="stable")
    picks = pieces["pick"][by_pick]
    size = np.cumsum(pieces["n"][by_pick].astype(np.int64))
    out, at = [], 0
    while at < len(by_pick):  # whole picks, about CHUNK windows at a time
        end = int(np.searchsorted(size, (size[at - 1] if at else 0) + CHUNK, "right"))
        end = int(np.searchsorted(picks, picks[min(max(end, at + 1), len(picks)) - 1], "right"))
        some = by_pick[at:end]
        owner, start = stretch(begin[some], pieces["n"][some])
        owner = some[owner]
        start_in_doc = pieces["start"][owner] + start - begin[owner]
        place = np.lexsort((start_in_doc, pieces["id"][owner]))
        rank = np.zeros(len(place), np.int64)  # equal (id, start) have one rank
        step = (np.diff(pieces["id"][owner][place]) != 0) | (np.diff(start_in_doc[place]) != 0)
        rank[place[1:]] = np.cumsum(step)
        order, same = suffix_order(text, start, width)
        found, least = longest_previous(order, same, rank)
        hit, source = order[found], order[least[found]]
        by = np.lexsort((start_in_doc[hit], pieces["key"][owner[hit]], pieces["id"][owner[hit]]))
        hit, source = hit[by], source[by]
        key, own_id, first = pieces["key"][owner[hit]], pieces["id"][owner[hit]], start_in_doc[hit]
        ref, ref_key, ref_start = pieces["id"][owner[source]], pieces["key"][owner[source]], start_in_doc[source]
        new = np.ones(len(hit), bool)  # neighbours with one source make one span
        new[1:] = (np.diff(own_id) != 0) | (np.diff(key) != 0) | (np.diff(first) != 1) | (np.diff(ref) != 0) | (np.diff(ref_key) != 0) | (np.diff(ref_start) != 1)
        lead = np.flatnonzero(new)
        out.append({"key": key[lead], "id": own_id[lead], "start": first[lead], "n": np.diff(np.append(lead, len(hit))), "from_id": ref[lead], "from_key": ref_key[lead],
                    "from_start": ref_start[lead]})
        at = end
    return {name: np.concatenate([o[name] for o in out]).astype(d) if out else np.zeros(0, d) for name, d in R.SPAN}


def pack_pieces(pieces: dict[str, np.ndarray], text: list[bytes]) -> bytes:
    return len(text).to_bytes(8, "little") + R.pack(pieces, PIECE) + b"".join(text)


def unpack_pieces(blobs: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    width = sum(np.dtype(d).itemsize for _, d in PIECE)
    heads, texts = [], []
    for blob in blobs:
        end = 8 + int.from_bytes(blob[:8], "little") * width
        heads.append(blob[8:end])
        texts.append(blob[end:])
    return R.unpack(heads, PIECE), np.frombuffer(b"".join(texts), np.uint8)


def contested_repeats(open_: DataFrame, width: int) -> DataFrame:
    """Packed repeats among the contested blocks of documents (key, id, text,
    spans with start, n, pick and heavy)."""
    parts = R.partitions(open_.sparkSession)

    def send(batches):
        by_content, _, results = R.dealer(parts)
        one, two, hasher = byte_values(81), byte_values(82), R.Hasher()
        for batch in batches:
            for part in text_slices([batch], "text"):
                data, offsets = column_bytes(part.column("text"))
                bounds, spans = R.list_column(part.column("spans"), ["start", "n", "pick", "heavy"])
                doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                heavy = spans["heavy"].astype(bool)
                pieces = {"pick": spans["pick"].view("<u8") if spans["pick"].dtype == np.int64 else spans["pick"].astype(np.int64).view("<u8"),
                          "id": part.column("id").to_numpy()[doc], "key": part.column("key").to_numpy()[doc], "start": spans["start"], "n": spans["n"]}
                rows = []
                light = np.flatnonzero(~heavy)
                to = (pieces["pick"][light] % np.uint64(parts)).astype(np.int64)
                order = light[np.argsort(to, kind="stable")]
                for some in np.split(order, np.flatnonzero(np.diff(np.sort(to))) + 1) if len(order) else []:
                    begin = offsets[doc[some]] + pieces["start"][some]
                    text = [data[a:a + n - 1 + width].tobytes() for a, n in zip(begin.tolist(), pieces["n"][some].tolist())]
                    rows.append((PIECES, int(pieces["pick"][some[0]] % np.uint64(parts)), pack_pieces(R.pick_rows(pieces, some), text)))
                some = np.flatnonzero(heavy)
                if len(some):  # window by window, long runs in stretches
                    first, second = hasher.totals(one[data]), hasher.totals(two[data])
                    owner, start = stretch(pieces["start"][some], pieces["n"][some])
                    for a in range(0, len(owner), R.FLUSH):
                        own, s = some[owner[a:a + R.FLUSH]], start[a:a + R.FLUSH]
                        at = offsets[doc[own]] + s
                        stays, spans_ = R.settle({"pick": hasher.range(first, at, at + width, 1), "content": hasher.range(second, at, at + width, 2), "id": pieces["id"][own],
                                                  "key": pieces["key"][own], "start": s, "n": np.ones(len(s), np.int64), "flag": np.zeros(len(s), np.uint8)}, True)
                        rows += by_content(stays) + results(spans_, None)
                yield R.batch_of(rows)

    def meet(batches):
        _, _, results = R.dealer(parts)
        found: dict[int, list[bytes]] = {R.BLOCKS: [], R.REPEATS: [], PIECES: []}
        for batch in batches:
            for kind, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                found[kind].append(data)
        yield R.batch_of([(R.REPEATS, 0, d) for d in found[R.REPEATS]] + results(R.settle(R.unpack(found[R.BLOCKS], R.BLOCK), True)[1], None))
        yield R.batch_of(results(lpf_repeats(*unpack_pieces(found[PIECES]), width), None))

    return open_.mapInArrow(send, R.PACKED).repartitionById(parts, "to").mapInArrow(meet, R.PACKED)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, inner: int = INNER, max_pieces: int = MAX_PIECES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, ``removed`` (maximal
    runs, end exclusive) and ``kept`` (the bytes that stay)."""
    rows = R.keyed(docs, id_col, text_col)
    once = R.distinct_rows(rows.select("key", "id", "text"))
    packed = R.block_table(once, blocks_maker(width, inner), same_document=True)
    contested = R.contested_of(packed)
    # all blocks of a pick go the same way, so that they meet
    many = (contested.groupBy("pick").agg(F.count("*").alias("pieces"), F.max("n").alias("longest"))
            .where((F.col("pieces") > max_pieces) | (F.col("longest") > MAX_RUN)).select("pick", F.lit(True).alias("many")))
    contested = contested.join(many, "pick", "left").withColumn("heavy", F.coalesce("many", F.lit(False)))
    open_ = R.with_spans(once, contested, ["start", "n", "pick", "heavy"], "inner")
    single = saved(contested_repeats(open_, width), free=True)
    hits = R.repeats_of(packed).unionByName(R.repeats_of(single))
    schema = "doc_id long, n_bytes long, n_removed long, removed array<struct<start:int,end:int>>, kept binary"

    def cut(batches):
        for batch in batches:
            for part in text_slices([batch], "text"):
                data, offsets = column_bytes(part.column("text"))
                bounds, hit = R.list_column(part.column("spans"), ["start", "n"])
                n_removed, removed, kept = [], [], []
                for d in range(part.num_rows):
                    own, text = slice(bounds[d], bounds[d + 1]), data[offsets[d]:offsets[d + 1]]
                    runs = []
                    if bounds[d] < bounds[d + 1]:
                        gone = R.covered(hit["start"][own], hit["n"][own], width, len(text))
                        edge = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                        runs = [{"start": a, "end": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
                        text = text[~gone]
                    removed.append(runs)
                    kept.append(text.tobytes())
                    n_removed.append(sum(r["end"] - r["start"] for r in runs))
                item = pa.struct([("start", pa.int32()), ("end", pa.int32())])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(n_removed, pa.int64()),
                                                  pa.array(removed, pa.list_(item)), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "removed", "kept"])

    return R.with_spans(rows.select("id", "key", "doc_id", "text"), hits, ["start", "n"], "left").select("doc_id", "text", "spans").mapInArrow(cut, schema)


def op8_suffix_lpf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its bytes in 100-byte strings that start earlier."""
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(doc_id, 9223372036854775807) AS id, hex(encode(coalesce(text, ''))) AS data FROM documents),
p AS (SELECT row, id, length(data) // 2 AS n, piece, substr(data, 2 * piece + 1, 710) AS part  -- 256 bytes and the 99 after them
      FROM (SELECT *, unnest(range(0, length(data) // 2, 256)) AS piece FROM d)),
b AS (SELECT row, id, n, piece + j AS i, substr(part, 2 * j + 1, 2) AS byte, CASE WHEN piece + j + 100 <= n THEN md5_number(substr(part, 2 * j + 1, 200)) END AS gram
      FROM (SELECT *, unnest(range(least(256, n - piece))) AS j FROM p)),
f AS (SELECT gram, min(id) AS id, arg_min(i, (id, i)) AS i FROM b WHERE gram IS NOT NULL GROUP BY gram),
h AS (SELECT b.row, b.i, byte, coalesce((b.id, b.i) > (f.id, f.i), false) AS hit FROM b LEFT JOIN f USING (gram)),
c AS (SELECT row, i, byte, bool_or(hit) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM h),
r AS (SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY row ORDER BY i) AS opens FROM c),
k AS (SELECT row, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans, string_agg(byte, '' ORDER BY i) FILTER (NOT gone) AS kept FROM r GROUP BY row)
SELECT doc_id, CAST(length(data) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN k USING (row)
"""

QUERIES = {"op8_suffix_lpf": op8_suffix_lpf}
ORACLE = {"op8_suffix_lpf": SQL}
