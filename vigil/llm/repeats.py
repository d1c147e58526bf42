"""Repeated windows of a corpus: which runs of ``width`` symbols (bytes or
words) also start earlier.

Comparing all windows would move many times the input, so windows are handled
by the block they belong to. Each window picks the smallest hash among its
inner runs of ``inner`` symbols (a minimizer); consecutive windows with the
same pick are a block, and equal windows always pick equal hashes. A block is
one record: pick, hash of all its symbols, position. Then

1. blocks equal in pick and content are settled as a whole: all but the first
   repeat it window by window;
2. a pick that occurs with two different contents is contested: its first
   blocks are looked at again, window by window (``look``, by the caller);
3. a pick with one content is free of other repeats.

Records travel as packed arrays, dealt by (pick, content) in step 1 and by pick
in step 2. Equal records are settled within each task before they are dealt,
and a task that sees a pick with two contents says so with one marker, so a
passage that a third of all documents share costs a few records a task, and no
group grows with the number of documents.

Positions are (id, start). ``same_document`` says whether an earlier start in
the same document counts as earlier. A text is known by its id and ``key``, a
hash of id and text, so a clash of hashes needs one id with two texts; rows with
an equal id are one document, a null id comes last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.tables import saved
from vigil.llm.text import P1, mix, powers

SEGMENT = 1 << 20  # symbols hashed at once
FLUSH = 1 << 18  # records settled together before they are dealt
NULL_ID = (1 << 63) - 1
# packed columns of a block: pick, content, id, key, start, windows, flags
BLOCK = [("pick", "<u8"), ("content", "<u8"), ("id", "<i8"), ("key", "<i8"), ("start", "<i4"), ("n", "<i4"), ("flag", "u1")]
PERIODIC, EXTRA, MARKER = 1, 2, 4  # flags: may repeat inside itself; more of the same document; says only that a pick is contested
ASK = [c for c in BLOCK if c[0] != "content"]  # what step 2 needs of a block
# packed columns of a result: text, start, windows, and the text and start of the earlier block; or the pick
SPAN = [("key", "<i8"), ("id", "<i8"), ("start", "<i4"), ("n", "<i4"), ("from_id", "<i8"), ("from_key", "<i8"), ("from_start", "<i4")]
OPEN = [("key", "<i8"), ("id", "<i8"), ("start", "<i4"), ("n", "<i4"), ("pick", "<u8")]
BLOCKS, REPEATS, CONTESTED = 0, 1, 2  # kinds of packed rows
PACKED = "kind int, to int, data binary"


def pack(columns: dict[str, np.ndarray], layout: list[tuple[str, str]]) -> bytes:
    return b"".join(np.ascontiguousarray(columns[name], dtype).tobytes() for name, dtype in layout)


def unpack(blobs: list[bytes], layout: list[tuple[str, str]]) -> dict[str, np.ndarray]:
    parts: dict[str, list] = {name: [] for name, _ in layout}
    width = sum(np.dtype(d).itemsize for _, d in layout)
    for blob in blobs:
        n, at = len(blob) // width, 0
        for name, dtype in layout:
            parts[name].append(np.frombuffer(blob, dtype, n, at))
            at += n * np.dtype(dtype).itemsize
    return {name: np.concatenate(parts[name]) if parts[name] else np.zeros(0, dtype) for name, dtype in layout}


def pick_rows(columns: dict[str, np.ndarray], at) -> dict[str, np.ndarray]:
    return {k: v[at] for k, v in columns.items()}


def deal(kind: int, columns: dict[str, np.ndarray], layout: list, to: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Packed rows (kind, to, data) for columns dealt to the numbers ``to``."""
    if not len(to):
        return []
    order = np.lexsort((columns["start"], columns["key"], to))  # a document's records side by side pack well
    cuts = np.flatnonzero(np.diff(to[order])) + 1
    return [(kind, int(to[part[0]]), pack(pick_rows(columns, part), layout)) for part in np.split(order, cuts)]


def batch_of(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kind, to, data = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(to, pa.int32()), pa.array(data, pa.binary())], ["kind", "to", "data"])


# --- blocks of one document ---------------------------------------------------
class Hasher:
    """Hashes of ranges of symbols: ``value`` maps symbols to 64-bit values."""

    def __init__(self) -> None:
        self.up, self.down = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def totals(self, values: np.ndarray) -> np.ndarray:
        n = len(values)
        if len(self.up) <= n:
            self.up, self.down = powers(n + 1, P1), powers(n + 1, pow(P1, -1, 1 << 64))
        out = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(values * self.up[:n], out=out[1:])
        return out

    def range(self, totals: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((totals[end] - totals[start]) * self.down[start], seed)

    def grams(self, totals: np.ndarray, n: int, seed: int) -> np.ndarray:
        size = len(totals) - n
        with np.errstate(over="ignore"):
            return mix((totals[n:] - totals[:-n]) * self.down[:size], seed)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, done = values, 1
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    return np.minimum(out[:len(out) - (width - done)], out[width - done:]) if done < width else out


def blocks_of(first: np.ndarray, second: np.ndarray, bounds: np.ndarray, width: int, inner: int, hasher: Hasher) -> dict[str, np.ndarray]:
    """Blocks of several documents whose symbols stand in a row: document d has
    symbols bounds[d]:bounds[d+1]. ``first`` and ``second`` are two
    values per symbol, for the picks and for the contents. Returns pick, content, doc, start (in the document), n, flag."""
    w = width - inner + 1
    empty = {"pick": np.zeros(0, np.uint64), "content": np.zeros(0, np.uint64), "doc": np.zeros(0, np.int64), "start": np.zeros(0, np.int64),
             "n": np.zeros(0, np.int64), "flag": np.zeros(0, np.uint8)}
    if len(first) < width:
        return empty
    grams = hasher.grams(hasher.totals(first), inner, 1)
    low = sliding_min(grams, w)  # the pick of each window
    windows = len(low)
    fits = np.zeros(windows + 1, np.int32)  # windows that lie in one document
    long = np.flatnonzero(np.diff(bounds) >= width)
    if not len(long):
        return empty
    np.add.at(fits, bounds[long], 1)
    np.add.at(fits, bounds[long + 1] - width + 1, -1)
    fits = np.cumsum(fits[:-1]) > 0
    new = fits.copy()
    new[1:] &= (low[1:] != low[:-1]) | ~fits[:-1]
    # two documents' windows never stand side by side: width - 1 others lie between
    last = fits.copy()
    last[:-1] &= (low[1:] != low[:-1]) | ~fits[1:]
    start, end = np.flatnonzero(new), np.flatnonzero(last) + 1
    pick = low[start]
    # a pick that occurs twice within the block's windows: they may repeat each other
    enters = np.zeros(windows + 1, np.int64)
    np.cumsum(grams[w - 1:] == low, out=enters[1:])
    twice = enters[end] - enters[np.minimum(start + 1, end)] > 0
    view = np.lib.stride_tricks.sliding_window_view(grams, w)
    for at in range(0, len(start), 4096):
        s = slice(at, at + 4096)
        twice[s] |= (view[start[s]] == pick[s, None]).sum(1) > 1
    doc = np.searchsorted(bounds, start, "right") - 1
    content = hasher.range(hasher.totals(second), start, end - 1 + width, 2)
    return {"pick": pick, "content": content, "doc": doc, "start": start - bounds[doc], "n": end - start, "flag": twice.astype(np.uint8) * PERIODIC}


def segments(bounds: np.ndarray, width: int, limit: int = SEGMENT):
    """Cut documents that stand in a row into stretches of at most about
    ``limit`` symbols that share width - 1 symbols where a document is cut:
    (from, to, bounds within, document numbers, their first symbols)."""
    docs = len(bounds) - 1
    d = 0
    while d < docs:
        e = max(d + 1, int(np.searchsorted(bounds, bounds[d] + limit, "right")) - 1)
        if bounds[e] - bounds[d] <= limit:
            yield bounds[d], bounds[e], bounds[d:e + 1] - bounds[d], np.arange(d, e), np.zeros(e - d, np.int64)
        else:  # one long document
            at, n = 0, int(bounds[d + 1] - bounds[d])
            while at == 0 or at + width <= n:
                to = min(n, at + limit + width - 1)
                yield bounds[d] + at, bounds[d] + to, np.array([0, to - at]), np.array([d]), np.array([at])
                at += limit
        d = e


# --- settling ------------------------------------------------------------------
def settle(b: dict[str, np.ndarray], same_document: bool) -> tuple[dict, dict]:
    """Blocks equal in pick and content: (those that stay, repeats of the
    first as spans). With ``same_document`` one block of each kind
    stays; without, all blocks of the first document stay, the later ones as extra."""
    order = np.lexsort((b["start"], b["id"], b["content"], b["pick"]))
    b = pick_rows(b, order)
    if not len(order):
        return b, {name: np.zeros(0, d) for name, d in SPAN}
    new = np.ones(len(order), bool)
    new[1:] = (b["pick"][1:] != b["pick"][:-1]) | (b["content"][1:] != b["content"][:-1])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = b["id"] > b["id"][lead]
    if same_document:
        later |= (b["id"] == b["id"][lead]) & (b["start"] > b["start"][lead])
        stays = new
    else:
        stays = ~later
    flag = np.where(new, b["flag"] & ~np.uint8(EXTRA), b["flag"] | np.uint8(EXTRA))
    spans = joined(pick_rows({"key": b["key"], "id": b["id"], "start": b["start"], "n": b["n"], "from_id": b["id"][lead], "from_key": b["key"][lead],
                              "from_start": b["start"][lead]}, later))
    # equal rows (same id and start, or same document) under another key: each keeps its own record
    twin = ~new & ~later & (b["key"] != b["key"][lead])
    return pick_rows(b | {"flag": flag}, stays | twin), spans


def joined(spans: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Spans of a document that follow each other in one earlier document as one."""
    if not len(spans["key"]):
        return spans
    s = pick_rows(spans, np.lexsort((spans["start"], spans["key"], spans["id"])))
    new = np.ones(len(s["key"]), bool)
    new[1:] = ((np.diff(s["id"]) != 0) | (np.diff(s["key"]) != 0) | (s["start"][1:] != s["start"][:-1] + s["n"][:-1]) | (np.diff(s["from_id"]) != 0)
               | (np.diff(s["from_key"]) != 0) | (s["from_start"][1:] != s["from_start"][:-1] + s["n"][:-1]))
    lead = np.flatnonzero(new)
    return pick_rows(s, lead) | {"n": np.add.reduceat(s["n"], lead)}


def first_look(b: dict[str, np.ndarray]) -> tuple[dict, dict]:
    """Settled blocks that meet by content: those known to be contested, and
    those (and markers) that must ask by pick. The input is sorted by pick."""
    n = len(b["pick"])
    if not n:
        return b, b
    new = np.ones(n, bool)
    new[1:] = b["pick"][1:] != b["pick"][:-1]
    group = np.cumsum(new) - 1
    lead = np.flatnonzero(new)
    # contents of a pick, and whether one of its blocks may repeat itself
    contents = np.bincount(group, (b["flag"] & EXTRA) == 0)
    periodic = np.bincount(group, (b["flag"] & PERIODIC) != 0) > 0
    sure = (contents > 1) | periodic
    asks = pick_rows(b, ~sure[group])
    marks = pick_rows(b, lead[sure])
    marks["flag"] = np.full(len(marks["flag"]), MARKER, np.uint8)
    return pick_rows(b, sure[group]), {k: np.concatenate([asks[k], marks[k]]) for k in b}


def second_look(b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Blocks that meet by pick: those whose pick has another content. Each
    task of the first look sends at most one content or marker of a pick."""
    picks, group = np.unique(b["pick"], return_inverse=True)
    if not len(picks):
        return b
    contents = np.bincount(group, (b["flag"] & EXTRA) == 0)
    return pick_rows(b, (contents[group] > 1) & ((b["flag"] & MARKER) == 0))


# --- the distributed steps -------------------------------------------------------
def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, doc_id, id, text): id with nulls last, key a hash of id and text."""
    doc_id, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.xxhash64(doc_id, text).alias("key"), doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(NULL_ID)).alias("id"), text.alias("text"))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """One row per id and key of ``keyed``: rows that repeat with id and text
    meet once, and results go back to all of them. Repeats are dropped within
    each task before the shuffle; where none repeats, texts are not moved."""
    repeated = rows.groupBy("id", "key").agg(F.count("*").alias("n")).where("n > 1")
    return rows if repeated.isEmpty() else rows.dropDuplicates(["id", "key"])


def dealer(parts: int):
    """Functions that put records on their way: blocks dealt by both hashes or
    by pick, results spread evenly."""

    def by_content(b):
        return deal(BLOCKS, b, BLOCK, ((b["pick"] ^ (b["content"] >> np.uint64(7))) % np.uint64(parts)).astype(np.int64))

    def by_pick(b):
        return deal(BLOCKS, b, ASK, (b["pick"] % np.uint64(parts)).astype(np.int64))

    def results(spans, contested):
        return (deal(REPEATS, spans, SPAN, spans["key"] % parts) if spans is not None else []) + \
               (deal(CONTESTED, contested, OPEN, contested["key"] % parts) if contested is not None else [])

    return by_content, by_pick, results


def partitions(spark: SparkSession) -> int:
    """Tasks of a shuffle, as the session sets them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def collected(batches):
    """All packed rows of a task, by kind."""
    found: dict[int, list[bytes]] = {BLOCKS: [], REPEATS: [], CONTESTED: []}
    for batch in batches:
        for kind, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            found[kind].append(data)
    return found


def block_table(rows: DataFrame, block_maker, same_document: bool) -> DataFrame:
    """Steps 1 and 2 for the documents of ``distinct_rows``: packed rows of repeats
    (SPAN) and of contested blocks (OPEN), written to the shared folder.
    ``block_maker()`` gives a function from a record batch to the blocks of its rows."""
    parts = partitions(rows.sparkSession)

    def make(batches):
        by_content, _, results = dealer(parts)
        blocks, held, size = block_maker(), [], 0

        def flush():
            b = {name: np.concatenate([h[name] for h in held]).astype(dtype) for name, dtype in BLOCK}
            stays, spans = settle(b, same_document)
            return batch_of(by_content(stays) + results(spans, None))

        for batch in batches:
            for b in blocks(batch):
                held.append(b)
                size += len(b["pick"])
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def meet_by_content(batches):
        _, by_pick, results = dealer(parts)
        found = collected(batches)
        stays, spans = settle(unpack(found[BLOCKS], BLOCK), same_document)
        sure, asks = first_look(stays)
        yield batch_of([(REPEATS, i % parts, d) for i, d in enumerate(found[REPEATS])])
        yield batch_of(by_pick(asks) + results(spans, sure))

    def meet_by_pick(batches):
        _, _, results = dealer(parts)
        found = collected(batches)
        yield batch_of([(kind, 0, d) for kind in (REPEATS, CONTESTED) for d in found[kind]] + results(None, second_look(unpack(found[BLOCKS], ASK))))

    out = (rows.mapInArrow(make, PACKED).repartitionById(parts, "to").mapInArrow(meet_by_content, PACKED)
           .repartitionById(parts, "to").mapInArrow(meet_by_pick, PACKED))
    return saved(out, free=True)


def rows_of(packed: DataFrame, kind: int, layout: list, schema: str) -> DataFrame:
    """Packed rows of one kind as a table; unsigned values keep their bits."""

    def open_(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                c = unpack([data], layout)
                arrays = [pa.array(c[name].view("<i8") if d == "<u8" else c[name]) for name, d in layout]
                yield pa.RecordBatch.from_arrays(arrays, [name for name, _ in layout])

    return packed.where(F.col("kind") == kind).select("data").mapInArrow(open_, schema)


def repeats_of(packed: DataFrame) -> DataFrame:
    return rows_of(packed, REPEATS, SPAN, "key long, id long, start int, n int, from_id long, from_key long, from_start int")


def contested_of(packed: DataFrame) -> DataFrame:
    return rows_of(packed, CONTESTED, OPEN, "key long, id long, start int, n int, pick long")


def single_windows(rows: DataFrame, window_maker, same_document: bool) -> DataFrame:
    """Repeats among single windows, packed. ``window_maker()`` gives a
    function from a record batch of ``rows`` to windows as blocks of one."""
    parts = partitions(rows.sparkSession)

    def make(batches):
        by_content, _, results = dealer(parts)
        windows = window_maker()
        for batch in batches:
            for b in windows(batch):
                stays, spans = settle(b, same_document)
                yield batch_of(by_content(stays) + results(spans, None))

    def meet(batches):
        _, _, results = dealer(parts)
        found = collected(batches)
        _, spans = settle(unpack(found[BLOCKS], BLOCK), same_document)
        yield batch_of([(REPEATS, 0, d) for d in found[REPEATS]] + results(spans, None))

    return rows.mapInArrow(make, PACKED).repartitionById(parts, "to").mapInArrow(meet, PACKED)


def with_spans(rows: DataFrame, spans: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Documents with their spans as a list ``spans``; a group is one document.
    Rows that repeat with id and text share their spans."""
    lists = spans.groupBy("id", "key").agg(F.collect_list(F.struct(*columns)).alias("spans"))
    return rows.join(lists, ["id", "key"], how)


def list_column(column: pa.Array, fields: list[str]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Bounds and fields of a column of lists of structs; nulls are empty."""
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    return np.concatenate([[0], np.cumsum(size)]).astype(np.int64), {f: flat.field(f).to_numpy(zero_copy_only=False) for f in fields}


def covered(starts: np.ndarray, n: np.ndarray, width: int, size: int) -> np.ndarray:
    """Symbols covered by the windows of some spans."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + n - 1 + width, -1)
    return np.cumsum(change[:-1]) > 0
