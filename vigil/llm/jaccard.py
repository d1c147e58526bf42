"""N-gram Jaccard join with a token-group matrix.

A document's set holds its distinct shingles of ``words`` lower-cased words;
two documents are linked when 100 * intersection >= percent * union. Result:
for every document its set size and the smallest id it reaches over links.

Method. Equal sets are one class. Similar sets are partitioned into groups: a
set's prefix (its first shingles in one order of all shingles, rare ones first)
must share ``need`` shingles with that of any linked set, so shingles that no
other prefix holds, and sets with too few shared ones, drop out. That is done
twice: by an order from a sample over all sets, then by exact frequencies among
the sets left, so that shingles of a large family don't fill the prefixes when
a corpus outgrows the sample. The rest are grouped by the last of their shared
prefix shingles, large groups in blocks of bounded size.
The token-group matrix holds, per group, the union of its members' shingles: its
prefix part is a table (token, group) that names the other groups a set must ask,
and the whole union is built where the group's members meet. A set that asks a
group first counts its shingles in that union; only if they reach the
percentage of its own size is the group opened, and the set compared exactly
with each member.

Since only classes are wanted, no pair is compared twice over: inside a group,
sets already in its largest class don't ask; between groups, after a first
round in which a few sets of each group ask another group, classes are ranked by
size, and a set only asks groups that hold a class of higher rank than its own:
of two sets in different classes, the one of lower rank asks. Every pair of linked sets is then
either compared or known to be in one class. Groups send class labels, not pairs.

Shingles are 62-bit hashes, classes of equal sets 64-bit hashes and the size.

Cases: without words (null, empty or blank text) the set is empty and linked
with nothing; with fewer words than a shingle the whole sequence is one
shingle; repeated rows are linked with each other; a null id is kept as a row
whose class is the smallest id of the others in it, or null; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm import repeats as R
from vigil.llm.graph import components
from vigil.llm.tables import saved
from vigil.llm.text import Powers, byte_values, column_bytes, gram_hashes, mix, text_slices, word_hashes, word_spans

WORDS = 4
PERCENT = 85
SAMPLE = 20_000  # documents whose shingles tell which ones are frequent
SAMPLE_CHARS = 50_000
FREQUENT = 5  # in so many of them
BLOCK_SETS = 1024
BLOCK_TOKENS = 2_000_000
ASKING = 8  # sets of each block that ask another one in the first round


def set_reader(words: int):
    """Function from a record batch with ``text`` to pieces of it: (batch,
    shingles sorted within each text, first shingle of each text)."""
    table, pows = byte_values(2, lower=True), Powers()

    def read(batch):
        for part in text_slices([batch], "text"):
            data, offsets = column_bytes(part.column("text"))
            starts, ends, first = word_spans(data, offsets)
            w = word_hashes(data, starts, ends, [table], pows)[0]
            size = np.diff(first)
            grams = gram_hashes(w, words) >> np.uint64(2)
            # grams inside one document; a short document is one gram of all its words
            doc = np.repeat(np.arange(len(size)), size)
            whole = doc[:len(grams)] == doc[words - 1:] if len(grams) else np.zeros(0, bool)
            grams, doc = grams[whole], doc[:len(whole)][whole]
            short = np.flatnonzero((size > 0) & (size < words))
            if len(short):
                own = np.array([gram_hashes(w[first[d]:first[d + 1]], int(size[d]), 7)[0] for d in short], np.uint64) >> np.uint64(2)
                grams, doc = np.concatenate([grams, own]), np.concatenate([doc, short])
            order = np.lexsort((grams, doc))
            grams, doc = grams[order], doc[order]
            new = np.ones(len(grams), bool)
            new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
            grams, doc = grams[new], doc[new]
            yield part, grams, np.searchsorted(doc, np.arange(len(size) + 1))

    return read


def fingerprints(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number per set: sum of its scrambled shingles, and its size."""
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams, 5), dtype=np.uint64)])
        return mix((total[first[1:]] - total[first[:-1]]) ^ (np.diff(first).astype(np.uint64) << np.uint64(40)), 6)


def at_least(size: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set shares with any linked set."""
    return -(-percent * size // 100)


def spare(size: np.ndarray) -> np.ndarray:
    """How many shared shingles a prefix is made long enough for."""
    return 1 + size * 3 // 100


def frequent_shingles(rows: DataFrame, words: int) -> np.ndarray:
    """Sorted shingles that ``FREQUENT`` or more documents of a sample of about
    ``SAMPLE`` hold. They come last in the order of shingles; any list gives
    right results. At most 1 / FREQUENT of the sample's shingles come back."""
    parts = R.partitions(rows.sparkSession)
    share = min(1.0, SAMPLE / max(1, rows.count()))
    sample = rows.where((F.char_length("text") <= SAMPLE_CHARS) & (F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < (1 << 30) * share)).select("text")
    layout = [("token", "<u8")]

    def send(batches):
        read = set_reader(words)
        for batch in batches:
            for _, grams, _ in read(batch):
                to = np.sort(grams % np.uint64(parts))
                order = grams[np.argsort(grams % np.uint64(parts), kind="stable")]
                cuts = np.flatnonzero(np.diff(to)) + 1
                yield R.batch_of([(0, int(p[0] % np.uint64(parts)), R.pack({"token": p}, layout)) for p in np.split(order, cuts) if len(p)])

    def count(batches):
        tokens, n = np.unique(R.unpack([x for b in batches for x in b.column(2).to_pylist()], layout)["token"], return_counts=True)
        yield R.batch_of([(0, 0, R.pack({"token": tokens[n >= FREQUENT]}, layout))])

    found = sample.mapInArrow(send, R.PACKED).repartitionById(parts, "to").mapInArrow(count, R.PACKED).select("data").collect()
    return np.sort(R.unpack([bytes(r["data"]) for r in found], layout)["token"])


def prefix_maker(words: int, percent: int, frequent):
    """Prefixes of the sets as records (pick: shingle, content: set)."""

    def make():
        read, last = set_reader(words), frequent.value

        def blocks(batch):
            for _, grams, first in read(batch):
                size = np.diff(first)
                prints = fingerprints(grams, first)
                # each set once
                _, one = np.unique(prints, return_index=True)
                one = one[size[one] > 0]
                doc = np.repeat(np.arange(len(size)), size)
                late = np.zeros(len(grams), bool)
                if len(last):
                    late = last[np.minimum(np.searchsorted(last, grams), len(last) - 1)] == grams
                token = grams | (late.astype(np.uint64) << np.uint64(62))
                order = np.lexsort((token, doc))
                place = np.arange(len(grams)) - np.repeat(first[:-1], size)
                length = size - at_least(size, percent) + spare(size)
                keep = np.isin(doc, one) & (place < length[doc])  # order keeps documents apart
                token, doc = token[order][keep], doc[keep]
                yield {"pick": token, "content": prints[doc], "id": np.zeros(len(doc), np.int64), "key": prints[doc].view(np.int64), "start": np.zeros(len(doc), np.int64),
                       "n": size[doc], "flag": np.zeros(len(doc), np.uint8)}

        return blocks

    return make


def set_table(rows: DataFrame, words: int) -> DataFrame:
    """(id, key, doc_id, fp, size) of every document."""

    def run(batches):
        read = set_reader(words)
        for batch in batches:
            for part, grams, first in read(batch):
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("key"), part.column("doc_id"), pa.array(fingerprints(grams, first).view(np.int64)), pa.array(np.diff(first), pa.int64())],
                                                 ["id", "key", "doc_id", "fp", "size"])

    return rows.select("id", "key", "doc_id", "text").mapInArrow(run, "id long, key long, doc_id long, fp long, size long")


def shingle_rows(texts: DataFrame, words: int) -> DataFrame:
    """(fp, size, token) for every shingle of every set of ``texts`` (fp, text)."""

    def run(batches):
        read = set_reader(words)
        for batch in batches:
            for part, grams, first in read(batch):
                size = np.diff(first)
                fp = part.column("fp").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(fp, size)), pa.array(np.repeat(size, size), pa.int64()), pa.array(grams.view(np.int64))], ["fp", "size", "token"])

    return texts.select("fp", "text").mapInArrow(run, "fp long, size long, token long")


def rare_prefixes(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(fp, size, token, n): prefixes of the sets of ``texts``, shingles ordered
    by the number ``n`` of these sets that hold them. Shingles of one set come
    first; they take their places and are left out."""
    counted = shingle_rows(texts, words).withColumn("n", F.count("*").over(Window.partitionBy("token"))).where("n > 1")
    own = Window.partitionBy("fp")
    place = F.col("size") - F.count("*").over(own) + F.row_number().over(own.orderBy("n", "token"))
    length = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1 + F.floor(F.col("size") * 3 / 100)  # as in prefix_maker
    return counted.withColumn("place", place).where(F.col("place") <= length).drop("place")


class Group:
    """The members of a group: their shingles by token, and their union."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.size, self.percent = np.array([len(s) for s in sets]), percent
        token, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(token, kind="stable")
        self.owner = owner[order]
        self.union, self.first = np.unique(token[order], return_index=True)
        self.first = np.append(self.first, len(token))

    def linked(self, tokens: np.ndarray) -> np.ndarray:
        """Members linked with a set. The union bounds the overlap first."""
        at = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        at = at[self.union[at] == tokens]
        if 100 * len(at) < self.percent * len(tokens):
            return np.zeros(0, np.int64)  # the group stays closed
        n = self.first[at + 1] - self.first[at]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[at], n)
        shared = np.bincount(self.owner[inside], minlength=len(self.size))
        return np.flatnonzero(100 * shared >= self.percent * (self.size + len(tokens) - shared))


def classes_within(sets: list[np.ndarray], group: Group) -> np.ndarray:
    """Class of each member (number of its first member). Every member outside
    the largest class has asked the group."""
    label, size = np.arange(len(sets)), np.ones(len(sets), np.int64)
    asked, main = np.zeros(len(sets), bool), 0
    while True:
        waiting = np.flatnonzero(~asked & (label != main))
        if not asked[0]:
            q = 0
        elif len(waiting):
            q = int(waiting[0])
        else:
            return label
        asked[q] = True
        near = np.unique(label[np.append(group.linked(sets[q]), q)])
        if len(near) > 1:
            label[np.isin(label, near)] = near[0]
            size[near[0]] = size[near].sum()
        if size[near[0]] > size[main] or label[main] != main:
            main = int(near[0])


def meet_groups(members: DataFrame, visits: DataFrame, words: int, percent: int, classes: bool) -> DataFrame:
    """Open the groups: ``members`` (block, fp, label, text) and ``visits``
    (block, fp, label, text). Rows out: (fp, block, label, visitor): for ``classes``, each member's
    class in its group, named by a member; and for each linked visitor the
    label (or class) of the members it is linked with. Groups with many
    visitors meet them in slices."""
    slices = visits.groupBy("block").agg(F.ceil(F.count("*") / F.lit(2 * BLOCK_SETS)).cast("int").alias("slices"))
    inside = (members.join(slices, "block", "left").withColumn("slice", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)))
              .select("block", "slice", "fp", "label", "text", F.lit(False).alias("visitor")))
    outside = visits.join(slices, "block").select("block", F.pmod(F.hash("fp"), F.col("slices")).alias("slice"), "fp", "label", "text", F.lit(True).alias("visitor"))
    schema = "fp long, block long, label long, visitor boolean"

    def open_(table: pa.Table) -> pa.Table:
        read = set_reader(words)
        sets, fps, labels, visitor = [], [], [], []
        for batch in table.to_batches():
            for part, grams, first in read(batch):
                sets += [grams[first[i]:first[i + 1]] for i in range(part.num_rows)]
                for out, name in ((fps, "fp"), (labels, "label"), (visitor, "visitor")):
                    out += part.column(name).to_pylist()
        _, one = np.unique(np.array(fps, np.int64) * 2 + np.array(visitor, np.int64), return_index=True)  # repeated rows
        here, there = [i for i in one if not visitor[i]], [i for i in one if visitor[i]]
        rows = []
        if here:
            group = Group([sets[i] for i in here], percent)
            own = np.array([labels[i] for i in here], np.int64)
            if classes:
                own = np.array([fps[i] for i in here], np.int64)[classes_within([sets[i] for i in here], group)]
                if table.column("slice")[0].as_py() == 0:
                    rows += [(fps[i], int(o), False) for i, o in zip(here, own)]
            for i in there:
                rows += [(fps[i], int(o), True) for o in np.unique(own[group.linked(sets[i])]) if classes or o != labels[i]]
        block = table.column("block")[0].as_py()
        return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([block] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                         pa.array([r[2] for r in rows], pa.bool_())], ["fp", "block", "label", "visitor"])

    return inside.unionByName(outside).groupBy("block", "slice").applyInArrow(open_, schema)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, ``key`` (hash of
    id and text) and ``class`` (a number per class of linked documents, null for empty sets)."""
    spark = docs.sparkSession
    rows = R.keyed(docs, id_col, text_col)
    sets = saved(set_table(rows, words))
    once = R.distinct_rows(rows.select("key", "id", "text"))
    frequent = spark.sparkContext.broadcast(frequent_shingles(once, words))
    shared = R.contested_of(R.block_table(once, prefix_maker(words, percent, frequent), same_document=True))
    frequent.destroy()  # its readers have written their table
    shared = shared.select(F.col("key").alias("fp"), F.col("n").cast("long").alias("size"))
    # sets with fewer shared prefix shingles than any linked pair has are linked with none
    need = 1 + F.floor(F.ceil(F.col("size") * percent / 100) * 3 / 100)
    left = shared.groupBy("fp").agg(F.first("size").alias("size"), F.count("*").alias("n")).where(F.col("n") >= need).select("fp")
    first_row = sets.groupBy("fp").agg(F.min(F.struct("id", "key")).alias("one")).select("fp", "one.*")
    texts = saved(once.join(left.join(first_row, "fp"), ["id", "key"]).select("fp", "text"), free=True)
    # the same with exact frequencies among the sets left; a set's group is the last of its
    # shared shingles (frequent ones come last), so that similar sets meet in few groups
    shared = rare_prefixes(texts, words, percent).withColumn("sets", F.count("*").over(Window.partitionBy("token"))).where("sets > 1")
    own = Window.partitionBy("fp")  # one set's prefix
    shared = (shared.withColumn("shares", F.count("*").over(own)).withColumn("first", F.max(F.struct("n", "token")).over(own)["token"])
              .where(F.col("shares") >= need).select("fp", "size", "token", "first"))
    shared = saved(shared, free=True)
    heads = shared.groupBy("fp").agg(F.first("size").alias("size"), F.first("first").alias("first"))
    large = (heads.groupBy("first").agg(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("size") / BLOCK_TOKENS)).alias("blocks"))
             .where(F.col("blocks") > 1))  # groups of more than one block are few
    block = F.xxhash64("first", F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1)))).alias("block")
    sets_in = saved(heads.join(large, "first", "left").select("fp", "size", block), free=True)
    shared = shared.join(large, "first", "left").select("fp", "size", "token", block)
    # the token-group matrix over prefixes, where a shingle is in more than one group
    across = shared.groupBy("token").agg(F.min("block").alias("lo"), F.max("block").alias("hi")).where(F.col("lo") != F.col("hi")).select("token")
    shared = saved(shared.join(across, "token", "left_semi"), free=True)  # (fp, size, token, block)
    matrix = shared.groupBy("token", "block").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    texts = texts.join(sets_in.select("fp", "block"), "fp")
    size_fits = (F.col("high") * 100 >= F.col("size") * percent) & (F.col("low") * percent <= F.col("size") * 100)

    # first round: classes inside each group; a few sets of each ask one other group
    some = Window.partitionBy("block").orderBy(F.xxhash64("fp"), "fp")
    asking = sets_in.withColumn("k", F.row_number().over(some)).where(F.col("k") <= ASKING).select("fp")
    least = matrix.groupBy("token").agg(F.min(F.struct("block", "low", "high")).alias("m")).select("token", "m.*")  # one row a token
    asked = (shared.join(asking, "fp").alias("q").join(least.alias("m"), (F.col("q.token") == F.col("m.token")) & (F.col("m.block") < F.col("q.block")) & size_fits)
             .groupBy("q.fp").agg(F.min("m.block").alias("block")))
    asked = saved(asked, free=True)  # who asks whom stands in a plan three times and more
    none = F.lit(0).cast("long").alias("label")
    visits = asked.join(texts.drop("block"), "fp").select("block", "fp", none, "text")
    met = saved(meet_groups(texts.select("block", "fp", none, "text"), visits, words, percent, classes=True), free=True)
    inside = met.where(~F.col("visitor")).select("fp", "block", "label")
    links = met.where("visitor").select("fp", F.col("label").alias("b")).join(inside.select("fp", F.col("label").alias("a")), "fp").select("a", "b")
    joined = components(links).select(F.col("node").alias("label"), "component")
    inside = saved(inside.join(joined, "label", "left").select("fp", "block", F.coalesce("component", "label").alias("label")), free=True)

    # second round: who may still be linked with a member of another class
    # of two sets in different classes the one whose class ranks lower asks the other's block, so that
    # the sets of a large class don't ask their many small neighbours one by one
    ranks = inside.join(inside.groupBy("label").count(), "label").select("fp", "block", "label", F.struct("count", "label").alias("rank"))
    held = matrix.join(ranks.groupBy("block").agg(F.max("rank").alias("top")), "block")
    highest = held.groupBy("token").agg(F.max("top").alias("highest"))
    q = shared.join(ranks.drop("block"), "fp").join(highest, "token").where(F.col("rank") < F.col("highest"))
    fits = (F.col("q.token") == F.col("m.token")) & (F.col("q.block") != F.col("m.block")) & size_fits & (F.col("q.rank") < F.col("m.top"))
    asked = (q.alias("q").join(held.alias("m"), fits).groupBy("q.fp", "m.block", "q.label", "q.size").agg(F.count("*").alias("n"))
             .where(F.col("n") >= need).select("fp", "block", "label"))
    asked = saved(asked, free=True)
    visits = asked.join(texts.drop("block"), "fp").select("block", "fp", "label", "text")
    targets = visits.select("block").distinct()
    members = texts.join(targets, "block", "left_semi").join(inside.select("fp", "label"), "fp").select("block", "fp", "label", "text")
    more = meet_groups(members, visits, words, percent, classes=False).join(inside.select("fp", F.col("label").alias("own")), "fp")
    more = saved(more.select(F.col("own").alias("a"), F.col("label").alias("b")), free=True)
    joined = components(more).select(F.col("node").alias("label"), "component")
    classes = inside.join(joined, "label", "left").select("fp", F.coalesce("component", "label").alias("class"))

    # every document: its set's class, and the smallest id of the class
    every = sets.join(classes, "fp", "left").select("doc_id", "size", "key", F.when(F.col("size") > 0, F.coalesce("class", "fp")).alias("class"))
    least = every.where("size > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    return every.join(least, "class", "left").select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"), "key", "class")


def one_of_each(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Documents without their near copies: of each class the row with the
    smallest id (nulls last) stays, of repeated rows one; documents with empty
    sets stay all. ``docs`` has doc_id and text; its columns travel as one
    struct, so their names clash with nothing. A row is known by its id and a
    hash of id and text."""
    found = jaccard_components(docs, words=words, percent=percent)
    stays = found.where("class is not null").groupBy("class").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(R.NULL_ID)).alias("id"), "key")).alias("first"))
    stays = stays.select("first.id", "first.key")
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(doc_id, F.lit(R.NULL_ID)).alias("id"), F.xxhash64(doc_id, text).alias("key"),
                       (~text.rlike(r"[^\x20\x09-\x0D]")).alias("blank"))
    kept = rows.where("NOT blank").dropDuplicates(["id", "key"]).join(stays, ["id", "key"], "left_semi")
    return kept.select("row.*").unionByName(rows.where("blank").select("row.*"))


def op2_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and class of every document."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT row, len(words) AS n, unnest(words) AS word, unnest(range(len(words))) AS i FROM d),
g AS (SELECT row, i, n, string_agg(word, ' ') OVER (PARTITION BY row ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS gram FROM w),
s AS (SELECT DISTINCT row, md5_number(gram) AS gram FROM g WHERE i + 4 <= n OR i = 0),
z AS (SELECT row, count(*) AS size, md5(string_agg(gram, ' ' ORDER BY gram)) AS print FROM s GROUP BY row),
e AS (SELECT print, min(row) AS row, any_value(size) AS size FROM z GROUP BY print),  -- one row of each set
l AS (SELECT a.row AS a, b.row AS b FROM e JOIN s a USING (row) JOIN s b USING (gram) JOIN e f ON f.row = b.row
      WHERE a.row < b.row GROUP BY a.row, b.row, e.size, f.size HAVING 100 * count(*) >= 85 * (e.size + f.size - count(*))),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT row AS a, row AS b FROM e UNION SELECT r.a, o.b FROM reach r JOIN both_ways o ON o.a = r.b),
o AS (SELECT e.print, min(doc_id) AS least FROM e JOIN reach ON a = e.row JOIN e f ON f.row = b JOIN z ON z.print = f.print JOIN d ON d.row = z.row GROUP BY e.print)
SELECT doc_id, coalesce(size, 0) AS n_shingles, coalesce(least, doc_id) AS component_id
FROM d LEFT JOIN z USING (row) LEFT JOIN o USING (print)
"""

QUERIES = {"op2_token_groups": op2_token_groups}
ORACLE = {"op2_token_groups": SQL}
