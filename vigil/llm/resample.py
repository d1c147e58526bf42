"""Importance resampling towards a target distribution with hashed n-grams.

Texts are brought to lower case (A-Z only) and pre-tokenised by an untrained
``Split`` of the ``tokenizers`` library, whose pattern gives words and their
offsets. A feature is a run of 1 to ``longest`` consecutive words: a window of
offset pairs, its words joined by one space, hashed with CRC-32 into
``buckets`` buckets. The histograms of all documents and of all target texts
give each bucket a gain, the scaled log ratio of its smoothed shares; the mean
gain of a document's features is its weight. A seeded Gumbel value is added to
the weight, and the highest sums are drawn, which samples without replacement
in proportion to exp(weight / 1000).

Each text is read once: its bucket counts (at most ``buckets`` numbers, however
long it is) are written to a table that the histogram and the weights read.
Only histograms come to the driver: one row a bucket, and counts of scores by
steps of ``STEP`` (scores lie within some 100,000 of each other).

Cases: a null or empty text, or one without words, has no features and weight
0, and is not drawn; repeated rows are scored each, hold a place each, and tie
by smaller doc_id, then in any order; a null doc_id is hashed as an empty one
and ties last; long texts are pre-tokenised slice by slice, and a word that a
cut divides is put together again; an empty table gives no rows, empty target
texts leave the smoothing alone; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.places import numbered
from vigil.llm.tables import saved
from vigil.llm.text import text_slices

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST = 1  # words of a feature
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
SLICE = 1 << 18  # characters pre-tokenised at once
STEP = 256
COUNTS = "doc_id long, n_words long, n_features long, buckets array<int>, counts array<long>"


def splitter():
    """Pre-tokeniser that keeps the words of a text."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


def word_offsets(text: str, split, size: int = SLICE) -> Iterator[list[tuple[int, int]]]:
    """Offset pairs of the words of a text, by slices of ``size`` characters."""
    held: list[tuple[int, int]] = []  # a word that reaches the end of its slice
    for at in range(0, len(text), size):
        pairs = [(at + start, at + end) for _, (start, end) in split.pre_tokenize_str(text[at:at + size])]
        if held and pairs and pairs[0][0] == held[0][1]:
            pairs[0] = (held[0][0], pairs[0][1])
        else:
            pairs = held + pairs
        held = [pairs.pop()] if pairs and pairs[-1][1] == at + size < len(text) else []
        yield pairs


def features(text: str, split, longest: int, size: int = SLICE) -> Iterator[tuple[int, list[str]]]:
    """(number of words, runs of 1 to ``longest`` words that end in them) of
    each slice of a text in lower case."""
    before: list[tuple[int, int]] = []
    for pairs in word_offsets(text, split, size):
        words = [text[s:e] for s, e in before + pairs]
        first, runs = len(before), words[len(before):]
        for n in range(2, longest + 1):
            runs += [" ".join(words[i - n + 1:i + 1]) for i in range(max(first, n - 1), len(words))]
        yield len(pairs), runs
        before = (before + pairs)[-(longest - 1):] if longest > 1 else []


class Buckets(dict):
    """Bucket of a feature; keeps those of up to 2**18 short features."""

    def __init__(self, number: int) -> None:
        self.number = number

    def __missing__(self, feature: str) -> int:
        bucket = zlib.crc32(feature.encode()) % self.number
        if len(feature) <= 64:
            if len(self) >= 1 << 18:
                self.clear()
            self[feature] = bucket
        return bucket


def bucket_counts(docs: DataFrame, id_col: str | None = "doc_id", text_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """One row per input row: doc_id, n_words, n_features and the number of
    features in each bucket that has any."""

    def count(batches):
        split, bucket_of = splitter(), Buckets(buckets)
        for batch in text_slices(batches, "text"):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words, found = 0, Counter()
                if text:
                    for n, runs in features(text.encode().lower().decode(), split, longest):  # bytes: A-Z only
                        words += n
                        found.update(map(bucket_of.__getitem__, runs))
                rows.append((doc, words, found.total(), list(found), list(found.values())))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                             ["doc_id", "n_words", "n_features", "buckets", "counts"])

    doc_id = F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")
    return docs.select(doc_id.alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(count, COUNTS)


def histogram(counted: DataFrame) -> dict[int, int]:
    """Features in each bucket, over all rows."""
    pairs = counted.select(F.explode(F.arrays_zip("buckets", "counts")).alias("x"))
    return {r["bucket"]: r["n"] for r in pairs.groupBy(F.col("x.buckets").alias("bucket")).agg(F.sum("x.counts").alias("n")).collect()}  # a row a bucket


def bucket_gains(source: dict[int, int], target: dict[int, int], buckets: int) -> list[int]:
    """Scaled log ratio of the smoothed shares of each bucket."""
    all_s, all_t = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return [math.floor(1000 * math.log((target.get(b, 0) + 1.0) * all_s / ((source.get(b, 0) + 1.0) * all_t))) for b in range(buckets)]


def weights(counted: DataFrame, gains: list[int]) -> DataFrame:
    """doc_id, n_words, n_features and weight, the floored mean gain of a
    document's features."""

    def weigh(batches):
        gain = np.array(gains, np.int64)
        for batch in batches:
            found, number = batch.column("buckets"), batch.column("counts").flatten().to_numpy()
            sums = np.concatenate([[0], np.cumsum(gain[found.flatten().to_numpy()] * number)])
            ends = np.cumsum(found.value_lengths().to_numpy())
            total = sums[ends] - sums[ends - found.value_lengths().to_numpy()]
            n = batch.column("n_features").to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(total // np.maximum(n, 1), pa.int64())], [*batch.schema.names[:3], "weight"])

    return counted.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def cut_score(scored: DataFrame, drawn: int) -> int:
    """The score of the row at place ``drawn`` from the top."""
    low, left = None, drawn
    for step in (STEP, 1):
        here = scored if low is None else scored.where(F.col("score").between(low, low + STEP - 1))
        steps = here.groupBy(F.floor(F.col("score") / step).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
        for s, n in sorted(((r["step"], r["n"]) for r in steps), reverse=True):
            if n >= left:
                low = s * step
                break
            left -= n
    return low


def importance_draw(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, longest: int = LONGEST,
                    buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
                    target_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, and
    rank (from 1) of the ``percent`` percent drawn of those with at least
    ``least_words`` words, null for the others."""
    counted = saved(bucket_counts(docs, id_col, text_col, longest, buckets))
    gains = bucket_gains(histogram(counted), histogram(bucket_counts(target, None, target_col, longest, buckets)), buckets)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = saved(weights(counted, gains).withColumn("score", F.col("weight") + noise))
    fit = F.col("n_words") >= least_words
    drawn = scored.where(fit).count() * percent // 100
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    high = fit & (F.col("score") >= cut_score(scored.where(fit), drawn))
    ranked = numbered(scored.where(high), [], [F.desc("score"), F.asc_nulls_last("doc_id")])
    ranked = ranked.withColumn("rank", F.when(F.col("place") < drawn, F.col("place") + 1)).drop("place", "places")
    return ranked.unionByName(scored.where(~high).withColumn("rank", F.lit(None).cast("long")))


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document weighed against the benchmark texts, a tenth of those
    with 20 words or more drawn."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return importance_draw(read("documents"), read("benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


CRC_TABLE = """
crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM range(256) r(n)))
"""


def crc_sql(text: str) -> str:
    """DuckDB: unsigned CRC-32 of a text's UTF-8 bytes, with ``crc_table.t`` in scope."""
    byte = "(strpos('0123456789ABCDEF', substr(hex(encode({0})), 2 * i + 1, 1)) - 1) * 16 + strpos('0123456789ABCDEF', substr(hex(encode({0})), 2 * i + 2, 1)) - 1"
    data = f"list_transform(range(octet_length(encode({text}))), lambda i: {byte.format(text)})"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {data}), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])))"


SQL = rf"""
WITH {CRC_TABLE},
d AS (SELECT row_number() OVER () AS row, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT row, unnest(regexp_extract_all(text, '{WORD}')) AS w FROM d),
v AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}')) AS w FROM benchmark),
c AS (SELECT w, {crc_sql("w")} % 10000 AS b FROM (SELECT w FROM w UNION SELECT w FROM v), crc_table),
s AS (SELECT b, count(*) AS s FROM w JOIN c USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM v JOIN c USING (w) GROUP BY b),
g AS (SELECT b, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
        / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS g
      FROM s FULL JOIN t USING (b)),
m AS (SELECT row, count(*) AS n, CAST(sum(g) AS BIGINT) AS total FROM w JOIN c USING (w) JOIN g USING (b) GROUP BY row),
x AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, CAST(coalesce((total - ((total % n) + n) % n) // n, 0) AS BIGINT) AS weight,
         CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN m USING (row)),
y AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place FROM y)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= (SELECT count(*) * 10 // 100 FROM y WHERE n_features >= 20) THEN place END AS rank
FROM r
"""

QUERIES = {"op11_target_resampling": op11_target_resampling}
ORACLE = {"op11_target_resampling": SQL}
