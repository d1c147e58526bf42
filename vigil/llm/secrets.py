"""Secret scan with corpus-wide ownership frequency.

Three base patterns find assignments, access keys and long hex runs; a fourth
finds other random-looking tokens. Every value found is hashed (values never
leave the scanning task) and the hashes are aggregated over the whole corpus by
distinct repositories and distinct owners, exact copies of a text counting
once. A value that more than
``max_owners`` owners or ``max_repos`` repositories hold is a widely copied
example; any other is owner-specific and looks live. Owner-specific random
tokens become additional spans of kind ``owned``; base spans always stay, and
their verdicts are counted.

Cases: a null text is scanned as empty; a null owner or repository counts as
one owner or repository of its own; repeated rows are scanned each; spans are
in code points, end exclusive; rows without any span have empty lists; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.tables import saved

# The base patterns and the least length of each, kinds in order.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # runs of hex digits are maximal, so this equals "a run, then its length"
KEYWORDS = ("passw", "secret", "token", "api")

TOKEN = r"[A-Za-z0-9+/_-]{20,}"
MIN_ENTROPY = 3.0  # bits a character of a random-looking token
MAX_OWNERS = 2
MAX_REPOS = 4
SPAN = "struct<start:int,kind:int,end:int,hash:string>"
SCANNED = f"row long, doc_id long, repo string, owner string, text_a long, text_b long, more array<long>, n_assign long, n_access long, n_hex long, base_sha256 string, found array<{SPAN}>"


def entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def scanner():
    """A function from a text to its spans (start, kind, end, value)."""
    assign, access = re.compile(ASSIGN, re.ASCII | re.IGNORECASE), re.compile(ACCESS)
    # the value's letters are listed in both cases, so ignoring case changes the keyword only
    hexa, token = re.compile(HEX), re.compile(TOKEN)

    def spans(text: str) -> list[tuple[int, int, int, str]]:
        out = []
        low = text.lower()
        if any(k in low for k in KEYWORDS):
            out += [(m.start(), 0, m.end(), m[2]) for m in assign.finditer(text) if len(m[2]) >= 8]
        if "AKIA" in text:
            out += [(m.start(), 1, m.end(), m[0]) for m in access.finditer(text) if len(m[0]) >= 16]
        out += [(m.start(), 2, m.end(), m[0]) for m in hexa.finditer(text)]
        base = sorted(out)
        starts, reach = [a for a, *_ in base], list(accumulate((b for _, _, b, _ in base), max))  # the end of all up to each
        for m in token.finditer(text):
            s, before = m[0], bisect_left(starts, m.end())
            if (any(c.isdigit() for c in s) and any(c.isalpha() for c in s) and entropy(s) >= MIN_ENTROPY
                    and not (before and reach[before - 1] > m.start())):
                out.append((m.start(), 3, m.end(), s))
        return sorted(out)

    return spans


def scan(docs: DataFrame, id_col: str, text_col: str, repo: Column, owner: Column, more: Sequence[str] = ()) -> DataFrame:
    """One row per document with its spans and candidate hashes, the hash of
    its text, and the long columns ``more`` as a list."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(repo, F.lit("")).alias("repo"), F.coalesce(owner, F.lit("")).alias("owner"),
                       F.xxhash64(F.lit(1), text).alias("text_a"), F.xxhash64(F.lit(2), text).alias("text_b"),
                       F.array(*map(F.col, more)).cast("array<long>").alias("more"), text.alias("text"))
    names = ["row", "doc_id", "repo", "owner", "text_a", "text_b", "more", "n_assign", "n_access", "n_hex", "base_sha256", "found"]
    kind_names = KINDS

    def run(batches):
        spans = scanner()
        for batch in batches:
            texts = batch.column(7).to_pylist()
            found = [spans(t) for t in texts]
            counts = [[sum(k == kind for _, k, _, _ in f) for f in found] for kind in range(3)]
            base = [hashlib.sha256(",".join(f"{kind_names[k]}:{a}:{b}" for a, k, b, _ in f if k < 3).encode()).hexdigest() for f in found]
            hashed = [[{"start": a, "kind": k, "end": b, "hash": hashlib.sha256(v.encode()).hexdigest()[:32]} for a, k, b, v in f] for f in found]
            item = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("hash", pa.string())])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(7)), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(base, pa.string()), pa.array(hashed, pa.list_(item))], names)

    return rows.mapInArrow(run, SCANNED)


def ownership(found: DataFrame) -> DataFrame:
    """Distinct owners and repositories of each candidate hash. A text counts
    once, for its least owner and repository, so that copies of one document
    do not look like several owners. Each grouping takes out repeats before the
    shuffle: a value copied into a third of all rows costs a row per task and
    text, then one per task, owner and repository."""
    texts = found.groupBy("hash", "text_a", "text_b").agg(F.min(F.struct("owner", "repo")).alias("by"))
    held = texts.groupBy("hash", F.col("by.owner").alias("owner"), F.col("by.repo").alias("repo")).agg(F.lit(1).alias("one"))
    owners = held.groupBy("hash", "owner").agg(F.count("one").alias("repos"))
    return owners.groupBy("hash").agg(F.count("owner").alias("n_owners"), F.sum("repos").alias("n_repos"))


def secret_spans(docs: DataFrame, repo: Column, owner: Column, id_col: str = "doc_id", text_col: str = "text",
                 max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS, more: Sequence[str] = ()) -> DataFrame:
    """One row per document: counts of the base kinds, ``base_sha256``,
    ``found`` (all reported spans with verdicts, by start and kind) and the
    number of base spans held to be copied examples and owner-specific.

    ``repo`` and ``owner`` are expressions over ``docs``; ``more`` names long
    columns of it to hand through."""
    scanned = saved(scan(docs, id_col, text_col, repo, owner, more))  # small beside the text; read three times
    each = scanned.select("row", "repo", "owner", "text_a", "text_b", F.explode("found").alias("s")).select("row", "repo", "owner", "text_a", "text_b", "s.*")
    verdict = ownership(each).select("hash", ((F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)).alias("live"))
    judged = (each.join(verdict, "hash").where((F.col("kind") < 3) | F.col("live"))
              .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("spans"),
                                  F.count_if((F.col("kind") < 3) & ~F.col("live")).alias("n_copied"),
                                  F.count_if((F.col("kind") < 3) & F.col("live")).alias("n_live")))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,live:boolean>>")
    return (scanned.drop("found", "repo", "owner").join(judged, "row", "left")
            .select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce("spans", none).alias("found"),
                    F.coalesce("n_copied", F.lit(0)).alias("n_copied"), F.coalesce("n_live", F.lit(0)).alias("n_live"), *[F.col("more")[i].alias(c) for i, c in enumerate(more)]))


def redacted(docs: DataFrame, repo: Column, owner: Column, mark: str = "[SECRET]") -> DataFrame:
    """Documents (doc_id, text, ...) whose owner-specific spans are replaced by
    ``mark``, overlapping ones by one; widely copied examples stay. A row is
    found again by 128 bits of hashes of its id and text; its columns travel as
    one struct, so their names clash with nothing."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = [F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), text) for seed in (1, 2)]
    rows = docs.select(F.struct(*docs.columns).alias("row"), key[0].alias("a"), key[1].alias("b"))
    inner = docs.select(key[0].alias("a"), key[1].alias("b"), repo.alias("repo"), owner.alias("owner"), F.col("text").alias("text"))
    found = secret_spans(inner, F.col("repo"), F.col("owner"), id_col="a", more=("b",)).withColumnRenamed("doc_id", "a")
    found = found.select("a", "b", F.filter("found", lambda s: s["live"]).alias("spans")).where(F.size("spans") > 0)
    found = found.groupBy("a", "b").agg(F.first("spans").alias("spans"))  # repeated rows have equal spans
    names = docs.columns
    at = names.index("text")

    def replace(batches):
        for batch in batches:
            row = batch.column(0)
            columns = [row.field(i) for i in range(len(names))]
            texts = []
            for text, spans in zip(columns[at].to_pylist(), batch.column(1).to_pylist()):
                end, out = 0, []
                for s in spans or []:  # by start
                    if s["start"] >= end:
                        out += [text[end:s["start"]], mark]
                    end = max(end, s["end"])
                texts.append("".join(out) + text[end:] if spans else text)
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.join(found, ["a", "b"], "left").select("row", "spans").mapInArrow(replace, docs.schema)


def op3_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document. The table names no repository: a source stands
    for an owner, and a source and language together for a repository."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = secret_spans(docs, F.concat_ws("/", "source", "lang"), F.col("source"))
    kind = F.array(*map(F.lit, KINDS))
    text = F.transform("found", lambda s: F.concat_ws(":", kind[s["kind"]], s["start"].cast("string"), s["end"].cast("string")))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(text, ",").alias("spans"), "n_copied", "n_live")


def found_sql(kind: str, pattern: str, value: str, least: int) -> str:
    """DuckDB: spans of one kind; the pieces between matches give the places."""
    return f"""
  SELECT row, '{kind}' AS kind, list_sum(list_transform(pieces[:k], lambda p: length(p))) + coalesce(list_sum(list_transform(matches[:k - 1], lambda p: length(p))), 0) AS start,
         matches[k] AS match, {value} AS value
  FROM (SELECT row, string_split_regex(text, '{pattern}') AS pieces, regexp_extract_all(text, '{pattern}') AS matches FROM d), unnest(range(1, len(matches) + 1)) AS t(k)
  WHERE length({value}) >= {least}"""


BOTH = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
VALUE = "[A-Za-z0-9+/_.=-]+"
ASSIGN_SQL = rf"""({BOTH})["'']?\x20*[:=]\x20*["'']?({VALUE})"""
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner, concat_ws('/', source, lang) AS repo FROM documents),
base AS (
  SELECT *, start + length(match) AS "end" FROM ({found_sql("assign", ASSIGN_SQL, f"regexp_extract(matches[k], '{ASSIGN_SQL}', 2)", 8)}
  UNION ALL {found_sql("access", "AKIA[A-Z0-9]+", "matches[k]", 16)}
  UNION ALL {found_sql("hex", "[0-9a-f]+", "matches[k]", 32)})),
token AS (SELECT *, start + length(match) AS "end" FROM ({found_sql("owned", "[A-Za-z0-9+/_-]+", "matches[k]", 20)})),
random AS (
  SELECT t.* FROM token t
  WHERE regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
    AND list_sum(list_transform(map_values(list_histogram(string_split(value, ''))), lambda n: -(n / length(value)) * log2(n / length(value)))) >= {MIN_ENTROPY}
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.row = t.row AND b.start < t."end" AND b."end" > t.start)),
spans AS (SELECT *, CASE kind WHEN 'assign' THEN 0 WHEN 'access' THEN 1 WHEN 'hex' THEN 2 ELSE 3 END AS k FROM (SELECT * FROM base UNION ALL SELECT * FROM random)),
texts AS (SELECT value, text, min((owner, repo)) AS held_by FROM spans JOIN d USING (row) GROUP BY value, text),
verdict AS (SELECT value, count(DISTINCT held_by[1]) <= {MAX_OWNERS} AND count(DISTINCT held_by) <= {MAX_REPOS} AS live FROM texts GROUP BY value),
r AS (
  SELECT row, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, k) FILTER (k < 3) AS base,
         string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, k) FILTER (k < 3 OR live) AS spans,
         count(*) FILTER (k < 3 AND NOT live) AS n_copied, count(*) FILTER (k < 3 AND live) AS n_live
  FROM spans JOIN verdict USING (value) GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_copied, 0) AS n_copied, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN r USING (row)
"""

QUERIES = {"op3_secret_ownership": op3_secret_ownership}
ORACLE = {"op3_secret_ownership": SQL}
