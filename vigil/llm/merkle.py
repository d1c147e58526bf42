"""Merkle manifest of a dataset, checked leaf by leaf with a recursive query.

Every row is a leaf: the hash of its columns. Per group, leaves in id order
are joined in runs of ``FAN`` to parent hashes until one node, the group's
root, is left; the groups' roots in group order give the dataset's root in the
same way. Digests enter other digests as lower-case hex text; inside the
tables they are binary.

Built levels are stored as node rows, each linked to its ancestor: a row holds
a node, the siblings to its left and right on each of ``HOP`` levels, and the
node ``HOP`` levels up (``BLOCK`` nodes have that ancestor; a block is hashed
in one task, as arrays of 32-byte digests). A recursive query then climbs from
every leaf: each round joins one link, appends its siblings to the leaf's
proof and folds them into the leaf's hash, up to the root. Above the first hop
all leaves of a block share their links, which are stored once for each block,
so that no key of a round's join has more than ``BLOCK`` rows, however large
the group. Up to ``SMALL`` of these links are broadcast.

Cases: nulls in any column are marked in the leaf; a null group is a group, the
first one; null ids come first; rows of equal id and group stand in the order
of their leaves, so equal rows are alike; a group of one row is its own root; a
row without id is never tampered with; an empty table gives no rows; texts may
be of any length (each is hashed where it is read); other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.places import numbered
from vigil.llm.resample import CRC_TABLE, crc_sql
from vigil.llm.tables import saved

FAN = 3
HOP = 6
BLOCK = FAN**HOP
STEPS = "array<struct<left: binary, right: binary>>"
SMALL = 20_000  # links of blocks that are broadcast, some 700 bytes each
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def leaf_hash(*columns: Column) -> Column:
    """SHA-256 of the columns: ``-`` for a null, else UTF-8 bytes, ``:``, value."""
    fields = [F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")) for c in columns]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(f, F.lit("-")) for f in fields]), 256))


def level_paths(nodes: list[bytes], whole: bool, fan: int = FAN, hop: int = HOP) -> tuple[list[list[tuple[bytes, bytes]]], bytes]:
    """For each node of a block its siblings, left and right, on up to ``hop``
    levels, and the block's top. A block that is its whole level ends at one
    node; others go up all levels."""
    levels = [nodes]
    while len(levels) <= hop and not (whole and len(levels[-1]) == 1):
        low = levels[-1]
        levels.append([hashlib.sha256("".join(x.hex() for x in low[i:i + fan]).encode()).digest() for i in range(0, len(low), fan)])
    paths: list[list[tuple[bytes, bytes]]] = [[]]  # of the top
    for low in reversed(levels[:-1]):
        steps = []
        for i in range(len(low)):
            first = i - i % fan
            steps.append([(b"".join(low[first:i]), b"".join(low[i + 1:first + fan])), *paths[i // fan]])
        paths = steps
    return paths, levels[-1][0]


def links(nodes: DataFrame, by: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Node rows (by, place, places, node, carry) with ``steps``, their
    siblings on each level up to ``top``, the top of their block."""
    kept = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}
    fields = ["place", "node", *carry]
    blocks = nodes.groupBy(*by, "places", F.expr(f"place DIV {BLOCK}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("nodes")).drop("block")  # at most BLOCK
    names = [*by, "places", *fields, "steps", "top"]
    schema = ", ".join(f"`{c}` {kept[c]}" for c in names[:-2]) + f", steps {STEPS}, top binary"
    steps_type = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))
    shared = [*by, "places"]

    def link(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # one block at a time
                held = batch.slice(i, 1)
                rows = held.column("nodes").flatten()
                inner = rows.type
                columns = [rows.field(inner.get_field_index(f)) for f in fields]
                n = len(rows)
                paths, top = level_paths(columns[1].to_pylist(), held.column("places")[0].as_py() <= BLOCK)
                steps = pa.array([[{"left": a, "right": b} for a, b in p] for p in paths], steps_type)
                same = [pa.repeat(held.column(c)[0], n) for c in shared]
                yield pa.RecordBatch.from_arrays([*same, *columns, steps, pa.array([top] * n, pa.binary())], names)

    return saved(blocks.mapInArrow(link, schema))


def built_stages(nodes: DataFrame, by: Sequence[str], carry: Sequence[str] = ()) -> list[DataFrame]:
    """Links of all stages, from the nodes up: the tops of one stage's blocks
    are the nodes of the next. None for no nodes."""
    most = nodes.agg(F.max("places")).first()[0]
    stages = []
    while most:
        stages.append(links(nodes, by, carry if not stages else ()))
        if most <= BLOCK:
            break
        most = -(-most // BLOCK)
        nodes = stages[-1].where(f"place % {BLOCK} = 0").selectExpr(
            *by, f"place DIV {BLOCK} AS place", f"(places + {BLOCK - 1}) DIV {BLOCK} AS places", "top AS node")
    return stages


def block_links(stages: list[DataFrame], roots: DataFrame, root_stages: list[DataFrame], group: str) -> DataFrame:
    """Links above the first stage, once for each block of leaves: (group,
    block, stage, steps, subroot, root); ``roots`` has each group's root."""
    blocks = stages[0].where(f"place % {BLOCK} = 0").selectExpr(group, f"place DIV {BLOCK} AS block")
    group_roots = roots.select(F.col(group).alias("_group"), F.col("node").alias("subroot"), F.col("place").alias("_root_place"))
    root = root_stages[-1].where("place = 0").select("top").first()[0]  # one digest
    blocks = saved(blocks.join(group_roots, F.col(group).eqNullSafe(F.col("_group"))).drop("_group"))
    out = None
    for n, stage in enumerate(stages[1:] + root_stages):
        up = n - len(stages) + 1
        if up < 0:
            at = F.expr(f"block DIV {BLOCK ** n}L")
            rows = stage.select(F.col(group).alias("_group"), F.col("place").alias("_place"), "steps")
            found = blocks.join(rows, F.col(group).eqNullSafe(F.col("_group")) & (at == F.col("_place")))
        else:
            at = F.expr(f"_root_place DIV {BLOCK ** up}L")
            found = blocks.join(stage.select(F.col("place").alias("_place"), "steps"), at == F.col("_place"))
        found = found.select(group, "block", F.lit(n + 1).alias("stage"), "steps", "subroot", F.lit(root).alias("root"))
        out = found if out is None else out.unionByName(found)
    return saved(out)


FOLD = "aggregate({steps}, {node}, (h, s) -> unhex(sha2(concat(lower(hex(s.left)), lower(hex(h)), lower(hex(s.right))), 256)))"
SIBLINGS = "aggregate({steps}, {proof}, (p, s) -> concat(p, s.left, s.right))"
CLIMB = f"""
WITH RECURSIVE climb (doc_id, leaf, grp, block, stage, folded, proof, subroot, root) AS (
  SELECT doc_id, leaf, grp, block, 1, {FOLD.format(steps="steps", node="shown")}, {SIBLINGS.format(steps="steps", proof="X''")},
         CAST(NULL AS BINARY), CAST(NULL AS BINARY)
  FROM {{leaves}}
  UNION ALL
  SELECT {{{{hint}}}} c.doc_id, c.leaf, c.grp, c.block, c.stage + 1, {FOLD.format(steps="n.steps", node="c.folded")},
         {SIBLINGS.format(steps="n.steps", proof="c.proof")}, n.subroot, n.root
  FROM climb c JOIN {{nodes}} n ON n.stage = c.stage AND n.block = c.block AND n.grp <=> c.grp)
SELECT doc_id, lower(hex(leaf)) AS leaf, lower(hex(subroot)) AS subroot, lower(hex(root)) AS root,
       sha2(lower(hex(proof)), 256) AS proof_sha256, lower(hex(folded)) AS folded_root, folded = root AS verified
FROM climb WHERE stage = {{last}}
"""


def merkle_manifest(docs: DataFrame, leaf: Column, shown: Column, id_col: str = "doc_id", group_col: str = "source") -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256 (hash of
    its proof), folded_root and verified: whether the hash ``shown`` (binary)
    in the place of ``leaf`` folds to the root along the leaf's proof."""
    spark = docs.sparkSession
    leaves = saved(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(group_col).alias("grp"), leaf.alias("node"), shown.alias("shown")))
    stages = built_stages(numbered(leaves, ["grp"], [F.asc_nulls_first("doc_id"), F.col("node")]), ["grp"], ("doc_id", "shown"))
    if not stages:
        texts = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
        return leaves.select("doc_id", *[F.lit(None).cast("string").alias(c) for c in texts], F.lit(None).cast("boolean").alias("verified"))
    roots = numbered(stages[-1].where("place = 0").select("grp", F.col("top").alias("node")), [], [F.asc_nulls_first("grp")])
    root_stages = built_stages(roots, [])
    above = block_links(stages, roots, root_stages, "grp")
    hint = "/*+ BROADCAST(n) */" if above.count() <= SMALL else ""  # counted; more of them meet the leaves by key
    start = stages[0].selectExpr("doc_id", "node AS leaf", "shown", "grp", f"place DIV {BLOCK} AS block", "steps")
    # a limit on the rows of recursive queries guards against endless ones; the rounds here are as many as stages
    limit = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return saved(spark.sql(CLIMB.replace("{{hint}}", hint), leaves=start, nodes=above, last=len(stages) + len(root_stages)))
    finally:
        spark.conf.set(ROW_LIMIT, limit)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and roots; half of them are shown without
    line breaks."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf, tampered = (leaf_hash(*before, text) for text in (F.col("text"), F.translate("text", "\n", "")))
    change = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    return merkle_manifest(docs, leaf, F.when(change, tampered).otherwise(leaf))


def field_sql(c: str, value: str | None = None) -> str:
    value = value or f"CAST({c} AS VARCHAR)"
    return f"coalesce(octet_length(encode({value})) || ':' || {value}, '-')"


HEAD = " || ".join(field_sql(c) for c in ("doc_id", "source", "lang", "n_chars"))
SQL = f"""
WITH RECURSIVE {CRC_TABLE},
a AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp, sha256({HEAD} || {field_sql("text")}) AS leaf,
         sha256({HEAD} || {field_sql("text", "replace(text, chr(10), '')")}) AS changed,
         coalesce({crc_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0, false) AS tampered
  FROM documents, crc_table),
b AS (
  SELECT row_number() OVER () AS row, doc_id, grp, leaf, CASE WHEN tampered THEN changed ELSE leaf END AS shown,
         row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY grp) AS places
  FROM a),
t AS (
  SELECT grp, 0 AS level, place, places, leaf AS node FROM b
  UNION ALL
  SELECT grp, level + 1, place // {FAN}, (places + {FAN - 1}) // {FAN}, sha256(string_agg(node, '' ORDER BY place))
  FROM t WHERE places > 1 GROUP BY grp, level, place // {FAN}, places),
g AS (SELECT grp, node AS subroot, (SELECT max(grp) + 1 FROM b) AS places FROM t WHERE places = 1),
u AS (
  SELECT 0 AS level, grp AS place, places, subroot AS node FROM g
  UNION ALL
  SELECT level + 1, place // {FAN}, (places + {FAN - 1}) // {FAN}, sha256(string_agg(node, '' ORDER BY place))
  FROM u WHERE places > 1 GROUP BY level, place // {FAN}, places),
runs AS (  -- the groups' trees, and above them (group -1) the tree of their roots
  SELECT grp, level, place // {FAN} AS run, list(node ORDER BY place) AS nodes FROM t WHERE places > 1 GROUP BY ALL
  UNION ALL
  SELECT -1, level, place // {FAN}, list(node ORDER BY place) FROM u WHERE places > 1 GROUP BY ALL),
climb AS (
  SELECT row, grp AS own, grp, 0 AS level, place, places, shown AS folded, '' AS proof FROM b
  UNION ALL
  SELECT c.row, c.own, r.grp, r.level + 1, c.place // {FAN}, (c.places + {FAN - 1}) // {FAN},
         sha256(array_to_string(nodes[:c.place % {FAN}], '') || c.folded || array_to_string(nodes[c.place % {FAN} + 2:], '')),
         c.proof || array_to_string(nodes[:c.place % {FAN}], '') || array_to_string(nodes[c.place % {FAN} + 2:], '')
  FROM (
    SELECT row, own, CASE WHEN places = 1 THEN -1 ELSE grp END AS grp, CASE WHEN places = 1 AND grp >= 0 THEN 0 ELSE level END AS level,
           CASE WHEN places = 1 AND grp >= 0 THEN grp ELSE place END AS place,
           CASE WHEN places = 1 AND grp >= 0 THEN (SELECT max(places) FROM g) ELSE places END AS places, folded, proof
    FROM climb) c
  JOIN runs r ON r.grp = c.grp AND r.level = c.level AND r.run = c.place // {FAN}
  WHERE c.places > 1),
top AS (
  SELECT row, arg_max(folded, length(proof) * 100 + n) AS folded, arg_max(proof, length(proof) * 100 + n) AS proof
  FROM (SELECT *, CASE WHEN grp = -1 THEN 50 ELSE 0 END + level AS n FROM climb) GROUP BY row),
root AS (SELECT node AS root FROM u WHERE places = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM b JOIN g USING (grp) JOIN top USING (row), root
"""

QUERIES = {"op13_merkle_manifest": op13_merkle_manifest}
ORACLE = {"op13_merkle_manifest": SQL}
