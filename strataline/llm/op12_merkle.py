"""Merkle manifest of a dataset, proved by a recursive query that climbs the stored levels.

Rows become leaves, ordered within their source; every 16 consecutive nodes of a source become one node of the next
level until one, the source's subroot, is left; the subroots, ordered by source, become a tree of the same shape above.
Each level is one aggregation over groups of at most 16 rows and is stored as parent-linked node rows: digest, digests
of the children, and where the node stands in its parent.

``proofs`` is one recursive common table expression: each leaf ascends from parent to parent, appends the siblings it
meets to its proof and folds them with its own, possibly tampered, digest until it stands at the root. The leaves of one
run of 16 share all siblings above it and so ascend together, each with a digest of its own: Spark shuffles every level
twice, and proofs carried leaf by leaf took more than three times the input on disk.

Positions are numbered without a task per source: rows are range-partitioned by source and id, and small tables of
counts per partition give the offsets. In the climb an upper node is met by all leaves below it, a third of the corpus
if one source holds as much. So leaves are cut in blocks of 4096 consecutive ones, a node is stored once per block below
it (at most one row per level and block more), and both sides join on block and node: no key has more than 4096 leaves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .shared import stored

RUN = 16
BLOCK = 4096
DIGEST = 32
TOP = -1  # the tree of subroots; a source's tree is named by the number of its first leaf
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A node's place in its parent's run and the parent's place in its tree.
UP = ["slot", "up_tree", "up_level", "up_pos"]


def encoded(value: Column) -> Column:
    """``-`` for null, else the byte count of the decimal or UTF-8 form, a colon and the form itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """sha256 of the parts one after the other, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def as_hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def lower_ascii(value: Column) -> Column:
    return F.translate(value, UPPER, LOWER)


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``number``, their place from 0 in the order of the columns, and ``tree``, the place of the first row
    with the same first column. No task sees more than a range of the rows, and the driver none."""
    spread = rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    ranged = stored(spread.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order]).withColumn(
        "place", F.monotonically_increasing_id()), "ranged")
    part, row = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = stored(ranged.groupBy(part.alias("part"), F.col(order[0]).alias("key")).agg(
        F.count("*").alias("n"), F.min(row).alias("least")), "counts")
    # One row per partition, and one per partition and key: both grow with partitions and keys, not with rows.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    starts = counts.join(offsets, "part").select("part", "key", "offset", F.min(F.col("offset") + F.col("least")).over(
        Window.partitionBy("key")).alias("tree"), F.sum("n").over(Window.partitionBy("key")).alias("width"))
    placed = ranged.select("*", part.alias("part"), row.alias("row"))
    return placed.join(starts, (placed["part"] == starts["part"]) & placed[order[0]].eqNullSafe(starts["key"])).select(
        *rows.columns, (F.col("offset") + F.col("row")).alias("number"), "tree", "width")


def leaves(docs: DataFrame, fields: Sequence[str] = FIELDS, id_column: str = "doc_id", source_column: str = "source",
           text_column: str = "text", tampered: Column | None = None) -> DataFrame:
    """Per row: ``id``, ``source_key`` (orders like the source, null first), ``digest`` of its fields, ``changed`` (the
    digest after tampering, else the same)."""
    true = [encoded(F.col(f"`{c}`")) for c in fields]
    false = [encoded(lower_ascii(F.col(f"`{c}`")) if c == text_column else F.col(f"`{c}`")) for c in fields]
    source = F.col(f"`{source_column}`").cast("string")
    row = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.when(source.isNull(), "-").otherwise(F.concat(F.lit(":"), source)).alias("source_key"),
        digest(*true).alias("digest"),
        (F.lit(None).cast("binary") if tampered is None else F.when(tampered, digest(*false))).alias("changed"))
    return stored(row.withColumn("changed", F.coalesce("changed", "digest")), "leaves")


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` (``tree``, ``level``, ``pos``, ``size`` of the level in its tree, ``lo``, ``hi``, ``digest``) and the
    stored levels above them, up to one node a tree."""
    found = [nodes]
    while True:
        kids = F.array_sort(F.collect_list(F.struct("pos", "digest")))  # 16 at most
        runs = found[-1].where("size > 1").groupBy("tree", F.shiftright("pos", 4).alias("run")).agg(
            (F.max("level") + 1).alias("level"), F.shiftright(F.max("size") + (RUN - 1), 4).alias("size"),
            F.min("lo").alias("lo"), F.max("hi").alias("hi"),
            F.array_join(F.transform(kids, lambda k: as_hex(k["digest"])), "").alias("joined"))
        level = stored(runs.select("tree", "level", F.col("run").alias("pos"), "size", "lo", "hi", digest(F.col("joined")).alias(
            "digest"), F.unhex("joined").alias("children")), "level")
        if level.isEmpty():
            return found
        found.append(level)


def _linked(level: DataFrame, ranks: DataFrame, several: bool) -> DataFrame:
    """Nodes with their place in their parent; a subroot's parent is in the tree of subroots, the root has none."""
    pos = F.col("pos")
    inner = level.where("size > 1").withColumns({
        "slot": F.pmod(pos, F.lit(RUN)).cast("int"), "up_tree": F.col("tree"), "up_level": F.col("level") + 1,
        "up_pos": F.shiftright(pos, 4)})
    outer = level.where("size = 1").join(ranks, "tree", "left")
    known = F.lit(several) & F.col("rank").isNotNull()
    outer = outer.withColumns({
        "slot": F.when(known, F.pmod("rank", F.lit(RUN)).cast("int")), "up_tree": F.when(known, F.lit(TOP).cast("long")),
        "up_level": F.when(known, F.lit(1)), "up_pos": F.when(known, F.shiftright("rank", 4))}).drop("rank")
    return inner.unionByName(outer)


class Manifest:
    """Levels built over the leaves: ``leaves`` and ``nodes`` with their links, and the ``root`` (hex; None if empty)."""

    def __init__(self, rows: DataFrame):
        numbered = stored(_numbered(rows.select("source_key", "id", "digest", "changed"), ["source_key", "id", "digest"]), "numbered")
        place = {"level": F.lit(0), "pos": F.col("number") - F.col("tree"), "size": F.col("width"),
                 "lo": F.col("number"), "hi": F.col("number")}
        lower = _levels(numbered.withColumns(place).select("tree", "level", "pos", "size", "lo", "hi", "digest"))
        cut = [level.where("size = 1").select(F.col("tree").alias("own"), "lo", "hi", "digest") for level in lower]
        subroots = cut[0]
        for level in cut[1:]:
            subroots = subroots.unionByName(level)
        ranked = stored(_numbered(subroots, ["own"]).drop("tree", "width"), "subroots")
        several = ranked.count()
        upper = _levels(ranked.select(
            F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("number").alias("pos"),
            F.lit(several).cast("long").alias("size"), "lo", "hi", "digest"))
        ranks = ranked.select(F.col("own").alias("tree"), F.col("number").alias("rank"))
        top = upper[-1].select("digest").first() if several else None
        self.root = top["digest"].hex() if top else None
        self.leaves = _linked(numbered.withColumns(place).select(
            "id", "number", "tree", "level", "pos", "size", "digest", "changed"), ranks, several > 1)
        spread = F.explode(F.sequence(F.floor(F.col("lo") / BLOCK), F.floor(F.col("hi") / BLOCK)))
        self.nodes: DataFrame | None = None
        for level in [*lower[1:], *upper[1:]]:
            part = _linked(level, ranks, several > 1).select("tree", "level", "pos", "children", *UP, spread.alias("block"))
            self.nodes = part if self.nodes is None else self.nodes.unionByName(part)


CLIMB = """
WITH RECURSIVE climb (block, members, base, proof, subroot, slot, up_tree, up_level, up_pos) AS (
  SELECT block, members, X'', X'', CAST(NULL AS BINARY), slot, up_tree, up_level, up_pos FROM {leaves}
  UNION ALL
  SELECT c.block,
         transform(c.members, m -> named_struct('place', m.place, 'id', m.id, 'leaf', m.leaf, 'folded', unhex(sha2(lower(hex(concat(
           substring(n.children, 1, {width} * coalesce(c.slot, m.place)), m.folded,
           substring(n.children, {width} * coalesce(c.slot, m.place) + {width} + 1)))), 256)))),
         CASE WHEN c.slot IS NULL THEN n.children ELSE c.base END,
         CASE WHEN c.slot IS NULL THEN c.proof ELSE concat(c.proof, substring(n.children, 1, {width} * c.slot),
                                                           substring(n.children, {width} * c.slot + {width} + 1)) END,
         coalesce(c.subroot, CASE WHEN n.tree = {top} THEN substring(n.children, {width} * c.slot + 1, {width}) END),
         n.slot, n.up_tree, n.up_level, n.up_pos
  FROM climb c JOIN {nodes} n
    ON c.block = n.block AND c.up_tree = n.tree AND c.up_level = n.level AND c.up_pos = n.pos)
SELECT m.id, lower(hex(m.leaf)) AS leaf, lower(hex(subroot)) AS subroot, lower(hex(m.folded)) AS folded_root,
       sha2(lower(hex(concat(substring(base, 1, {width} * m.place), substring(base, {width} * m.place + {width} + 1), proof))), 256)
         AS proof_sha256
FROM (SELECT base, proof, subroot, explode(members) AS m FROM climb WHERE up_tree IS NULL)"""


def proofs(manifest: Manifest) -> DataFrame:
    """Per leaf: ``id``, ``leaf``, ``subroot``, ``proof_sha256``, ``folded_root``, from one recursive query.

    Leaves of one run meet the same siblings above it. They ascend in one row, each with its own folded digest; the run's
    digests stand in ``base``, of which each leaf's proof takes all but its own, and ``slot`` is null until they have.
    """
    spark = manifest.leaves.sparkSession
    nodes = manifest.nodes
    if nodes is None:  # every leaf is a tree of its own, or there is none
        nodes = manifest.leaves.where("false").select(
            "tree", "level", "pos", F.col("digest").alias("children"), *UP, F.col("number").alias("block"))
    single = F.col("size") == 1
    groups = manifest.leaves.groupBy("tree", F.shiftright("pos", 4).alias("run"), "up_tree", "up_level", "up_pos").agg(
        F.floor(F.min("number") / BLOCK).alias("block"), F.min(F.when(single, F.col("slot"))).alias("slot"),
        F.array_sort(F.collect_list(F.struct(
            F.when(single, 0).otherwise(F.col("slot")).alias("place"), "id", F.col("digest").alias("leaf"),
            F.col("changed").alias("folded")))).alias("members"))  # 16 at most
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")  # a row per run and level, whatever their number
    try:
        return stored(spark.sql(CLIMB, leaves=stored(groups, "climbers"), nodes=stored(nodes, "nodes"), width=DIGEST, top=TOP), "proofs")
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)


def verify(docs: DataFrame, tampered: Column | None = None, id_column: str = "doc_id", **columns) -> DataFrame:
    """One row per input row: ``id_column``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of the siblings, level by
    level, left to right), ``folded_root`` (from the leaf as tampered where ``tampered`` holds), ``verified``.

    Null fields, ids and sources have a digest and an order of their own (first); rows with equal source and id are
    ordered by digest, so repeats and ties don't change the root. A lone row of a lone source is leaf, subroot and root
    at once. An empty table gives no rows; long texts enter as their digest only; other columns are ignored.
    """
    manifest = Manifest(leaves(docs, id_column=id_column, tampered=tampered, **columns))
    root = F.lit(manifest.root).cast("string")
    return proofs(manifest).select(
        F.col("id").alias(id_column), "leaf", F.coalesce("subroot", root).alias("subroot"), root.alias("root"), "proof_sha256",
        "folded_root", F.coalesce(F.col("folded_root") == root, F.lit(False)).alias("verified"))


def every_fifth(id_column: str = "doc_id") -> Column:
    """Rows whose id's crc32 (of its decimal form) is divisible by five; a null id is none of them."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


#: The same rows from plain SQL: levels by recursion, siblings by string aggregation, crc32 bit by bit.
ORACLE = r"""
WITH RECURSIVE
parts AS (
  SELECT doc_id, source, text,
         concat_ws('', coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                   coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head,
         list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))),
           lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda i: CAST(3988292384 AS UBIGINT))),
             lambda x, k: xor(x >> 1, k * (x & 1)))) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN xor(crc, CAST(4294967295 AS UBIGINT)) % 5 = 0
              THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
              ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS changed
  FROM parts),
sources AS (
  SELECT source, row_number() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS tree FROM (SELECT DISTINCT source FROM documents)),
leaves AS (
  SELECT doc_id, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS size, leaf, changed
  FROM hashed JOIN sources ON hashed.source IS NOT DISTINCT FROM sources.source),
lower_nodes(tree, level, pos, size, h) AS (
  SELECT tree, 0, pos, size, leaf FROM leaves
  UNION ALL
  SELECT tree, max(level) + 1, pos // 16, (max(size) + 15) // 16, sha256(string_agg(h, '' ORDER BY pos))
  FROM lower_nodes WHERE size > 1 GROUP BY tree, pos // 16),
subroots AS (SELECT tree, level, h FROM lower_nodes WHERE size = 1),
upper_nodes(level, pos, size, h) AS (
  SELECT 0, tree, (SELECT count(*) FROM sources), h FROM subroots
  UNION ALL
  SELECT max(level) + 1, pos // 16, (max(size) + 15) // 16, sha256(string_agg(h, '' ORDER BY pos))
  FROM upper_nodes WHERE size > 1 GROUP BY pos // 16),
nodes AS (
  SELECT tree, level, pos, h FROM lower_nodes WHERE size > 1
  UNION ALL SELECT -1, level, pos, h FROM upper_nodes WHERE size > 1),
sides AS (
  SELECT a.tree, a.level, a.pos,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM nodes a JOIN nodes b ON b.tree = a.tree AND b.level = a.level AND b.pos // 16 = a.pos // 16
  GROUP BY a.tree, a.level, a.pos),
steps AS (
  SELECT s.tree, s.level, s.pos, s.before, s.after,
         coalesce(s.tree >= 0 AND r.level = s.level + 1, FALSE) AS ends_tree
  FROM sides s LEFT JOIN subroots r ON r.tree = s.tree),
climb(doc_id, own, leaf, tree, level, pos, folded, proof) AS (
  SELECT doc_id, tree, leaf, CASE WHEN size > 1 THEN tree ELSE -1 END, 0, CASE WHEN size > 1 THEN pos ELSE tree END, changed, '' FROM leaves
  UNION ALL
  SELECT c.doc_id, c.own, c.leaf, CASE WHEN s.ends_tree THEN -1 ELSE c.tree END,
         CASE WHEN s.ends_tree THEN 0 ELSE c.level + 1 END,
         CASE WHEN s.ends_tree THEN c.own ELSE c.pos // 16 END,
         sha256(s.before || c.folded || s.after), c.proof || s.before || s.after
  FROM climb c JOIN steps s ON s.tree = c.tree AND s.level = c.level AND s.pos = c.pos),
top AS (SELECT level, h FROM upper_nodes WHERE size = 1)
SELECT c.doc_id, c.leaf, r.h AS subroot, t.h AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = t.h AS verified
FROM climb c JOIN top t ON c.tree = -1 AND c.level = t.level JOIN subroots r ON r.tree = c.own"""
