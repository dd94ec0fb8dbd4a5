"""Merkle manifest of a table: one hash tree per group of rows and one over the groups' roots.

A level of a tree is kept as one string of 64 hex digits per node. Rows of a group get positions 0, 1, 2, ... and every
aligned block of ``fanout ** height`` of them is one row whose levels are such strings, so a node's children are a
substring of fixed width and a node's siblings are the substrings at its sides. The roots of a group's blocks are the
nodes of its next layer, and so on until one block holds them all. Everything is column expressions; no task sees more
than a block, and the layers are stored, each smaller than the one below by the size of a block.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..session import stored
from .registry import query, table

FANOUT = 2
# Levels of a block: 256 nodes at its bottom, 16 kB of hex digits.
HEIGHT = 8
DIGITS = 64
PATH = "array<struct<left: string, right: string>>"


def field_bytes(value: Column) -> Column:
    """What a value adds to a leaf: its length in bytes, a colon and itself, or a minus sign for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field_bytes, values)), 256)


def group_key(value: Column) -> Column:
    """A text that orders groups: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``pos``, the place of a row in its ``grp`` by ``order``, and ``n``, the rows of the group.

    Rows are range-partitioned by group and order and numbered from the counts of the ranges, so a group of any size is
    spread over tasks. Rows that agree in everything are told apart by the place where they were stored.
    """
    keys = ["grp", *order, "__tie"]
    told = stored(rows.withColumn("__tie", F.monotonically_increasing_id()), "merkle-leaves")
    ranged = stored(told.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .withColumn("__id", F.monotonically_increasing_id()).drop("__tie"), "merkle-places")
    part = F.shiftright(F.col("__id"), 33)
    counts = ranged.groupBy(part.alias("__part"), "grp").agg(F.count("*").alias("__count"), F.min("__id").alias("__first"))
    of_group = W.Window.partitionBy("grp")
    before = of_group.orderBy("__part").rowsBetween(W.Window.unboundedPreceding, -1)
    starts = counts.select("__part", "grp", "__first", F.sum("__count").over(of_group).alias("n"),
                           F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__before"))
    return (ranged.withColumn("__part", part).join(starts, ["__part", "grp"])
            .withColumn("pos", F.col("__id") - F.col("__first") + F.col("__before"))
            .drop("__id", "__part", "__first", "__before"))


def _parents(level: str, fanout: int) -> str:
    run = DIGITS * fanout
    return (f"array_join(transform(sequence(0, int((length({level}) - 1) div {run})), "
            f"i -> sha2(substring({level}, i * {run} + 1, {run}), 256)), '')")


def _layer(nodes: DataFrame, payload: Sequence[str], fanout: int, height: int) -> DataFrame:
    """Blocks of nodes (grp, pos, n, node, payload): (grp, block, n, members, levels).

    A block of a group that is larger than a block has ``height`` levels above its nodes, whatever it holds; the only
    block of a group ends where one node is left.
    """
    size = fanout ** height
    blocks = (nodes.withColumn("block", F.expr(f"pos div {size}")).groupBy("grp", "block")
              .agg(F.max("n").alias("n"),
                   F.sort_array(F.collect_list(F.struct("pos", "node", *payload))).alias("members")))
    depth = " + ".join(f"int(n > {fanout ** k})" for k in range(height))
    return (blocks.withColumn("__depth", F.expr(depth))
            .withColumn("levels", F.expr(
                f"aggregate(slice(sequence(1, {height}), 1, __depth), array(array_join(members.node, '')), "
                f"(have, k) -> array_append(have, {_parents('element_at(have, -1)', fanout)}))")).drop("__depth"))


@dataclass
class Tree:
    """The layers of one or more trees, lowest first, and the root of each (grp, root)."""

    layers: list[DataFrame]
    roots: DataFrame
    payload: list[str]
    fanout: int
    height: int


def build(nodes: DataFrame, payload: Sequence[str] = (), fanout: int = FANOUT, height: int = HEIGHT) -> Tree:
    """Trees over nodes (grp, pos, n, node, payload), one per ``grp``."""
    size = fanout ** height
    layers, roots, extra = [], [], list(payload)
    while True:
        layer = stored(_layer(nodes, extra, fanout, height), "merkle-layer")
        layers.append(layer)
        top = F.element_at("levels", -1)
        roots.append(layer.where(F.col("n") <= size).select("grp", top.alias("root")))
        open_ = layer.where(F.col("n") > size)
        if not open_.limit(1).count():
            break
        nodes, extra = open_.select("grp", F.col("block").alias("pos"), F.expr(f"(n - 1) div {size} + 1").alias("n"),
                                    top.alias("node")), []
    all_roots = roots[0]
    for more in roots[1:]:
        all_roots = all_roots.union(more)
    return Tree(layers, all_roots, list(payload), fanout, height)


def _own_path(fanout: int) -> str:
    """Siblings of member i of a block, level by level: the other nodes of its run, left and right of it."""
    at = f"(i div bigint(power({fanout}, k)))"
    start, place = f"({at} - {at} % {fanout})", f"({at} % {fanout})"
    left = f"substring(levels[k], int({start} * {DIGITS} + 1), int({place} * {DIGITS}))"
    right = f"substring(levels[k], int(({at} + 1) * {DIGITS} + 1), int(({fanout} - 1 - {place}) * {DIGITS}))"
    return (f"transform(slice(sequence(0, size(levels)), 1, size(levels) - 1), "
            f"k -> struct({left} AS left, {right} AS right))")


def paths(tree: Tree, above: DataFrame) -> DataFrame:
    """(grp, pos, node, payload, path, carry) of every lowest node. ``path`` has the siblings from the node up and
    on through the path of its group; ``above`` has (grp, path, carry) for every group."""
    upper = None
    size = tree.fanout ** tree.height
    for i in range(len(tree.layers) - 1, -1, -1):
        layer = tree.layers[i]
        ends = layer.where(F.col("n") <= size).select("grp", "block").join(above, "grp")
        upper = ends if upper is None else upper.select("grp", F.col("pos").alias("block"), "path", "carry").unionByName(ends)
        payload = tree.payload if i == 0 else []
        named = ", ".join(f"m.{c} AS {c}" for c in ["pos", "node", *payload])
        member = (f"explode(transform(members, (m, i) -> struct({named}, "
                  f"concat({_own_path(tree.fanout)}, path) AS path)))")
        upper = (layer.join(upper, ["grp", "block"]).select("grp", "carry", F.expr(member).alias("x"))
                 .select("grp", "carry", "x.*"))
    return upper


def fold(path: str, node: str) -> Column:
    """The root that a node and the siblings on its path give."""
    return F.expr(f"aggregate({path}, {node}, (h, p) -> sha2(concat(p.left, h, p.right), 256))")


def siblings(path: str) -> Column:
    """All siblings on a path as one text, from the node up, left to right."""
    return F.expr(f"array_join(transform({path}, p -> concat(p.left, p.right)), '')")


def manifest(rows: DataFrame, order: Sequence[str], payload: Sequence[str] = (), fanout: int = FANOUT,
             height: int = HEIGHT) -> DataFrame:
    """(grp, node, subroot, root, path, payload) of rows (grp, node, order, payload), ``node`` being a leaf's hash.

    The rows of each ``grp``, by ``order`` (nulls first) and then by leaf, are the leaves of one tree; its root is the
    subroot. Subroots by ``grp`` are the leaves of the last tree. A run of nodes, the last one perhaps shorter, becomes
    their hash until one node remains; a lone leaf is its own root. Equal rows are leaves of their own. ``payload`` are
    further columns to carry. An empty table has no rows and no root.
    """
    kept = [c for c in dict.fromkeys([*order, *payload]) if c not in ("grp", "node")]
    lower = build(placed(rows.select("grp", "node", *kept), [*order, "node"]), kept, fanout, height)
    subroots = lower.roots.select(F.lit("").alias("grp"), F.col("grp").alias("member"), F.col("root").alias("node"))
    upper = build(placed(subroots, ["member"]), ["member"], fanout, height)
    top = upper.roots.select("grp", F.expr(f"cast(array() AS {PATH})").alias("path"), F.col("root").alias("carry"))
    groups = paths(upper, top).select(F.col("member").alias("grp"), "path",
                                      F.struct(F.col("node").alias("subroot"), F.col("carry").alias("root")).alias("carry"))
    return paths(lower, groups).select("grp", "node", "carry.subroot", "carry.root", "path", *kept)


def document_leaves(docs: DataFrame) -> DataFrame:
    """(grp, node, doc_id, tampered) of documents: one group per lang; ``tampered`` is the leaf with ``n_chars`` one
    higher in the rows that are tampered with, and else the leaf. Nulls are hashed as such, a null ``n_chars`` stays
    and a null doc_id, which comes first, is never tampered with."""
    def leaf(n_chars: Column) -> Column:
        return leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    return (docs.select(group_key(F.col("lang")).alias("grp"), leaf(F.col("n_chars")).alias("node"), "doc_id",
                        F.when(hit, leaf(more)).alias("__other"))
            .select("grp", "node", "doc_id", F.coalesce("__other", "node").alias("tampered")))


@query(sql=r"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, n_chars IS NOT NULL AND coalesce(crc % 7 = 0, false) AS hit,
         sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || z) AS leaf,
         sha256(a || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || z) AS other
  FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                  || coalesce(strlen(lang) || ':' || lang, '-') AS a, coalesce(strlen(text) || ':' || text, '-') AS z,
               xor(4294967295, list_reduce(
                list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                                                                lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
        FROM documents)),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
tree AS (
  SELECT lang, 0 AS k, pos AS i, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM placed
  UNION ALL
  SELECT lang, k + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM tree WHERE n > 1
  GROUP BY lang, k, i // 2, n),
sub AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS k, pos AS i, subroot AS h, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT k + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY k, i // 2, n),
deep AS (SELECT lang, max(k) AS depth FROM tree GROUP BY lang),
steps AS (
  SELECT p.doc_id, p.leaf, t.k, CASE WHEN (p.pos >> t.k) % 2 = 1 THEN b.h ELSE '' END AS l,
         CASE WHEN (p.pos >> t.k) % 2 = 0 THEN coalesce(b.h, '') ELSE '' END AS r
  FROM placed p JOIN tree t ON t.lang IS NOT DISTINCT FROM p.lang AND t.i = p.pos >> t.k AND t.n > 1
  LEFT JOIN tree b ON b.lang IS NOT DISTINCT FROM p.lang AND b.k = t.k AND b.i = xor(t.i, 1)
  UNION ALL
  SELECT p.doc_id, p.leaf, d.depth + t.k, CASE WHEN (s.pos >> t.k) % 2 = 1 THEN b.h ELSE '' END,
         CASE WHEN (s.pos >> t.k) % 2 = 0 THEN coalesce(b.h, '') ELSE '' END
  FROM placed p JOIN sub s ON s.lang IS NOT DISTINCT FROM p.lang JOIN deep d ON d.lang IS NOT DISTINCT FROM p.lang
  JOIN top t ON t.i = s.pos >> t.k AND t.n > 1 LEFT JOIN top b ON b.k = t.k AND b.i = xor(t.i, 1)),
fold AS (
  SELECT doc_id, leaf, 0 AS k, CASE WHEN hit THEN other ELSE leaf END AS h FROM leaves
  UNION ALL
  SELECT f.doc_id, f.leaf, f.k + 1, sha256(s.l || f.h || s.r) FROM fold f
  JOIN steps s ON s.doc_id = f.doc_id AND s.leaf = f.leaf AND s.k = f.k),
proof AS (SELECT doc_id, leaf, sha256(string_agg(l || r, '' ORDER BY k)) AS proof FROM steps GROUP BY doc_id, leaf),
folded AS (SELECT doc_id, leaf, max_by(h, k) AS folded FROM fold GROUP BY doc_id, leaf)
SELECT p.doc_id, p.leaf, s.subroot, t.h AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
       f.folded AS folded_root, f.folded = t.h AS verified
FROM placed p JOIN sub s ON s.lang IS NOT DISTINCT FROM p.lang JOIN top t ON t.n = 1
LEFT JOIN proof q ON q.doc_id = p.doc_id AND q.leaf = p.leaf JOIN folded f ON f.doc_id = p.doc_id AND f.leaf = p.leaf
""")
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the root that its tampered leaf gives."""
    found = manifest(document_leaves(table(spark, folder, "documents")), ["doc_id"], ["tampered"])
    return (found.select("doc_id", F.col("node").alias("leaf"), "subroot", "root",
                         F.sha2(siblings("path"), 256).alias("proof_sha256"), fold("path", "tampered").alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
