"""Merkle manifest of a table: sibling-shift self-joins, level by level.

Rows become leaves, numbered from 0 in the order of their id within a group (one
tree a group). A level is a table of nodes ``(tree, size, idx, hash)``. Every level
is joined with itself on computed sibling indices: ``idx XOR 1`` in a binary tree,
otherwise the indices of the run's other slots. So each node knows the hashes
before and after it in its run; the nodes in slot zero emit their parents. A level
is stored before the next one reads it, so a lost executor costs one level at most.
The groups' roots, in the order of the groups, are the leaves of the tree above.

Proofs go the other way: a node's path is its own siblings followed by its parent's
path, one equijoin a level. Folding a leaf with its path gives the root again.

Keys ``(tree, idx)`` are unique, so no key is hot however large a group is; the
order is made by range partitions on group, id, leaf and a salt, which also splits
rows that are equal in everything.

Defined cases: nulls are fields of their own (``-``), a null group is a group and
comes first, a null id comes before all others of its group; equal rows are leaves
each, side by side; a lone node goes up as the hash of itself alone; a lone leaf is
its group's root; texts of any length are hashed whole; an empty table gives an
empty result. Columns that are not part of a leaf are not looked at, so none clashes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.common import table, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STORED_EVERY = 5  # levels of paths joined in one plan
_PLACE_BITS = 33  # of monotonically_increasing_id
_PATH = "array<struct<before:binary,after:binary>>"


def field(value: Column) -> Column:
    """Text of one field: ``-`` for null, else its UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def _text(digests: Column) -> Column:
    """Digests, one or several behind each other, as lower-case hex."""
    return F.lower(F.hex(digests))


def _no_digest() -> Column:
    return F.unhex(F.lit(""))


def _empty_if_null(digests: Column) -> Column:
    return F.coalesce(digests, _no_digest())


def ordered(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` with ``name``, its row numbers from 0 in the order of ``keys``.

    Range partitions are sorted and stored with each row's place; the rows of the
    partitions before, one number a partition, are the broadcast side.
    """
    number = F.monotonically_increasing_id()
    stored = written(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
            *df.columns,
            F.shiftright(number, _PLACE_BITS).alias("part"),
            number.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("place"),
        ),
        "ordered",
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset")
    )
    return stored.join(F.broadcast(offsets), "part").select(
        *df.columns, (F.col("offset") + F.col("place")).alias(name)
    )


def with_siblings(nodes: DataFrame, arity: int = 2) -> DataFrame:
    """``nodes`` with the hashes before and after each one in its run (null: none there)."""
    other = nodes.select(
        F.col("tree").alias("other_tree"), F.col("idx").alias("other_idx"),
        F.col("hash").alias("other_hash"),
    )
    if arity == 2:
        sibling = F.col("idx").bitwiseXOR(F.lit(1))
        joined = nodes.join(
            other, (F.col("tree") == F.col("other_tree")) & (sibling == F.col("other_idx")), "left"
        )
        return joined.select(
            *nodes.columns,
            F.when(F.col("other_idx") < F.col("idx"), F.col("other_hash")).alias("before"),
            F.when(F.col("other_idx") > F.col("idx"), F.col("other_hash")).alias("after"),
        )
    slot = F.col("idx") % arity
    # one row per other slot of the run; a node has arity - 1 of them
    shifted = nodes.select(
        "tree", "idx", F.explode(F.sequence(F.lit(1), F.lit(arity - 1))).alias("shift")
    ).select("tree", "idx", (F.col("idx") - slot + (slot + F.col("shift")) % arity).alias("sibling"))
    found = shifted.join(
        other, (F.col("tree") == F.col("other_tree")) & (F.col("sibling") == F.col("other_idx"))
    ).groupBy(F.col("tree").alias("at_tree"), F.col("idx").alias("at_idx")).agg(
        F.sort_array(F.collect_list(F.struct("other_idx", "other_hash"))).alias("others")
    )

    def side(picked) -> Column:
        kept = F.filter("others", picked)
        digests = F.aggregate(kept, _no_digest(), lambda all_, x: F.concat(all_, x["other_hash"]))
        return F.when(F.size(kept) > 0, digests)

    joined = nodes.join(
        found, (F.col("tree") == F.col("at_tree")) & (F.col("idx") == F.col("at_idx")), "left"
    )
    return joined.select(
        *nodes.columns,
        side(lambda x: x["other_idx"] < F.col("idx")).alias("before"),
        side(lambda x: x["other_idx"] > F.col("idx")).alias("after"),
    )


@dataclass
class Forest:
    """Stored levels of all trees, leaves first, and the trees' roots."""

    levels: list[DataFrame]
    roots: DataFrame  # tree, height, hash
    arity: int


def build(leaves: DataFrame, arity: int = 2) -> Forest:
    """Levels above ``leaves`` (tree, size, idx, hash and any other columns)."""
    widest = leaves.agg(F.max("size")).first()[0] or 0
    levels, nodes = [], leaves
    while True:
        level = written(with_siblings(nodes, arity), f"level{len(levels)}")
        levels.append(level)
        if widest <= 1:
            break
        slot_zero = level.where((F.col("size") > 1) & (F.col("idx") % arity == 0))
        nodes = slot_zero.select(
            "tree",
            F.ceil(F.col("size") / arity).alias("size"),
            F.floor(F.col("idx") / arity).alias("idx"),
            F.unhex(F.sha2(_text(F.concat("hash", _empty_if_null(F.col("after")))), 256)).alias("hash"),
        )
        widest = -(-widest // arity)
    roots = None
    for height, level in enumerate(levels):
        done = level.where("size = 1").select("tree", F.lit(height).alias("height"), "hash")
        roots = done if roots is None else roots.unionAll(done)
    return Forest(levels, written(roots, "roots"), arity)


def leaf_paths(forest: Forest, above: DataFrame) -> DataFrame:
    """The leaves' level with ``path``: siblings from the leaf to the root and ``above``.

    ``above`` has for every tree (tree, height, path) what follows its root.
    """
    paths = None
    for height in reversed(range(len(forest.levels))):
        level = forest.levels[height]
        upper = above.where(F.col("height") == height).select(
            F.col("tree").alias("up_tree"), F.lit(0).cast("long").alias("up_idx"),
            F.col("path").alias("up_path"),
        )
        if paths is not None:
            upper = upper.unionAll(paths.select("tree", "idx", "path"))
        own = F.array(F.struct("before", "after")).cast(_PATH)
        path = F.when(F.col("size") > 1, F.concat(own, F.col("up_path"))).otherwise(F.col("up_path"))
        paths = level.join(
            upper,
            (F.col("tree") == F.col("up_tree"))
            & (F.floor(F.col("idx") / forest.arity) == F.col("up_idx")),
        ).select(*[c for c in level.columns if c not in ("before", "after")], path.alias("path"))
        if height and (len(forest.levels) - height) % STORED_EVERY == 0:
            paths = written(paths, f"paths{height}")
    return paths


def proof(path: Column) -> Column:
    """Hash of all siblings of a path, from the leaf to the root, left to right."""
    digests = F.transform(
        path, lambda e: _text(F.concat(_empty_if_null(e["before"]), _empty_if_null(e["after"])))
    )
    return F.sha2(F.array_join(digests, ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """Root (hex) that a leaf (hex) gives with its path."""
    return F.aggregate(
        path,
        leaf,
        lambda h, e: F.sha2(
            F.concat(
                _text(_empty_if_null(e["before"])), h, _text(_empty_if_null(e["after"]))
            ),
            256,
        ),
    )


def manifest(rows: DataFrame, group: str, order: str, leaf: str, arity: int = 2) -> DataFrame:
    """Every row with leaf number, subroot, root and the path from its leaf to the root.

    ``rows`` holds the leaf's hash (binary) in ``leaf``; other columns stay, and must
    not bear the names tree, size, idx, hash, before, after, path, subroot or root.
    """
    # stored once: equal rows then keep the salt that orders them
    salted = written(
        rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "leaves"
    )
    in_order = ordered(salted, [group, order, leaf, "salt"], "at").drop("salt")
    trees = written(
        in_order.groupBy(F.col(group).alias("tree_group")).agg(
            F.min("at").alias("tree"), F.count(F.lit(1)).alias("size")
        ),
        "trees",
    )
    # the first leaf's number names a tree; a group's rows find it without a hot key:
    # the few trees are the small side, AQE broadcasts them under its size check
    leaves = in_order.join(trees, F.col(group).eqNullSafe(F.col("tree_group"))).select(
        *rows.columns, "tree", "size", (F.col("at") - F.col("tree")).alias("idx"),
        F.col(leaf).alias("hash"),
    )
    forest = build(leaves, arity)
    subroots = ordered(forest.roots, ["tree"], "idx").select(
        F.lit(0).cast("long").alias("tree"), "idx", "hash",
        F.col("tree").alias("of_tree"), F.col("height").alias("of_height"),
    )
    n_trees = forest.roots.count()
    top = build(subroots.withColumn("size", F.lit(n_trees).cast("long")), arity)
    root = top.roots.select("tree", "height", F.array().cast(_PATH).alias("path"))
    above = leaf_paths(top, root).select(
        F.col("of_tree").alias("tree"), F.col("of_height").alias("height"),
        F.col("hash").alias("subroot"), "path",
    )
    above = written(above, "above")
    (root_hash,) = top.roots.select("hash").first() or (None,)
    found = leaf_paths(forest, above)
    named = above.select(F.col("tree").alias("of_tree"), "subroot")
    return found.join(named, F.col("tree") == F.col("of_tree")).select(
        *rows.columns, "idx", "subroot", F.lit(root_hash).cast("binary").alias("root"), "path"
    )


def op13_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of ``documents``, a tree per lang, with proofs and a check of tampered rows."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    rows = docs.select(
        "doc_id",
        F.col("lang").alias("lang"),
        leaf_hash(*[F.col(c) for c in FIELDS]).alias("leaf"),
        F.when(tampered & F.col("n_chars").isNotNull(), leaf_hash(*changed)).alias("seen"),
    )
    found = manifest(rows, "lang", "doc_id", "leaf")
    folded_root = folded(_text(F.coalesce("seen", "leaf")), F.col("path"))
    return found.select(
        "doc_id",
        _text(F.col("leaf")).alias("leaf"),
        _text(F.col("subroot")).alias("subroot"),
        _text(F.col("root")).alias("root"),
        proof(F.col("path")).alias("proof_sha256"),
        folded_root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


# crc32 of the decimal id byte by byte, 8 shifts each; the levels climb in one
# recursion and the paths in another. Rows equal in lang and doc_id are ordered by leaf.
OP13_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT *,
    xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::UBIGINT),
      lambda c, b: list_reduce([xor(c, b)] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
        lambda r, k: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::UBIGINT) ELSE r // 2 END)), 4294967295::UBIGINT) AS crc
  FROM documents
),
hashed AS (
  SELECT doc_id, lang, crc % 7 = 0 AND n_chars IS NOT NULL AS tampered,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS chars,
    coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS more_chars,
    coalesce(strlen(text) || ':' || text, '-') AS body
  FROM docs
),
leaves AS (
  SELECT doc_id, lang, sha256(head || chars || body) AS leaf,
    CASE WHEN tampered THEN sha256(head || more_chars || body) END AS seen
  FROM hashed
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS size, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
  FROM leaves
),
nodes AS (
  SELECT 0 AS level, tree, idx, size, leaf AS hash FROM placed
  UNION ALL
  SELECT level + 1, tree, idx // 2, (size + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
  FROM nodes WHERE size > 1 GROUP BY level, tree, idx // 2, size
),
subroots AS (SELECT tree, level AS height, hash FROM nodes WHERE size = 1),
top AS (
  SELECT 0 AS level, tree AS idx, (SELECT count(*) FROM subroots) AS size, hash FROM subroots
  UNION ALL
  SELECT level + 1, idx // 2, (size + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
  FROM top WHERE size > 1 GROUP BY level, idx // 2, size
),
low AS (
  SELECT row_number() OVER () AS row_id, doc_id, leaf, tree, size, 0 AS level, idx, '' AS siblings, coalesce(seen, leaf) AS fold FROM placed
  UNION ALL
  SELECT w.row_id, w.doc_id, w.leaf, w.tree, (w.size + 1) // 2, w.level + 1, w.idx // 2, w.siblings || coalesce(n.hash, ''),
    sha256(CASE WHEN w.idx % 2 = 1 THEN n.hash || w.fold ELSE w.fold || coalesce(n.hash, '') END)
  FROM low w LEFT JOIN nodes n ON n.level = w.level AND n.tree = w.tree AND n.idx = xor(w.idx, 1)
  WHERE w.size > 1
),
high AS (
  SELECT row_id, doc_id, leaf, tree, (SELECT count(*) FROM subroots) AS size, 0 AS level, tree AS idx, siblings, fold FROM low WHERE size = 1
  UNION ALL
  SELECT w.row_id, w.doc_id, w.leaf, w.tree, (w.size + 1) // 2, w.level + 1, w.idx // 2, w.siblings || coalesce(n.hash, ''),
    sha256(CASE WHEN w.idx % 2 = 1 THEN n.hash || w.fold ELSE w.fold || coalesce(n.hash, '') END)
  FROM high w LEFT JOIN top n ON n.level = w.level AND n.idx = xor(w.idx, 1)
  WHERE w.size > 1
)
SELECT h.doc_id, h.leaf, s.hash AS subroot, t.hash AS root, sha256(h.siblings) AS proof_sha256,
       h.fold AS folded_root, h.fold = t.hash AS verified
FROM high h JOIN subroots s ON s.tree = h.tree JOIN top t ON t.size = 1
WHERE h.size = 1
"""
