"""Merkle manifest of a dataset: subtrees by group, one root, a proof for every row.

A leaf is the hash of a row's fields.  In every group the leaves ascend by key and
are hashed in runs of ``ARITY`` up to one subroot; the subroots, ordered by group,
are hashed likewise up to the root.

A level is one frame of nodes (tree, place, digest).  Each node's siblings are found by
equijoins of the level with itself on computed places: the slots of a run follow each
other in a circle, so the k-th sibling stands at the run's first place plus (slot + k) mod ARITY.
The rows in slot zero then emit the parents.  Trees that have reached one node leave.

Proofs go down again: each level hands its nodes' siblings, those before and those
after, to the level below by an equijoin on (tree, place div ARITY).

Scale: texts are read once and only hashed; nothing but digests, places and keys is
shuffled.  All trees of a level share its joins, whose keys are distinct, so a hot group is
spread like any other.  A level holds a third of the nodes below it and is written to
the shared folder, so a lost executor costs no more than a level.  The driver sees the
number of nodes left, the largest tree and the root.

Defined results: null fields count as ``-``, and null keys come first; rows that share a key
ascend by leaf; repeated rows are leaves of their own; a null key is never tampered with;
an empty table has no root and gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiremart.llm.common import salted_left_join, written
from hiremart.operators.numbering import dense_index

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text: Column) -> Column:
    """Binary sha256."""
    return F.unhex(F.sha2(text, 256))


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf(fields: list[Column]) -> Column:
    """Hash of a row: each field as its UTF-8 byte count, a colon and its text, or ``-`` if null."""
    parts = []
    for f in fields:
        text = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return sha(F.concat(*parts))


def with_siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` (tree, place, digest and others) with the digests of the run's other nodes, joined as binary: before, after."""
    slot, first = F.col("place") % ARITY, F.col("place") - F.col("place") % ARITY
    out = nodes
    for k in range(1, ARITY):
        other = nodes.select(F.col("tree").alias("_t"), F.col("place").alias("_p"), F.col("digest").alias(f"_s{k}"))
        there = first + (slot + k) % ARITY
        out = out.join(other, (F.col("tree") == F.col("_t")) & (there == F.col("_p")), "left").drop("_t", "_p")
    none = F.lit(b"")
    at = {k: F.coalesce(F.col(f"_s{k}"), none) for k in range(1, ARITY)}
    # the k-th sibling in the circle lies after a node if slot + k stays below ARITY, else before it
    after = F.concat(*[F.when(slot + k < ARITY, v).otherwise(none) for k, v in at.items()])
    before = F.concat(*[F.when(slot + k >= ARITY, v).otherwise(none) for k, v in at.items()])
    return out.select(*nodes.columns, before.alias("before"), after.alias("after"))


def raised(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Levels of all trees with siblings, lowest first, and the top node of each tree (tree, digest).

    ``nodes`` (written): tree, place from 0, size (nodes of the tree), digest."""
    levels, tops = [], nodes.where("size = 1").select("tree", "digest")
    height, largest = 0, nodes.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        level = written(with_siblings(nodes.where("size > 1")), f"merkle-level-{height}")
        levels.append(level)
        parents = level.where(F.col("place") % ARITY == 0).select(
            "tree", F.expr(f"place div {ARITY}").alias("place"), F.expr(f"(size + {ARITY - 1}) div {ARITY}").alias("size"),
            sha(F.concat(hexed(F.col("digest")), hexed(F.col("after")))).alias("digest"),
        )
        nodes = parents
        tops = tops.unionByName(parents.where("size = 1").select("tree", "digest"))
        largest, height = -(-largest // ARITY), height + 1
    return levels, tops


def height(size: Column) -> Column:
    """Levels below the top node of a tree with so many lowest nodes."""
    steps = F.lit(0)
    for k in range(40):  # ARITY ** 40 is beyond any long
        if ARITY**k < 1 << 63:
            steps = steps + (size > F.lit(ARITY**k)).cast("int")
    return steps


def paths(bottom: DataFrame, levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """``bottom`` (the lowest nodes with other columns) with ``top``'s columns and ``steps``: the siblings on the way up, as (before, after).

    ``top``, by tree: height, the steps that follow above the tree, and other columns."""
    rest = [c for c in top.columns if c not in ("tree", "height", "steps")]
    columns = [*bottom.columns, "steps", *rest]
    known = None
    for k in range(len(levels) - 1, -1, -1):
        begin = top.where(F.col("height") == k + 1).select("tree", F.lit(0).cast("long").alias("place"), "steps", *rest)
        above = (begin if known is None else known.select(*begin.columns).unionByName(begin)).withColumnsRenamed({"tree": "_t", "place": "_p", "steps": "_steps"})
        here = levels[k].join(above, (F.col("tree") == F.col("_t")) & (F.expr(f"place div {ARITY}") == F.col("_p")))
        known = here.withColumn("steps", F.concat(F.array(F.struct("before", "after")), F.col("_steps")))
    alone = bottom.where("size = 1").join(top, "tree").select(*columns)
    return alone if known is None else known.select(*columns).unionByName(alone)


def manifest(docs: DataFrame, *, key: str = "doc_id", group: str = "source", fields: tuple[str, ...] = FIELDS, tampered: dict[str, Column] | None = None) -> DataFrame:
    """Key, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    ``tampered`` replaces fields in the copy of each row that is verified against the proofs."""
    changed = tampered or {}
    group_key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # null first, then bytewise
    leaves = docs.select(
        F.col(key).alias("_key"), group_key.alias("_group"), leaf([F.col(f) for f in fields]).alias("_leaf"),
        leaf([changed.get(f, F.col(f)) for f in fields]).alias("_changed"),
    )
    numbered = written(dense_index(leaves, ["_group", "_key", "_leaf"], "_at", start=0), "merkle-leaves")
    groups = numbered.groupBy("_group").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("size"))
    groups = written(dense_index(groups, ["_group"], "tree", start=0), "merkle-groups")
    placed = salted_left_join(numbered, groups, ["_group"], F.col("_at"))
    placed = written(placed.select("tree", (F.col("_at") - F.col("_first")).alias("place"), "size", F.col("_leaf").alias("digest"), "_key", "_changed"), "merkle-placed")
    levels, tops = raised(placed)
    sizes = groups.select("tree", height(F.col("size")).alias("height"))
    subroots = written(tops.join(sizes, "tree"), "merkle-subroots")
    count = F.lit(groups.count()).cast("long")
    forest = written(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), count.alias("size"), "digest", F.col("height").alias("below")), "merkle-forest")
    crown, roots = raised(forest)
    root = roots.select("digest").first()
    root = F.lit(bytes(root[0]) if root else b"")
    no_steps = F.array().cast("array<struct<before:binary,after:binary>>")
    trunk = paths(forest, crown, roots.select("tree", height(count).alias("height"), no_steps.alias("steps")))
    trunk = written(trunk.select(F.col("place").alias("tree"), F.col("below").alias("height"), "steps", F.col("digest").alias("subroot")), "merkle-trunk")
    rows = paths(placed, levels, trunk)
    proof = F.sha2(F.array_join(F.transform("steps", lambda s: F.concat(hexed(s["before"]), hexed(s["after"]))), ""), 256)
    folded = F.aggregate("steps", F.col("_changed"), lambda acc, s: sha(F.concat(hexed(s["before"]), hexed(acc), hexed(s["after"]))))
    out = rows.select(
        F.col("_key").alias(key), hexed(F.col("digest")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), hexed(root).alias("root"),
        proof.alias("proof_sha256"), hexed(folded).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: line breaks are deleted from every second document's text, by crc32 of its id."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    text = F.col("text").cast("string")
    return manifest(docs, tampered={"text": F.when(hit, F.translate(text, "\n", "")).otherwise(text)})
