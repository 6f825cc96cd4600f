"""Merkle manifest of a table: per group a binary tree over its rows, and one tree over the groups.

A row's fields are hashed to its *leaf*. A group's leaves ascend by id; on every level two nodes, or a last one alone,
become their hash, until one is left, the group's subroot. Subroots ascend by group (null first) and give the root in
the same way.

**Windows.** Leaves have positions in their group and are cut into blocks of 2 to the power of ``span`` neighbours. In a
block one window order serves all its levels: on level l a node stands on its first leaf's row, so that its sibling is
``2**l`` rows ahead (slot 0) or behind (slot 1), if the run has two nodes. Lag and lead at that offset bring it, the rows of
slot 0 hash the parent, and the other rows of a node read its sibling from the row of the node's first leaf. The tops of
blocks are the leaves of the next pass, a 256th as many, so a group of any size is never one task.

**Defined results.** A null field counts as ``-``, so rows of nulls have leaves; a null id comes first in its group and is
never tampered with; a null group is a group of its own. Rows that repeat an id are ordered by their leaf; equal rows
have equal leaves, each with its own place and proof. Empty and very long texts are hashed like any other. An empty table
gives no rows. Only the named fields are read, other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayglass.llm.common import name_of, stored
from stayglass.operators.ranks import global_row_number


@dataclass(frozen=True)
class Settings:
    span: int = 8  # levels of one pass


def field(column: Column) -> Column:
    """A value with its size in bytes, so that no two rows of fields read the same."""
    text = column.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*(field(c) for c in fields)).cast("binary"), 256)


def _levels(nodes: Column) -> Column:
    """Levels above so many nodes."""
    return F.when(nodes > 1, F.length(F.bin(nodes - 1))).otherwise(0)


def _climb(nodes: DataFrame, s: Settings) -> DataFrame:
    """Adds ``block``, ``top`` (on the first row of a block) and ``path``: per level of this pass ``0`` or ``1`` (the
    slot) and the sibling, or nothing where the node was alone."""
    size = 1 << s.span
    nodes = nodes.withColumns({"block": F.shiftright("pos", s.span), "at": F.col("pos").bitwiseAND(F.lit(size - 1)).cast("int")})
    here = F.least(F.lit(size), F.col("n") - F.col("block") * size)
    nodes = nodes.withColumns({"here": here.cast("int"), "steps": F.when(F.col("n") > size, s.span).otherwise(_levels(F.col("n"))), "top": F.col("digest")})
    rows = Window.partitionBy("gid", "block").orderBy("at")
    for level in range(s.span):
        reach = 1 << level
        first = (F.col("at") % reach == 0) & (F.col("steps") > level)
        number = F.shiftright("at", level)
        slot = number % 2
        run = F.least(F.lit(2), F.ceil(F.col("here") / reach).cast("int") - (number - slot))
        nodes = nodes.withColumns({"ahead": F.lead("top", reach).over(rows), "behind": F.lag("top", reach).over(rows)})
        mate = F.when(run < 2, "").when(slot == 0, F.concat(F.lit("0"), "ahead")).otherwise(F.concat(F.lit("1"), "behind"))
        nodes = nodes.withColumn("mate", F.when(first, mate))
        parent = F.when(first & (slot == 0), F.sha2(F.concat("top", F.substring("mate", 2, 64)).cast("binary"), 256))
        nodes = nodes.withColumns({
            f"mate{level}": F.when(F.col("steps") > level, F.last("mate", True).over(rows.rowsBetween(Window.unboundedPreceding, 0))),
            "top": F.when(F.col("steps") > level, parent).otherwise(F.col("top")),
        })
    mates = [f"mate{level}" for level in range(s.span)]
    return nodes.withColumn("path", F.array_compact(F.array(*mates))).drop(*mates, "mate", "ahead", "behind", "here", "steps", "at")


def trees(nodes: DataFrame, largest: int, s: Settings) -> DataFrame:
    """Adds ``path`` from the leaf upwards and ``summit``, the digest of the whole group.

    ``nodes`` has gid, pos (from 0 in each gid), n (nodes of the gid), digest and other columns; ``largest`` is the
    greatest n. Each pass is written once and read by its tops and by its leaves."""
    if largest <= 1:
        return nodes.withColumns({"path": F.array().cast("array<string>"), "summit": F.col("digest")})
    step = stored(_climb(nodes, s), "merkle-pass")
    size = 1 << s.span
    tops = step.where(F.col("pos") % size == 0).select("gid", F.col("block").alias("pos"), F.ceil(F.col("n") / size).alias("n"), F.col("top").alias("digest"))
    above = trees(tops, -(-largest // size), s).select("gid", F.col("pos").alias("block"), F.col("path").alias("rest"), "summit")
    joined = step.join(above, ["gid", "block"])
    return joined.withColumn("path", F.concat("path", "rest")).drop("rest", "block", "top")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    def step(node, mate):
        other = F.substring(mate, 2, 64)
        pair = F.when(mate.startswith("0"), F.concat(node, other)).when(mate.startswith("1"), F.concat(other, node)).otherwise(node)
        return F.sha2(pair.cast("binary"), 256)

    return F.aggregate(path, start, step)


def manifest(docs: DataFrame, doc_id: str, fields: list[str], group: str, suspect: Column | None = None, settings: Settings = Settings()) -> DataFrame:
    """Per row: id, leaf, subroot, root, ``path`` (slot and sibling per level, up to the root) and ``suspect``.

    ``suspect`` is any digest to carry along with a row, such as the leaf of a row under suspicion."""
    s, spark = settings, docs.sparkSession
    rows = docs.select(
        name_of(doc_id).alias("id"), name_of(group).alias("lang"), leaf([name_of(c) for c in fields]).alias("digest"),
        (F.lit(None).cast("string") if suspect is None else suspect).alias("suspect"), F.monotonically_increasing_id().alias("tie"),
    )
    rows = global_row_number(stored(rows, "merkle-leaves"), ["lang", "id", "digest", "tie"], "place")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("begin"))
    groups = global_row_number(stored(sizes, "merkle-groups"), ["lang"], "gid")
    most, count = groups.agg(F.max("n"), F.count("*")).first()
    nodes = rows.join(groups, rows["lang"].eqNullSafe(groups["lang"])).select(
        "gid", (F.col("place") - F.col("begin")).alias("pos"), "n", "digest", "id", "suspect"
    )
    inner = trees(nodes.withColumn("leaf", F.col("digest")), most or 0, s)
    inner = stored(inner.select("gid", "pos", "id", "leaf", "suspect", "path", F.col("summit").alias("subroot")), "merkle-trees")
    subroots = inner.where("pos = 0").select(F.lit(0).alias("gid"), (F.col("gid") - 1).alias("pos"), F.lit(count).cast("bigint").alias("n"), F.col("subroot").alias("digest"))
    outer = trees(subroots, count, s).select((F.col("pos") + 1).alias("gid"), F.col("path").alias("rest"), F.col("summit").alias("root"))
    out = inner.join(outer, "gid")
    return out.select(F.col("id").alias(doc_id), "leaf", "subroot", "root", F.concat("path", "rest").alias("path"), "suspect")


def checked(docs: DataFrame, tampered: Column, doc_id: str = "doc_id", fields=("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang",
            altered: str = "n_chars", settings: Settings = Settings()) -> DataFrame:
    """Id, leaf, subroot, root, proof_sha256, folded_root and verified: where ``tampered`` holds, the leaf that is folded
    up to the root is the one of the row with 1 added to ``altered``."""
    bad = leaf([F.when(tampered, name_of(c) + 1).otherwise(name_of(c)) if c == altered else name_of(c) for c in fields])
    rows = manifest(docs, doc_id, list(fields), group, F.when(tampered, bad), settings)
    mates = F.transform("path", lambda x: F.substring(x, 2, 64))
    rows = rows.withColumns({
        "proof_sha256": F.sha2(F.array_join(mates, "").cast("binary"), 256),
        "folded_root": folded(F.coalesce("suspect", "leaf"), F.col("path")),
    })
    return rows.select(name_of(doc_id), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
