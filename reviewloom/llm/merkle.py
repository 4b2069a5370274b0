"""A Merkle manifest of a table: a hash tree per group, a tree over the groups, a proof for every row.

Rows of a group are numbered in order. Every aligned block of 256 neighbours keeps each of
its levels as one string of hex digests: parents are hashes of fixed-width substrings, and
the proof of a node is made of the substrings beside it. The roots of the blocks are the
nodes of the next, 256 times smaller round. No row holds more than one block, so neither a
large group nor a large table meets in one task.

Null values are hashed as "-". A null doc_id comes first, a null lang is a group of its own.
Rows of one group and doc_id are ordered by leaf; equal rows are leaves like any others, and
get proofs of neighbouring places. An empty table gives no rows. Long texts are hashed where
they are read and go no further. Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.llm import common

WIDTH = 64  # hex digits of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Shape:
    """Nodes under one parent, and levels that a block holds."""

    fan_out: int = 2
    levels: int = 8

    @property
    def block(self) -> int:
        return self.fan_out**self.levels


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: list[Column]) -> Column:
    """Hash of a row: every value with its length in bytes, so that no two rows read alike."""
    as_text = [f.cast("string") for f in fields]
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in as_text))


def numbered(nodes: DataFrame, order: list[str], partitions: int) -> DataFrame:
    """Adds pos, the place of a row in its group, and total, the rows of the group.

    One range-partitioned sort over all groups, whose parts are counted afterwards. The last
    sort key splits rows that are equal in all others.
    """
    spread = nodes.withColumn("_split", F.xxhash64(F.monotonically_increasing_id()))
    ranged = spread.repartitionByRange(partitions, "grp", *order, "_split").sortWithinPartitions("grp", *order, "_split")
    at = F.monotonically_increasing_id()  # the part in the upper bits, the place in the part in the lower
    rows = common.kept_table(ranged.drop("_split").withColumn("_at", at).withColumn("_part", F.shiftright("_at", 33)))
    runs = rows.groupBy("grp", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    parts = Window.partitionBy("grp").orderBy("_part")
    before = F.coalesce(F.sum("_n").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(
        F.col("grp").alias("_grp"), F.col("_part").alias("_p"), (before - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("grp")).alias("total"),
    )
    # at most a row for each part and group boundary; a part of the table belongs to few of them
    joined = rows.join(common.small(common.kept_table(runs)), (F.col("grp") == F.col("_grp")) & (F.col("_part") == F.col("_p")))
    return joined.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_grp", "_p", "_shift")


def node(level: Column, first: Column | int, count: Column | int) -> Column:
    """A substring of nodes, counted from 0."""
    return F.substring(level, F.lit(first) * WIDTH + 1, F.lit(count) * WIDTH)


def parents(level: Column, fan_out: int) -> Column:
    """The level above a level of more than one node, or of the last nodes of a longer one."""
    runs = F.ceil(F.length(level) / (WIDTH * fan_out)).cast("int")
    hashed = F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(node(level, i * fan_out, fan_out), 256))
    return F.array_join(hashed, "")


def blocks(nodes: DataFrame, payload: list[str], shape: Shape) -> DataFrame:
    """Aligned blocks (grp, block, total, level0 ..., root, members) of nodes (grp, pos, total, node)."""
    # a group of at most one block ends at its single root, others go up all levels
    depth = F.least(F.lit(shape.levels), sum(
        (F.col("total") > shape.fan_out**i).cast("int") for i in range(shape.levels)
    ))
    member = F.struct("pos", "node", *payload)
    out = nodes.groupBy("grp", (F.floor(F.col("pos") / shape.block)).alias("block"), "total").agg(
        F.sort_array(F.collect_list(member)).alias("members")
    ).withColumns({"level0": F.array_join("members.node", ""), "depth": depth})
    for i in range(shape.levels):
        out = out.withColumn(f"level{i + 1}", F.when(F.col("depth") > i, parents(F.col(f"level{i}"), shape.fan_out)))
    top = F.coalesce(*(F.col(f"level{i}") for i in range(shape.levels, -1, -1)))
    return common.kept_table(out.withColumn("top", top))


def steps(shape: Shape, place: Column) -> Column:
    """Siblings of a node on the way up its block: at every level those on its left and on its right."""
    out = []
    for i in range(shape.levels):
        at = F.floor(place / shape.fan_out**i).cast("int")
        first = (at / F.lit(shape.fan_out)).cast("int") * shape.fan_out
        level = F.col(f"level{i}")
        right = node(level, at + 1, F.lit(shape.fan_out - 1) - (at - first))
        both = F.struct(node(level, first, at - first).alias("left"), right.alias("right"))
        out.append(F.when(F.col("depth") > i, both))
    return F.filter(F.array(*out), lambda s: s.isNotNull())


def members(of: DataFrame, payload: list[str], shape: Shape) -> DataFrame:
    """The nodes of blocks, each with the steps of its block and of the blocks above."""
    rows = of.select("*", F.explode("members").alias("_m")).withColumn("_own", steps(shape, F.col("_m.pos") % shape.block))
    return rows.select(
        "grp", F.col("_m.pos").alias("pos"), F.col("_m.node").alias("node"), *(F.col(f"_m.{p}").alias(p) for p in payload),
        F.concat("_own", "above").alias("path"), "subroot",
    )


def forest(nodes: DataFrame, payload: list[str], shape: Shape) -> tuple[DataFrame, DataFrame]:
    """Trees over numbered nodes: every node with its path and subroot, and the root of every group."""
    rounds, largest = [], nodes.agg(F.max("total")).first()[0] or 0
    carried = payload
    while True:
        rounds.append(blocks(nodes, carried, shape))
        largest = math.ceil(largest / shape.block)
        if largest <= 1:
            break
        # a group that is down to its root stays one node, so it goes up with the others unchanged
        upper = F.greatest(F.ceil(F.col("total") / shape.block), F.lit(1))
        nodes = rounds[-1].select("grp", F.col("block").alias("pos"), upper.alias("total"), F.col("top").alias("node"))
        carried = []
    roots = rounds[-1].select("grp", F.col("top").alias("root"))
    above = rounds[-1].withColumns({"above": F.array().cast("array<struct<left:string,right:string>>"), "subroot": F.col("top")})
    for lower in reversed(rounds[:-1]):
        paths = members(above, [], shape).select("grp", F.col("pos").alias("block"), F.col("path").alias("above"), "subroot")
        above = lower.join(paths, ["grp", "block"])
    return members(above, payload, shape), roots


def fold(start: Column, path: Column) -> Column:
    """The root that a node and its siblings give."""
    return F.aggregate(path, start, lambda n, s: digest(s["left"], n, s["right"]))


def proof(path: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(rows: DataFrame, order: list[str], payload: list[str], shape: Shape = Shape(), partitions: int | None = None) -> DataFrame:
    """Rows (grp, node, order, payload) with path (siblings up to the root), subroot and root.

    grp is a string that is not null; groups are ordered bytewise.
    """
    partitions = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = list(dict.fromkeys([*order, *payload]))
    leaves, roots = forest(numbered(rows.select("grp", "node", *columns), [*order, "node"], partitions), columns, shape)
    groups = common.kept_table(roots).select(F.lit("").alias("grp"), F.col("grp").alias("of"), F.col("root").alias("node"))
    tops, _ = forest(numbered(groups, ["of"], partitions), ["of"], shape)
    tops = tops.select(F.col("of").alias("grp"), F.col("path").alias("_top"), F.col("subroot").alias("root"))
    joined = leaves.join(common.small(common.kept_table(tops)), "grp")
    return joined.withColumn("path", F.concat("path", "_top")).drop("_top")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether it still gives the root after tampering."""
    docs = common.table(spark, sf_dir, "documents")
    more = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(1)).otherwise(0)
    group = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    rows = docs.select(
        "doc_id", group.alias("grp"), leaf([F.col(c) for c in FIELDS]).alias("node"),
        leaf([F.col(c) + more if c == "n_chars" else F.col(c) for c in FIELDS]).alias("now"),
    )
    out = manifest(rows, ["doc_id"], ["now"]).withColumn("folded_root", fold(F.col("now"), F.col("path")))
    return out.select(
        "doc_id", F.col("node").alias("leaf"), "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
