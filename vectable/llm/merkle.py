"""Merkle manifest of a table: a leaf hash per row, a tree per group, a tree over the groups, a proof per row.

Every row gets its rank within its group. The low digits of the rank, one per level of the tree, are
grouped away one after the other inside blocks of 2^8 rows, and each step nests the children it has
hashed as structs in their parent. One exchange by block and one sort by all digits serve the whole
chain, since every shorter list of digits is a prefix of the one before. A block is then one row that
holds its part of the tree, and a transform and explode give the proofs inside it, without a join.
The roots of blocks are the leaves of the next round, so that the tree above a block is built
the same way; a block takes what stands above it by its key, one row for 256.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from vectable.sources.tables import settle, small_side

BLOCK_BITS = 8  # digits grouped away in a block: no row holds more than 2^8 leaves


def field_bytes(value: Column) -> Column:
    """How one field enters a leaf: ``-`` for NULL, else its UTF-8 length, a colon and the value."""
    shown = value.cast("string")
    return F.when(shown.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown))


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Hash of a row: lowercase hex SHA-256 of its fields."""
    return F.sha2(F.concat(*[field_bytes(f) for f in fields]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""

    def step(found: Column, at: Column) -> Column:
        beside = F.coalesce(at["hash"], F.lit(""))
        return F.sha2(F.when(at["left"], F.concat(beside, found)).otherwise(F.concat(found, beside)), 256)

    return F.aggregate(proof, leaf, step)


def proof_hash(proof: Column) -> Column:
    """One hash over the siblings of a proof."""
    return F.sha2(F.array_join(F.transform(proof, lambda at: at["hash"]), ""), 256)


def manifest(
    rows: DataFrame, fields: Sequence[str], key: str = "doc_id", group: str = "lang", claimed: Column | None = None
) -> DataFrame:
    """key, leaf, claimed, subroot, root, proof for every row.

    ``fields`` enter the leaf in their order. Within a group leaves ascend by key (NULL first), equal keys
    by leaf, so that repeated rows have a place each; groups ascend by name (NULL first, and a group of its
    own). Two nodes that follow each other become the hash of both, a last one without a partner the
    hash of itself, until one is left; a group of one row has its leaf as subroot. ``claimed`` is a hash per row
    to be held against the tree later, the leaf itself by default: ``fold(claimed, proof) == root``.
    ``proof`` lists the steps from the leaf to the root: the sibling's hash (NULL where a node has none) and
    whether it stands on the left. NULL fields are told from empty ones. An empty table has no rows here.
    Other columns are not read, whatever their names.
    """
    leaf = leaf_hash([F.col(f"`{f}`") for f in fields])
    leaves = settle(  # ranking reads them twice, texts are read once
        rows.select(F.col(f"`{group}`").alias("grp"), F.col(f"`{key}`").alias("key"), leaf.alias("hash"), (leaf if claimed is None else claimed).alias("other"))
        .select("grp", "key", "hash", F.when(F.col("other") != F.col("hash"), F.col("other")).alias("other"))
    )
    placed, height = _ranked(leaves, ["grp"], ["key", "hash"])
    rounds = _climb(placed.select("grp", "rank", "levels", "hash", F.struct("key", "other").alias("item")), height)

    top = rounds[-1].select(F.lit(0).alias("all"), "grp", "hash")  # one row per group
    over, above = _ranked(settle(top), ["all"], ["grp"])
    upper = _climb(over.select(F.col("all").alias("grp"), "rank", "levels", "hash", F.struct(F.col("grp").alias("name")).alias("item")), above)
    start = upper[-1].select("grp", "block", F.col("hash").alias("root"), _no_steps().alias("steps"))
    groups = _descend(upper, start, ["root"])
    start = groups.select(F.col("item.name").alias("grp"), F.lit(0).cast("bigint").alias("block"), F.col("hash").alias("subroot"), "root", "steps")
    out = _descend(rounds, settle(start), ["subroot", "root"])
    return out.select(
        F.col("item.key").alias(key), F.col("hash").alias("leaf"), F.coalesce("item.other", "hash").alias("claimed"),
        "subroot", "root", F.col("steps").alias("proof"),
    )


def _no_steps() -> Column:
    return F.array().cast("array<struct<hash:string,left:boolean>>")


def _ranked(nodes: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, int]:
    """``nodes`` with rank (from 0) within the group and the levels of the group's tree, and the most levels.

    Rows are dealt by ranges of (group, order), so a hot group spans many tasks; a row's rank is its place in
    its range plus the rows of the group in earlier ranges, of which there is one count per range and group.
    """
    keys = [*group, *order]
    dealt = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = settle(dealt.withColumn("at", F.monotonically_increasing_id()))  # the range in the high bits, the place in the low 33
    part = F.shiftright("at", 33)
    sizes = dealt.groupBy(*group, part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    names = ", ".join(group)
    sizes = sizes.select(
        *[F.col(g).alias(f"__{g}") for g in group], "part",
        F.expr(f"first - coalesce(sum(n) OVER (PARTITION BY {names} ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("shift"),
        F.expr(f"sum(n) OVER (PARTITION BY {names})").alias("total"),
    )
    levels = F.when(F.col("total") <= 1, 0).otherwise(F.length(F.bin(F.col("total") - 1)))  # smallest with 2^levels >= total
    sizes = settle(sizes.withColumn("levels", levels).drop("total"))
    height = sizes.agg(F.max("levels")).first()[0] or 0
    on = [dealt[g].eqNullSafe(F.col(f"__{g}")) for g in group] + [part == F.col("part")]
    placed = dealt.join(small_side(sizes), on).withColumn("rank", F.col("at") - F.col("shift"))
    return placed.select(*nodes.columns, "rank", "levels"), height


def _climb(nodes: DataFrame, height: int) -> list[DataFrame]:
    """Tables of blocks, lowest first, up to the one with a single block per group.

    ``nodes``: grp, rank, levels, hash, item; ``levels`` is how many levels the group has from here up.
    """
    rounds = []
    while True:
        rounds.append(settle(_blocks(nodes)))
        height -= BLOCK_BITS
        if height <= 0:
            return rounds
        nodes = rounds[-1].select(
            "grp", F.col("block").alias("rank"), F.greatest(F.col("levels") - BLOCK_BITS, F.lit(0)).alias("levels"), "hash",
            F.struct("block").alias("item"),
        )


def _blocks(nodes: DataFrame) -> DataFrame:
    """grp, levels, block, hash, children: the digits of the rank grouped away from the lowest up."""
    digits = [f"d{i}" for i in reversed(range(BLOCK_BITS))]
    digit = [F.shiftright("rank", i).bitwiseAND(F.lit(1)).cast("int").alias(f"d{i}") for i in reversed(range(BLOCK_BITS))]
    keys = ["grp", "levels", "block"]
    rows = nodes.select("grp", "levels", F.shiftright("rank", BLOCK_BITS).alias("block"), *digit, F.struct("hash", "item").alias("node"))
    rows = rows.repartition("grp", "block").sortWithinPartitions(*keys, *digits)
    for level in range(1, BLOCK_BITS + 1):
        last = F.col(digits.pop())
        rows = rows.groupBy(*keys, *digits).agg(
            F.first(F.when(last == 0, F.col("node")), ignorenulls=True).alias("a"),
            F.first(F.when(last == 1, F.col("node")), ignorenulls=True).alias("b"),
        )
        both = F.sha2(F.concat(F.col("a.hash"), F.coalesce("b.hash", F.lit(""))), 256)
        up = F.when(F.col("levels") >= level, both).otherwise(F.col("a.hash"))  # above the group's root nothing is hashed
        rows = rows.select(*keys, *digits, F.struct(up.alias("hash"), F.array_compact(F.array("a", "b")).alias("children")).alias("node"))
    return rows.select(*keys, "node.hash", "node.children")


def _descend(rounds: list[DataFrame], paths: DataFrame, carried: list[str]) -> DataFrame:
    """grp, hash, item, steps and the ``carried`` columns for every node of the lowest round, from ``paths``:
    grp, block, steps and those columns for every block of the highest."""
    for n, blocks in enumerate(reversed(rounds)):
        above = small_side(paths).withColumnsRenamed({"grp": "__grp", "block": "__block"})
        met = blocks.join(above, [F.col("grp").eqNullSafe(F.col("__grp")), F.col("block") == F.col("__block")])
        inside = _nodes_below(F.col("children"), BLOCK_BITS, [])
        found = met.select("grp", "levels", *carried, F.col("steps").alias("above"), F.explode(inside).alias("node"))
        own = F.slice("node.steps", 1, F.least(F.col("levels"), F.lit(BLOCK_BITS)))  # none from above the group's root
        out = found.select("grp", *carried, "node.hash", "node.item", F.concat(own, "above").alias("steps"))
        if n < len(rounds) - 1:
            paths = settle(out.select("grp", F.col("item.block").alias("block"), "steps", *carried))
    return out


def _nodes_below(children: Column, level: int, above: list[Column]) -> Column:
    """All nodes under ``children`` as one array, each with its steps up to here, nearest first."""

    def under(child: Column, place: Column) -> Column:
        step = F.struct(F.get(children, 1 - place)["hash"].alias("hash"), (place == 1).alias("left"))
        if level == 1:
            return F.array(F.struct(child["hash"].alias("hash"), child["item"].alias("item"), F.array(step, *above).alias("steps")))
        return _nodes_below(child["children"], level - 1, [step, *above])

    return F.flatten(F.transform(children, under))
