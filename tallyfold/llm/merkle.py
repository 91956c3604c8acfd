"""Merkle manifest of a dataset, with the proof of every row by pointer jumping.

Method: rows are leaves, and those of one group form a tree in the order of their keys: runs
of `arity` digests become the digest of the run, level by level. The roots of the groups are
the leaves of one more tree, whose root stands for the dataset. Every node points at its
parent and holds the siblings on that way. A self-join replaces a node's pointer by that of
the node it points at and appends that node's siblings, so the distance doubles each time,
until all leaves point at their root; their segments then are the proofs.

Before round r only nodes on levels that 2^r divides are of use: those that 2^(r+1) divides
jump, to the others. So the side that is looked up has a cubic root, then a ninth root and
so on of the leaves, and Spark broadcasts it once its size allows that.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import cut
from tallyfold.operators.lookups import spread_join

#: What the siblings of a node at one level are: the digests left and right of it, joined.
SEGMENT = "array<struct<before: string, after: string>>"


def digest_of(*columns) -> Column:
    """SHA-256 in lowercase hex of the columns one after another.

    A value is written as its length in UTF-8 bytes, a colon and itself; null as a dash.
    """
    parts = []
    for c in columns:
        text = F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings of a proof, level by level, left to right."""
    siblings = F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")
    return F.sha2(siblings.cast("binary"), 256)


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """The rows with `place`, from 0 in the order of each tree, and `n`, the rows of the tree.

    The rows are dealt by ranges of (tree, order), so a large tree spreads over many tasks;
    only counts by (range, tree) are added up.
    """
    dealt = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    dealt = cut(dealt.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")))
    counts = dealt.groupBy("_part", tree).agg(F.count("*").alias("rows"), F.min("_at").alias("first"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")
    shifts = counts.select("_part", tree, shift.alias("shift"), F.sum("rows").over(whole).alias("n"))
    placed = dealt.join(shifts, ["_part", tree]).withColumn("place", F.col("_at") + F.col("shift"))
    return placed.drop("_part", "_at", "shift")


def _grown(leaves: DataFrame, tree: str, arity: int) -> tuple[DataFrame, DataFrame, int]:
    """(nodes below the roots, roots, height of the highest tree) over `leaves`.

    Leaves are (tree, place, n, digest), `leaf` with the digest again, and what they carry. Nodes have (tree, level, place,
    segment, up_level, up_place); on level 0 also what the leaves carry.
    """
    carried = [c for c in leaves.columns if c not in (tree, "place", "n", "digest")]
    largest = leaves.agg(F.max("n")).first()[0] or 0
    nodes, roots, height = None, leaves.where("n = 1").select(tree, "digest"), 0
    level = leaves.where("n > 1")
    while largest > 1:
        run = F.floor(F.col("place") / arity).cast("long")
        child = F.struct("place", "digest", *(carried if height == 0 else []))
        runs = level.groupBy(tree, "n", run.alias("up_place")).agg(F.array_sort(F.collect_list(child)).alias("children"))
        runs = cut(runs)
        below = runs.select(tree, "up_place", F.transform("children", lambda c: c["digest"]).alias("digests"), F.posexplode("children").alias("k", "child"))
        at = F.col("k")
        siblings = F.struct(
            F.array_join(F.slice("digests", 1, at), "").alias("before"),
            F.array_join(F.slice("digests", at + 2, F.lit(arity)), "").alias("after"),
        )
        node = below.select(
            tree,
            F.lit(height).alias("level"),
            F.col("child.place").alias("place"),
            F.array(siblings).cast(SEGMENT).alias("segment"),
            F.lit(height + 1).alias("up_level"),
            "up_place",
            *[(F.col(f"child.{c}") if height == 0 else F.lit(None).cast(leaves.schema[c].dataType)).alias(c) for c in carried],
        )
        nodes = node if nodes is None else nodes.unionAll(node)
        parent = F.sha2(F.array_join(F.transform("children", lambda c: c["digest"]), "").cast("binary"), 256)
        above = runs.select(tree, F.col("up_place").alias("place"), F.ceil(F.col("n") / arity).cast("long").alias("n"), parent.alias("digest"))
        roots = roots.unionAll(above.where("n = 1").select(tree, "digest"))
        level, height, largest = above.where("n > 1"), height + 1, -(-largest // arity)
    return nodes, roots, height


def _jumped(nodes: DataFrame, tree: str, height: int) -> DataFrame:
    """The leaves among the nodes with the siblings of their whole way in `segment`."""
    step = 1
    while step < height:
        jump = nodes.where(F.col("level") % (2 * step) == 0)
        target = nodes.where(F.col("level") % (2 * step) == step).select(
            tree,
            F.col("level").alias("up_level"),
            F.col("place").alias("up_place"),
            F.col("segment").alias("further"),
            F.col("up_level").alias("next_level"),
            F.col("up_place").alias("next_place"),
        )
        met = jump.join(target, [tree, "up_level", "up_place"], "left")
        moved = {
            "segment": F.concat("segment", F.coalesce("further", F.array().cast(SEGMENT))),
            "up_level": F.coalesce("next_level", "up_level"),
            "up_place": F.coalesce("next_place", "up_place"),
        }
        nodes, step = cut(met.withColumns(moved).drop("further", "next_level", "next_place").select(nodes.columns)), 2 * step
    return nodes.where("level = 0")


def _proven(leaves: DataFrame, tree: str, arity: int) -> tuple[DataFrame, DataFrame]:
    """(leaves with their proof up to the root of their tree, roots)."""
    nodes, roots, height = _grown(leaves, tree, arity)
    alone = leaves.where("n = 1").withColumn("proof", F.array().cast(SEGMENT))
    columns = [c for c in leaves.columns if c not in ("place", "n")]
    if nodes is None:
        return alone.select(*columns, "proof"), roots
    # The digest of a leaf travels with it, as `leaf`.
    proven = _jumped(nodes, tree, height).withColumnRenamed("segment", "proof")
    return proven.withColumn("digest", F.col("leaf")).select(*columns, "proof").unionAll(alone.select(*columns, "proof")), roots


def proofs(docs: DataFrame, leaf: Column, group: str = "source", key: str = "doc_id", arity: int = 3, **carried) -> DataFrame:
    """(key, leaf, subroot, root, proof, and what is carried) of every row.

    `leaf` is the digest of a row, `carried` further columns by name, computed in the same
    scan. `proof` lists for each level the digests before and after the row's own way,
    through the root of its group (`subroot`) to the root of all; `folded` gives the root
    from it. Groups are ordered bytewise, null first; rows of a group by key, null first.

    Rows with equal keys come in the order of their leaves; repeated rows are leaves of
    their own and come back repeated. Texts are hashed whole, whatever their length. An
    empty table gives an empty result. Columns that are not named are not read.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("_tree")
    extra = [c.alias(name) for name, c in carried.items()]
    rows = cut(docs.select(tree, F.col(key).alias("_key"), leaf.alias("leaf"), *extra))
    ranked = numbered(rows, "_tree", ["_key", "leaf"]).withColumn("digest", F.col("leaf"))
    own, subroots = _proven(cut(ranked), "_tree", arity)
    subroots = numbered(subroots.select(F.lit(0).alias("_all"), F.col("_tree").alias("_group"), "digest"), "_all", ["_group"])
    upper, root = _proven(cut(subroots.withColumn("leaf", F.col("digest"))), "_all", arity)
    upper = upper.join(root.select("_all", F.col("digest").alias("root")), "_all")
    upper = upper.select(F.col("_group").alias("_tree"), F.col("leaf").alias("subroot"), F.col("proof").alias("_upper"), "root")
    found = spread_join(own, upper, ["_tree"], "inner")
    proof = F.concat("proof", "_upper").alias("proof")
    return found.select(F.col("_key").alias(key), "leaf", "subroot", "root", proof, *carried)
