"""Near-duplicate embeddings by NN-descent.

Method: equal vectors are collapsed. Leaves of a few random-projection trees give each
vector a first list of neighbours. In each round of descent a vector meets, at each of its
neighbours, the neighbours' neighbours, and keeps those that are closer than its list's
last. A list whose entries all reach the threshold is saturated: there may be more. Its
vector's list is enlarged to its whole class, the vectors that threshold edges connect,
compared block by block. Saturated vectors then look for neighbours outside their class, and
classes that meet are joined, until none do. Recall is audited against brute force for a
bounded number of vectors; below the asked recall, further trees and rounds with lists of
twice the length follow. What stays below it is warned of, or an error where too much is missing.
Threshold edges remain.
"""

import copy
import math
import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.llm.common import cut
from tallyfold.llm.components import components

#: Length of a neighbour list, trees to begin with, and rows that meet in one place.
NEIGHBOURS = 8
TREES = 6
LEAF = 64
MEETING = 256
ROUNDS = 2
#: Vectors that the audit compares with all others, the recall it asks for, the least it bears, and further attempts.
AUDITED = 400
RECALL = 0.97
LEAST_RECALL = 0.9
ATTEMPTS = 2

LIST = "u long, v long, sim double"


def unit(blobs: list[bytes], kind: str) -> np.ndarray:
    """Rows of length 1, in double precision."""
    rows = np.stack([np.frombuffer(b, kind) for b in blobs]).astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _dealt(rows: DataFrame, keys: list[str], member: str, limit: int, seed: int) -> DataFrame:
    """`part` in a group: groups over the limit are split at random into `parts` of about that size.

    The hash beside the keys gives both sides of the join a plain shuffle, so that the rows of
    a large group are spread over tasks.
    """
    mark = F.xxhash64(*keys).alias("mark")
    sizes = rows.groupBy(*keys).count().where(F.col("count") > limit).select("*", mark)
    parts = F.greatest(F.lit(1), F.ceil(F.coalesce("count", F.lit(1)) / limit))
    joined = rows.select("*", mark).join(sizes, [*keys, "mark"], "left").withColumn("parts", parts)
    return joined.withColumn("part", F.pmod(F.xxhash64(member, F.lit(seed)), "parts")).drop("count", "mark")


def _usable():
    """True for rows that can be compared; never null."""
    plain = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    some = F.exists("embedding", lambda x: x != 0)
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & plain & some, F.lit(False))


class Vectors:
    """The distinct usable vectors: (id, label, vec, copies), `vec` as bytes."""

    #: Columns by which some vectors are kept apart.
    roots: tuple[str, ...] = ()

    def __init__(self, table: DataFrame):
        item = table.schema["embedding"].dataType.elementType
        self.kind = "<f4" if isinstance(item, T.FloatType) else "<f8"
        kind = self.kind

        def pack(batches):
            for batch in batches:
                vecs = [np.array(v, kind).tobytes() for v in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(vecs, "binary")], ["vec_id", "label", "vec"])

        asked = table.where(_usable()).select(F.col("vec_id").cast("long"), F.col("label").cast("string"), "embedding")
        # Vectors of different lengths are never compared: the length is part of the label.
        labelled = asked.withColumn("label", F.concat_ws(":", F.size("embedding"), "label"))
        self.rows = cut(labelled.mapInArrow(pack, "vec_id long, label string, vec binary"))
        self.distinct = cut(self.rows.groupBy("label", "vec").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))


def _leaves(vectors: Vectors, bits: int, trees: list[int]) -> DataFrame:
    """(tree, label, code, id): the leaf of each vector in each tree."""
    kind = vectors.kind

    def run(batches):
        for batch in batches:
            blobs = batch.column("vec").to_pylist()
            by_size: dict[int, list[int]] = {}
            for k, b in enumerate(blobs):
                by_size.setdefault(len(b), []).append(k)
            for places in by_size.values():
                rows = unit([blobs[k] for k in places], kind)
                take = pa.array(places, "int64")
                for tree in trees:
                    planes = np.random.default_rng([tree, rows.shape[1]]).standard_normal((rows.shape[1], bits))
                    codes = ((rows @ planes) > 0) @ (1 << np.arange(bits, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(places), tree), "int32"), batch.column("label").take(take), pa.array(codes, "int64"), batch.column("id").take(take)], ["tree", "label", "code", "id"]
                    )

    return vectors.distinct.select("id", "label", "vec").mapInArrow(run, "tree int, label string, code long, id long")


def _meet(kind: str, count: int):
    """For the vectors that meet: each one's best `count` others, if closer than its own `bar`.

    Where they have a `root`, only vectors of another root count.
    """

    def run(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        rows = unit(table["vec"].to_pylist(), kind)
        bars = table["bar"].to_numpy()
        # Without roots each vector only leaves out itself.
        own = table["root" if "root" in table.column_names else "id"].to_numpy()
        us, vs, sims = [], [], []
        for at in range(0, len(ids), 1024):
            sim = rows[at : at + 1024] @ rows.T
            sim[own[at : at + 1024, None] == own[None, :]] = -2
            best = np.argsort(-sim, axis=1, kind="stable")[:, :count]
            close = np.take_along_axis(sim, best, 1)
            x, y = np.nonzero((close > -2) & (close > bars[at : at + 1024, None]))
            us.append(ids[at + x])
            vs.append(ids[best[x, y]])
            sims.append(close[x, y])
        return pa.table({"u": pa.array(np.concatenate(us), "int64"), "v": pa.array(np.concatenate(vs), "int64"), "sim": pa.array(np.concatenate(sims), "float64")})

    return run


def _best(found: DataFrame, count: int) -> DataFrame:
    """The `count` closest of each vector; of equally close ones the smaller ids."""
    pairs = found.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("sim")).alias("far"), "v")))  # at most trees or meetings x list length
    first = pairs.groupBy("u").agg(F.slice(ordered, 1, count).alias("list"))
    return first.select("u", F.explode("list").alias("e")).select("u", F.col("e.v").alias("v"), (-F.col("e.far")).alias("sim"))


def first_lists(vectors: Vectors, trees: list[int], count: int, leaf: int = LEAF) -> DataFrame:
    """Lists from the leaves of random-projection trees; large leaves are split at random."""
    largest = vectors.distinct.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits = min(40, max(0, math.ceil(math.log2(max(1, largest / (leaf / 2))))))
    places = _dealt(cut(_leaves(vectors, bits, trees)), ["tree", "label", "code"], "id", leaf, 1)
    vecs = vectors.distinct.select("id", "vec", F.lit(-1.5).alias("bar"), *vectors.roots)
    met = places.join(vecs, "id").groupBy("tree", "label", "code", "part").applyInArrow(_meet(vectors.kind, count // 2), LIST)
    return cut(_best(met, count))


def descend(vectors: Vectors, lists: DataFrame, count: int, seed: int, also: DataFrame | None = None) -> DataFrame:
    """One round: vectors meet at their neighbours, and at those of `also`, and lists take what is closer."""
    places = lists if also is None else lists.unionAll(also)
    ends = places.select(F.col("v").alias("pivot"), F.col("u").alias("id"))
    back = places.select(F.col("u").alias("pivot"), F.col("v").alias("id"))
    own = vectors.distinct.select(F.col("id").alias("pivot"), "id")
    meetings = _dealt(cut(ends.unionAll(back).unionAll(own).distinct()), ["pivot"], "id", MEETING, seed)
    bars = lists.groupBy(F.col("u").alias("id")).agg(F.when(F.count("*") >= count, F.min("sim")).alias("bar"))
    vecs = vectors.distinct.join(bars, "id", "left").select("id", "vec", F.coalesce("bar", F.lit(-1.5)).alias("bar"), *vectors.roots)
    met = meetings.join(vecs, "id").groupBy("pivot", "part").applyInArrow(_meet(vectors.kind, count // 2), LIST)
    return cut(_best(lists.unionAll(met), count))


def _block_links(kind: str, threshold: float):
    """For two blocks of a class: how many copies each member of the first links to in the second."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        first, second = table.filter(table["first"]), table.filter(table["second"])
        if not first.num_rows or not second.num_rows:
            return pa.table({"id": pa.array([], "int64"), "n": pa.array([], "int64")})
        a, b = unit(first["vec"].to_pylist(), kind), unit(second["vec"].to_pylist(), kind)
        linked = a @ b.T >= threshold
        linked &= first["id"].to_numpy()[:, None] != second["id"].to_numpy()[None, :]
        return pa.table({"id": first["id"].cast("int64"), "n": pa.array(linked @ second["copies"].to_numpy(), "int64")})

    return run


def _enlarged(vectors: Vectors, members: DataFrame, threshold: float) -> DataFrame:
    """(id, n): links inside the classes `members` (id, root), each vector with its whole class.

    A class is dealt into blocks, and each pair of blocks is one task's work.
    """
    rows = _dealt(members, ["root"], "id", 2 * MEETING, 7).withColumnRenamed("part", "own")
    spread = rows.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    # A row goes to its block's pairs as the first side, and as the second side to those of all others.
    as_first = spread.select("id", "root", F.col("own").alias("a"), F.col("other").alias("b"), F.lit(True).alias("first"), (F.col("own") == F.col("other")).alias("second"))
    as_second = spread.where("own != other").select("id", "root", F.col("other").alias("a"), F.col("own").alias("b"), F.lit(False).alias("first"), F.lit(True).alias("second"))
    placed = as_first.unionAll(as_second).join(vectors.distinct.select("id", "vec", "copies"), "id")
    counted = placed.groupBy("root", "a", "b").applyInArrow(_block_links(vectors.kind, threshold), "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def _bridges(vectors: Vectors, lists: DataFrame, classes: DataFrame, saturated: DataFrame, trees: list[int], count: int, threshold: float) -> DataFrame:
    """Threshold edges between the classes of saturated vectors: their lists had no place for them.

    An edge that has an end with room in its list is in that list.
    """
    apart = copy.copy(vectors)
    full = classes.join(saturated.select(F.col("u").alias("node")), "node", "left_semi").select(F.col("node").alias("id"), "root")
    apart.distinct, apart.roots = cut(vectors.distinct.join(full, "id")), ("root",)
    several = apart.distinct.groupBy("label").agg((F.min("root") < F.max("root")).alias("several")).where("several")
    if several.isEmpty():
        return lists.limit(0)
    apart.distinct = cut(apart.distinct.join(several.select("label"), "label", "left_semi"))
    outside = first_lists(apart, trees, count)
    for k in range(ROUNDS):
        outside = descend(apart, outside, count, 100 + k, lists)
    return cut(outside.where(F.col("sim") >= threshold))


def _links(vectors: Vectors, lists: DataFrame, trees: list[int], count: int, threshold: float) -> DataFrame:
    """(id, root, n): class and links to copies of other vectors, of each vector with a link."""
    near = cut(lists.where(F.col("sim") >= threshold))
    saturated = cut(near.groupBy("u").count().where(F.col("count") >= count))
    classes = components(near.select("u", "v"))
    while not (bridges := _bridges(vectors, lists, classes, saturated, trees, count, threshold)).isEmpty():
        near = cut(near.unionAll(bridges))
        classes = components(near.select("u", "v"))
    roots = classes.join(saturated.select(F.col("u").alias("node")), "node", "left_semi").select("root").distinct()
    large = classes.join(roots, "root", "left_semi").select(F.col("node").alias("id"), "root")
    both = near.select("u", "v").unionAll(near.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    copies = vectors.distinct.select(F.col("id").alias("v"), "copies")
    listed = both.join(copies, "v").groupBy(F.col("u").alias("id")).agg(F.sum("copies").alias("n"))
    listed = listed.join(large, "id", "left_anti")
    counted = listed.unionByName(_enlarged(vectors, cut(large), threshold))
    return cut(counted.join(classes.withColumnRenamed("node", "id"), "id"))


def audit(vectors: Vectors, links: DataFrame, threshold: float, count: int = AUDITED) -> float:
    """Share of the true links that were found, of the `count` vectors with the least hashes."""
    picked = vectors.distinct.orderBy(F.xxhash64("id"), "id").limit(count)
    rows = picked.select("id", "label", "vec").collect()
    kind, sent = vectors.kind, vectors.distinct.sparkSession.sparkContext.broadcast([(r.id, r.label, bytes(r.vec)) for r in rows])

    def run(batches):
        for batch in batches:
            by_label: dict[str, list[int]] = {}
            for k, label in enumerate(batch.column("label").to_pylist()):
                by_label.setdefault(label, []).append(k)
            blobs, ids, copies = batch.column("vec").to_pylist(), batch.column("id").to_numpy(), batch.column("copies").to_numpy()
            for label, places in by_label.items():
                asked = [q for q in sent.value if q[1] == label]
                if asked:
                    near = unit([q[2] for q in asked], kind) @ unit([blobs[k] for k in places], kind).T >= threshold
                    near &= np.array([q[0] for q in asked])[:, None] != ids[places][None, :]
                    yield pa.RecordBatch.from_arrays([pa.array([q[0] for q in asked], "int64"), pa.array(near @ copies[places], "int64")], ["id", "real"])

    real = vectors.distinct.mapInArrow(run, "id long, real long").groupBy("id").agg(F.sum("real").alias("real"))
    found = real.join(links.select("id", "n"), "id", "left").agg(F.sum("real"), F.sum(F.least("real", F.coalesce("n", F.lit(0))))).first()
    return found[1] / found[0] if found[0] else 1.0


class LowRecall(RuntimeError):
    """The neighbour graph lacks too many links for its classes to be of use."""


def near_duplicates(embeddings: DataFrame, threshold: float = 0.98, neighbours: int = NEIGHBOURS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    Two vectors are linked if their labels are equal, not null, and their cosine reaches the
    threshold. `component_id` is the smallest vec_id that links reach; `kept` is true for that
    vector. Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, nor do those without a label or a vec_id; nor vectors of different lengths. A
    repeated row counts as one more vector; rows that share a vec_id and differ should not be.
    An empty table gives an empty result. If the audit still finds less than `LEAST_RECALL` of
    the links after all attempts, that is an error.
    """
    asked = embeddings.select("vec_id", "label", "embedding")
    vectors = Vectors(asked)
    trees = list(range(TREES))
    lists = first_lists(vectors, trees, neighbours)
    for attempt in range(ATTEMPTS + 1):
        for k in range(ROUNDS):
            lists = descend(vectors, lists, neighbours, 10 * attempt + k)
        links = _links(vectors, lists, trees, neighbours, threshold)
        recall = audit(vectors, links, threshold)
        if recall >= RECALL:
            break
        if attempt == ATTEMPTS:
            if recall < LEAST_RECALL:
                raise LowRecall(f"only {recall:.3f} of the audited links were found after {ATTEMPTS + 1} attempts")
            warnings.warn(f"{recall:.3f} of the audited links were found, less than {RECALL}", RuntimeWarning, stacklevel=2)
            break
        trees, neighbours = [t + TREES for t in trees], 2 * neighbours
        lists = cut(_best(lists.unionAll(first_lists(vectors, trees, neighbours)), neighbours))
    named = vectors.distinct.join(links, "id", "left").select(
        "label", "vec", F.coalesce("root", "id").alias("component_id"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    # The hash beside the keys gives both sides a plain shuffle, so that a hot vector is split.
    mark = F.xxhash64("label", "vec").alias("mark")
    known = vectors.rows.select("*", mark).join(named.select("*", mark), ["label", "vec", "mark"]).select("vec_id", "n_links", "component_id")
    return known.unionByName(_unlinked(asked)).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _unlinked(asked: DataFrame) -> DataFrame:
    """The vectors that can't be compared, each on its own."""
    vec_id = F.col("vec_id").cast("long")
    return asked.where(~_usable()).select(vec_id.alias("vec_id"), F.lit(0).cast("long").alias("n_links"), vec_id.alias("component_id"))
