"""SimHash near-duplicates by deletion-variant signatures.

Method: fingerprints that differ in at most `distance` bits are cut into so few segments
that one of them differs in at most one bit. Each segment is indexed once per bit, with
that bit as a wildcard. Two fingerprints whose segment differs in one bit or none share a
variant, so an equality join finds them, and the whole distance is verified in the join.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import cut
from tallyfold.llm.components import components
from tallyfold.operators.lookups import spread_join


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """The SimHash of a text in UTF-8; 0 without words.

    Words are lower-cased in A-Z only. A bit is set if over half of the shingles' hashes
    have it; a shingle that is repeated counts each time.
    """
    words = text.lower().split()  # bytes: at blanks and tab to carriage return
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], stops[:-1]))[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts, (stops[shingle - 1 :] - 1).tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    all_bits = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(hashes), 1 << 16):  # whole texts, but not all of their bits at a time
        ones += np.unpackbits(all_bits[at : at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp) of every document, the fingerprint as a signed long; 0 for a null text.

    A column `text_key` is handed on.
    """
    more = [c for c in ("text_key",) if c in docs.columns]

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast("binary")
            prints = [fingerprint(t.as_py() or b"", shingle, seed) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast("int64"), pa.array(np.array(prints, np.uint64).view(np.int64)), *batch.columns[2:]], ["doc_id", "fp", *more])

    return docs.select("doc_id", "text", *more).mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *more)))


def _segments(distance: int, bits: int = 64) -> list[int]:
    """Masks of as few segments as leave one with at most one differing bit."""
    count = distance // 2 + 1
    ends = [bits * k // count for k in range(count + 1)]
    return [sum(1 << b for b in range(a, z)) for a, z in zip(ends, ends[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct values `fp` within the distance, each once.

    Each value gets 64 rows, one for each bit as a wildcard. A pair shares one variant for a
    segment that differs in one bit, and all variants of a segment that is the same; of
    these only the first counts, and only in the first segment that qualifies.
    """
    masks = _segments(distance)
    bit = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit")
    mask = F.coalesce(*(F.when(F.col("bit") < m.bit_length(), F.lit(_signed(m))) for m in masks))
    hole = F.expr("shiftleft(1L, bit)")
    variants = prints.select("fp", bit).withColumn("mask", mask).withColumn("variant", F.col("fp").bitwiseAND(F.col("mask")).bitwiseAND(F.bitwise_not(hole)))
    left = variants.select("bit", "variant", F.col("fp").alias("a"))
    right = variants.select(F.col("bit").alias("same_bit"), F.col("variant").alias("same_variant"), F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    bits = lambda m: F.bit_count(differ.bitwiseAND(F.lit(_signed(m))))
    first, earlier = None, F.lit(True)
    for m in masks:
        lowest = (m & -m).bit_length() - 1
        here = F.col("bit").between(lowest, m.bit_length() - 1) & ((bits(m) == 1) | (F.col("bit") == lowest))
        first = here & earlier if first is None else first | (here & earlier)
        earlier = earlier & (bits(m) > 1)
    near = (F.col("a") < F.col("b")) & (F.bit_count(differ) <= distance) & first
    return left.join(right, F.expr("bit = same_bit AND variant = same_variant") & near).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 4, seed: int = 42, distance: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) of every document; fp is the fingerprint as a signed long.

    `component_id` is the smallest doc_id that links reach, the document's own included.
    Equal texts share a fingerprint and are collapsed to it before anything is compared, so
    copies cost nothing. A null or wordless text has fingerprint 0 and is linked like any
    other; a null doc_id is never the smallest, unless the component has no other; repeated
    rows come back repeated. An empty table gives an empty result.
    """
    return _grouped(docs, shingle, seed, distance).select("doc_id", "fp", "component_id")


def _grouped(docs: DataFrame, shingle: int, seed: int, distance: int) -> DataFrame:
    """The fingerprints of the documents, with `root`, the least fingerprint of the component, and component_id."""
    prints = cut(fingerprints(docs, shingle, seed))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct.select("fp"), distance))
    grouped = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    first = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    # A root may stand for very many fingerprints; this join can be split.
    named = cut(spread_join(grouped, first, ["root"], "inner").select("fp", "root", "component_id"))
    # The hash beside the key gives both sides a plain shuffle, so a hot fingerprint is split.
    mark = F.xxhash64("fp").alias("mark")
    return prints.select("*", mark).join(named.select("*", mark), ["fp", "mark"], "left").drop("mark")


def one_of_each_group(docs: DataFrame, shingle: int = 4, seed: int = 42, distance: int = 4) -> DataFrame:
    """The documents with all their columns, whatever their names, one of each near-duplicate group: the least doc_id.

    Documents without an id come after those with one, so one of them stays where a group has
    no other. Of equal ids the least hash of the text decides, and of repeated rows one stays.
    """
    key = F.xxhash64("text")
    found = _grouped(docs.select("doc_id", "text", key.alias("text_key")), shingle, seed, distance)
    rows = found.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "n")
    first = cut(rows.groupBy("root").agg(F.min(order).alias("row")).select(F.col("row.doc_id").alias("first_id"), F.col("row.text_key").alias("first_key"), (F.col("row.n") > 1).alias("repeated")))
    # The rows are structs on the way, so that no name of theirs meets one of ours.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col("doc_id").alias("own_id"), key.alias("own_key"))
    same = F.col("own_id").eqNullSafe(F.col("first_id")) & (F.col("own_key") == F.col("first_key"))
    once = rows.join(first.where("NOT repeated"), same, "left_semi")
    repeated = first.where("repeated")
    if not repeated.isEmpty():
        copies = rows.join(repeated, same, "left_semi")
        once = once.unionAll(copies.dropDuplicates(["own_id", "own_key"]))
    return once.select(*(F.col(f"doc.`{c}`") for c in docs.columns))
