"""Best-fit packing of tokenized documents into sequences of a fixed length.

Method: hierarchical residual packing. Documents become pieces; full pieces are sequences
by themselves. The others are packed best-fit, in groups that fit a task; bins that are
full, or nearly, or have no room for any other, are emitted. The underfull bins go on as items
of the next round, dealt anew into as few groups as hold them, until it is one group or until a
round joins hardly any. No group has more items than a task can pack, in any round.
"""

import json
import re
import struct
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.bpe import byte_symbols
from tallyfold.llm.common import cut

#: Items that one task packs at a time.
GROUP_ITEMS = 20_000
#: A bin with this much room left, or less, is emitted; 4 tokens are 0.4 % of a sequence.
NEARLY_FULL = 4
#: A round that leaves more than this share of its items as bins is the last.
LEAST_GAIN = 0.99
#: Text segments whose ids a task keeps; when there are more, it starts anew. Bounds memory only.
CACHED_SEGMENTS = 400_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: White space before a blank: there the text can't be cut into segments that encode alone.
BEFORE_BLANK = re.compile(r"\s ").search
#: How a byte-level vocabulary of this kind cuts a text into words; a fixed value of its format.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Stands for a null doc_id inside a bin.
NULL_ID = -(1 << 63)
MEMBER = "<qiqqq"  # a piece inside a bin


class Ids:
    """Encodes texts to little-endian 32-bit ids, remembering the words it has met.

    The vocabulary comes from a byte-level tokenizer file whose ids follow the order of its
    merges, so the ids are ranks; the ids are those of the tokenizers library. Its pattern takes
    a blank together with the word after it, and never goes from a word over into white space.
    So the ids of the parts of a text that is cut before each blank are, one after another, its own.
    """

    def __init__(self, spec: str):
        import tiktoken

        spec = json.loads(spec)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte = {s: b for b, s in byte_symbols().items()}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.encoding = tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)
        self.after_blank = Known(self)

    def segment(self, text: str) -> bytes:
        found = self.encoding.encode(text, allowed_special="all") if "<|" in text else self.encoding.encode_ordinary(text)
        return struct.pack(f"<{len(found)}I", *found)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.after_blank) > CACHED_SEGMENTS:
            self.after_blank.clear()
        ids_of, out = self.after_blank.__getitem__, []
        for text in texts:
            first, *rest = [text] if BEFORE_BLANK(text) else text.split(" ")
            out.append(b"".join([self.segment(first) if first else b"", *map(ids_of, rest)]))
        return out


class Known(dict):
    """The ids of a blank and the word after it; what is too long for a word is not kept."""

    def __init__(self, ids: Ids):
        super().__init__()
        self.ids = ids

    def __missing__(self, word: str) -> bytes:
        found = self.ids.segment(" " + word)
        if len(word) < 100:
            self[word] = found
        return found


def pieces(docs: DataFrame, spec: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the pieces of every document.

    A document is its ids and `end_id`. One of more than `capacity` ids is cut into pieces of
    exactly that length, but for the first, which takes the rest. A null text counts as empty,
    so each row has a piece; null ids and repeated rows are kept as they are. `spec` is the
    content of a tokenizer file, of a size that does not depend on the data.
    """
    spec = docs.sparkSession.sparkContext.broadcast(spec)
    return docs.select("doc_id", "text").mapInArrow(_cutter(spec, struct.pack("<I", end_id), capacity), PIECES)


def _cutter(spec, end: bytes, capacity: int):
    names = [c.split(" ")[0] for c in PIECES.split(", ")]

    def run(batches):
        ids = Ids(spec.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out = []
                encoded = ids.encode([t or "" for t in part.column(1).to_pylist()])
                for doc_id, data in zip(part.column(0).to_pylist(), encoded, strict=True):
                    data += end
                    size, view = len(data) // 4, memoryview(data)
                    stops = [size % capacity or capacity]
                    stops += range(stops[0] + capacity, size + 1, capacity)
                    start = 0
                    for k, stop in enumerate(stops):
                        out.append((doc_id, k, start, stop - start, zlib.crc32(view[4 * start : 4 * stop])))
                        start = stop
                columns = list(zip(*out, strict=True))
                kinds = ["int64", "int32", "int64", "int64", "int64"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers: the largest item first, each into the fullest bin it fits.

    Ties go by the place of the item. `rooms` has a bit for each amount of room that an open
    bin has, so the best bin is its lowest bit that is not below the item's size.
    """
    bins: list[list[int]] = []
    open_at: dict[int, list[int]] = {}
    rooms = 0
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[item]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            into = open_at[room].pop()
            if not open_at[room]:
                rooms ^= 1 << room
            bins[into].append(item)
            room -= size
        else:
            into, room = len(bins), capacity - size
            bins.append([item])
        if room:
            open_at.setdefault(room, []).append(into)
            rooms |= 1 << room
    return bins


def _packer(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("members", "ascending")])
        sizes, members = table["size"].to_pylist(), table["members"].to_pylist()
        bins = best_fit(sizes, capacity)
        return pa.table({"size": pa.array([sum(sizes[i] for i in b) for b in bins], "int64"), "members": pa.array([b"".join([members[i] for i in b]) for b in bins], "binary")})

    return run


def _part(groups: int, number: int) -> Column:
    """The group of an item in a round. Its place, the same if a task is repeated, spreads items that are equal."""
    return F.pmod(F.xxhash64("members", F.monotonically_increasing_id(), F.lit(number)), F.lit(groups))


def pack(cut_pieces: DataFrame, capacity: int = 1024, group_items: int = GROUP_ITEMS, nearly_full: int = NEARLY_FULL) -> DataFrame:
    """The pieces with the sequence and the offset at which each is placed.

    Every piece is placed once, in a sequence of at most `capacity` ids, gapless from 0.
    Repeated rows are items of their own. An empty table gives an empty result. A bin carries
    its members (at most one per id) with it, so no join is needed to name them.
    """
    cut_pieces = cut(cut_pieces)
    whole = cut_pieces.where(F.col("length") == capacity)
    rest = cut_pieces.where(F.col("length") < capacity)
    items = rest.mapInArrow(_as_items, "size long, members binary")
    before = rest.count()
    emitted = []
    while before:
        groups = -(-before // group_items)
        dealt = items.withColumn("part", _part(groups, len(emitted)))
        bins = cut(dealt.groupBy("part").applyInArrow(_packer(capacity), "size long, members binary"))
        if groups == 1:
            emitted.append(bins)
            break
        underfull = F.col("size") < capacity - nearly_full
        smallest = bins.where(underfull).agg(F.min("size")).first()[0] or 0
        goes_on = underfull & (F.col("size") <= capacity - smallest)  # others have no room for any bin
        left = bins.where(goes_on).count()
        if left > LEAST_GAIN * before:
            emitted.append(bins)
            break
        emitted.append(bins.where(~goes_on))
        items, before = bins.where(goes_on), left
    number = F.monotonically_increasing_id()  # over rows that were cut off: the same if a task is repeated
    done = whole.withColumn("sequence_id", 2 * number).withColumn("offset", F.lit(0).cast("long"))
    if emitted:
        bins = emitted[0]
        for more in emitted[1:]:
            bins = bins.unionAll(more)
        placed = bins.select((2 * number + 1).alias("sequence_id"), "members").mapInArrow(_as_rows, PIECES + ", sequence_id long, offset long")
        done = done.unionByName(placed)
    return done


def _as_items(batches):
    for batch in batches:
        rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        packed = [struct.pack(MEMBER, NULL_ID if r[0] is None else r[0], *r[1:]) for r in rows]
        yield pa.RecordBatch.from_arrays([batch.column("length"), pa.array(packed, "binary")], ["size", "members"])


def _as_rows(batches):
    names = [*(c.split(" ")[0] for c in PIECES.split(", ")), "sequence_id", "offset"]
    kinds = ["int64", "int32", "int64", "int64", "int64", "int64", "int64"]
    for batch in batches:
        out = []
        for sequence, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            offset = 0
            for doc_id, *rest in struct.iter_unpack(MEMBER, members):
                out.append((None if doc_id == NULL_ID else doc_id, *rest, sequence, offset))
                offset += rest[2]
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
