"""Removal of passages that earlier documents have, by relative Lempel-Ziv parsing.

Method: documents in the order of their ids form reference blocks. Each block is indexed by the
hashes of its windows of `window` words, and the indexes meet by ranges of hashes: a task gets one
range of all blocks and finds, for each hash of a block, the last block before it that has it.
That block is asked for the reference, and answers with the passage of words around it. A
document is then parsed greedily: where the index of the references (those passages and the
earlier documents of the own block) has its next window, the factor is copied from there, word
by word as far as both agree; else a word is a literal. A factor is at least a window long, so
its words are duplicates; windows across its end are looked up again, since the next factor may
reach back into it. All words are compared, so equal hashes of different words remove nothing.

An index block holds each hash once and is asked for it by one later block at most, so a passage
that very many documents share is one entry and one answer a block.
"""

import hashlib
import math
from array import array
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text of a reference block, and windows of a hash range, on average.
BLOCK_BYTES = 8 << 20
RANGE_WINDOWS = 1 << 20
#: Bytes of text that one row of the sample for the borders stands for.
SAMPLE_BYTES = 4096
#: Windows that are hashed at a time, and texts of which the words are kept for the next comparison.
STEP_WORDS = 1 << 16
RECENT_TEXTS = 32


def _mixers(window: int) -> np.ndarray:
    """Odd factors, one for each place in a window."""
    return np.array([xxhash.xxh64_intdigest(str(k).encode(), 13) | 1 for k in range(window)], np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """How many words each text has, and the 64-bit hashes of all words in a row.

    The words themselves are not kept: as objects they take ten times the room of their text.
    """
    sizes, hashes, digest = np.zeros(len(texts), np.int64), array("Q"), xxhash.xxh64_intdigest
    for k, text in enumerate(texts):
        words = text.split()  # bytes: at blanks and tab to carriage return
        sizes[k] = len(words)
        hashes.extend(map(digest, words))
    return sizes, np.asarray(hashes, np.uint64)


def windows(ends: np.ndarray, hashes: np.ndarray, window: int):
    """Of all windows inside one document, step by step: place of the first word, document number, hash.

    `ends` are those of the documents among all words.
    """
    total = len(hashes) - window + 1
    kind = np.int32 if len(hashes) < 1 << 30 else np.int64
    for a in range(0, total, STEP_WORDS):
        size = min(STEP_WORDS, total - a)
        mixed = np.zeros(size, np.uint64)
        for k, m in enumerate(_mixers(window)):
            mixed += hashes[a + k : a + k + size] * m
        mixed ^= mixed >> np.uint64(32)
        at = np.arange(a, a + size, dtype=kind)
        document = np.searchsorted(ends, at, "right").astype(kind)
        inside = at + window <= ends[document]
        yield at[inside], document[inside], mixed[inside]


def _joined(parts, kinds=(np.int64, np.int64, np.uint64)) -> list[np.ndarray]:
    """The steps of `windows` in a row."""
    columns = list(zip(*parts, strict=True)) or [[np.zeros(0, k)] for k in kinds]
    return [np.concatenate(c) for c in columns]


def _all_hashes(ends: np.ndarray, hashes: np.ndarray, window: int) -> np.ndarray:
    """The hashes of all windows inside one document, ascending."""
    found, n = np.empty(max(0, len(hashes) - window + 1), np.uint64), 0
    for _, _, mixed in windows(ends, hashes, window):
        found[n : n + len(mixed)] = mixed
        n += len(mixed)
    found = found[:n]
    found.sort()
    return found


def _slots(index: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the hashes are in an ascending index, and whether they are in it."""
    if not len(index):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    slot = np.minimum(np.searchsorted(index, hashes), len(index) - 1)
    return slot, index[slot] == hashes


def _text_rows(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Ids (a null counts as larger than all others) and texts, in the order of the ids."""
    largest = np.iinfo(np.int64).max
    ids = np.array([largest if i is None else i for i in table["doc_id"].to_pylist()], np.int64)
    texts = [t or b"" for t in table["text"].cast("binary").to_pylist()]
    order = np.argsort(ids, kind="stable")
    return ids[order], [texts[i] for i in order], order


def _borders(ranges: int) -> np.ndarray:
    return np.array([(k << 64) // ranges for k in range(1, ranges)], np.uint64)


def _indexer(window: int, ranges: int, block: str):
    def run(table: pa.Table) -> pa.Table:
        _, texts, _ = _text_rows(table)
        sizes, hashes = word_hashes(texts)
        index = _all_hashes(np.cumsum(sizes), hashes, window)
        index = index[np.append(True, index[1:] != index[:-1])[: len(index)]]
        parts = np.split(index, np.searchsorted(index, _borders(ranges)))
        full = [k for k, p in enumerate(parts) if len(p)]
        own = [table[block][0].as_py()] * len(full)
        return pa.table({"range": pa.array(full, "int32"), "asker": pa.array(own, "int32"), "hashes": pa.array([parts[k].astype("<u8").tobytes() for k in full], "binary")})

    return run


def _asker(last: int, block: str):
    """For one hash range: which block each block asks for which hashes. Blocks after `last` are never asked."""

    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(h, "<u8") for h in table["hashes"].to_pylist()]
        hashes = np.concatenate(parts)
        blocks = np.repeat(np.array(table["asker"].to_pylist(), np.int64), [len(p) for p in parts])
        order = np.lexsort((blocks, hashes))
        hashes, blocks = hashes[order], blocks[order]
        # The place of the last entry before each one whose block may be asked.
        place = np.maximum.accumulate(np.where(blocks <= last, np.arange(len(blocks)), -1))
        place = np.concatenate(([-1], place[:-1]))
        found = np.flatnonzero((place >= 0) & (hashes[place] == hashes))
        asked, asker, hashes = blocks[place[found]], blocks[found], hashes[found]
        order = np.lexsort((hashes, asker, asked))
        asked, asker, hashes = asked[order], asker[order], hashes[order].astype("<u8")
        changes = np.flatnonzero((asked[1:] != asked[:-1]) | (asker[1:] != asker[:-1])) + 1
        edges = np.concatenate(([0], changes)) if len(asked) else changes
        sent = [part.tobytes() for part in np.split(hashes, changes)] if len(asked) else []
        return pa.table({block: pa.array(asked[edges], "int32"), "asker": pa.array(asker[edges], "int32"), "hashes": pa.array(sent, "binary")})

    return run


class _Texts:
    """Texts with the hashes of all their words in a row. The words of a text are split off when asked for."""

    def __init__(self, texts: list[bytes]):
        sizes, self.hashes = word_hashes(texts)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes  # of the texts among all words
        self.words = lru_cache(RECENT_TEXTS)(lambda k: texts[k].split())


def _answerer(window: int, block: str):
    """Cogroup function of a block and what it is asked: the passages that hold the windows, for each block that asked."""

    def run(docs: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"asker": [], "passage": []}
        if docs.num_rows and asked.num_rows:
            _, texts, _ = _text_rows(docs)
            texts = _Texts(texts)
            wanted: dict[int, list] = {}
            for asker, sent in zip(asked["asker"].to_pylist(), asked["hashes"].to_pylist(), strict=True):
                wanted.setdefault(asker, []).append(np.frombuffer(sent, "<u8"))
            index = np.unique(np.concatenate([part for parts in wanted.values() for part in parts]))
            # The first window with each hash that is asked for: its place and document.
            first, where = np.full(len(index), -1), np.full(len(index), -1)
            for at, document, mixed in windows(texts.ends, texts.hashes, window):
                slot, known = _slots(index, mixed)
                known &= first[slot] < 0
                fresh, row = np.unique(slot[known], return_index=True)
                first[fresh], where[fresh] = at[known][row], document[known][row]
            for asker, sent in wanted.items():
                found = np.searchsorted(index, np.concatenate(sent))
                found = found[np.argsort(first[found], kind="stable")]
                place, doc = first[found], where[found]
                # Windows that start next to each other in one document, or overlap there, are one passage.
                fresh = np.concatenate(([True], (doc[1:] != doc[:-1]) | (place[1:] > place[:-1] + window)))
                begins, ends = place[fresh], np.append(place[:-1][fresh[1:]], place[-1]) + window
                for d, a, z in zip(doc[fresh].tolist(), begins.tolist(), ends.tolist(), strict=True):
                    out["asker"].append(asker)
                    start = int(texts.starts[d])
                    out["passage"].append(b" ".join(texts.words(d)[a - start : z - start]))
        return pa.table({block: pa.array(out["asker"], "int32"), "passage": pa.array(out["passage"], "binary")})

    return run


class _References(_Texts):
    """Texts with, ascending, the hashes of their windows, and the first window that has each."""

    def __init__(self, texts: list[bytes], window: int):
        super().__init__(texts)
        at, document, mixed = _joined(windows(self.ends, self.hashes, window))
        self.index, first = np.unique(mixed, return_index=True)
        self.first, self.text = at[first], document[first]


def _copied(own: list[bytes], hashes: np.ndarray, start: int, place: int, refs: _Texts, text: int, at: int) -> int:
    """How many words from `place` of a document equal those from `at` of a reference text, compared as words."""
    room = min(len(own) - place, int(refs.ends[text]) - at)
    differ = np.flatnonzero(hashes[start + place : start + place + room] != refs.hashes[at : at + room])
    size = int(differ[0]) if len(differ) else room
    other, offset = refs.words(text), at - int(refs.starts[text])
    if own[place : place + size] == other[offset : offset + size]:
        return size
    return next(k for k in range(size) if own[place + k] != other[offset + k])


def factors(own: list[bytes], hashes: np.ndarray, start: int, found: list[int], sources, window: int) -> list[tuple[int, int]]:
    """The factors of a document as (first word, words): greedy copies from references.

    `found` are the places of its windows that a reference may have, ascending, and `sources`
    gives for a place the (references, text, word) to copy from. A place inside a factor is
    tried again only if its window reaches across the factor's end.
    """
    out, inside = [], -1
    for place in found:
        if place + window <= inside:
            continue
        size = max((_copied(own, hashes, start, place, *s) for s in sources(place)), default=0)
        if size >= window:
            out.append((place, size))
            inside = place + size
    return out


def _parse(docs: pa.Table, answers: pa.Table, window: int):
    """For each document of a block: row, a function for its words, which of them repeats cover, and the factors."""
    ids, texts, order = _text_rows(docs)
    own = _Texts(texts)
    other = _References([p or b"" for p in answers["passage"].to_pylist()], window)
    # Only windows that the block has twice, or a passage too, are looked at further.
    repeated = _all_hashes(own.ends, own.hashes, window)
    repeated = repeated[1:][repeated[1:] == repeated[:-1]]
    steps = windows(own.ends, own.hashes, window)
    at, document, mixed = _joined((p[known], d[known], m[known]) for p, d, m in steps for known in [_slots(repeated, m)[1] | _slots(other.index, m)[1]])
    _, first, place = np.unique(mixed, return_index=True, return_inverse=True)
    first = first[place]
    # The own block is a reference where a document with a smaller id has the window; ids ascend.
    in_own = ids[document[first]] < ids[document]
    slot, in_other = _slots(other.index, mixed)
    found = np.flatnonzero(in_own | in_other)
    by_document = np.searchsorted(document[found], np.arange(len(texts) + 1))
    for k, row in enumerate(order.tolist()):
        start, words = int(own.starts[k]), partial(own.words, k)
        gone, spans = np.zeros(int(own.ends[k]) - start, bool), []
        here = found[by_document[k] : by_document[k + 1]]
        if len(here):
            entry = dict(zip((at[here] - start).tolist(), here.tolist(), strict=True))

            def sources(p, entry=entry):
                e = entry[p]
                if in_own[e]:
                    yield own, int(document[first[e]]), int(at[first[e]])
                if in_other[e]:
                    yield other, int(other.text[slot[e]]), int(other.first[slot[e]])

            spans = factors(words(), own.hashes, start, list(entry), sources, window)
        for a, n in spans:
            gone[a : a + n] = True
        yield row, words, gone, spans


def _kept(words: list[bytes], gone: np.ndarray) -> bytes:
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def _reporter(window: int, digest: bool):
    """Cogroup function: one row per document, with what is left of it."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        out = {"doc_id": [], "n_words": [], "n_removed": [], "kept": [], "factors": []}
        doc_ids = docs["doc_id"].to_pylist()
        for row, words, gone, spans in _parse(docs, answers, window) if doc_ids else ():
            kept = _kept(words(), gone)
            values = doc_ids[row], len(gone), int(gone.sum()), hashlib.sha256(kept).hexdigest() if digest else kept.decode(), spans
            for column, value in zip(out.values(), values, strict=True):
                column.append(value)
        table = {k: pa.array(out[k], "int64") for k in ("doc_id", "n_words", "n_removed")}
        if digest:
            return pa.table(table | {"kept_sha256": pa.array(out["kept"], "string")})
        kind = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())]))
        spans = [[{"start": a, "words": n} for a, n in s] for s in out["factors"]]
        return pa.table(table | {"kept": pa.array(out["kept"], "string"), "factors": pa.array(spans, kind)})

    return run


def _rewriter(window: int, columns: list[str]):
    """Cogroup function: the documents with their repeats cut out of the texts."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        cut, rows = {}, []
        for row, words, gone, _ in _parse(docs, answers, window) if docs.num_rows else ():
            if gone.any():
                cut[row] = _kept(words(), gone).decode()
            if not len(gone) or not gone.all():
                rows.append(row)
        place, field = docs.schema.get_field_index("text"), docs.schema.field("text")
        changed = np.zeros(docs.num_rows, bool)
        changed[list(cut)] = True
        text = docs["text"].combine_chunks()
        text = pc.replace_with_mask(text, pa.array(changed), pa.array([cut[row] for row in sorted(cut)], field.type))
        docs = docs.set_column(place, "text", text)
        return docs.take(pa.array(sorted(rows), "int64")).select(columns)

    return run


def _constant(values: list, kind: str):
    """An array that Spark folds into one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>") if values else F.array().cast(f"array<{kind}>")


def _block(doc_id, text, borders: list[int], blocks: int):
    """How many of the sorted borders are below the id.

    Rows without an id come after all others and are no references for each other, so they are
    dealt over as many further blocks, by their text. The borders are looked up in two steps, so
    a row costs the square root of their number.
    """
    step = math.isqrt(len(borders)) + 1
    below = lambda b: b < doc_id
    group = F.size(F.filter(_constant(borders[step::step], "bigint"), below))
    place = group * step + F.size(F.filter(F.slice(_constant(borders, "bigint"), group * step + 1, step), below))
    return F.when(doc_id.isNull(), len(borders) + 1 + F.pmod(F.xxhash64(text), F.lit(blocks))).otherwise(place).cast("int")


def _run(docs: DataFrame, window: int, block_bytes: int, range_windows: int, parser, kinds) -> DataFrame:
    """Blocks, index, the questions that hash ranges find, their answers, and the parser with them."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, ranges = max(1, -(-size // block_bytes)), max(1, size // (6 * range_windows))
    borders = []
    if blocks > 1:
        # A row for each few KB of text, so that blocks are equal in bytes and not in documents.
        pages = F.sequence(F.lit(0), (F.coalesce(F.octet_length("text"), F.lit(0)) / SAMPLE_BYTES).cast("int"))
        shares = _constant([k / blocks for k in range(1, blocks)], "double")
        found = docs.select("doc_id", F.explode(pages)).agg(F.percentile_approx("doc_id", shares, F.lit(100 * blocks))).first()[0]
        borders = sorted(set(found or []))
    block = "_block"
    while block in docs.columns:
        block += "_"
    # Index, answers and parser take whole rows, so they share one shuffle of the texts.
    blocked = docs.withColumn(block, _block(F.col("doc_id"), F.col("text"), borders, blocks))
    index = blocked.groupBy(block).applyInArrow(_indexer(window, ranges, block), "range int, asker int, hashes binary")
    asked = index.groupBy("range").applyInArrow(_asker(len(borders), block), f"{block} int, asker int, hashes binary")
    answers = blocked.groupBy(block).cogroup(asked.groupBy(block)).applyInArrow(_answerer(window, block), f"{block} int, passage binary")
    return blocked.groupBy(block).cogroup(answers.groupBy(block)).applyInArrow(parser, kinds)


def remove_repeats(docs: DataFrame, window: int = 13, digest: bool = False, block_bytes: int = BLOCK_BYTES, range_windows: int = RANGE_WINDOWS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, factors) of every document.

    Each word is removed that a window of `window` words covers whose words also start in a
    document with a smaller doc_id. `kept` has the other words, joined by one blank; with
    `digest` it is their SHA-256 instead, and there are no factors. `factors` lists
    the copies as (start, words). Windows are judged on the input as it is.

    A null text has no words. A null doc_id counts as larger than all others. Rows that share
    a doc_id, repeated rows too, don't make each other's words repeats. Texts of any length
    stay whole. An empty table gives an empty result. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = "doc_id long, n_words long, n_removed long, "
    kinds += "kept_sha256 string" if digest else "kept string, factors array<struct<start: long, words: long>>"
    return _run(docs, window, block_bytes, range_windows, _reporter(window, digest), kinds)


def without_repeats(docs: DataFrame, window: int = 13, block_bytes: int = BLOCK_BYTES, range_windows: int = RANGE_WINDOWS) -> DataFrame:
    """The documents with all their columns, the repeats that `remove_repeats` finds cut out.

    A text without repeats stays as it is. One with repeats becomes its other words, joined
    by one blank; a document of which nothing is left goes. Other columns may have any names.
    """
    return _run(docs, window, block_bytes, range_windows, _rewriter(window, docs.columns), docs.schema)
