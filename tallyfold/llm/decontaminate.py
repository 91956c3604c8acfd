"""Removal of documents that hold passages of a benchmark, by suffix arrays.

Method: the documents of a task are cut into shards, and a shard's suffixes are sorted. All
suffixes of the test items are then looked up by binary search, which gives the places of a
window of words and, word by word from there, the longest verbatim match.

Words are compared by their number among the test words, so equal numbers are equal words.
A run of document words is left out of the suffix array if it has fewer test words in a row
than the shortest window: no window can be there.

Test items travel to the tasks in blocks of a fixed size; each block is one pass over the
documents. Within a pass nothing is shuffled, and a document gets its result where it is read.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import cut

#: Bytes of test texts of a block, and words of a shard, at least one document.
BLOCK_BYTES = 16 << 20
SHARD_WORDS = 1 << 20
#: What one pass finds in a document: covered words as (first, words), and item ids.
FOUND = "struct<spans: array<struct<start: bigint, words: bigint>>, items: array<string>>"
MATCH = "doc_id long, doc_word long, item_id string, item_word long, n_words long"

_SPACES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8: ASCII letters, lower-cased, and digits, and all that is not ASCII."""
    return text.translate(_SPACES).split()


class Items:
    """Test items as numbers: their words, and all windows they have.

    `windows` has a row for each distinct window, padded with -1; `holders` the items of it.
    """

    def __init__(self, ids: list, texts: list[bytes], window: int):
        self.vocabulary: dict[bytes, int] = {}
        numbers, self.ids, windows = [], [], {}
        for key, text in zip(ids, texts, strict=True):
            words = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if not words:
                continue
            size = min(window, len(words))
            for k in range(len(words) - size + 1):
                windows.setdefault(tuple(words[k : k + size]), []).append((len(numbers), k))
            numbers.append(np.array(words, np.int32))
            self.ids.append(key)
        self.numbers = numbers
        self.places = list(windows.values())
        self.sizes = np.array([len(w) for w in windows], np.int64)
        self.windows = np.full((len(windows), window), -1, np.int32)
        for row, w in enumerate(windows):
            self.windows[row, : len(w)] = w
        self.shortest = int(self.sizes.min()) if windows else 0
        self.longest = max(map(len, numbers), default=0)


def suffix_array(numbers: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of test words, sorted by their first `depth` words.

    A number of -1 ends all suffixes before it; it sorts first. Ranks of 1, 2, 4 and so on
    words are doubled until the depth is reached or all suffixes differ.
    """
    total = len(numbers)
    starts = np.flatnonzero(numbers >= 0)
    rank = numbers.astype(np.int64) + 1  # 0 where a suffix ends
    order = starts[np.argsort(rank[starts], kind="stable")]
    length = 1
    while length < depth and len(order) > 1:
        further = np.zeros(total, np.int64)
        further[: total - length] = rank[length:]
        further[rank == 0] = 0
        top = int(rank.max()) + 1
        both = rank * top + further
        order = starts[np.argsort(both[starts], kind="stable")]
        ordered = both[order]
        fresh = np.concatenate(([1], (ordered[1:] != ordered[:-1]).astype(np.int64)))
        rank = np.zeros(total, np.int64)
        rank[order] = np.cumsum(fresh)
        length *= 2
        if rank[order[-1]] == len(order):
            break
    return order


def _bounds(numbers: np.ndarray, array: np.ndarray, queries: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query the range of the suffix array that starts with its first words."""
    padded = np.concatenate((numbers, np.full(queries.shape[1], -1, numbers.dtype)))

    def search(after: bool) -> np.ndarray:
        low, high = np.zeros(len(queries), np.int64), np.full(len(queries), len(array), np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            at = array[np.minimum(middle, len(array) - 1)]
            # -1 below, 1 above or 0 equal on the query's words; the first difference decides.
            compared = np.zeros(len(queries), np.int8)
            for k in range(queries.shape[1]):
                todo = (compared == 0) & (k < sizes)
                if not todo.any():
                    break
                compared[todo] = np.sign(padded[at[todo] + k].astype(np.int64) - queries[todo, k])
            right = (compared < 0) | (after & (compared == 0))
            low = np.where(open_ & right, middle + 1, low)
            high = np.where(open_ & ~right, middle, high)
        return low

    return search(False), search(True)


def occurrences(numbers: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """(window, place) of all places of all windows of the items in a shard."""
    none = np.zeros(0, np.int64)
    if not len(items.sizes) or not len(numbers):
        return none, none
    known = np.concatenate(([False], numbers >= 0, [False])).astype(np.int8)
    edges = np.flatnonzero(np.diff(known)).reshape(-1, 2)
    live = edges[edges[:, 1] - edges[:, 0] >= items.shortest]
    if not len(live):
        return none, none
    # The runs one after another, each closed by -1.
    sizes = live[:, 1] - live[:, 0] + 1
    starts = np.cumsum(sizes) - sizes
    back = np.arange(int(sizes.sum())) + np.repeat(live[:, 0] - starts, sizes)
    run = np.append(numbers, -1)[back]
    run[starts + sizes - 1] = -1
    array = suffix_array(run, items.windows.shape[1])
    low, high = _bounds(run, array, items.windows, items.sizes)
    counts = high - low
    window = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(window)) - np.repeat(np.cumsum(counts) - counts, counts)
    return window, back[array[np.repeat(low, counts) + inside]]


def _shards(texts: list[bytes], items: Items, shard_words: int):
    """Parts of the texts as (first row, words of each, numbers of all words, a -1 after each text)."""
    get = items.vocabulary.get
    first, sizes, numbers = 0, [], []
    for row, text in enumerate(texts):
        found = [get(w, -1) for w in words_of(text)]
        if numbers and len(numbers) + len(found) > shard_words:
            yield first, sizes, np.array(numbers, np.int32)
            first, sizes, numbers = row, [], []
        sizes.append(len(found))
        numbers += found
        numbers.append(-1)
    if sizes:
        yield first, sizes, np.array(numbers, np.int32)


def _found_places(numbers: np.ndarray, items: Items, shard_words: int) -> tuple[np.ndarray, np.ndarray]:
    """`occurrences` in a shard; one very long text is searched part by part, with overlaps."""
    overlap = items.windows.shape[1] - 1
    if len(numbers) <= 2 * shard_words:
        return occurrences(numbers, items)
    windows, places = [], []
    for at in range(0, len(numbers), shard_words):
        window, place = occurrences(numbers[at : at + shard_words + overlap], items)
        own = place < shard_words
        windows.append(window[own])
        places.append(place[own] + at)
    return np.concatenate(windows), np.concatenate(places)


def _spans(numbers: np.ndarray, window: np.ndarray, place: np.ndarray, items: Items) -> np.ndarray:
    """(first, end) of the runs of words that found windows cover."""
    change = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + items.sizes[window], -1)
    covered = np.concatenate(([0], (np.cumsum(change) > 0).astype(np.int8)))
    return np.flatnonzero(np.diff(covered)).reshape(-1, 2)


def _per_text(texts: list[bytes], items: Items, shard_words: int):
    """For each text its number of words, the spans that windows cover, and the items found."""
    for _, sizes, numbers in _shards(texts, items, shard_words):
        window, place = _found_places(numbers, items, shard_words)
        ends = np.cumsum(np.array(sizes, np.int64) + 1)
        starts = ends - np.array(sizes, np.int64) - 1
        text_of = np.searchsorted(ends, place, side="right")
        spans = _spans(numbers, window, place, items)
        span_text = np.searchsorted(ends, spans[:, 0], side="right")
        held: dict[int, set] = {}
        for pair in np.unique(text_of * max(1, len(items.sizes)) + window).tolist():
            text, w = divmod(pair, max(1, len(items.sizes)))
            held.setdefault(text, set()).update(items.ids[i] for i, _ in items.places[w])
        runs: dict[int, list] = {}
        for text, (a, z) in zip(span_text.tolist(), spans.tolist(), strict=True):
            runs.setdefault(text, []).append((a - int(starts[text]), z - a))
        for k, size in enumerate(sizes):
            yield size, runs.get(k, []), held.get(k, set())


def _blocks(benchmark: DataFrame, block_bytes: int):
    """The items in lists of at most `block_bytes` of text, one list at a time."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary"))
    for key, text in rows.toLocalIterator():
        text = bytes(text or b"")
        if ids and size + len(text) > block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(key)
        texts.append(text)
        size += len(text)
    yield ids, texts


def _with_found(docs: DataFrame, ids: list, texts: list[bytes], window: int, shard_words: int, name: str) -> DataFrame:
    """The rows of (doc_id, text, ...) with what a block of items finds in them."""

    def run(batches):
        items = Items(ids, texts, window)
        kind = pa.struct([("spans", pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())]))), ("items", pa.list_(pa.string()))])
        for batch in batches:
            given = [t.as_py() or b"" for t in batch.column("text").cast("binary")]
            rows, n_words = [], []
            for size, spans, found in _per_text(given, items, shard_words):
                n_words.append(size)
                rows.append({"spans": [{"start": a, "words": n} for a, n in spans], "items": [i for i in found if i is not None]})
            columns = [c for c in batch.schema.names if c != "_words"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(n_words, pa.int64()), pa.array(rows, kind)],
                [*columns, "_words", name],
            )

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "_words"]
    return docs.mapInArrow(run, ", ".join([*kept, "_words long", f"{name} {FOUND}"]))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, n_words, spans, items) of every document.

    `spans` has the (start, words) runs of words that lie in an occurrence of a window of an
    item, `items` the ids of the items with such windows. A window is `window` consecutive
    words of an item; an item of fewer words, but not none, is one window.

    A null or empty text has no words, in documents as in items. Items may repeat: an id is
    listed once, and an item without an id hits but isn't listed. Repeated documents come back
    repeated, with a null id too. Texts of any length are searched whole. Empty tables give no
    rows or no hits. Other columns are not read.
    """
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = []
    for ids, texts in _blocks(benchmark, block_bytes):
        if names:  # the pass before is written, so that tasks hold one block at a time
            found = cut(found)
        names.append(f"_found_{len(names)}")
        found = _with_found(found, ids, texts, window, shard_words, names[-1])
    spans = F.col(f"{names[0]}.spans") if len(names) == 1 else _merged(F.concat(*[F.col(f"{n}.spans") for n in names]))
    items = F.array_sort(F.array_distinct(F.concat(*[F.col(f"{n}.items") for n in names])))
    return found.select("doc_id", F.col("_words").alias("n_words"), spans.alias("spans"), items.alias("items"))


def _merged(spans):
    """Spans of several blocks: those that meet become one."""
    kind = "struct<done: array<struct<start: bigint, words: bigint>>, start: bigint, stop: bigint>"
    empty = F.struct(F.array().alias("done"), F.lit(0).alias("start"), F.lit(0).alias("stop")).cast(kind)

    def closed(run):
        own = F.array(F.struct(run["start"].alias("start"), (run["stop"] - run["start"]).alias("words")))
        return F.when(run["stop"] > run["start"], F.concat(run["done"], own)).otherwise(run["done"])

    def step(run, span):
        stop = span["start"] + span["words"]
        joined = F.struct(run["done"].alias("done"), run["start"].alias("start"), F.greatest(run["stop"], stop).alias("stop"))
        begun = F.struct(closed(run).alias("done"), span["start"].alias("start"), stop.alias("stop"))
        return F.when((run["stop"] > run["start"]) & (span["start"] <= run["stop"]), joined).otherwise(begun).cast(kind)

    return F.aggregate(F.array_sort(spans), empty, step, closed)


def judge(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every document; see `hits`."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])
    return hits(docs, benchmark, **options).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, doc_word, item_id, item_word, n_words): all longest verbatim matches and their places.

    A match has at least one window and can't be made longer on either side. Places count
    words from 0. Nulls, repeats and empty tables are as in `hits`.
    """

    def finder(ids, texts):
        def run(batches):
            items = Items(ids, texts, window)
            for batch in batches:
                given = [t.as_py() or b"" for t in batch.column(1).cast("binary")]
                rows = list(_matches(given, items, shard_words))
                doc_ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(columns[1], pa.int64()), pa.array([items.ids[i] for i in columns[2]], pa.string()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())],
                    ["doc_id", "doc_word", "item_id", "item_word", "n_words"],
                )

        return run

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for ids, texts in _blocks(benchmark, block_bytes):
        part = docs.mapInArrow(finder(ids, texts), MATCH)
        found = part if found is None else found.unionAll(part)
    return found


def _matches(texts: list[bytes], items: Items, shard_words: int):
    """(row, word, item, item's word, words) of the longest matches."""
    for first, sizes, numbers in _shards(texts, items, shard_words):
        ends = np.cumsum(np.array(sizes, np.int64) + 1)
        closed = np.append(numbers, -1)
        for w, at in zip(*(x.tolist() for x in _found_places(numbers, items, shard_words)), strict=True):
            for item, k in items.places[w]:
                own = items.numbers[item]
                if k and at and closed[at - 1] == own[k - 1]:
                    continue  # part of the match that starts a word before
                size = min(len(own) - k, len(closed) - at)
                differ = np.flatnonzero(closed[at : at + size] != own[k : k + size])
                text = int(np.searchsorted(ends, at, side="right"))
                start = int(ends[text]) - sizes[text] - 1
                yield first + text, at - start, item, k, int(differ[0]) if len(differ) else size


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The documents with all their columns but without those that hold a window of an item."""
    for number, (ids, texts) in enumerate(_blocks(benchmark, block_bytes)):
        docs = _without_found(cut(docs) if number else docs, ids, texts, window, shard_words)
    return docs


def _without_found(docs: DataFrame, ids: list, texts: list[bytes], window: int, shard_words: int) -> DataFrame:
    def run(batches):
        items = Items(ids, texts, window)
        for batch in batches:
            given = [t.as_py() or b"" for t in batch.column("text").cast("binary")]
            clean = [not spans for _, spans, _ in _per_text(given, items, shard_words)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
