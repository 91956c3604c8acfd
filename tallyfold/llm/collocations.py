"""Phrases whose words belong together, counted over a prefix-free parse.

Method: the words of a piece of text are cut into chunks where the content says so: a window
of `longest - 1` words whose hash is divisible by `spread` ends one chunk and starts the next,
so that neighbours overlap by that window; a piece of up to `spread` words is one chunk. Equal
text is cut equally wherever it stands. A task keeps a dictionary of distinct chunks with how
often each occurs, and all counting is done inside the distinct chunks, weighted by that number. A phrase belongs to the chunk that owns its
first word; words of the closing overlap are owned by the next chunk, so nothing is counted
twice, and no phrase of up to `longest` words crosses the end of its chunk. Counts of tasks add
up, so the dictionaries need not be merged: they are written once, as numbers of words, and
only counts are shuffled, not the text.

A phrase can only be frequent if all its parts are. So three passes find what may be frequent:
words, pairs of such words, and longer runs of such pairs. They shuffle short hashes with
counts, packed by ranges; what reaches `least` is marked in a bit table of fixed size, whatever
the data. The last pass counts the marked phrases as texts, packed in the same way. Two phrases with one hash or one bit
cost a row there, never a result: the counts that are compared and returned are of texts.
"""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import cut
from tallyfold.operators.lookups import spread_join

#: Bits of a table of phrases that may be frequent (4 MB), a power of two.
FILTER_BITS = 1 << 25
#: Words of the distinct chunks that a task holds before it counts them and hands on the counts.
HELD_WORDS = 1 << 20
#: Bytes of text for each range of hashes: a task sums the counts of one range.
RANGE_BYTES = 48 << 20
#: A window ends a chunk if its hash is divisible by this: words of a chunk, on average.
SPREAD = 24
#: Parts in which a language's candidates are ranked before the last ranking.
RANK_PARTS = 256

#: Letters lower-cased, what separates pieces as a line end, and what separates words as a blank.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
PARSED = "lang string, words binary, ids binary, sizes binary, own binary, n binary"


def chunks(words: list[bytes], overlap: int, spread: int) -> list[tuple[list[bytes], int]]:
    """(words, how many of them it owns) of the chunks of a piece; the last one owns all of its words."""
    if len(words) <= spread:
        return [(words, len(words))]
    out, start = [], 0
    for k in range(1, len(words) - overlap):
        if zlib.crc32(b" ".join(words[k : k + overlap])) % spread == 0:
            out.append((words[start : k + overlap], k - start))
            start = k
    out.append((words[start:], len(words) - start))
    return out


def dictionaries(batches, longest: int, spread: int, held_words: int):
    """Dictionaries {lang: {(chunk, own): n}} of batches (lang, text), each of about `held_words` words.

    In place of the number of words that a chunk owns, 0 stands for all.
    """
    found: dict = defaultdict(dict)
    held = 0
    for batch in batches:
        langs = batch.column(0).cast("binary").to_pylist()
        for lang, text in zip(langs, batch.column(1).cast("binary"), strict=True):
            known = found[lang]
            for piece in (text.as_py() or b"").translate(_PLAIN).split(b"\n"):
                piece = piece.strip(b" ")
                if not piece:
                    continue
                size = piece.count(b" ") + 1
                if size > spread or b"  " in piece:
                    words = piece.split(b" ") if b"  " not in piece else [w for w in piece.split(b" ") if w]
                    keys = [(b" ".join(own), 0 if own[-1] is words[-1] and n == len(own) else n) for own, n in chunks(words, longest - 1, spread)]
                else:
                    keys = ((piece, 0),)
                for key in keys:
                    n = known.get(key)
                    if n is None:
                        held += key[0].count(b" ") + 1
                        known[key] = 1
                    else:
                        known[key] = n + 1
            if held >= held_words:
                yield found
                found, held = defaultdict(dict), 0
    yield found


def parse(docs: DataFrame, longest: int = 5, spread: int = SPREAD, held_words: int = HELD_WORDS) -> DataFrame:
    """One row for each dictionary of chunks of one language, packed.

    `words` are the distinct words, joined by blanks; `ids` the numbers among them of the words
    of all chunks, one after another; `sizes`, `own` and `n` have for each chunk its words, how
    many of them it owns, and how often it occurs. All are compressed.
    """

    def run(batches):
        for found in dictionaries(batches, longest, spread, held_words):
            rows = [(lang.decode(), *_packed_chunks(known)) for lang, known in found.items() if known]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.string()] + [pa.binary()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "words", "ids", "sizes", "own", "n"])

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(run, PARSED)


def _packed_chunks(known: dict) -> tuple[bytes, ...]:
    texts = [chunk for chunk, _ in known]
    words = b" ".join(texts).split(b" ")
    numbers: dict = defaultdict()
    numbers.default_factory = numbers.__len__
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    sizes = np.fromiter((t.count(b" ") + 1 for t in texts), np.int64, len(texts))
    own = np.fromiter((size for _, size in known), np.int64, len(texts))
    n = np.fromiter(known.values(), np.int64, len(texts))
    return _squeezed(b" ".join(numbers)), *(_small(x) for x in (ids, sizes, np.where(own == 0, sizes, own), n))


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unsqueezed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _small(numbers: np.ndarray) -> bytes:
    """Numbers from 0, compressed: their first bytes, their second bytes and so on, of which the last are mostly 0."""
    return _squeezed(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unsqueezed(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


def _mixed(sums: np.ndarray) -> np.ndarray:
    """The bits of a sum of hashes, spread over all places."""
    sums = (sums ^ (sums >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return sums ^ (sums >> np.uint64(29))


class _Chunks:
    """A row of `parse` as arrays over the words of all chunks."""

    def __init__(self, lang: str, words: bytes, ids: bytes, sizes: bytes, own: bytes, n: bytes):
        self.lang, self.distinct = lang, _unsqueezed(words).split(b" ")
        seed = xxhash.xxh64_intdigest(lang.encode(), 42)
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.distinct), np.uint64, len(self.distinct))
        self.ids, sizes = _numbers(ids), _numbers(sizes)
        ends = np.cumsum(sizes)
        place = np.arange(len(self.ids)) - np.repeat(ends - sizes, sizes)
        self.own = place < np.repeat(_numbers(own), sizes)
        self.room = np.repeat(sizes, sizes) - place  # words from here to the end of the chunk
        self.weights = np.repeat(_numbers(n), sizes)

    @classmethod
    def of(cls, batch):
        for row in batch.to_pylist():
            yield cls(*row.values())

    def total(self) -> int:
        return int(self.weights[self.own].sum())

    def phrase_hashes(self, size: int) -> np.ndarray:
        """The hash of the `size` words from each place; of no use where there is no room for them."""
        own = _mixed(self.hashes)[self.ids] if size == 1 else self.hashes[self.ids]
        if size == 1:
            return own
        sums = np.zeros(len(own), np.uint64)
        for k in range(min(size, len(own))):
            factor = np.uint64(xxhash.xxh64_intdigest(b"%d of %d" % (k, size), 7) | 1)
            sums[: len(own) - k] += own[k:] * factor
        return _mixed(sums)

    def candidates(self, size: int, tables: list) -> np.ndarray:
        """Places whose `size` words may be frequent, as far as the tables of shorter phrases tell; own or not."""
        fits = self.room >= size
        for shorter in range(1, min(size - 1, len(tables)) + 1):
            marked = tables[shorter - 1].has(self.phrase_hashes(shorter)) & (self.room >= shorter)
            for k in range(min(size - shorter + 1, len(fits))):
                fits[: len(fits) - k] &= marked[k:]
        return fits


class _Bits:
    """Lookup of hashes in a bit table."""

    def __init__(self, table: bytes, ranges: int):
        self.table, self.ranges = np.frombuffer(table, np.uint8), ranges

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = _bit(_slots(hashes, self.ranges), 8 * len(self.table))
        return (self.table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _slots(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """What is shuffled of a hash: its range, from the high half, and its low half."""
    return (hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32) << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF)


def _bit(slots: np.ndarray, bits: int) -> np.ndarray:
    return (_mixed(slots) >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def _packed(slots: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """One row for each range: the steps between the low halves, and the counts."""
    ranges, low = (slots >> np.uint64(32)).astype(np.int64), (slots & np.uint64(0xFFFFFFFF)).astype(np.int64)
    stops = np.flatnonzero(ranges[1:] != ranges[:-1]) + 1
    parts = list(zip(np.split(low, stops), np.split(counts, stops), strict=True)) if len(slots) else []
    first = ranges[np.concatenate(([0], stops))] if len(slots) else ranges
    columns = [pa.array(first, pa.int32()), *(pa.array([_small(x) for x in c], pa.binary()) for c in ([np.diff(p[0], prepend=0) for p in parts], [p[1] for p in parts]))]
    return pa.RecordBatch.from_arrays(columns, ["range", "steps", "counts"])


def _marked(parsed: DataFrame, sizes: list[int], tables: list, least: int, bits: int, ranges: int) -> bytes:
    """The bit table of the phrases of the given sizes whose hashes are counted `least` times or more."""

    def count(batches):
        lookups = [_Bits(t.value, ranges) for t in tables]
        for batch in batches:
            for words in _Chunks.of(batch):
                keys, counts = [], []
                for size in sizes:
                    at = np.flatnonzero(words.own & words.candidates(size, lookups))
                    keys.append(_slots(words.phrase_hashes(size)[at], ranges))
                    counts.append(words.weights[at])
                yield _packed(*_summed(np.concatenate(keys), np.concatenate(counts)))

    def frequent(table: pa.Table) -> pa.Table:
        range_ = np.uint64(table["range"][0].as_py()) << np.uint64(32)
        low, counts = _summed(
            np.concatenate([np.cumsum(_numbers(x)) for x in table["steps"].to_pylist()]), np.concatenate([_numbers(x) for x in table["counts"].to_pylist()])
        )
        at = _bit(low[counts >= least].astype(np.uint64) | range_, bits)
        word, first = np.unique(at >> 6, return_inverse=True)
        values = np.zeros(len(word), np.uint64)
        np.bitwise_or.at(values, first, np.uint64(1) << (at & 63).astype(np.uint64))
        return pa.table({"word": pa.array(word, pa.int64()), "bits": pa.array(values.view(np.int64), pa.int64())})

    counted = parsed.mapInArrow(count, "range int, steps binary, counts binary")
    found = counted.groupBy("range").applyInArrow(frequent, "word long, bits long")
    # One number for each 64 bits at most, so what reaches the driver has a fixed size.
    table = np.zeros(bits // 64, np.int64)
    for batch in found.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow().to_batches():
        table[batch.column("word").to_numpy()] = batch.column("bits").to_numpy()
    return table.astype("<i8").tobytes()


def _texts(parsed: DataFrame, tables: list, least: int, longest: int, ranges: int) -> DataFrame:
    """(lang, phrase, n) of the marked phrases found `least` times or more, and of all words of a language under the null phrase."""

    def phrases(words: _Chunks, lookups: list) -> dict:
        counts: dict = defaultdict(int)
        own = np.bincount(words.ids[words.own], weights=words.weights[words.own], minlength=len(words.distinct))
        for k in np.flatnonzero(lookups[0].has(_mixed(words.hashes)) & (own > 0)).tolist():
            counts[(k,)] = int(own[k])
        for size in range(2, longest + 1):
            marked = lookups[min(size, len(lookups)) - 1].has(words.phrase_hashes(size))
            at = np.flatnonzero(words.own & words.candidates(size, lookups[:2]) & marked)
            ids = [words.ids[at + k].tolist() for k in range(size)]
            for phrase, n in zip(zip(*ids, strict=True), words.weights[at].tolist(), strict=True):
                counts[phrase] += n
        name = words.distinct
        return {b" ".join([name[k] for k in phrase]): n for phrase, n in counts.items()}

    def count(batches):
        lookups = [_Bits(t.value, ranges) for t in tables]
        for batch in batches:
            for words in _Chunks.of(batch):
                # The first range also gets the number of all words.
                dealt: dict = {0: ([], [])}
                for phrase, n in sorted(phrases(words, lookups).items()):
                    own = dealt.setdefault(xxhash.xxh64_intdigest(phrase) * ranges >> 64, ([], []))
                    own[0].append(phrase)
                    own[1].append(n)
                rows = [(k, words.lang, words.total() if k == 0 else 0, _squeezed(b"\n".join(p)), _small(np.array(n, np.int64))) for k, (p, n) in dealt.items()]
                kinds = pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary()
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["range", "lang", "total", "phrases", "counts"])

    def add_up(table: pa.Table) -> pa.Table:
        counts: dict = defaultdict(int)
        for row in table.to_pylist():
            lang, data = row["lang"], _unsqueezed(row["phrases"])
            counts[lang, None] += row["total"]
            for phrase, n in zip(data.split(b"\n") if data else (), _numbers(row["counts"]).tolist(), strict=True):
                counts[lang, phrase] += n
        kept = [(lang, phrase, n) for (lang, phrase), n in counts.items() if (n >= least if phrase else n)]
        columns = list(zip(*kept, strict=True)) or [[]] * 3
        return pa.table({"lang": pa.array(columns[0], pa.string()), "phrase": pa.array(columns[1], pa.binary()).cast(pa.string()), "n": pa.array(columns[2], pa.int64())})

    counted = parsed.mapInArrow(count, "range int, lang string, total long, phrases binary, counts binary")
    return counted.groupBy("range").applyInArrow(add_up, "lang string, phrase string, n long")


def phrase_counts(
    docs: DataFrame,
    least: int = 100,
    longest: int = 5,
    spread: int = SPREAD,
    filter_bits: int = FILTER_BITS,
    held_words: int = HELD_WORDS,
    range_bytes: int = RANGE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, n, size) of all phrases of 1 to `longest` words found `least` times or more, (lang, total) words)."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    ranges = 1 + size // range_bytes
    parsed = cut(parse(docs, longest, spread, held_words))
    context, tables = docs.sparkSession.sparkContext, []
    for sizes in ([1], [2], list(range(3, longest + 1))):
        tables.append(context.broadcast(_marked(parsed, sizes, tables[:2], least, filter_bits, ranges)))
    counts = cut(_texts(parsed, tables, least, longest, ranges))
    totals = counts.where("phrase IS NULL").select("lang", F.col("n").alias("total"))
    found = counts.where("phrase IS NOT NULL")
    return found.select("*", F.size(F.split("phrase", " ")).alias("size")), totals


def cut_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)) as a long, exact: the products are decimals of 38 digits."""
    whole = "decimal(18,0)"
    top = (a.cast(whole) * n.cast(whole)).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)")
    return F.call_function("div", top, left.cast(whole) * right.cast(whole))


def mine(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best `top` collocations of each language.

    Texts are lower-cased in A-Z and split at `.,;:!?` and line ends into pieces, those at
    blanks and tabs into words. `a` is how often a phrase of 2 to `longest` words occurs inside
    pieces, at least `least` times; `n` counts all words of the language. Cut after its first
    k words it has `l` and `r`, the counts of both parts, and the score
    floor(1000 * a * n / (l * r)); the lowest counts, and of equal ones the first. A phrase
    whose words stand in a longer phrase that occurs as often is left out, whether or not that
    one is. Order: score and `a` descending, then the phrase bytewise.

    A null text is empty, a null language is `und`; texts and pieces of any length count
    whole; repeated rows count each time. Empty tables give no rows. Other columns are not read.
    """
    counts, totals = phrase_counts(docs, least, longest, **options)
    candidates = counts.where("size > 1").withColumnRenamed("n", "a")
    kept = _without_parts(candidates)
    words = F.split("phrase", " ")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({"head": F.array_join(F.slice(words, 1, F.col("k")), " "), "tail": F.array_join(F.slice(words, F.col("k") + 1, F.col("size")), " ")})
    # A common word is the head of very many phrases, so the join is one that splits hot keys.
    cuts = spread_join(cuts, counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"], "inner")
    cuts = spread_join(cuts, counts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"], "inner")
    cuts = spread_join(cuts, totals.withColumnRenamed("total", "n"), ["lang"], "inner")
    scored = cuts.withColumn("score", cut_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    ranked = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each part first, so that no task sorts all phrases of a language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    own = Window.partitionBy("lang", part).orderBy(*order)
    best = ranked.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _without_parts(candidates: DataFrame) -> DataFrame:
    """Candidates that stand in no longer one of at least their own count."""
    words = F.split("phrase", " ")
    sizes = F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("part_size")
    longer = candidates.where("size > 2").select("lang", "a", "size", words.alias("words"), sizes)
    starts = F.explode(F.sequence(F.lit(1), F.col("size") - F.col("part_size") + 1)).alias("start")
    parts = longer.select("lang", "a", "words", "part_size", starts)
    part = F.array_join(F.slice("words", F.col("start"), F.col("part_size")), " ")
    above = parts.groupBy("lang", part.alias("phrase")).agg(F.max("a").alias("longer_a"))
    return candidates.join(above, ["lang", "phrase"], "left").where("longer_a IS NULL OR longer_a < a").drop("longer_a")
