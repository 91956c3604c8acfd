"""Language identification by cross-parsing entropy.

Method: for each language a suffix automaton of labelled text is built. A text is parsed
against it into phrases: each is the longest match that occurs in the labelled text, and the
next begins at the character that ended it. Text that is like the labelled text needs few
phrases. The language that needs the fewest, as bits for each character, wins.

The automata are tables of states by the letters of their own language, or sorted transitions
where that has very many letters. Their size does not depend on the number of documents, and all blocks of a batch are parsed in step, a character at a time, over whole columns.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import held_out

#: Labelled documents of each language that the automata are fitted on, the characters of each
#: from its first letter on, and those of the text that is put together from them.
FITTED_DOCS = 200
FITTED_DOC_CHARS = 4000
FITTED_CHARS = 60_000
#: Entries of a table; an automaton that needs more is kept as sorted transitions.
TABLE_ENTRIES = 1 << 24
#: A text is parsed in blocks of so many characters; no phrase crosses a border.
BLOCK = 512
#: Blocks that are parsed in step, so that a very long text needs no more memory than others.
TOGETHER = 8192

BLANK, OTHER = 1, 0


def suffix_automaton(symbols) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; state 0 is the empty one."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        new = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in edges[state]:
            edges[state][symbol] = new
            state = link[state]
        if state >= 0:
            target = edges[state][symbol]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                clone = len(edges)
                edges.append(dict(edges[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                while state >= 0 and edges[state].get(symbol) == target:
                    edges[state][symbol] = clone
                    state = link[state]
                link[target] = link[new] = clone
        last = new
    return edges


def letters_only(text: str) -> str:
    """Lower case, and one blank for each run of what is not a letter."""
    return "".join(c if c.isalpha() else " " for c in text.lower())


class Automaton:
    """Transitions of a labelled text; a state is the place of its row, of `width` entries.

    `own` maps the codes of all languages to the columns of this one. Its letters have one
    each; whatever else there is shares column OTHER, which matches nothing.
    """

    def __init__(self, text: str, code: dict[str, int]):
        letters = sorted(set(text) - {" "})
        column = {c: k + 2 for k, c in enumerate(letters)} | {" ": BLANK}
        self.width = len(letters) + 2
        self.own = np.zeros(len(code) + 2, np.int32)
        for c, k in column.items():
            self.own[code[c]] = k
        edges = suffix_automaton(column[c] for c in text)
        if len(edges) * self.width <= TABLE_ENTRIES:
            self.keys, self.table = None, np.full(len(edges) * self.width, -1, np.int32)
            for state, out in enumerate(edges):
                for symbol, target in out.items():
                    self.table[state * self.width + symbol] = target * self.width
        else:
            pairs = sorted((state * self.width + symbol, target * self.width) for state, out in enumerate(edges) for symbol, target in out.items())
            self.keys, self.table = (np.array(x, np.int64) for x in zip(*pairs, strict=True))

    def step(self, places: np.ndarray) -> np.ndarray:
        """The next states at places of the table, -1 where no match goes on."""
        if self.keys is None:
            return self.table[places]
        at = np.minimum(np.searchsorted(self.keys, places), len(self.keys) - 1)
        return np.where(self.keys[at] == places, self.table[at], -1)


class Model:
    """Languages, the codes of all their letters, and an automaton for each language."""

    def __init__(self, labelled: dict[str, str]):
        self.languages = sorted(labelled)
        texts = {k: " ".join(letters_only(labelled[k]).split()) for k in self.languages}
        self.codes = np.full(0x110000, BLANK, np.int32)
        self.alphabet = sorted({c for text in texts.values() for c in text} - {" "})
        code = {c: k + 2 for k, c in enumerate(self.alphabet)} | {" ": BLANK}
        self.tables = [Automaton(texts[k], code) for k in self.languages]
        self.bits = [math.log2(max(2, len(texts[k]))) for k in self.languages]

    def encode(self, text: str) -> np.ndarray:
        """The codes of a lower-cased text, runs of non-letters as one blank."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        codes = self.lookup()[points]
        blank = codes == BLANK
        keep = ~(blank & np.concatenate(([True], blank[:-1])))
        return codes[keep]

    def lookup(self) -> np.ndarray:
        if not getattr(self, "ready", False):
            alpha = np.array([chr(p).isalpha() for p in range(0x110000)])
            self.codes[alpha] = OTHER
            for k, c in enumerate(self.alphabet):
                self.codes[ord(c)] = k + 2
            self.ready = True
        return self.codes

    def phrases(self, blocks: np.ndarray, sizes: np.ndarray, automaton: Automaton) -> np.ndarray:
        """Phrases of each block. Blocks are columns, the longest first, with `sizes` characters.

        A character that the labelled text lacks begins a phrase, which goes on after it.
        """
        state = np.zeros(blocks.shape[1], automaton.table.dtype)
        count = np.ones(blocks.shape[1], np.int64)
        active = len(sizes)
        for k, row in enumerate(blocks):
            while active and sizes[active - 1] <= k:
                active -= 1
            symbol = automaton.own[row[:active]]
            step = automaton.step(state[:active] + symbol)
            ended = step < 0
            count[:active] += ended
            alone = automaton.step(symbol)
            state[:active] = np.where(ended, np.maximum(alone, 0), step)
        return count

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language, score) of each text; the score is 0 to 1, higher if the others need more."""
        codes = [self.encode(t.lower()) for t in texts]
        sizes = np.array([len(c) for c in codes])
        letters = np.array([bool((c != BLANK).any()) for c in codes], bool)
        owner = np.repeat(np.arange(len(texts)), -(-sizes // BLOCK))
        if not len(owner) or not self.languages:
            return [("und", 0.0)] * len(texts)
        lengths = np.concatenate([np.minimum(BLOCK, s - np.arange(0, s, BLOCK)) for s in sizes.tolist() if s])
        flat = np.concatenate(codes)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        order = np.argsort(-lengths, kind="stable")
        cost = np.zeros((len(self.languages), len(texts)))
        for g in range(0, len(order), TOGETHER):
            some = order[g : g + TOGETHER]
            at = starts[some][None, :] + np.arange(lengths[some[0]])[:, None]
            blocks = flat[np.minimum(at, len(flat) - 1)]
            for k, (automaton, bits) in enumerate(zip(self.tables, self.bits, strict=True)):
                needed = self.phrases(blocks, lengths[some], automaton) * bits
                cost[k] += np.bincount(owner[some], needed, len(texts))
        cost /= np.maximum(sizes, 1)
        best = cost.argmin(axis=0)  # of equals the first by name
        least = cost[best, np.arange(len(texts))]
        rivals = np.sort(cost, axis=0)[1] if len(self.languages) > 1 else least * 2
        score = np.clip(1 - least / np.maximum(rivals, 1e-9), 0, 1)
        return [(self.languages[b], float(s)) if has else ("und", 0.0) for b, s, has in zip(best, score, letters, strict=True)]


def fit(docs: DataFrame) -> Model:
    """A model of a bounded sample of the documents that are not held out and have a language.

    For each language these are the FITTED_DOCS documents with the least hash of their id, of
    those that have a letter, and of each the first FITTED_DOC_CHARS characters from it on. Few rows reach the
    driver, however many there are.
    """
    usable = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike("\\p{L}"))
    piece = F.substring(F.regexp_replace("text", "^\\P{L}+", ""), 1, FITTED_DOC_CHARS).alias("text")
    by_hash = usable.select("lang", piece, F.xxhash64("doc_id").alias("place"))
    ranked = by_hash.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("place", "text")))
    labelled: dict[str, str] = {}
    for row in ranked.where(F.col("rank") <= FITTED_DOCS).orderBy("lang", "rank").select("lang", "text").collect():
        if len(labelled.setdefault(row.lang, "")) < FITTED_CHARS:
            labelled[row.lang] = f"{labelled[row.lang]} {row.text}"[:FITTED_CHARS]
    return Model(labelled)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, from its text alone.

    `und` and 0 where the text is null or has no letter, and where no language was learned.
    Whole texts are read. Repeated rows and null ids come back as they are; an empty table
    gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = own.predict([t or "" for t in part.column(2).to_pylist()])
                columns = [pa.array([f[0] for f in found], "string"), pa.array([f[1] for f in found], "float64")]
                yield pa.RecordBatch.from_arrays([part.column(0).cast("int64"), part.column(1), *columns], ["doc_id", "held_out", "lang_pred", "score"])

    asked = docs.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    return asked.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
