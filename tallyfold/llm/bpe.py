"""BPE encoding and decoding over a trie of the distinct words.

Method: the distinct words of a batch go into a trie whose edges are the initial symbols.
Depth first, each node gets the last token of the encoding of its prefix. That token is
unique: a token sequence is the encoding of a string exactly if each two neighbours stay
apart when they are encoded alone. So the last token of a prefix is the one token that
ends there and may follow the last token of the prefix before it. Prefixes that words share
are computed once, and walking the last tokens backwards gives a word's whole encoding.
"""

import hashlib
import json
import re
import sys
import types
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Entries of a generation of a cache; two are kept. It bounds memory only.
CACHED_WORDS = 200_000
#: Pairs of tokens whose verdict is kept.
CACHED_PAIRS = 2_000_000


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


class Generations:
    """A cache of two generations: when the new one is full it becomes the old one, and what is used moves on."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def missing(self, keys: set) -> list:
        """The keys that are in neither generation; the others are in the new one afterwards."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        out, new, old = [], self.new, self.old
        for key in keys - new.keys():
            found = old.get(key)
            if found is None:
                out.append(key)
            else:
                new[key] = found
        return out


class TrieBpe:
    """A byte-level BPE vocabulary with word ends, read from the text of a tokenizer file.

    Token ids have to follow the order of the merges, as they do in the files of this kind.
    """

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merged, self.halves, before = {}, {}, -1
        for left, right in merges:
            i = self.vocab[left + right]
            if i <= before:
                raise ValueError("token ids don't follow the order of the merges")
            before = i
            pair = self.vocab[left], self.vocab[right]
            self.merged[pair], self.halves[i] = i, pair
        symbols = byte_symbols()
        self.symbols = {ord(chr(b)): s for b, s in symbols.items()}
        self.root = self._automaton()
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern.replace("\\s", "\\p{White_Space}")).findall
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        self.judged = 0
        self.number = {i: str(i) for i in self.token}
        self.special_texts = {t: (str(i), t) for t, i in self.special.items()}
        self.encoded, self.done = Generations(CACHED_WORDS), Generations(CACHED_WORDS)

    def _automaton(self) -> dict:
        """The root of the tokens' suffix automaton, by which a walk knows all tokens that end where it is.

        A node maps a symbol to the next node; under 0 it has its tokens as (size, token, left
        neighbours judged so far), longest first, and under 1 the node of its longest suffix.
        """
        end, root = self.end, {}
        for token, i in self.vocab.items():
            body = token.removesuffix(end) if end else token
            if not body:
                continue
            node = root
            for symbol in [*body[:-1], body[-1] + (end if len(body) < len(token) else "")]:
                node = node.setdefault(symbol, {})
            node[2] = len(body), i, {}
        root[0], level = (), [(root, None, None)]
        while level:
            below = []
            for node, up, symbol in level:
                for s, child in node.items():
                    if isinstance(s, str):
                        below.append((child, node, s))
                if up is not None:
                    back = up.get(1)
                    while back is not None and symbol not in back:
                        back = back.get(1)
                    node[1] = root if back is None else back[symbol]
                    own = node.pop(2, None)
                    node[0] = ((own,) if own else ()) + node[1][0]
            level = below
        return root

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart: no merge that comes in time crosses the border."""
        # Undo the merges on either side of the border, the latest first. A merge across the
        # border wins if it comes before the merge that took one of its parts away.
        merged, halves, limit = self.merged, self.halves, 1 << 60
        while True:
            if merged.get((left, right), limit) < limit:
                return False
            if left in halves and (left > right or right not in halves):
                limit, left = left, halves[left][1]
            elif right in halves:
                limit, right = right + 1, halves[right][0]
            else:
                return True

    def _next(self, node: dict, symbol: str) -> dict:
        """The node after a symbol that the node itself has no edge for: that of its longest suffix with one."""
        back = node.get(1)
        while back is not None and symbol not in back:
            back = back.get(1)
        found = self.root if back is None else back[symbol]
        if not found[0]:
            raise ValueError("a symbol is not in the vocabulary")
        return found

    def encode_words(self, words, encoded: dict) -> None:
        """Puts the encodings of these words (in byte symbols) into `encoded`.

        The trie is held in its sorted form: sorted words come in the order of a depth-first
        walk, and two neighbours share the nodes of their common prefix. `tokens`, `starts` and
        `nodes` hold the states of the nodes on the way to the current word, so only the nodes
        that it does not share with the word before it are computed.
        """
        end, before, number, step = self.end, "", self.number, self._next
        tokens, starts, nodes = [], [], [self.root]  # of each prefix: its last token, where that starts, where the walk is
        for word in sorted(words):
            size = len(word)
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            before = word
            shared = min(shared, size if not end else size - 1)
            del tokens[shared:], starts[shared:], nodes[shared + 1 :]
            node = nodes[shared]
            for stop in range(shared + 1, size + 1):
                symbol = word[stop - 1] + end if stop == size else word[stop - 1]
                node = node.get(symbol) or step(node, symbol)
                for length, token, judged in node[0]:
                    start = stop - length
                    if not start:
                        break
                    left = tokens[start - 1]
                    apart = judged.get(left)
                    if apart is None:
                        apart = judged[left] = self.stay_apart(left, token)
                        self.judged += 1
                    if apart:
                        break
                tokens.append(token)
                starts.append(start)
                nodes.append(node)
            ids, stop = [], size
            while stop:
                ids.append(tokens[stop - 1])
                stop = starts[stop - 1]
            ids.reverse()
            encoded[word] = " ".join([number[i] for i in ids]), self.decode(ids)
            if end:  # the state of the whole word is that of its end, not of a prefix
                tokens.pop()
                starts.pop()
                nodes.pop()
                before = word[:-1]
        if self.judged > CACHED_PAIRS:
            self.judged, self.root = 0, self._automaton()

    def words_in(self, chunk: str) -> list[str]:
        """The words of a text without white space, in byte symbols, and its special tokens."""
        if chunk.isalpha() and "Σ" not in chunk:
            word = chunk.lower()
            if word.isascii():
                return [word]
        out: list[str] = []
        for part in self.at_special(chunk) if "<|" in chunk else (chunk,):
            if part in self.special:
                out.append(part)
            else:
                text = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                pieces = (text,) if text.isalpha() else self.pieces(text)
                out += [w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.symbols) for w in pieces]
        return out

    def encode_chunks(self, chunks: set) -> dict:
        """A dictionary that has for each chunk its ids and tokens as texts."""
        split = {c: self.words_in(c) for c in self.done.missing(chunks)}
        special = self.special_texts
        words = {w for ws in split.values() for w in ws if w not in special}
        self.encode_words(self.encoded.missing(words), self.encoded.new)
        encoded, done = self.encoded.new, self.done.new
        for chunk, words in split.items():
            if len(words) == 1 and words[0] in encoded:
                done[chunk] = encoded[words[0]]
            else:
                found = [special.get(w) or encoded[w] for w in words]
                done[chunk] = " ".join([f[0] for f in found]), " ".join([f[1] for f in found])
        return done

    def decode(self, ids) -> str:
        """The tokens, joined as a tokenizer file without a decoder asks for: by blanks."""
        token = self.token
        return " ".join([token[i] for i in ids])


#: The blanks that the white space of the file's patterns has not, though str.split() does.
ODD_BLANKS = re.compile("[\x1c-\x1f]").search
WHITE_SPACE = regex.compile(r"\p{White_Space}+").split


def chunks_of(text: str) -> list[str]:
    return [c for c in WHITE_SPACE(text) if c] if ODD_BLANKS(text) else text.split()


def encode(docs: DataFrame, spec: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every document: ids and decoded are texts.

    `spec` is the content of the tokenizer file, of a size that does not depend on the data.
    A null text counts as empty: no token, empty texts. A null doc_id stays null; repeated
    rows give repeated results. Only doc_id and text are read of `docs`.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _encoder(docs.sparkSession.sparkContext.broadcast(spec), _key(spec), digest=False), "doc_id long, n_tokens long, ids string, decoded string"
    )


def encode_digests(docs: DataFrame, spec: str) -> DataFrame:
    """As `encode`, with the SHA-256 of both texts in their place."""
    return docs.select("doc_id", "text").mapInArrow(
        _encoder(docs.sparkSession.sparkContext.broadcast(spec), _key(spec), digest=True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _key(spec: str) -> str:
    return hashlib.sha256(spec.encode()).hexdigest()


def _of_this_worker(spec, key: str) -> TrieBpe:
    """The encoder that this Python process keeps between its tasks, with its caches of a bounded size."""
    kept = sys.modules.setdefault("_bpe_of_this_worker", types.ModuleType("_bpe_of_this_worker")).__dict__
    if kept.get("key") != key:
        kept["key"], kept["encoder"] = key, TrieBpe(spec.value)
    return kept["encoder"]


def _encoder(spec, key: str, digest: bool):
    def run(batches):
        bpe = _of_this_worker(spec, key)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                yield _encode_part(bpe, batch.slice(start, 1000), digest)

    return run


def _encode_part(bpe: TrieBpe, part: pa.RecordBatch, digest: bool) -> pa.RecordBatch:
    texts = [chunks_of(t or "") for t in part.column(1).to_pylist()]
    done = bpe.encode_chunks(set().union(*texts))
    counts, ids, decoded = [], [], []
    for chunks in texts:
        both = [done[c] for c in chunks]
        i, d = " ".join([b[0] for b in both]), " ".join([b[1] for b in both])
        counts.append(i.count(" ") + 1 if i else 0)
        ids.append(hashlib.sha256(i.encode()).hexdigest() if digest else i)
        decoded.append(hashlib.sha256(d.encode()).hexdigest() if digest else d)
    names = ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"])]
    return pa.RecordBatch.from_arrays([part.column(0).cast("int64"), pa.array(counts, "int64"), pa.array(ids, "string"), pa.array(decoded, "string")], names)
