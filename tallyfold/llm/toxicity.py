"""Toxicity of documents whose words may be disguised: a noisy channel, then a learned score.

Method: a token with leetspeak, spacing between its letters or repeated letters is a lattice
of what its characters may stand for. A Viterbi search finds the likeliest path under a
character model, whose trigram counts come from all documents; the path is the restored
text. Words that can't be read in another way are their own restoration. Restored words, and
their beginnings, have weights learned from labelled documents, and a document's score
comes from its most telling word.
"""

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import held_out

#: Labelled documents that weights and score are fitted on, and features that get a weight.
FITTED_DOCS = 30_000
FEATURES = 50_000
#: A feature has to occur in so many labelled documents; its rate is smoothed by so many.
MIN_DOCS = 3
SMOOTHING = 4.0
#: Restored tokens that a task keeps; when there are more, it starts anew. Bounds memory only.
CACHED_TOKENS = 300_000

#: What characters may stand for besides themselves; a choice of this method.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
FILLERS = "*._-'~#%&"
#: Fillers that may also hide a letter, up to so many in a row.
MASKS, MASKED_LETTERS = "*#", 3
#: Latin letters that letters of other scripts look like.
LOOK_ALIKES = str.maketrans("аеорсухіјѕԁһԛԝ", "aeopcyxijsdhqw")
#: Log probabilities of the channel: a character as it is, a stand-in, a filler, a repeated letter, a doubled one, a space, a hidden letter.
PLAIN, STAND_IN, FILLER, REPEATED, DOUBLED, SPACE, HIDDEN = 0.0, -1.0, -0.5, -0.5, -6.0, -2.0, -3.0
EDGES = ".,;:!?()[]{}\"'|"

#: Letters set apart, or symbols that stand for them; white space or punctuation borders the run.
SPACED = re.compile(r"(?!_)[\w@$!|+€](?=[ ._*-])(?<![^\s.,;:!?()\[\]{}\"'|].)(?:[ ._*-](?!_)[\w@$!|+€]){2,}(?![^\s.,;:!?()\[\]{}\"'|])")
BETWEEN = re.compile(r"[ ._*-]")
DOUBLE = re.compile(r"(.)\1").search
RUNS = re.compile(r"(.)\1*", re.DOTALL)
DISGUISED = re.compile(r"[^\W\d_]").search
LATIN = re.compile("[a-z]").search
#: Without a letter, a token of stand-ins is a disguised word unless it reads as a number or price.
SYMBOLS = re.compile(r"[@$!|+€]").search
NUMBER = re.compile(r"[+$€]?[\d.,:/%-]*[$€+%]?").fullmatch


def readable(token: str) -> bool:
    """Whether a token may be a word: it has a letter, or symbols that stand for letters."""
    return bool(DISGUISED(token) or SYMBOLS(token) and not NUMBER(token))


#: Letters of the character model; all others share one code. Blank is the border of a word.
ALPHABET = " abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýßœ"
SIZE = len(ALPHABET) + 1
#: What a filler that may hide a letter stands for: nothing or one of a-z, which have the codes 1 to 26.
HIDES = [("", FILLER), *((letter, HIDDEN) for letter in ALPHABET[1:27])]
HIDDEN_CODES = np.arange(1, 27)
#: The first run of such fillers.
MASKED = re.compile("|".join(f"(?<!{c}){c}{{1,{MASKED_LETTERS}}}(?!{c})" for c in map(re.escape, MASKS)))
#: In a word of letters, from a run of equal ones to the first two single letters in a row: these
#: are the same in all readings, so none depends on what lies beyond. Without them it is still open.
CHOICES = re.compile(r"(.)\1+(?:(.)\2+|(.)(?!\3)(?=(.)\4))*(?:(.)(?!\5)(.)(?!\6))?", re.DOTALL)


def letter_codes() -> np.ndarray:
    codes = np.zeros(0x110000, np.int64)  # what is no letter is a border
    codes[[p for p in range(0x3000) if chr(p).isalpha()]] = SIZE - 1
    codes[0x3000:] = SIZE - 1
    for k, c in enumerate(ALPHABET):
        codes[ord(c)] = k
    return codes


def character_counts(docs: DataFrame) -> np.ndarray:
    """How often each trigram of letters and borders occurs in all documents.

    Each task counts its own texts; the sums reach the driver as a table of a fixed size.
    """

    def run(batches):
        codes, total = letter_codes(), np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                text = " ".join(["", *(t.lower() for t in batch.column(0).slice(at, 200).to_pylist() if t), ""])
                c = codes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
                c = c[~((c == 0) & np.concatenate(([False], c[:-1] == 0)))]
                c = np.concatenate(([0], c))
                if len(c) > 2:
                    total += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE**3)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, "int64"), pa.array(total[found], "int64")], ["gram", "n"])

    sums = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    out = np.zeros(SIZE**3)
    for gram, n in sums.collect():
        out[gram] = n
    return out.reshape(SIZE, SIZE, SIZE)


def latin(token: str) -> str:
    """A token in lower case, with wide and styled letters as plain ones and, among Latin ones, look-alikes as Latin."""
    token = unicodedata.normalize("NFKC", token).lower()
    return token.translate(LOOK_ALIKES) if LATIN(token) else token


def _reading(chain) -> str:
    """The text of a chain of parts, the last first."""
    parts = []
    while chain:
        chain, text = chain
        parts.append(text)
    return "".join(reversed(parts))


class Channel:
    """Restores disguised tokens under a character model."""

    def __init__(self, counts: np.ndarray):
        pairs, singles = counts.sum(axis=0), counts.sum(axis=(0, 1))
        one = (singles + 1) / (singles.sum() + SIZE)
        two = (pairs + 5 * one) / (pairs.sum(axis=1, keepdims=True) + 5)
        three = (counts + 5 * two) / (counts.sum(axis=2, keepdims=True) + 5)
        self.log = np.log(three)
        self.code = {c: k for k, c in enumerate(ALPHABET)}
        self.endings: dict = {}

    def options(self, token: str, lettered: bool | None = None) -> list[list[tuple[str, float]]]:
        """For each run of equal characters what it may stand for, with the channel's log probability.

        `lettered`: the word has a letter, here or in another part of it.
        """
        out = []
        lettered = bool(DISGUISED(token)) if lettered is None else lettered
        for run in RUNS.finditer(token):
            c, n = run[1], len(run[0])
            if c in MASKS and n <= MASKED_LETTERS:
                out += [HIDES] * n
                continue
            if c.isalpha():
                kinds = [(c, PLAIN)] if n == 1 else [(c * 2, PLAIN), (c, DOUBLED)] if n == 2 else [(c, REPEATED), (c * 2, REPEATED)]
            elif c in LEET:
                kinds = [(s * k, STAND_IN * n) for s in LEET[c] for k in {1, min(n, 2)}]
                if c in "!|+$" and lettered:  # else symbols are all that the word has
                    kinds.append(("", FILLER * n))
            elif c in FILLERS or c == " ":
                kinds = [("", FILLER * n)]
            else:
                kinds = [(" ", PLAIN)]
            out.append(kinds)
        return out

    def decode(self, token: str, spaced: bool = False) -> str:
        """The likeliest reading of a token; `spaced`: of letters set apart, in which words may end anywhere."""
        if spaced:
            options = self.options(token)
            # A symbol set apart is a letter; only the last may be punctuation.
            options[:-1] = [[k for k in kinds if k[0]] for kinds in options[:-1]]
            paths = self._follow({(0, 0): (0.0, None)}, [*options, [(" ", PLAIN)]], spaced)
            return _reading(max(paths.values(), key=lambda p: p[0])[1]).strip()
        head = token if token.isalpha() else token[: next(k for k, c in enumerate(token) if not c.isalpha())]
        lettered, done, at = bool(head) or bool(DISGUISED(token)), "", 0
        for window in CHOICES.finditer(head):
            done += head[at : window.start()]
            at = window.start()
            if window[5] is None:  # it is still open where the letters end
                break
            done += self._part(self._state(done), window[0], True, False)
            at = window.end()
        else:
            if head is token:
                return done + head[at:]
            done, at = done + head[at:], len(head)
            masked = MASKED.search(token, at)
            if masked and masked.start() > at:
                paths = self._follow({self._state(done): (0.0, None)}, self.options(token[at : masked.start()], lettered))
                if len(paths) == 1:
                    done, at = done + _reading(next(iter(paths.values()))[1]), masked.start()
        return (done + (self._part(self._state(done), token[at:], lettered, True) if at < len(token) else "")).strip()

    def _state(self, done: str) -> tuple[int, int]:
        """The codes of the last two letters."""
        x, y = (" " + done)[-2:] if done else "  "
        return self.code.get(x, SIZE - 1), self.code.get(y, SIZE - 1)

    def _part(self, state: tuple[int, int], part: str, lettered: bool, last: bool) -> str:
        """The likeliest reading of a part of a token after two letters; those met are remembered.

        What follows a part that is not the last, and what comes before the two letters, has no say in it.
        """
        if part[0] in MASKS and part == part[0] * len(part):
            part = MASKS[0] * len(part)  # all of them hide alike
        key = state, part, lettered, last
        if key not in self.endings:
            if len(self.endings) > CACHED_TOKENS:
                self.endings.clear()
            paths = self._follow({state: (0.0, None)}, self.options(part, lettered) + [[(" ", PLAIN)]] * last)
            self.endings[key] = _reading(max(paths.values(), key=lambda p: p[0])[1])
        return self.endings[key]

    def _follow(self, paths: dict, steps: list, spaced: bool = False) -> dict:
        """The best path into each pair of last letters after some more steps; of equals the first."""
        log, code, other = self.log, self.code, SIZE - 1
        for kinds in steps:
            if kinds is HIDES:
                paths = self._unhide(paths)
                continue
            if len(paths) == 1 and len(kinds) == 1 and not spaced:  # no choice, so nothing to weigh
                ((x, y), (score, done)) = next(iter(paths.items()))
                text = kinds[0][0]
                for c in text:
                    x, y = y, code.get(c, other)
                paths = {(x, y): (score, (done, text))}
                continue
            new: dict = {}
            if spaced:
                kinds = kinds + [(" " + text, cost + SPACE) for text, cost in kinds if text.strip()]
            for (a, b), (score, done) in paths.items():
                for text, cost in kinds:
                    x, y, total = a, b, score + cost
                    for c in text:
                        z = code.get(c, other)
                        total += log[x, y, z]
                        x, y = y, z
                    known = new.get((x, y))
                    if known is None or total > known[0]:
                        new[x, y] = total, (done, text)
            paths = new
        return paths

    def _unhide(self, paths: dict) -> dict:
        """A step over a filler that may hide a letter: the same as for other steps, all letters at once."""
        x, y = np.array(list(paths)).T
        scores, chains = (list(p) for p in zip(*paths.values(), strict=True))
        scores = np.array(scores)
        letters = (scores + HIDDEN)[:, None] + self.log[x[:, None], y[:, None], HIDDEN_CODES]
        totals = np.column_stack([scores + FILLER, letters]).ravel()
        into = np.column_stack([x * SIZE + y, y[:, None] * SIZE + HIDDEN_CODES]).ravel()
        best = np.full(SIZE * SIZE, -np.inf)
        np.maximum.at(best, into, totals)
        wins = np.flatnonzero(totals == best[into])[::-1]  # written backwards, the first stays
        winner, met = np.zeros(SIZE * SIZE, np.int64), np.full(SIZE * SIZE, len(into))
        winner[into[wins]] = wins
        met[into[::-1]] = np.arange(len(into))[::-1]
        order = np.argsort(met, kind="stable")[: np.count_nonzero(met < len(into))]
        found = zip(order.tolist(), winner[order].tolist(), totals[winner[order]].tolist(), strict=True)
        return {divmod(k, SIZE): (total, (chains[w // len(HIDES)], HIDES[w % len(HIDES)][0])) for k, w, total in found}

    def restore(self, token: str) -> str:
        """The restoration of a token without white space, in lower case."""
        token = token.lower() if token.isascii() else latin(token)
        plain = token.strip(EDGES)
        if plain.isalpha() and not DOUBLE(plain):
            return plain
        if not readable(plain):
            return plain
        return self.decode(plain if plain and not any(c in LEET for c in token[len(token.rstrip(EDGES)) :]) else token)

    def parts(self, text: str) -> tuple[list[str], list[str]]:
        """(tokens, restored runs of spaced letters) of a text."""
        letters = [BETWEEN.sub("", latin(m)) for m in SPACED.findall(text)]
        runs = [self.decode(m, spaced=True) for m in letters if readable(m)]
        return text.split(), runs

    def restore_text(self, text: str) -> str:
        """The whole text with its disguised tokens restored."""
        tokens, runs = self.parts(text)
        return " ".join([*map(self.restore, tokens), *runs])


def features(word: str) -> list[str]:
    """A restored word and its beginnings, which inflected words share."""
    if len(word) > 6:
        return [word, word[:4] + "*", word[:5] + "*", word[:6] + "*"]
    return [word, *(word[:k] + "*" for k in (4, 5) if len(word) > k)]


@dataclass
class Model:
    channel: Channel
    weights: dict[str, float] = field(default_factory=dict)
    slope: float = 0.0
    offset: float = -3.0
    done: dict[str, float] = field(default_factory=dict)

    @cached_property
    def starts(self) -> set[str]:
        """The first four characters of all words and beginnings that have a weight; other words have none."""
        return {f[:4] for f in self.weights}

    def weight(self, token: str) -> float:
        """The weight of the most telling word that a token is restored to."""
        known, starts, best = self.weights.get, self.starts, 0.0
        for w in self.channel.restore(token).split(" "):
            if w[:4] in starts:
                best = max(best, *map(known, features(w), repeat(0.0)))
        return best

    def evidence(self, text: str) -> float:
        """The weight of the most telling word of a whole text; 0 without any."""
        tokens, runs = self.channel.parts(text)
        if len(self.done) > CACHED_TOKENS:
            self.done.clear()
        done = self.done
        tokens = set(tokens)
        found = list(map(done.get, tokens))
        if None in found:
            for t in tokens.difference(done):
                done[t] = self.weight(t)
            found = map(done.get, tokens)
        own = max(found, default=0.0)
        known = self.weights.get
        return max([own, *(known(f, 0.0) for r in runs for w in r.split(" ") for f in features(w))])

    def score(self, text: str) -> float:
        return 1 / (1 + math.exp(-min(50.0, max(-50.0, self.slope * self.evidence(text) + self.offset))))


def _labelled(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic) of a bounded sample of the labelled documents that are not held out."""
    own = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    one = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic")


def _feature_counts(channel) -> object:
    def run(batches):
        own, restored = channel.value, {}
        docs, toxic = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens, runs = own.parts(text or "")
                if len(restored) > CACHED_TOKENS:
                    restored.clear()
                found = set()
                for t in {*tokens}:
                    if t not in restored:
                        restored[t] = [f for w in own.restore(t).split(" ") for f in features(w)]
                    found.update(restored[t])
                found.update(f for r in runs for w in r.split(" ") for f in features(w))
                docs.update(found)
                if label == 1:
                    toxic.update(found)
        yield pa.RecordBatch.from_arrays([pa.array(docs.keys(), "string"), pa.array(docs.values(), "int64"), pa.array([toxic[f] for f in docs], "int64")], ["feature", "n", "n_toxic"])

    return run


def _evidence(model):
    def run(batches):
        own = model.value
        for batch in batches:
            found = [own.evidence(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, "float64"), batch.column(1).cast("int32")], ["evidence", "toxic"])

    return run


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic regression on one variable, lightly held towards 0."""
    design, beta = np.column_stack([x, np.ones(len(x))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + np.diag([0.1, 1e-6])
        beta += np.clip(np.linalg.solve(hessian, design.T @ (y - p) - np.array([0.1, 1e-6]) * beta), -3, 3)
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, rows: int = FITTED_DOCS) -> Model:
    """The character model of all documents; weights and score of a bounded labelled sample.

    Without labels of both kinds every document scores low.
    """
    context = docs.sparkSession.sparkContext
    channel = Channel(character_counts(docs))
    sample = _labelled(docs, labels, rows)
    kinds = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    model = Model(channel)
    if not (kinds.get(0) and kinds.get(1)):
        return model
    prior = kinds[1] / (kinds[0] + kinds[1])
    counts = sample.mapInArrow(_feature_counts(context.broadcast(channel)), "feature string, n long, n_toxic long")
    summed = counts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))
    rate = (F.col("n_toxic") + SMOOTHING * prior) / (F.col("n") + SMOOTHING)
    weight = F.log(rate / (1 - rate)) - math.log(prior / (1 - prior))
    telling = summed.where(F.col("n") >= MIN_DOCS).withColumn("weight", weight).where("weight > 0.5")
    best = telling.orderBy(F.desc("weight"), "feature").limit(FEATURES)
    model.weights = {r.feature: r.weight for r in best.select("feature", "weight").collect()}
    seen = sample.mapInArrow(_evidence(context.broadcast(model)), "evidence double, toxic int").collect()
    model.slope, model.offset = logistic(np.array([r.evidence for r in seen]), np.array([float(r.toxic) for r in seen]))
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, from its text alone.

    A null text counts as empty. Whole texts are read. Repeated rows and null ids come back
    as they are; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = sent.value
        for batch in batches:
            found = [own.score(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast("int64"), batch.column(1), pa.array(found, "float64"), pa.array([int(f >= threshold) for f in found], "int32")], ["doc_id", "held_out", "score", "predicted"])

    asked = docs.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    return asked.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
