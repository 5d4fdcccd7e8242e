"""Toxicity by a weighted lexicon that is matched with an Aho-Corasick automaton.

Texts are folded first: look-alike letters of other scripts become Latin ones,
digits and signs that stand for letters inside a word become those letters. An
entry without accents is also found where the text puts accents on its letters. The lexicon is learned from labelled documents. An entry is a whole
word or the beginning of a word; its weight says how much more often it stands
in toxic documents. Exception phrases are two-word phrases around an entry that
are no more toxic than other text; a match inside one does not count. The
weights found in a text are summed and normalised by its length, and a small
logistic model turns them into a score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.context import cut_lineage
from tablewarden.llm.tables import held_out, map_batches, texts_of

#: At most so many labelled documents are learned from, those with the least hash of their id.
MAX_TRAINING_ROWS = 20_000
MIN_DOCUMENTS = 4  # an entry stands in so many toxic documents at least
MIN_LIFT = 4.0  # and in so many times as many toxic as other documents, by rate
PREFIXES = (3, 4, 5, 6)
MAX_ENTRIES = 20_000
#: The sample is spread over so many files, for its texts are read several times.
TRAINING_PARTS = 32
MAX_REMEMBERED = 200_000
MAX_REMEMBERED_LENGTH = 64

# Letters of other scripts and signs that look like a Latin letter.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j",
    "ѕ": "s", "ԁ": "d", "һ": "h", "ɡ": "g", "ӏ": "l", "к": "k", "м": "m", "т": "t", "в": "b",
    "н": "h", "α": "a", "ο": "o", "ρ": "p", "ν": "v", "τ": "t", "ι": "i", "κ": "k", "ε": "e",
    "υ": "u", "ı": "i", "ł": "l", "ø": "o", "đ": "d",
}
# Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a",
               "$": "s", "!": "i", "|": "l", "+": "t"}

_STANDS_IN = "".join(SUBSTITUTES)
_MIXED = re.compile(
    rf"(?<=[^\W\d_])[{re.escape(_STANDS_IN)}]+(?=[^\W\d_])"
    rf"|(?<![^\s])[{re.escape(_STANDS_IN)}]+(?=[^\W\d_])|(?<=[^\W\d_])[0134578]+(?![^\W_])"
)
_STANDS_FOR = str.maketrans(SUBSTITUTES)
_SPACES = re.compile(r"[\W\d_]+")


class _Letters(dict):
    """Code point -> folded text; worked out once for each code point that occurs."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        plain = "".join(
            LOOKALIKES.get(c, c)
            for c in unicodedata.normalize("NFKC", char.lower())
            if unicodedata.category(c) != "Cf"
        )
        self[code] = plain
        return plain


class _Bases(dict):
    """Code point -> the letter without its accents, one for one."""

    def __missing__(self, code: int) -> str:
        base = self[code] = unicodedata.normalize("NFD", chr(code))[0]
        return base


_letters, _bases = _Letters(), _Bases()


def _fold_token(token: str) -> str:
    plain = token.lower() if token.isascii() else token.translate(_letters)
    if not plain.isalpha():
        plain = _MIXED.sub(lambda m: m.group().translate(_STANDS_FOR), plain)
        plain = _SPACES.sub(" ", plain).strip()
    return plain


def _bare_word(word: str) -> str:
    return word if word.isascii() else word.translate(_bases)


class _Remembered(dict):
    """Word -> what `work` makes of it; a bounded number of short words is remembered."""

    def __init__(self, work: Callable[[str], str]):
        super().__init__()
        self._work = work

    def __missing__(self, word: str) -> str:
        found = self._work(word)
        if len(word) <= MAX_REMEMBERED_LENGTH:
            if len(self) >= MAX_REMEMBERED:
                self.clear()
            self[word] = found
        return found


_folded, _bared = _Remembered(_fold_token), _Remembered(_bare_word)


def fold(text: str) -> str:
    """Lower-case words between single spaces, with a space before and after.

    What a sign stands for depends on its neighbours up to the next white space,
    so each token is folded by itself.
    """
    return f" {' '.join(filter(None, map(_folded.__getitem__, text.split())))} "


def without_accents(folded: str) -> str:
    if folded.isascii():
        return folded
    return " ".join(map(_bared.__getitem__, folded.split(" ")))


@dataclass(frozen=True)
class Lexicon:
    """entries: ' word ' or ' beginn' -> weight; exceptions: ' two words '; bias and slopes."""

    entries: dict[str, float]
    exceptions: frozenset[str]
    model: tuple[float, ...]

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for entry, weight in self.entries.items():
            found.add_word(entry, (entry, weight))
        for phrase in self.exceptions:
            found.add_word(phrase, (phrase, None))
        if len(found):
            found.make_automaton()
        return found


def matches(automaton: ahocorasick.Automaton, folded: str) -> list[tuple[str, float]]:
    """The heaviest entry at each place, without those inside an exception phrase."""
    if not len(automaton):
        return []
    places: dict[int, tuple[str, float]] = {}
    excused: list[tuple[int, int]] = []
    bare = without_accents(folded)
    for text in (folded,) if bare == folded else (folded, bare):
        for end, (entry, weight) in automaton.iter(text):
            begin = end - len(entry) + 1
            if weight is None:
                excused.append((begin, end))
            elif begin not in places or weight > places[begin][1]:
                places[begin] = (entry, weight)
    if excused:
        for begin, end in excused:
            for place in [p for p in places if begin <= p < end]:
                del places[place]
    return list(places.values())


def features(found: list[float], folded: str) -> tuple[float, float, float]:
    """The heaviest weight, the sum of weights, and the sum by length of the text."""
    if not found:
        return 0.0, 0.0, 0.0
    total = sum(found)
    return max(found), math.log1p(total), total / math.sqrt(folded.count(" "))


def score_of(lexicon: Lexicon, values: Iterable[float]) -> float:
    z = lexicon.model[0] + sum(a * b for a, b in zip(lexicon.model[1:], values))
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _candidates(folded: str) -> set[str]:
    found = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in PREFIXES if len(word) > n)
    return found


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Lexicon:
    """A lexicon from the labelled documents that are not held out.

    Candidates are counted on the executors; the driver gets those entries that
    pass the limits, `MAX_ENTRIES` at most. Labels without a document, documents
    without a text and null labels teach nothing. With repeated rows each counts.
    Without any label of one kind the lexicon is empty and every score is alike.
    """
    # Bounded by `max_rows` narrow rows, so it can be broadcast whatever the tables hold.
    chosen = (
        labels.where(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .select("doc_id", "toxic")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_rows)
    )
    rows = cut_lineage(
        docs.where("text is not null").select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .withColumn("h", F.xxhash64("text")).repartition(TRAINING_PARTS, "h")
        .dropDuplicates(["h", "toxic"]).select("text", "toxic")
    )

    def count():
        def step(batch):
            kinds = batch.column(batch.schema.get_field_index("toxic")).to_pylist()
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(texts_of(batch), kinds):
                for c in _candidates(fold(text.decode())):
                    counts.setdefault(c, [0, 0])[toxic > 0] += 1
                counts.setdefault("", [0, 0])[toxic > 0] += 1
            return {"entry": list(counts), "clean": [v[0] for v in counts.values()],
                    "toxic": [v[1] for v in counts.values()]}
        return step

    schema = "entry string, clean long, toxic long"
    counted = (
        map_batches(rows.select("text", "toxic"), schema, count)
        .groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where((F.col("toxic") >= MIN_DOCUMENTS) | (F.col("entry") == ""))
    )
    # The most toxic beginnings and words; far more than any real lexicon has.
    top = counted.orderBy((F.col("entry") == "").desc(), ((F.col("toxic") + 1) / (F.col("clean") + 1)).desc(),
                          F.col("toxic").desc(), "entry").limit(MAX_ENTRIES).collect()
    if not top or not (top[0].toxic and top[0].clean):
        return Lexicon({}, frozenset(), (0.0, 0.0, 0.0, 0.0))
    clean, toxic = top[0].clean, top[0].toxic
    rate = {
        r.entry: ((r.toxic + 0.5) / (toxic + 1), (r.clean + 0.5) / (clean + 1)) for r in top[1:]
    }
    strong = {e: math.log(t / c) for e, (t, c) in rate.items() if t / c >= MIN_LIFT}
    entries = _pruned(strong, {r.entry: r.toxic for r in top[1:]})
    return _fitted(rows, entries)


def _pruned(strong: dict[str, float], support: dict[str, int]) -> dict[str, float]:
    """One entry for each stem: the longest beginning that all its forms share."""
    shared = dict(strong)
    for entry in sorted(strong, key=len, reverse=True):
        for n in range(4, len(entry)):
            shorter = entry[:n]
            if shorter in shared and support[entry] >= 0.9 * support[shorter]:
                del shared[shorter]
    kept = dict(shared)
    for entry in sorted(shared, key=len):
        if any(entry[:n] in kept and kept[entry[:n]] >= shared[entry] - 0.7
               for n in range(4, len(entry))):
            del kept[entry]
    return kept


def _fitted(rows: DataFrame, entries: dict[str, float]) -> Lexicon:
    """Exception phrases and the logistic model, from the matches in the training rows."""
    bare = Lexicon(entries, frozenset(), ())

    def phrases():
        automaton = bare.automaton()

        def step(batch):
            kinds = batch.column(batch.schema.get_field_index("toxic")).to_pylist()
            out: dict[tuple[str, int], int] = {}
            for text, toxic in zip(texts_of(batch), kinds):
                folded = fold(text.decode())
                if not len(automaton):
                    break
                seen = set()
                for end, (entry, _) in automaton.iter(folded):
                    begin = end - len(entry) + 1
                    stop = folded.find(" ", begin + 1)
                    after = folded.find(" ", stop + 1)
                    before = folded.rfind(" ", 0, begin) if begin else -1
                    if after > 0:
                        seen.add(folded[begin : after + 1])
                    if before >= 0:
                        seen.add(folded[before : stop + 1])
                for phrase in seen:
                    out[phrase, int(toxic > 0)] = out.get((phrase, int(toxic > 0)), 0) + 1
            return {"phrase": [p for p, _ in out], "toxic": [t for _, t in out],
                    "n": list(out.values())}
        return step

    schema = "phrase string, toxic long, n long"
    excused = (
        map_batches(rows.select("text", "toxic"), schema, phrases)
        .groupBy("phrase")
        .agg(F.sum(F.col("n") * (1 - F.col("toxic"))).alias("clean"),
             F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
        .where(f"clean >= {MIN_DOCUMENTS} and toxic * 4 <= clean")
        .orderBy(F.col("clean").desc(), "phrase").limit(MAX_ENTRIES).collect()
    )
    lexicon = Lexicon(entries, frozenset(r.phrase for r in excused), ())

    def measure():
        automaton = lexicon.automaton()

        def step(batch):
            kinds = batch.column(batch.schema.get_field_index("toxic")).to_pylist()
            folded = [fold(t.decode()) for t in texts_of(batch)]
            values = [features([w for _, w in matches(automaton, f)], f) for f in folded]
            return {"x": [list(v) for v in values], "y": [float(k > 0) for k in kinds]}
        return step

    points = map_batches(
        rows.select("text", "toxic"), "x array<double>, y double", measure
    ).collect()
    x = np.array([[1.0, *p.x] for p in points])
    y = np.array([p.y for p in points])
    return Lexicon(entries, lexicon.exceptions, tuple(_logistic(x, y)))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> list[float]:
    """Newton's method with a little shrinkage, so that separable classes stay finite."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty @ w
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, held_out, score, predicted and n_matches of every document. Map-only.

    Only the text is looked at. Null and empty texts have no match and get the
    score of such a text.
    """

    def make():
        automaton = lexicon.automaton()

        def step(batch):
            folded = [fold(t.decode()) for t in texts_of(batch)]
            found = [[w for _, w in matches(automaton, f)] for f in folded]
            scores = [score_of(lexicon, features(w, f)) for w, f in zip(found, folded)]
            return {
                "doc_id": batch.column(batch.schema.get_field_index("doc_id")),
                "held_out": batch.column(batch.schema.get_field_index("held_out")),
                "score": scores,
                "predicted": [int(s >= 0.5) for s in scores],
                "n_matches": [len(f) for f in found],
            }
        return step

    schema = "doc_id long, held_out boolean, score double, predicted int, n_matches int"
    return map_batches(
        docs.select("doc_id", held_out().alias("held_out"), "text"), schema, make
    )
