"""Language identification by the nearest of several centroids for each language.

A text is a vector of hashed character n-grams (one to three letters, within
words), weighted by log counts and inverse document frequency and brought to
length one. Each language has several centroids, found by clustering the vectors
of its training documents. The language of the centroid with the largest cosine
is taken. A text whose cosine is below what nearly all documents of that language
reach is rejected as too far from everything known. What they reach is measured on
training documents that are left out of the clustering, and for a language of few
documents also on what those of other languages reach if only as few are clustered.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewarden.context import cut_lineage
from tablewarden.llm.tables import held_out, map_batches, texts_of
from tablewarden.llm.words import mix

#: At most so many training documents of each language, those with the least hash of their id.
#: (Up to a thousand, Spark ranks within each task first and never gathers a language.)
MAX_ROWS_PER_LANGUAGE = 1_000
#: At most so many languages, the most frequent; a bound for the model's size.
MAX_LANGUAGES = 200
CENTROIDS = 4
DIMENSIONS = 1 << 13
REJECT_QUANTILE = 0.002
#: Rejection starts at this share of the cosine that the quantile gives.
REJECT_SHARE = 0.8
FOLDS = 5
#: Below so many distinct training documents the quantile of a language is not its own alone.
FEW = 256

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_letter = np.zeros(0x110000, dtype=np.uint32)
_known = np.zeros(0x110000, dtype=bool)


def _letters_of(codes: np.ndarray) -> np.ndarray:
    """Lower-case letters by code point; 0 for all else. Worked out once for each code point."""
    new = codes[~_known[codes]]
    for code in np.unique(new).tolist():
        char = chr(code)
        lower = char.lower()
        _letter[code] = ord(lower[0]) if char.isalpha() else 0
        _known[code] = True
    return _letter[codes]


def grams(text: str, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """Counts of hashed n-grams; None if the text has no letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    if not len(codes):
        return None
    letters = _letters_of(codes)
    if not letters.any():
        return None
    x = np.concatenate([[0], letters, [0]]).astype(np.uint64)
    keep = (x[1:] > 0) | (x[:-1] > 0)
    counts = np.zeros(dimensions, dtype=np.float32)
    two = (x[:-1] * _A + x[1:] * _B)[keep]
    middle = x[1:-1] > 0
    one = x[1:-1][middle]
    three = ((x[:-2] * _A + x[1:-1]) * _B + x[2:] * _A)[middle]
    for kind, values in enumerate((one, two, three)):
        slot = mix(values + np.uint64(kind)) % np.uint64(dimensions)
        counts += np.bincount(slot.astype(np.int64), minlength=dimensions).astype(np.float32)
    return counts


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length one."""
    weighted = np.log1p(counts) * idf
    norm = np.linalg.norm(weighted, axis=1, keepdims=True)
    return weighted / np.maximum(norm, 1e-12)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    centroids: np.ndarray  # one row for each centroid
    owner: np.ndarray  # the language of each centroid
    floor: np.ndarray  # by language, the least cosine that is accepted


def _clustered(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; begins with rows far from each other, so it has no chance in it."""
    seeds = [int(np.argmax(rows @ rows.mean(axis=0)))]
    nearest = rows @ rows[seeds[0]]
    while len(seeds) < min(k, len(rows)):
        seeds.append(int(np.argsort(nearest, kind="stable")[len(rows) // 50]))
        nearest = np.maximum(nearest, rows @ rows[seeds[-1]])
    centres = rows[seeds]
    for _ in range(rounds):
        own = np.argmax(rows @ centres.T, axis=1)
        sums = np.stack([
            rows[own == c].sum(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))
        ])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def _left_out(counts: np.ndarray, train: np.ndarray, others: np.ndarray, n_others: int) -> np.ndarray:
    """Cosines of the rows outside `train` to centroids of those inside.

    Rows left out do not count in the document frequencies either; `others` is how
    many of `n_others` documents of other languages have each n-gram.
    """
    present = others + (counts[train] > 0).sum(axis=0)
    x = vectors(counts, _idf(present, n_others + int(train.sum())))
    return (x[~train] @ _clustered(x[train], CENTROIDS).T).max(axis=1)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _idf(present: np.ndarray, n: int) -> np.ndarray:
    return (np.log((1 + n) / (1 + present)) + 1).astype(np.float32)


def _reach(counts: np.ndarray, others: np.ndarray, n_others: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Cosines of distinct documents left out in turn, and by k of those left out if 2^k are clustered."""
    n = len(counts)
    own = [np.zeros(0)]
    if n > 1:
        fold = np.arange(n) % min(FOLDS, n)
        own = [_left_out(counts, fold != f, others, n_others) for f in range(min(FOLDS, n))]
    few = {}
    for k in range(FEW.bit_length() - 1):
        if 1 << k < n:
            few[k] = _left_out(counts, np.arange(n) < 1 << k, others, n_others)
    return np.concatenate(own), few


def _floors(sizes: list[int], reached: list[tuple[np.ndarray, dict[int, np.ndarray]]]) -> np.ndarray:
    """By language, the least cosine that is accepted; 0 where nothing could be measured."""
    floor = []
    for n, (own, _) in zip(sizes, reached):
        measured = [own]
        if n < FEW:
            measured += [few[n.bit_length() - 1] for _, few in reached if n.bit_length() - 1 in few]
        floor.append(REJECT_SHARE * min(
            (float(np.quantile(x, REJECT_QUANTILE)) for x in measured if len(x)), default=0.0
        ))
    return np.array(floor)


def learn(docs: DataFrame, max_rows: int = MAX_ROWS_PER_LANGUAGE) -> Model:
    """Centroids from documents that are not held out and have a language.

    The sample of each language is bounded, so the model is fitted on the driver.
    Texts without a letter teach nothing.
    """
    labelled = docs.where(
        ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    )
    known = [
        r.lang for r in labelled.groupBy("lang").count()
        .orderBy(F.col("count").desc(), "lang").limit(MAX_LANGUAGES).collect()
    ]
    if not known:
        return Model((), np.ones(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS), np.float32),
                     np.zeros(0, np.int64), np.zeros(0))
    # The least hashes of a language, ranked without the texts; each task keeps its own first.
    ids = labelled.where(F.col("lang").isin(known)).select("doc_id", "lang")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = ids.withColumn("r", F.row_number().over(first)).where(F.col("r") <= max_rows)
    sample = cut_lineage(
        labelled.select("doc_id", "lang", "text")
        .join(F.broadcast(chosen.select("doc_id", "lang").distinct()), ["doc_id", "lang"], "left_semi")
    )

    def count():
        def step(batch):
            out = {"lang": [], "slots": [], "counts": []}
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            for lang, text in zip(langs, texts_of(batch)):
                x = grams(text.decode())
                if x is not None:
                    at = np.flatnonzero(x)
                    out["lang"].append(lang)
                    out["slots"].append(at.astype(np.int32).tobytes())
                    out["counts"].append(x[at].tobytes())
            return out
        return step

    rows = map_batches(
        sample.select("lang", "text"), "lang string, slots binary, counts binary", count
    ).collect()
    # In an order of their own, so that the documents left out do not depend on the tasks.
    rows = [
        (r.lang, np.frombuffer(r.slots, np.int32), np.frombuffer(r.counts, np.float32))
        for r in sorted(rows, key=lambda r: (r.lang, _digest(r.slots + r.counts), r.slots, r.counts))
    ]
    languages = tuple(sorted({lang for lang, _, _ in rows}))
    present = np.zeros(DIMENSIONS)
    for _, slots, _ in rows:
        present[slots] += 1
    idf = _idf(present, len(rows))
    centroids, owner, sizes, reached = [], [], [], []
    for number, lang in enumerate(languages):
        own = [r[1:] for r in rows if r[0] == lang]
        counts = np.zeros((len(own), DIMENSIONS), dtype=np.float32)
        for i, (slots, values) in enumerate(own):
            counts[i, slots] = values
        x = vectors(counts, idf)
        centres = _clustered(x, CENTROIDS)
        centroids.append(centres)
        owner += [number] * len(centres)
        # Copies of a document would vouch for each other.
        _, first = np.unique([_digest(s.tobytes() + v.tobytes()) for s, v in own], return_index=True)
        distinct = counts[np.sort(first)]
        sizes.append(len(distinct))
        reached.append(_reach(distinct, present - (counts > 0).sum(axis=0), len(rows) - len(own)))
    return Model(languages, idf, np.concatenate(centroids).astype(np.float32), np.array(owner),
                 _floors(sizes, reached))


def _nearest(model: Model, texts: list[bytes]) -> tuple[list, list, list, list]:
    """Language, score, cosine and rejection of each text."""
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    cosines, rejected = [0.0] * len(texts), [True] * len(texts)
    if not model.languages:
        return langs, scores, cosines, rejected
    for begin in range(0, len(texts), 256):
        places, rows = [], []
        for i in range(begin, min(begin + 256, len(texts))):
            x = grams(texts[i].decode())
            if x is not None:
                places.append(i)
                rows.append(x)
        if not rows:
            continue
        near = vectors(np.stack(rows), model.idf) @ model.centroids.T
        best = np.stack(
            [near[:, model.owner == k].max(axis=1) for k in range(len(model.languages))], axis=1
        )
        top = best.argmax(axis=1)
        # How far the nearest language stands out from the others.
        share = np.exp(20 * (best - best.max(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        for j, i in enumerate(places):
            langs[i] = model.languages[top[j]]
            scores[i] = float(min(1.0, max(0.0, share[j, top[j]])))
            cosines[i] = float(best[j, top[j]])
            rejected[i] = bool(best[j, top[j]] < model.floor[top[j]])
    return langs, scores, cosines, rejected


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cosine and rejected of every document. Map-only.

    Null texts and texts without a letter are `und`, with score 0, and rejected.
    Only the text is looked at; ties go to the language that sorts first.
    """

    def make():
        def step(batch):
            langs, scores, cosines, rejected = _nearest(model, texts_of(batch))
            return {
                "doc_id": batch.column(batch.schema.get_field_index("doc_id")),
                "held_out": batch.column(batch.schema.get_field_index("held_out")),
                "lang_pred": langs, "score": scores, "cosine": cosines, "rejected": rejected,
            }
        return step

    return map_batches(
        docs.select("doc_id", held_out().alias("held_out"), "text"),
        "doc_id long, held_out boolean, lang_pred string, score double, cosine double, rejected boolean",
        make,
    )


def filter_languages(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose language is known, with their columns as they were. Map-only."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), "text")

    def make():
        def step(batch):
            rejected = _nearest(model, texts_of(batch))[3]
            return {"doc": batch.column(batch.schema.get_field_index("doc")),
                    "rejected": rejected}
        return step

    ddl = f"doc {whole.schema['doc'].dataType.simpleString()}, rejected boolean"
    return map_batches(whole, ddl, make).where("not rejected").select("doc.*")
