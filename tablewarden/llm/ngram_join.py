"""Similarity join of documents by their sets of word 5-grams.

A document's set is ordered by one order for all documents: frequent shingles
last, else by hash. Two similar documents share one of the first quarter of
shingles in that order, so only those enter the inverted lists. Any such order is
right; which shingles count as frequent only decides how long the lists become.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.context import cut_lineage, lookup_join, settled, small_or_shuffled
from tablewarden.llm.overlap import link_lists, prefix_length
from tablewarden.llm.tables import map_batches, text_slices, texts_of
from tablewarden.llm.words import scan, sequence_hash, shingle_set

WIDTH = 5
PERCENT = 75
#: A shingle is frequent if the batches that hold it twice or more hold it so often together.
FREQUENT = 8
#: So many frequent shingles at most are set apart, the most frequent (8 MB).
MAX_FREQUENT = 1_000_000
#: Bytes of text whose sets are made together, and shingles that are counted together.
SET_BYTES = 2 << 20
COUNT_SHINGLES = 4_000_000
#: Ids of copies are broadcast up to this number (16 MB), else joined by a shuffle.
MAX_BROADCAST_IDS = 1_000_000


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Some rows of a batch after others, and the shingle set of each text."""
    for part in text_slices(batch, SET_BYTES):
        words = scan(texts_of(part), fold=True)
        yield part, [shingle_set(words.hashes[i:j], WIDTH) for i, j in words.slices()]


def _repeated(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The shingles in two or more of the sets, and in how many."""
    values = np.concatenate(sets)
    values.sort()
    again, more = np.unique(values[1:][values[1:] == values[:-1]], return_counts=True)
    return again, more + 1


def _key(items: np.ndarray) -> int:
    """The identity of a set: a signed 64-bit hash of its items and their number."""
    return sequence_hash(items) - (1 << 63) if len(items) else 0


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _described(docs: DataFrame) -> DataFrame:
    """doc_id, n and key of each row; and as rows of their own (`hot`) the shingles that
    a batch holds twice or more, with their number."""

    def make():
        def step(batch):
            seen, size = [], 0

            def counted():
                hot, number = _repeated(seen)
                seen.clear()
                return {"doc_id": pa.nulls(len(hot), pa.int64()), "n": number, "key": _signed(hot),
                        "hot": np.ones(len(hot), dtype=bool)}

            for part, sets in _sets(batch):
                yield {
                    "doc_id": part.column(part.schema.get_field_index("doc_id")),
                    "n": [len(items) for items in sets],
                    "key": [_key(items) for items in sets],
                    "hot": np.zeros(len(sets), dtype=bool),
                }
                seen += sets
                size += sum(map(len, sets))
                if size > COUNT_SHINGLES:
                    yield counted()
                    size = 0
            if seen:
                yield counted()
        return step

    return cut_lineage(
        map_batches(docs.select("doc_id", "text"), "doc_id long, n long, key long, hot boolean", make)
    )


def _postings(docs: DataFrame, frequent: np.ndarray, copies: DataFrame) -> DataFrame:
    """(g, node, n): the first shingles of each distinct set."""

    def make():
        def step(batch):
            for part, sets in _sets(batch):
                out = {"doc_id": part.column(part.schema.get_field_index("doc_id")),
                       "node": [], "n": [], "first": []}
                for items in sets:
                    if len(items) and len(frequent):
                        at = np.searchsorted(frequent, items)
                        at[at == len(frequent)] = 0
                        often = frequent[at] == items
                        items_in_order = np.concatenate([items[~often], items[often]])
                    else:
                        items_in_order = items
                    length = prefix_length(len(items), PERCENT) if len(items) else 0
                    out["node"].append(_key(items))
                    out["n"].append(len(items))
                    out["first"].append(_signed(items_in_order[:length]))
                yield out
        return step

    rows = map_batches(
        docs.select("doc_id", "text"), "doc_id long, node long, n long, first array<long>", make
    )
    return cut_lineage(
        rows.join(copies, rows.doc_id.eqNullSafe(copies.copy) & (rows.node == copies.key), "left_anti")
        .select("first", "node", "n")
    ).select(F.explode("first").alias("g"), "node", "n")


def _items_of(docs: DataFrame, holders: DataFrame):
    """For `link_lists`: the sets of the asked nodes, from one holder of each."""

    def make():
        def step(batch):
            for _, sets in _sets(batch):
                yield {"node": [_key(items) for items in sets],
                       "items": [items.astype("<u8").tobytes() for items in sets]}
        return step

    def items_of(nodes: DataFrame) -> DataFrame:
        ids = small_or_shuffled(
            nodes.join(holders, nodes.node == holders.key).select(F.col("holder").alias("h")).distinct(),
            MAX_BROADCAST_IDS,
        )
        texts = docs.join(ids, docs.doc_id.eqNullSafe(ids.h), "left_semi").select("text")
        found = map_batches(texts, "node long, items binary", make)
        return found.join(small_or_shuffled(nodes, MAX_BROADCAST_IDS), "node", "left_semi")

    return items_of


def join_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    The component is the least doc_id that can be reached by links (Jaccard of
    0.75 or more), a row's own if it has none. Equal sets are one node, so any
    number of copies costs as much as one. Empty and null texts have no shingle
    and no link. Rows without an id take part; their component is that of the
    others, or null.
    """
    described = _described(docs)
    rows = described.where("not hot").select("doc_id", "n", "key")
    frequent = np.sort(
        described.where("hot").groupBy("key").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= FREQUENT).orderBy(F.col("n").desc(), "key").limit(MAX_FREQUENT)
        .select("key").toArrow().column("key").to_numpy().view(np.uint64)
    )
    holders = cut_lineage(
        rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("holder"))
    )
    copies = small_or_shuffled(
        cut_lineage(
            rows.where("n > 0").join(holders, "key")
            .where(~F.col("doc_id").eqNullSafe(F.col("holder")))
            .select(F.col("doc_id").alias("copy"), "key").distinct()
        ),
        MAX_BROADCAST_IDS,
    )
    linked = settled(docs.sparkSession, lambda: link_lists(
        _postings(docs, frequent, copies), _items_of(docs, holders), PERCENT, prefixes=True
    ))
    grouped = cut_lineage(
        holders.join(linked, holders.key == linked.node, "left")
        .select("key", "holder", F.coalesce("component", "key").alias("c"))
    )
    least = grouped.groupBy("c").agg(F.min("holder").alias("least"))
    named = grouped.join(least, "c").select("key", "least")
    found = lookup_join(rows.where("n > 0"), named, ["key"], "left").unionByName(
        rows.where("n = 0").withColumn("least", F.col("doc_id"))
    )
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The documents with the least id of each group, and all without an id; columns as they were.

    Repeated rows of one id are one document, of which one row stays.
    """
    verdicts = settled(docs.sparkSession, lambda: join_documents(docs))
    stay = verdicts.where("doc_id is not null and doc_id = component_id").select("doc_id")
    gone = verdicts.where("doc_id is not null").select("doc_id").distinct().join(
        stay.distinct(), "doc_id", "left_anti"
    )
    kept = docs.join(small_or_shuffled(cut_lineage(gone), MAX_BROADCAST_IDS), "doc_id", "left_anti") \
        .select(*(docs[c] for c in docs.columns))
    repeated = cut_lineage(stay.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if repeated.limit(1).count() == 0:
        return kept
    few = small_or_shuffled(repeated, MAX_BROADCAST_IDS)
    return kept.join(few, "doc_id", "left_anti").select(*docs.columns).unionByName(
        kept.join(few, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    )
