"""Merkle trees over the sections and paragraphs of a text.

A paragraph is a line. Its leaves are runs of words that end where the words
themselves say so, so that an edit changes only the leaves it touches. Long runs
without a space are cut in the same way at a few code points. No leaf is longer
than a bound counted from the cut before it, whatever its words are. A section
is a run of paragraphs, ended in the same way. Each node is a hash of its
children, the root one of the sections: equal roots mean equal texts, and where
roots differ, the branches that differ lead to the edit.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.context import ship_package, small_or_shuffled, cut_lineage
from tablewarden.llm.order import pieces_of, split_points
from tablewarden.llm.tables import map_batches, pa_schema

LEAF_WORDS = 8  # on average
SECTION_PARAGRAPHS = 8
LONGEST_LEAF_WORDS = 16
#: Longer words, with their spaces, are cut at code points.
LONG_WORD = 48
LEAF_CODES = 32  # on average
LONGEST_LEAF_CODES = 64
CODE_WINDOW = 4
_WORD = re.compile(r" *[^ ]+ *| +")

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_sections int, n_paragraphs int, n_leaves int, "
    "first_edited_paragraph int"
)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


@dataclass
class Tree:
    root: str
    sections: list[bytes]
    paragraphs: list[bytes]
    leaves: list[bytes]


def _ends_leaf(text: str, one_in: int) -> bool:
    return zlib.crc32(text.encode()) % one_in == 0


def _leaf_ends(line: str) -> Iterator[int]:
    """Where the leaves of a line end, but for the last."""
    count = 0  # words since the last cut
    for m in _WORD.finditer(line):
        begin, end = m.span()
        if end - begin <= LONG_WORD:
            count += 1
            # A word ends a leaf by its own letters, whatever stands around it.
            if count == LONGEST_LEAF_WORDS or _ends_leaf(m[0].strip(" "), LEAF_WORDS):
                yield end
                count = 0
            continue
        if count:
            yield begin
        last = begin
        for k in range(begin + CODE_WINDOW, end):
            if k - last == LONGEST_LEAF_CODES or _ends_leaf(line[k - CODE_WINDOW : k], LEAF_CODES):
                yield k
                last = k
        yield end
        count = 0


def build(text: str) -> Tree:
    """The tree of a text. The empty text has one empty paragraph."""
    sections: list[bytes] = []
    paragraphs: list[bytes] = []
    leaves: list[bytes] = []
    open_section: list[bytes] = []
    for line in text.split("\n"):
        own: list[bytes] = []
        begin = 0
        for end in _leaf_ends(line):
            own.append(_digest(line[begin:end].encode()))
            begin = end
        if begin < len(line) or not own:
            own.append(_digest(line[begin:].encode()))
        leaves += own
        paragraph = _digest(b"".join(own))
        paragraphs.append(paragraph)
        open_section.append(paragraph)
        if paragraph[0] % SECTION_PARAGRAPHS == 0:
            sections.append(_digest(b"".join(open_section)))
            open_section = []
    if open_section:
        sections.append(_digest(b"".join(open_section)))
    root = hashlib.sha256(b"".join(sections)).hexdigest()
    return Tree(root, sections, paragraphs, leaves)


def likeness(a: Tree, b: Tree) -> float:
    """The share of leaves that two trees have in common; 1 if and only if the roots are equal."""
    if a.root == b.root:
        return 1.0
    common = (Counter(a.leaves) & Counter(b.leaves)).total()
    return min(2.0 * common / (len(a.leaves) + len(b.leaves)), 1.0 - 1e-9)


def first_difference(a: Tree, b: Tree) -> int | None:
    """The first paragraph that differs, found by walking down from the roots."""
    if a.root == b.root:
        return None
    for i, (x, y) in enumerate(zip(a.paragraphs, b.paragraphs)):
        if x != y:
            return i
    return min(len(a.paragraphs), len(b.paragraphs))


def edited(text: str, following: str) -> str:
    """`text` with its last quarter replaced by as much of the beginning of the next one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Trees of each text, of its edited text, and how alike they and the next text are.

    The next document is the one after it by (doc_id, text), the first after the
    last. Texts are shuffled once, into pieces by id; the first row of each piece
    also goes to the piece before it. Null texts are empty; rows without an id
    come first. A document alone is its own next one.
    """
    spark = docs.sparkSession
    points = split_points(docs)

    def cut():
        def step(batch):
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            return {"piece": pieces_of(ids, points), "doc_id": ids,
                    "text": batch.column(batch.schema.get_field_index("text"))}
        return step

    rows = map_batches(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")),
                       "piece int, doc_id long, text string", cut)
    # The first document of each piece by number: as many rows as there are pieces.
    ids = map_batches(docs.select("doc_id", F.lit("").alias("text")),
                      "piece int, doc_id long, text string", cut)
    heads = sorted(
        (r.piece, r.doc_id) for r in
        ids.groupBy("piece").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("m"))
        .select("piece", "m.doc_id").collect()
    ) if docs.limit(1).count() else []
    used = [p for p, _ in heads]
    # A piece's first row follows the last row of the piece before; the very first closes the circle.
    seams = spark.createDataFrame(
        [(p, d, used[k - 1]) for k, (p, d) in enumerate(heads)],
        "piece int, head long, before int",
    )
    marked = rows.join(
        F.broadcast(seams.withColumnRenamed("piece", "p")),
        (F.col("piece") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("head")), "left",
    )
    doubled = marked.select(
        F.explode(
            F.when(
                F.col("before").isNotNull(),
                F.array(F.struct(F.col("piece").alias("at"), F.lit(False).alias("seam")),
                        F.struct(F.col("before").alias("at"), F.lit(True).alias("seam"))),
            ).otherwise(F.array(F.struct(F.col("piece").alias("at"), F.lit(False).alias("seam"))))
        ).alias("x"), "doc_id", "text",
    ).select("x.at", "x.seam", "doc_id", "text")
    ordered = doubled.repartition("at").sortWithinPartitions("at", "seam", "doc_id", "text")
    ship_package(spark)
    result = T.StructType.fromDDL(RESULT)
    schema = pa_schema(result)
    return ordered.mapInArrow(lambda batches: _compare(batches, schema), result)


def _compare(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in order -> results; of the rows beyond a seam only the first counts."""
    held = None  # (piece, doc_id, text, tree) that waits for the next row
    for batch in batches:
        out: list[tuple] = []
        for at, seam, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            tree = None
            if held and held[0] == at:
                tree = build(text)
                out.append(_row(*held[1:], text, tree))
                held = None
            if not seam:
                held = at, doc_id, text, tree or build(text)
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)], schema=schema
            )


def _row(doc_id, text: str, tree: Tree, following: str, next_tree: Tree) -> tuple:
    changed = edited(text, following)
    other = build(changed)
    return (
        doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), tree.root, other.root,
        likeness(tree, other), likeness(tree, next_tree), len(tree.sections), len(tree.paragraphs),
        len(tree.leaves), first_difference(tree, other),
    )
