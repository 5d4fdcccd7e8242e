"""Packing documents into sequences of fixed length with a controlled mixture of sources.

Each source is a queue of its documents' tokens, in the order of ids. Windows of
many sequences are filled by deficit round-robin: in each window a source is
owed a fixed share, gets whole tokens, and the rest of what it is owed is carried
to the next window. What a source has been served before any window follows from
its share alone, so the deficits are carried over windows and partitions without
passing state along: each document computes its own place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tablewarden.context import cut_lineage, ship_package, small_or_shuffled
from tablewarden.llm.bpe import ByteLevelEncoder, tokenizer
from tablewarden.llm.order import pieces_of, split_points
from tablewarden.llm.tables import map_batches, pa_schema, texts_of

SEQUENCE = 1024
WINDOW_TOKENS = 64 * SEQUENCE
#: So many sources have queues of their own, the largest; all others share one queue.
MAX_QUEUES = 1_000
_FRACTION = 16

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long"
)


class Schedule:
    """Where token t of a queue comes to stand.

    `totals` are the tokens of each queue. `shares` are the proportions wanted in
    each window; by default those of the corpus, so that all queues end together.
    When a queue has run out, the others go on by their shares.
    """

    def __init__(self, totals: list[int], shares: list[float] | None = None,
                 window: int = WINDOW_TOKENS):
        self.totals = np.array(totals, dtype=np.int64)
        wanted = [float(t) for t in totals] if shares is None else [float(s) for s in shares]
        whole = sum(wanted) or 1.0
        # Owed in each window, in 1 / 2**16 of a token.
        owed = [max(1, int(np.ceil(window * w / whole * (1 << _FRACTION)))) for w in wanted]
        self.owed = np.array(owed, dtype=np.int64)
        self._windows: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}

    def served(self, window: int) -> np.ndarray:
        """Tokens that each queue has been served before a window begins."""
        return np.minimum(self.totals, (window * self.owed) >> _FRACTION)

    def _window(self, w: int) -> tuple[int, np.ndarray, np.ndarray]:
        if w not in self._windows:
            if len(self._windows) > 1_000:
                self._windows.clear()
            before, after = self.served(w), self.served(w + 1)
            turns = np.cumsum(after - before) - (after - before)
            self._windows[w] = int(before.sum()), turns, before
        return self._windows[w]

    def runs(self, queue: int, first: int, n: int) -> Iterator[tuple[int, int, int]]:
        """(place, index in the queue, length) of tokens first .. first + n that stay together."""
        owed = int(self.owed[queue])
        t, end = first, first + n
        while t < end:
            w = -(-((t + 1) << _FRACTION) // owed) - 1
            base, turns, before = self._window(w)
            stop = min(end, (w + 1) * owed >> _FRACTION)
            yield base + int(turns[queue]) + t - int(before[queue]), t, stop - t
            t = stop


def pack_documents(
    docs: DataFrame,
    path: str,
    end_id: int,
    length: int = SEQUENCE,
    window: int = WINDOW_TOKENS,
    shares: dict[str | None, float] | None = None,
    max_queues: int = MAX_QUEUES,
) -> DataFrame:
    """One row for each piece of a document: where it stands in which sequence.

    Every token, and the end id after each document, is in exactly one piece. Only
    the last sequence is not full. Null texts and sources are packed too, a null
    source as a source. Rows with equal ids are ordered by their tokens.
    `shares` gives proportions by source; a source without one gets none of its
    own until the others have run out, and so ends up last.
    """
    if docs.sparkSession is None or length < 1:
        raise ValueError("sequences need a length")
    points = split_points(docs)
    width = 2 if tokenizer(path).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4

    def encoder():
        encode = ByteLevelEncoder(path)
        end = np.array([end_id], dtype=f"<u{width}").tobytes()

        def step(batch):
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            arrays = [
                np.frombuffer(a, "<u4").astype(f"<u{width}").tobytes() + end
                for a in encode(texts_of(batch))
            ]
            return {
                "doc_id": ids, "source": batch.column(batch.schema.get_field_index("source")),
                "piece": pieces_of(ids, points), "n": [len(a) // width for a in arrays], "ids": arrays,
            }
        return step

    tokens = cut_lineage(
        map_batches(docs.select("doc_id", "source", "text"),
                    "doc_id long, source string, piece int, n long, ids binary", encoder)
    )
    # Token counts by source and piece; small queues are put together.
    counts = cut_lineage(tokens.groupBy("source", "piece").agg(F.sum("n").alias("n")))
    largest = (
        counts.groupBy("source").agg(F.sum("n").alias("n"))
        .orderBy(F.col("n").desc(), "source").limit(max_queues + 1).collect()
    )
    own = sorted((r.source for r in largest[:max_queues]), key=lambda s: (s is not None, s or ""))
    rest = len(own)
    queues = docs.sparkSession.createDataFrame(
        [(s, k) for k, s in enumerate(own)], "name string, queue int"
    )

    def queued(df: DataFrame) -> DataFrame:
        found = df.join(F.broadcast(queues), df.source.eqNullSafe(queues.name), "left")
        return found.withColumn("queue", F.coalesce("queue", F.lit(rest))).drop("name")

    before = Window.partitionBy("queue").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut_lineage(
        queued(counts).groupBy("queue", "piece").agg(F.sum("n").alias("n"))
        .select("queue", "piece", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    totals = [0] * (rest + 1)
    for r in bases.groupBy("queue").agg(F.sum("n").alias("n")).collect():
        totals[r.queue] = r.n
    wanted = None
    if shares is not None:
        wanted = [shares.get(s, 0.0) for s in own] + [0.0]
    schedule = Schedule(totals, wanted, window)

    placed = (
        queued(tokens).join(small_or_shuffled(bases.drop("n")), ["queue", "piece"])
        .select("piece", "queue", "base", "doc_id", "n", "ids")
        .repartition("piece").sortWithinPartitions("piece", "queue", "doc_id", "ids")
    )
    ship_package(docs.sparkSession)
    return placed.mapInArrow(_placer(schedule, length, width), T.StructType.fromDDL(PIECES))


def _placer(schedule: Schedule, length: int, width: int):
    schema = pa_schema(T.StructType.fromDDL(PIECES))
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, taken = None, 0
        for batch in batches:
            out: list[tuple] = []
            for piece, queue, base, doc_id, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (piece, queue) != group:
                    group, taken = (piece, queue), base
                ids = np.frombuffer(ids, f"<u{width}").astype("<u4")
                for place, t, size in schedule.runs(queue, taken, n):
                    while size:
                        offset = place % length
                        part = min(size, length - offset)
                        start = t - taken
                        crc = zlib.crc32(ids[start : start + part])
                        out.append((doc_id, start, part, crc, n, place // length, offset))
                        place, t, size = place + part, t + part, size - part
                taken += n
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)], names=names
                )

    return run
