"""Repair of conversation structure by generalised LR parsing.

The roles of a conversation should read `(system? (user assistant)+)?`. Rows are deleted,
given another role or kept, and empty rows inserted, at the least cost. The parser holds a
graph-structured stack: at each row one node for each state on top, with edges to what may
lie below. Paths that reach an equal top merge, and the least (cost, audit) stays. That is
safe: with equal cost neither audit begins with the other, because both have used up the
same rows and an insert costs something, so what follows cannot turn their order round.

A conversation is cut into blocks of turns, so that one of any length is parsed by many
tasks: each block is parsed from every top it may begin with, and a fold over the small
results picks the cheapest way through.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.context import cut_lineage, ship_package, small_or_shuffled
from tablewarden.llm.tables import pa_schema

TURNS_PER_BLOCK = 1_000
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
SPACES = " \t\n\x0b\x0c\r"
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

# LR tables of  C -> S T | ;  S -> s | ;  T -> T P | P ;  P -> u a
SHIFT = {(0, "s"): 1, (2, "u"): 4, (3, "u"): 4, (4, "a"): 5}
REDUCE = {1: ("S", 1), 5: ("P", 2), 6: ("T", 1), 7: ("T", 2)}
BEFORE = {(0, "u"): ("S", 0)}  # reductions that need the next symbol
GOTO = {(0, "S"): 2, (2, "T"): 3, (2, "P"): 6, (3, "P"): 7}
ACCEPTS = (0, 3)
#: Tops that a block may begin with.
TOPS = (0, 2, 3, 4)


class Node(NamedTuple):
    """A top of the stack and the nodes that may lie below it."""

    state: int
    below: frozenset[Node] = frozenset()


def _reduce(node: Node, rule: tuple[str, int]) -> list[Node]:
    """All results of taking the right side off the stack and going on from what is below."""
    name, size = rule
    bases = {node}
    for _ in range(size):
        bases = {below for base in bases for below in base.below}
    return [Node(GOTO[base.state, name], frozenset([base])) for base in bases]


@cache
def shifted(node: Node, symbol: str) -> tuple[Node, ...]:
    """The tops after reading a symbol and all reductions that then are due; none if it may not follow."""
    work = [node]
    if (node.state, symbol) in BEFORE:
        work += _reduce(node, BEFORE[node.state, symbol])
    work = [Node(SHIFT[n.state, symbol], frozenset([n])) for n in work if (n.state, symbol) in SHIFT]
    done: dict[int, set[Node]] = {}
    while work:
        top = work.pop()
        if top.state in REDUCE:
            work += _reduce(top, REDUCE[top.state])
        else:
            done.setdefault(top.state, set()).update(top.below)
    return tuple(Node(state, frozenset(below)) for state, below in done.items())


@cache
def entry(state: int) -> Node:
    """The top with all that may lie below it at the beginning of a block."""
    start = Node(0)
    ready = Node(2, frozenset([start]))
    turns = Node(3, frozenset([ready]))
    return {0: start, 2: ready, 3: turns, 4: Node(4, frozenset([ready, turns]))}[state]


Tops = dict[int, tuple[int, str, Node]]


def _merge(tops: Tops, cost: int, audit: str, node: Node) -> bool:
    held = tops.get(node.state)
    if held is None:
        tops[node.state] = (cost, audit, node)
        return True
    least = min(held[:2], (cost, audit))
    both = node if node == held[2] else Node(node.state, node.below | held[2].below)
    tops[node.state] = (*least, both)
    return least != held[:2]


def with_inserts(tops: Tops) -> Tops:
    """Also the tops that are reached by inserting rows."""
    out, work = dict(tops), list(tops)
    while work:
        cost, audit, node = out[work.pop()]
        for symbol in NAMES:
            for after in shifted(node, symbol):
                if _merge(out, cost + INSERT, audit + "I", after):
                    work.append(after.state)
    return out


def read(tops: Tops, initial: str, fault: str) -> Tops:
    """All tops after one row."""
    out: Tops = {}
    extra = TRUNCATED if fault == "truncated" else 0
    for cost, audit, node in with_inserts(tops).values():
        _merge(out, cost + DELETE, audit + "D", node)
        if fault in ("blank", "duplicate"):
            continue
        for after in shifted(node, initial):
            _merge(out, cost + KEEP + extra, audit + "K", after)
        for symbol in NAMES:
            for after in shifted(node, symbol):
                _merge(out, cost + REROLE + extra, audit + "R", after)
    return out


def apply_audit(state: int, audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) of a block that begins with this top."""
    node = entry(state)
    for edit in audit:
        role, text = next(rows) if edit != "I" else ("", "")
        if edit == "D":
            continue
        if edit == "K":
            symbol = role[:1]
        else:
            symbol = next(s for s in NAMES if shifted(node, s))
            role = NAMES[symbol]
        node = shifted(node, symbol)[0]
        yield role, text


def _fault(role: str, text: str, seen: bool) -> str:
    said = text.rstrip(SPACES)
    if not said:
        return "blank"
    if seen:
        return "duplicate"
    return "" if said[-1] in ".!?" else "truncated"


def _stream(df: DataFrame, ddl: str, make) -> DataFrame:
    """A generator of rows over the rows of each task, in order."""
    ship_package(df.sparkSession)
    schema = T.StructType.fromDDL(ddl)
    arrow = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for row in make(rows):
            held.append(row)
            size += 64 + sum(len(v) for v in row if isinstance(v, str))
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def damage(conversations: DataFrame) -> DataFrame:
    """conv, conv_id, turn, role and text of the rows that damage leaves, in no order.

    `conv` is conv_id as text, never null. The CRC of `conv_id:turn` decides what becomes
    of a row; nulls count as one space.
    """
    space = F.lit(" ")
    spelt = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    kind = F.crc32(spelt.cast("binary")) % 20
    text = F.coalesce("text", space)
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), space).alias("conv"), "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)))
        .alias("copy"),
    ).drop("copy")


def blocks_of(rows: DataFrame, turns: int = TURNS_PER_BLOCK) -> DataFrame:
    """`rows` (conv, turn, role, text; turns may be null) with their block, whether it is all
    of the conversation, and whether an earlier block has the same role and text."""
    cut = rows.select(
        "conv", F.coalesce(F.floor(F.col("turn") / F.lit(turns)), F.lit(-(1 << 62))).alias("block"),
        "turn", "role", "text",
    )
    spans = cut.groupBy("conv").agg(F.min("block").alias("a"), F.max("block").alias("b"))
    long = cut_lineage(spans.where("a < b").select("conv"))
    if long.limit(1).count() == 0:
        return cut.select("*", F.lit(True).alias("whole"), F.lit(False).alias("before"))
    marked = cut.join(
        small_or_shuffled(long.withColumn("long", F.lit(True))), "conv", "left"
    ).withColumn("whole", F.col("long").isNull())
    key = ["conv", "role", F.sha2("text", 256).alias("said")]
    first = marked.where("long").select(*key, "block").groupBy("conv", "role", "said").agg(
        F.min("block").alias("first"), F.max("block").alias("last"))
    repeated = cut_lineage(first.where("first < last").select("conv", "role", "said", "first"))
    return marked.withColumn("said", F.when(F.col("long"), F.sha2("text", 256))).join(
        small_or_shuffled(repeated), ["conv", "role", "said"], "left"
    ).select(
        "conv", "block", "turn", "role", "text", "whole",
        F.coalesce(F.col("first") < F.col("block"), F.lit(False)).alias("before"),
    )


def _ordered(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("conv", "block").sortWithinPartitions("conv", "block", *order)


PARSED = (
    "conv string, block long, turns long, low long, high long, blank long, duplicate long, "
    "truncated long, illegal long, first string, last string, "
    "ways array<struct<enter:int,leave:int,cost:long,audit:string>>"
)


def parse_blocks(rows: DataFrame) -> DataFrame:
    """Counts of each block, and the least (cost, audit) from each top to each other top."""

    def make(stream):
        key, held = None, None

        def close():
            ways = [(enter, leave, cost, audit) for enter, tops in held["tops"].items()
                    for leave, (cost, audit, _) in tops.items()]
            ways = [dict(zip(("enter", "leave", "cost", "audit"), w)) for w in ways]
            n = held["n"]
            return (*key, held["turns"], held["low"], held["turn"], n["blank"], n["duplicate"],
                    n["truncated"], n["illegal"], held["first"], held["last"], ways)

        for conv, block, turn, role, text, whole, before in stream:
            if (conv, block) != key:
                if key is not None:
                    yield close()
                key = conv, block
                tops = {s: {s: (0, "", entry(s))} for s in ((0,) if whole else TOPS)}
                held = {"tops": tops, "seen": set(), "turns": 0, "low": None, "turn": None, "last": None,
                        "first": role[:1],
                        "n": dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)}
            if turn is not None and turn != held["turn"]:
                held["turns"] += 1
                held["low"] = turn if held["low"] is None else held["low"]
                held["turn"] = turn
            said = role, hashlib.blake2b(text.encode(), digest_size=20).digest()
            fault = _fault(role, text, before or said in held["seen"])
            held["seen"].add(said)
            if fault:
                held["n"][fault] += 1
            if held["last"] is not None and held["last"] + role[:1] not in LEGAL:
                held["n"]["illegal"] += 1
            held["last"] = role[:1]
            held["tops"] = {s: read(t, role[:1], fault) for s, t in held["tops"].items()}
        if key is not None:
            yield close()

    needed = rows.select("conv", "block", "turn", "role", "text", "whole", "before")
    return _stream(_ordered(needed, "turn", "role", "text"), PARSED, make)


CHOSEN = (
    "conv string, block long, enter int, cost long, audit string, gaps long, blank long, "
    "duplicate long, truncated long, illegal long"
)


def choose_ways(parsed: DataFrame) -> DataFrame:
    """For each block the top it begins with and its (cost, audit) on the cheapest way through
    the conversation; its counts, to be added up (the last block holds the conversation's gaps).

    The fold sees a few numbers for each block. Audits of the tops are compared by what
    follows the part that they share.
    """

    def close(tops, blocks, totals):
        ends = with_inserts({s: (c, a, entry(s)) for s, (c, a, _) in tops.items()})
        cost, audit, state = min((*ends[s][:2], s) for s in ACCEPTS if s in ends)
        # Inserts at the very end come after the last block's own edits.
        source = min((c, a, s) for s, (c, a, _) in tops.items()
                     if audit.startswith(a) and set(audit[len(a):]) <= {"I"}
                     and c + INSERT * (len(audit) - len(a)) == cost)
        extra = len(audit) - len(source[1])
        chain, out = tops[source[2]][2], []
        for key, counts in reversed(blocks):
            chain, enter, cost, audit = chain
            out.append((*key, enter, cost + INSERT * extra, audit + "I" * extra,
                        0 if out else totals["gaps"](), *counts))
            extra = 0
        return out

    def make(stream):
        conv = None
        for (name, block, turns, low, high, blank, duplicate, truncated, illegal, first, last,
             ways) in stream:
            if name != conv:
                if conv is not None:
                    yield from close(tops, blocks, totals)
                conv, blocks, before = name, [], None
                tops = {0: (0, "", None)}
                span = {"low": None, "high": None, "turns": 0}
                totals = {"gaps": lambda span=span: 0 if span["low"] is None
                          else span["high"] - span["low"] + 1 - span["turns"]}
            if low is not None:
                span["low"] = low if span["low"] is None else span["low"]
                span["high"] = high
                span["turns"] += turns
            illegal += before is not None and before + first not in LEGAL
            before = last
            after = {}
            for way in ways:
                enter, leave, cost, audit = (way[k] for k in ("enter", "leave", "cost", "audit"))
                if enter not in tops:
                    continue
                c, a, chain = tops[enter]
                found = (c + cost, a + audit, (chain, enter, cost, audit))
                if leave not in after or found[:2] < after[leave][:2]:
                    after[leave] = found
            shared = len(os.path.commonprefix([a for _, a, _ in after.values()]))
            tops = {s: (c, a[shared:], chain) for s, (c, a, chain) in after.items()}
            blocks.append(((name, block), (blank, duplicate, truncated, illegal)))
        if conv is not None:
            yield from close(tops, blocks, totals)

    ordered = parsed.repartition("conv").sortWithinPartitions("conv", "block")
    return _stream(ordered, CHOSEN, make)


def repaired_rows(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """conv, block, pos, role and text of the repaired conversations."""

    def make(stream):
        def blocks():
            key, state, audit, held = None, 0, "", []
            for conv, block, is_row, turn, role, text, enter in stream:
                if not is_row:
                    if key is not None:
                        yield key, state, audit, held
                    key, state, audit, held = (conv, block), enter, text, []
                else:
                    held.append((role, text))
            if key is not None:
                yield key, state, audit, held

        for key, state, audit, held in blocks():
            for pos, (role, text) in enumerate(apply_audit(state, audit, iter(held))):
                yield (*key, pos, role, text)

    null = F.lit(None)
    way = chosen.select(
        "conv", "block", F.lit(False).alias("is_row"), null.cast("long").alias("turn"),
        F.lit("").alias("role"), F.col("audit").alias("text"), "enter")
    both = way.unionByName(rows.select(
        "conv", "block", F.lit(True).alias("is_row"), "turn", "role", "text",
        null.cast("int").alias("enter")))
    return _stream(_ordered(both, "is_row", "turn", "role", "text"),
                   "conv string, block long, pos long, role string, text string", make)


def digests(repaired: DataFrame) -> DataFrame:
    """conv -> the SHA-256 of `role:text`, joined by line breaks. Rows are hashed as they pass."""

    def make(stream):
        conv, digest = None, None
        for name, role, text in stream:
            if name != conv:
                if conv is not None:
                    yield conv, digest.hexdigest()
                conv, digest = name, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if conv is not None:
            yield conv, digest.hexdigest()

    ordered = repaired.repartition("conv").sortWithinPartitions("conv", "block", "pos")
    return _stream(ordered.select("conv", "role", "text"), "conv string, repaired_sha256 string", make)


def repair(rows: DataFrame, turns: int = TURNS_PER_BLOCK) -> tuple[DataFrame, DataFrame]:
    """(what was chosen for each block, the repaired rows) of conv, turn, role, text.

    conv, role and text must not be null. Rows follow each other by turn (null first), then
    by role and text; rows of one turn stay in one block. Texts may be of any length.
    """
    cut = cut_lineage(blocks_of(rows, turns))
    chosen = cut_lineage(choose_ways(parse_blocks(cut)))
    return chosen, repaired_rows(cut, chosen)


def repair_damaged(conversations: DataFrame, turns: int = TURNS_PER_BLOCK) -> DataFrame:
    """One row for each conv_id (null is one of its own): faults, cost, audit, digest of the repair.

    A conversation without rows after the damage has zeros, no audit, and the digest of
    an empty text. Repeated rows and equal turns are rows like any other; columns besides
    conv_id, turn, role and text are not read.
    """
    chosen, repaired = repair(damage(conversations), turns)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    # An audit is a character a row; the contract wants it in one piece.
    whole = chosen.groupBy("conv").agg(
        *(F.sum(c).alias(c) for c in counts),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))),
                                 lambda x: x["audit"]), "").alias("audit"),
    )
    ids = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv"), "conv_id").distinct()
    empty = hashlib.sha256(b"").hexdigest()
    return ids.join(whole, "conv", "left").join(digests(repaired), "conv", "left").select(
        "conv_id",
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
