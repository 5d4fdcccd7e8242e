from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product
from pathlib import Path

import pytest

from tablewarden.llm import turns

SPACE = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id long, turn long, role string, text string, conv string, block string"
GOOD = re.compile(r"(s?(ua)+)?\Z")


def damaged(rows):
    """{conv_id: rows after damage}, written from the contract."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        spelt = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(spelt.encode()) % 20
        kept = out[conv]
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
            for c, r in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        said = SPACE.findall(text)
        out.append("blank" if not said else "duplicate" if (role, text) in seen
                   else "" if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute(rows):
    """All of a result but the id: by a plain search over positions and grammar states."""
    kinds = faults(rows)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}
    best = {(0, ""): (0, "", ())}
    for i in range(len(rows) + 1):
        for _ in range(4):  # inserts
            for (at, state), (cost, audit, made) in list(best.items()):
                for s, name in names.items():
                    if at == i and (state, s) in step:
                        new = (cost + 2, audit + "I", made + ((name, ""),))
                        key = at, step[state, s]
                        best[key] = min(best.get(key, new), new)
        if i == len(rows):
            break
        _, role, text = rows[i]
        for (at, state), (cost, audit, made) in list(best.items()):
            if at != i:
                continue
            moves = [(state, cost + 3, "D", made)]
            if kinds[i] in ("", "truncated"):
                plus = kinds[i] == "truncated"
                if (state, role[:1]) in step:
                    moves.append((step[state, role[:1]], cost + plus, "K", made + ((role, text),)))
                for s, name in names.items():
                    if (state, s) in step:
                        moves.append((step[state, s], cost + 2 + plus, "R", made + ((name, text),)))
            for state2, c, edit, m in moves:
                new = (c, audit + edit, m)
                best[i + 1, state2] = min(best.get((i + 1, state2), new), new)
    cost, audit, made = min(best[len(rows), s] for s in ("", "a") if (len(rows), s) in best)
    assert GOOD.match("".join(r[:1] for r, _ in made))
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in made)
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def check(df, turns_per_block):
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    want = {conv: brute(kept) for conv, kept in damaged(rows).items()}
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                       r.repaired_sha256)
           for r in turns.repair_damaged(df, turns_per_block).collect()}
    assert got == want


@pytest.fixture(scope="module")
def messy(spark):
    pick = random.Random(5)
    rows = []
    for conv in range(150):
        for turn in range(pick.randrange(0, 14)):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = pick.choice(["Yes.", "No!", "so on", " \n", "", None, f"{turn}?", "É. ", "x" * 50_000])
            rows.append((conv, pick.choice([turn, turn, turn, None, 3 * turn]), role, text, "c", "b"))
    rows += [(None, 0, "user", "no id.", "c", "b"), (None, 1, "assistant", "yes.", "c", "b")]
    rows += [(900, None, "user", "a.", None, None), (900, None, "user", "a.", None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("per_block", [1, 4, 1_000])
def test_equals_brute_force(messy, per_block):
    check(messy, per_block)


def test_equals_brute_force_on_the_table(spark):
    path = "/root/testdata/sf0.01/conversations.parquet"
    if not Path(path).exists():
        pytest.skip("no test tables")
    check(spark.read.parquet(path), 1_000)


def test_one_long_conversation_in_many_blocks(spark):
    pick = random.Random(8)
    rows = [(1, t, pick.choice(["user", "assistant"]), f"{t % 300} times.", "c", "b") for t in range(2_000)]
    check(spark.createDataFrame(rows, SCHEMA), 64)


def test_parser_accepts_the_grammar_and_nothing_else():
    for n in range(6):
        for roles in product("sua", repeat=n):
            nodes = {turns.entry(0)}
            for symbol in roles:
                nodes = {after for node in nodes for after in turns.shifted(node, symbol)}
            accepted = any(node.state in turns.ACCEPTS for node in nodes)
            assert accepted == bool(GOOD.match("".join(roles)))


def test_no_rows(spark):
    assert turns.repair_damaged(spark.createDataFrame([], SCHEMA)).count() == 0
