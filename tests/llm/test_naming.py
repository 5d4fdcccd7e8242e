from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest

from tablewarden.llm import naming

FOLD = str.maketrans(naming.UPPER, naming.LOWER)


def brute(rows):
    """(doc_id, keep_id, group_size, sha) of each row, and how many of a group are kept."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(FOLD)].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        for i in ids:
            out[i, keep, len(ids), sha] += 1
    return out, len(groups)


def check(docs, **options):
    got = naming.find_copies(docs, **options).collect()
    want, groups = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize("frame", ["awkward", "small"])
def test_equals_brute_force(request, frame):
    check(request.getfixturevalue(frame))


@pytest.mark.parametrize("heavy_rows", [1, 3, 10_000])
def test_block_borders_odd_counts_and_heavy_blocks(spark, heavy_rows, monkeypatch):
    monkeypatch.setattr(naming, "HEAVY_MOST", 10**9)
    texts = ["a" * n for n in range(0, 40)] + ["A" * n for n in range(0, 40, 3)]
    texts += ["abcd" * 5, "abcd" * 5 + "x", "abcd" * 4 + "abcx", "ABCD" * 5, "Ä" * 9, "ä" * 9, None]
    texts += ["hot text of several blocks"] * 30 + ["hot text of several blockS"] * 5
    docs = spark.createDataFrame(
        [(i, t) for i, t in enumerate(texts)] + [(3, "aaa"), (None, "aaa"), (None, "alone")],
        "doc_id long, text string",
    ).repartition(5)
    check(docs, size=4, heavy_rows=heavy_rows)


def test_other_letters_are_not_folded(spark):
    docs = spark.createDataFrame([(1, "É"), (2, "é"), (3, "İ"), (4, "i̇"), (5, "ẞ"), (6, "ß")],
                                 "doc_id long, text string")
    assert all(r.kept for r in naming.find_copies(docs).collect())


def test_no_rows(no_rows):
    assert naming.find_copies(no_rows).count() == 0


def test_no_python_in_the_plan(small):
    plan = naming.find_copies(small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
