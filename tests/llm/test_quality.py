from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tablewarden.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


@pytest.mark.parametrize("frame", ["awkward", "small"])
def test_counts_equal_brute_force(request, frame):
    docs = request.getfixturevalue(frame)
    want = sorted((r.doc_id or -1, *brute(r.text)) for r in docs.select("doc_id", "text").collect())
    got = sorted(
        (r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
         r.base_failed)
        for r in quality.score_quality(docs).collect()
    )
    assert got == want


def test_verdict_joins_hosts_back(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    rows = [(i, good, "fine") for i in range(30)] + [(30, bad, "fine")]
    rows += [(100 + i, bad, "junk") for i in range(30)] + [(200, good, "junk")]
    rows += [(300, bad, "tiny"), (301, good, None), (302, bad, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in quality.score_quality(docs).collect() if r.kept}
    assert kept == {*range(30), 301}  # the good document of the junk host goes too
    rates = {(r.host, r.rule): r.rate for r in quality.host_rates(quality.measured(docs)).collect()}
    assert rates["tiny", "short"] < 1  # one failure out of one is shrunk


def test_hosts_that_differ_by_chance_stay(spark):
    """Small hosts of one true rate: none is rejected, and a bad host among them is."""
    rng = random.Random(4)
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    rows = [(f"h{h}", bad if rng.random() < 0.1 else good) for h in range(1500) for _ in range(1 + h % 3)]
    docs = spark.createDataFrame([(i, t, s) for i, (s, t) in enumerate(rows)],
                                 "doc_id long, text string, source string")
    by_host = Counter(s for s, t in rows if t == bad)
    assert max(by_host.values()) > 1
    assert not any(r.host_rejected for r in quality.host_verdicts(quality.measured(docs)).collect())
    worse = docs.unionByName(
        spark.createDataFrame([(10_000 + i, bad, "junk") for i in range(200)], docs.schema)
    )
    got = quality.host_verdicts(quality.measured(worse)).where("host_rejected").collect()
    assert [r.host for r in got] == ["junk"]


def test_failing_documents_go_where_hosts_fail_too(spark):
    good = " ".join(f"w{i}" for i in range(60))
    symbols = " ".join(f"#{i}$" for i in range(60))
    lines = "\n".join([" ".join(f"l{i}w{k}" for k in range(6)) for i in range(20)] + ["x"] * 12)
    rows = [(i, symbols if i < 14 else good, "worse") for i in range(20)]
    rows += [(100 + i, symbols if i < 1 else good, "better") for i in range(20)]
    rows += [(200 + i, lines if i < 10 else good, "lines") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality.score_quality(docs).collect()}
    assert not any(r.base_failed for r in got.values())
    gone = {i for i, r in got.items() if not r.kept}
    assert gone == {*range(14), *range(200, 210)}  # the good documents of both hosts stay
    one = docs.where("source = 'worse'")
    assert {r.doc_id for r in quality.score_quality(one).collect() if not r.kept} == {*range(14)}


def test_filter_keeps_columns_and_rows(awkward, no_rows):
    kept = quality.filter_quality(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) <= {8}
    assert quality.filter_quality(no_rows).count() == 0
    assert quality.score_quality(no_rows).count() == 0
