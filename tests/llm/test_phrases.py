from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from tablewarden.context import cut_lineage
from tablewarden.llm import phrases

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute_counts(rows):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        for words in pieces(text):
            n[lang or "und"] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang or "und"][tuple(words[i : i + size])] += 1
    return n, f


def brute(rows, least, top):
    n, counted = brute_counts(rows)
    out = []
    for lang, f in counted.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], a)
        scored = []
        for p, a in found.items():
            if 100 * inside[p] >= 80 * a:
                continue
            score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                 for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def rows_of(docs):
    return [(r.lang, r.text) for r in docs.select("lang", "text").collect()]


@pytest.mark.parametrize("frame, least, top", [("small", 30, 2000), ("small", 3, 50), ("awkward", 2, 2000)])
def test_equals_brute_force(request, frame, least, top, monkeypatch):
    monkeypatch.setattr(phrases, "RUN_BYTES", 1 << 18)  # many runs, so that counts are added up
    docs = request.getfixturevalue(frame)
    got = sorted(tuple(r) for r in phrases.mine_phrases(docs, top, least).collect())
    want = brute(rows_of(docs), least, top)
    assert got == want and want


def test_counts_do_not_rest_on_the_filter(small):
    """A filter so small that nearly all hashes collide gives the same counts."""
    dictionary = cut_lineage(phrases.parse(small))
    n, f = brute_counts(rows_of(small))
    want = {(lang, " ".join(p), len(p), a) for lang in f for p, a in f[lang].items() if a >= 30}
    want |= {(lang, "", 0, a) for lang, a in n.items()}
    got = {tuple(r) for r in phrases.phrase_counts(dictionary, 30, filter_log=8).collect()}
    assert got == want


def test_copies_share_chunks_and_overlaps_count_once(spark):
    text = " ".join(f"w{i * i * i % 9973 % 211}" for i in range(6_000))
    docs = spark.createDataFrame(
        [("en", text)] * 40 + [("en", "other words first " + text), (None, text)],
        "lang string, text string")
    dictionary = cut_lineage(phrases.parse(docs))
    chunks = dictionary.where("lang = 'en'").collect()
    assert sum(r.parsed == 41 for r in chunks) > 0.8 * len(chunks)
    got = {(r.lang, r.phrase): r.f for r in phrases.phrase_counts(dictionary, 1).collect()}
    n, f = brute_counts(rows_of(docs))
    want = {(lang, " ".join(p)): a for lang in f for p, a in f[lang].items()} | {
        (lang, ""): a for lang, a in n.items()}
    assert got == want


def test_no_rows(no_rows):
    assert phrases.mine_phrases(no_rows).count() == 0
