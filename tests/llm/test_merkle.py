from __future__ import annotations

import hashlib

import pytest

from tablewarden.llm import merkle


@pytest.mark.parametrize("frame", ["awkward", "small"])
def test_edited_texts_and_fingerprints(request, frame):
    docs = request.getfixturevalue(frame)
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in
                   docs.select("doc_id", "text").collect()))
    want = []
    for k, (has, doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][2]
        n = len(text) // 4
        changed = text[: len(text) - n] + following[:n]
        a, b, c = map(merkle.build, (text, changed, following))
        want.append((doc_id if has else None, len(text), hashlib.sha256(changed.encode()).hexdigest(),
                     a.root, b.root, merkle.likeness(a, b), merkle.likeness(a, c)))
    got = [tuple(r)[:7] for r in merkle.fingerprint_documents(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_trees_locate_edits():
    lines = [f"line {i} has some words of its own and a few more of them" for i in range(60)]
    a = merkle.build("\n".join(lines))
    lines[41] = lines[41].replace("few", "lot")
    b = merkle.build("\n".join(lines))
    assert a.root != b.root and merkle.first_difference(a, b) == 41
    assert sum(x != y for x, y in zip(a.paragraphs, b.paragraphs)) == 1
    assert len(set(a.sections) ^ set(b.sections)) <= 4
    assert 0.95 < merkle.likeness(a, b) < 1 == merkle.likeness(a, a)
    assert merkle.build("a\nb").root != merkle.build("a b").root != merkle.build("a  b").root
    assert merkle.build("").root == merkle.build("").root and merkle.first_difference(a, a) is None


@pytest.mark.parametrize("text", [
    "word " * 400, "a " * 800, " ".join(f"w{i * 7919 % 1000:03}!!" for i in range(400)),
    " ".join(f"{i * 7919 % 1000}$$$" for i in range(400)), "x" * 3000, " " * 3000,
    "".join(chr(0x4E00 + i * i * 7919 % 3001) for i in range(2000)),
    "".join(chr(0x0E01 + i * i * 31 % 46) for i in range(2000)),
])
def test_leaves_of_any_text_are_short(text):
    following = " ".join(f"other{i * i % 977}" for i in range(400))
    a, b = merkle.build(text), merkle.build(merkle.edited(text, following))
    assert 0.55 <= merkle.likeness(a, b) <= 0.9
    assert len(a.leaves) >= len(text) / (17 * merkle.LONG_WORD)


def test_no_rows_and_one_row(spark, no_rows):
    assert merkle.fingerprint_documents(no_rows).count() == 0
    one = merkle.fingerprint_documents(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string"))
    assert [(r.doc_id, r.near_next) for r in one.collect()] == [(1, 1.0)]
