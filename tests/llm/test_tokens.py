from __future__ import annotations

import hashlib
import tracemalloc
import zlib
from collections import defaultdict
from threading import get_ident

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablewarden.context import shared_dir
from tablewarden.llm import bpe, packing, token_files, word_table
from tablewarden.llm.bpe import ByteLevelEncoder, WordEncoder, byte_pieces, encode_words, tokenizer

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
FRAMES = pytest.mark.parametrize("frame", ["awkward", "small"])


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def raw(ids):
    return np.array(ids, dtype="<u4").tobytes()


PIECES = st.sampled_from(
    [" ", "  ", "\n", " \n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "'s", "'LL", "don't",
     "word", "Word,", "42", "x9!", "é", "é", "ß.", "Σ", "ος", "漢字", "\U0001f600", "<|endoftext|>",
     "<|startoftext|>", "<|", "...", "_", "​", "﻿", "́a"])
TEXT = st.one_of(st.lists(PIECES, max_size=12).map("".join), st.text(max_size=30))


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_encoders_equal_the_tokenizers(texts):
    for path, encoder in ((BYTES, BYTE_ENCODER), (WORDS, WORD_ENCODER)):
        found = tokenizer(path)
        want = [raw(found.encode(t, add_special_tokens=False).ids) for t in texts]
        assert encoder([t.encode() for t in texts]) == want


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_words_of_the_table_equal_the_tokenizer(text):
    ((_, split),) = SPLITTER([text.encode()])
    entries = split.words_at(split.order)
    assert "".join(entries) == text
    assert word_table.word_keys(entries).tolist() == split.hashes[split.order].tolist()
    found = tokenizer(BYTES)
    got = [i for e in entries for i in found.encode(e, add_special_tokens=False).ids]
    assert got == found.encode(text, add_special_tokens=False).ids


BYTE_ENCODER, WORD_ENCODER = ByteLevelEncoder(BYTES), WordEncoder(WORDS)
SPLITTER = word_table.Splitter(BYTES)


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr("tablewarden.llm.bpe.MAX_REMEMBERED", 3)
    texts = [f"Some word{'x' * k}, und älter {k} again\nand éa again".encode() for k in range(9)]
    for path, kind in ((BYTES, ByteLevelEncoder), (WORDS, WordEncoder)):
        encoder, found = kind(path), tokenizer(path)
        for t in [*texts, *texts]:
            want = raw(found.encode(t.decode(), add_special_tokens=False).ids)
            assert encoder([t]) == [want]


ENCODERS = pytest.mark.parametrize(("path", "kind"), [(BYTES, ByteLevelEncoder), (WORDS, WordEncoder)])


def words_asked(monkeypatch):
    """Lists of the words that encoders spell from here on, one for each group of texts."""
    asked = []

    def spy(path, words):
        asked.append(list(words))
        return encode_words(path, words)

    monkeypatch.setattr(bpe, "encode_words", spy)
    bpe.remembered.cache_clear()
    return asked


@ENCODERS
def test_the_next_task_knows_the_words_of_the_last(monkeypatch, path, kind):
    asked = words_asked(monkeypatch)
    first, second = ([f"some wörds {k} zebra{k}".encode()] for k in "ab")
    assert kind(path)(first) == [raw(ids_of(path, first[0].decode()))]
    assert kind(path)(second) == [raw(ids_of(path, second[0].decode()))]
    assert len(asked) == 2 and [w.strip() for w in sorted(asked[1])] == ["b", "zebrab"]


@ENCODERS
def test_words_met_again_are_kept_when_others_are_forgotten(monkeypatch, path, kind):
    monkeypatch.setattr(bpe, "MAX_REMEMBERED", 20)
    asked = words_asked(monkeypatch)
    rare = [[f"start common again {' '.join(k + i for i in 'abcdefghi')}"] for k in 'jklmnpqrstuv']
    for (text,) in rare:
        assert kind(path)([text.encode()]) == [raw(ids_of(path, text))]
    assert sum(w.strip() == "common" for words in asked for w in words) == 1
    assert len(bpe.remembered(path, kind, get_ident()).hashes) <= 20 + 12


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_of_letters_are_encoded_many_at_once(monkeypatch, path):
    """One encoding for hundreds of words, with the ids that each has by itself."""
    words = [f"{a}{b}{c}" for a in ("th", "é", "ß", "wörd", "zz") for b in ("", "ing", "ÿ") for c in ("", "s", "ed")]
    apart = []
    monkeypatch.setattr(bpe, "_apart", lambda found, some: apart.extend(some) or ([], []))
    sizes, ids = encode_words(path, words)
    want = [ids_of(path, w) for w in words]
    assert apart == [] and sizes.tolist() == [len(i) for i in want]
    assert ids.tolist() == [i for one in want for i in one]


def test_pieces_decode_as_the_tokenizer():
    found, pieces = tokenizer(BYTES), byte_pieces(BYTES)
    for ids in ([50256, 0, 220, 447], [447, 247, 198], list(range(256))):
        text = b"".join(pieces[i] for i in ids).decode("utf-8", "replace")
        assert text == found.decode(ids, skip_special_tokens=False)


@FRAMES
def test_token_files(spark, request, frame):
    docs = request.getfixturevalue(frame)
    got = token_files.round_trip(docs, WORDS, 2).collect()
    want = defaultdict(list)
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    start = 0
    for r in rows:
        ids = [*ids_of(WORDS, r.text), 2]
        want[r.doc_id].append((start, len(ids), zlib.crc32(raw(ids))))
        start += len(ids)
    have = defaultdict(list)
    for r in got:
        have[r.doc_id].append((r.start, r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == dict(want)


def test_single_documents_and_damage(spark, small):
    target = f"{shared_dir(spark)}/t"
    token_files.write_tokens(small, target, WORDS, 2)
    got = {r.doc_id: r.ids for r in token_files.read_documents(spark, target, [3, 77, 10**9]).collect()}
    texts = {r.doc_id: r.text for r in small.where("doc_id in (3, 77)").collect()}
    assert got == {k: [*ids_of(WORDS, t), 2] for k, t in texts.items()}
    other = f"{shared_dir(spark)}/u"
    token_files.write_tokens(small.limit(3), other, WORDS, 2)
    spark.read.parquet(f"{target}/blocks").write.parquet(f"{other}/mixed/blocks")
    spark.read.parquet(f"{other}/dictionary").write.parquet(f"{other}/mixed/dictionary")
    with pytest.raises(Exception, match="dictionary"):
        token_files.read_tokens(spark, f"{other}/mixed").collect()


@FRAMES
def test_packing(request, frame):
    docs = request.getfixturevalue(frame)
    got = packing.pack_documents(docs, BYTES, 0, window=4096).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
    total = sum(r.length for r in got)
    assert sorted(sequences) == list(range(-(-total // 1024)))
    for number, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 1024 or number == max(sequences)
    for r in docs.select("doc_id", "text").distinct().collect():
        ids = raw([*ids_of(BYTES, r.text), 0])
        found = pieces[r.doc_id, len(ids) // 4]
        for start, length, crc in found:
            assert zlib.crc32(ids[4 * start : 4 * (start + length)]) == crc
        copies = sum(s == 0 for s, _, _ in found)
        assert sum(n for _, n, _ in found) == copies * len(ids) // 4


def test_windows_hold_the_mixture(spark):
    rows = [(i, "some words of a text " * 20, "a" if i % 3 else "b") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    source = {i: s for i, _, s in rows}

    def share(shares):
        got = packing.pack_documents(docs, BYTES, 0, window=8192, shares=shares).collect()
        early = [r for r in got if r.sequence_id < 24]  # three windows
        b = sum(r.length for r in early if source[r.doc_id] == "b")
        return b / sum(r.length for r in early)

    assert abs(share(None) - 1 / 3) < 0.01
    assert abs(share({"a": 1.0, "b": 3.0}) - 0.75) < 0.01


def test_schedule_places_every_token_once():
    for totals, shares in (([5, 0, 17, 1], None), ([50, 3, 900], [1.0, 5.0, 0.0]), ([7], None)):
        plan = packing.Schedule(totals, shares, 16)
        seen = sorted(
            p + k for q, n in enumerate(totals) for p, _, size in plan.runs(q, 0, n) for k in range(size)
        )
        assert seen == list(range(sum(totals)))


@FRAMES
@pytest.mark.parametrize(("head", "log"), [(0, 26), (50, 6), (500_000, 26)])
def test_word_table(request, frame, head, log, monkeypatch):
    """A filter of 64 bits tells hardly any word that occurs once from the others."""
    monkeypatch.setattr(word_table, "HEAD_WORDS", head)
    monkeypatch.setattr(word_table, "FILTER_LOG", log)
    docs = request.getfixturevalue(frame)
    got = sorted(map(tuple, word_table.encode_and_decode(docs, BYTES).collect()), key=str)
    found = Tokenizer.from_file(BYTES)
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = found.encode(r.text or "", add_special_tokens=False).ids
        text = found.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(raw(ids)).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_no_rows(no_rows):
    assert token_files.round_trip(no_rows, WORDS, 2).count() == 0
    assert packing.pack_documents(no_rows, BYTES, 0).count() == 0
    assert word_table.encode_and_decode(no_rows, BYTES).count() == 0


def test_asked_words_grow_with_the_texts(spark, monkeypatch):
    """Words found three times are asked for, whether or not the broadcast part has room for them."""
    monkeypatch.setattr(word_table, "HEAD_WORDS", 40)
    path = public_tokenizers.path("byte_bpe_50k.json")
    asked = []
    for n in (30, 60):
        texts = [(i, " ".join(["start", *(f"q{k}z" for k in range(n))])) for i in range(3)]
        encoded, _ = word_table.encode_with_gaps(spark.createDataFrame(texts, "doc_id long, text string"), path)
        asked.append(encoded.agg({"n_rare": "sum"}).first()[0])
    assert asked[0] >= 3 * 30 and asked[1] <= 3 * asked[0]


@pytest.fixture
def steps_of_word_table(spark, monkeypatch):
    """What runs on each Arrow batch, by the columns it makes; the table holds words of a few texts."""
    real, makes = word_table.map_batches, {}

    def spy(df, ddl, make):
        makes[ddl] = make
        return real(df, ddl, make)

    monkeypatch.setattr(word_table, "map_batches", spy)
    texts = [(i, "some words of a few texts " * 3 + " ".join(f"q{k}" for k in range(500))) for i in range(4)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    encoded, dictionary = word_table.encode_with_gaps(frame, BYTES)
    return makes, encoded.toArrow().combine_chunks().to_batches()[0], dictionary


def test_memory_of_a_batch_is_bounded(steps_of_word_table):
    """Counting and looking up take a few megabytes of a batch's text at a time."""
    makes, _, _ = steps_of_word_table
    texts = [" ".join(f"w{(i * 977 + k * k) % 30_000}" for k in range(1_000)) for i in range(1_600)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(1_600), pa.int64()), "text": texts})
    assert batch.nbytes > 10 << 20
    for ddl in ("word string, n long", "key binary, rare array<string>",
                "key binary, doc_id long, n_rare int, known binary, gaps binary"):
        step = makes[ddl]()
        tracemalloc.start()
        try:
            parts = sum(1 for _ in step(batch))
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert parts >= 5, ddl
        assert peak < 130 << 20, (ddl, peak >> 20)


def test_ids_are_put_together_some_rows_at_a_time(steps_of_word_table, monkeypatch):
    _, batch, dictionary = steps_of_word_table
    whole = [(doc_id, raw(ids)) for ids_, every in word_table._assembler(BYTES, dictionary)(batch)
             for doc_id, ids in zip(ids_.to_pylist(), every)]
    assert len(whole) == batch.num_rows
    monkeypatch.setattr(word_table, "ASSEMBLE_BYTES", 1)
    parts = [(ids_.to_pylist(), [raw(i) for i in every])
             for ids_, every in word_table._assembler(BYTES, dictionary)(batch)]
    assert len(parts) == batch.num_rows
    assert [(d, i) for ds, every in parts for d, i in zip(ds, every)] == whole
