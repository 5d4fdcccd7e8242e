from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablewarden.llm import ngram_join, word_table, words
from tablewarden.llm.bpe import ByteLevelEncoder, WordEncoder


def thue_morse(n, one, other):
    return [(one, other)[i.bit_count() % 2] for i in range(n)]


A = "".join(thue_morse(1024, "a", "b")).encode()
B = "".join(thue_morse(1024, "b", "a")).encode()


@pytest.mark.parametrize("fold", [False, True])
@pytest.mark.parametrize("only_spaces", [False, True])
def test_regular_words_have_hashes_of_their_own(fold, only_spaces):
    found = words.scan([A, B, A, b"x " + B], fold, only_spaces)
    a, b, again, _, inner = found.hashes.tolist()
    assert a == again and b == inner and a != b


def test_long_words_fold_like_short_ones():
    upper, lower = words.scan([b"AB" * 400 + b" Ab", b"ab" * 400 + b" ab"], True).hashes.reshape(2, 2)
    assert (upper == lower).all()


def test_regular_sequences_have_hashes_of_their_own():
    one, other = np.uint64(7), np.uint64(9)
    a, b = (np.array(thue_morse(1024, *pair), dtype=np.uint64) for pair in ((one, other), (other, one)))
    assert words.sequence_hash(a) != words.sequence_hash(b) == words.sequence_hash(b.copy())


@pytest.mark.parametrize("encoder, name", [(ByteLevelEncoder, "byte_bpe_50k.json"), (WordEncoder, "word_bpe_49k.json")])
def test_ids_of_regular_words(encoder, name):
    path = public_tokenizers.path(name)
    texts = [A, B, A + b" " + B]
    tokens = Tokenizer.from_file(path)
    want = [tokens.encode(t.decode(), add_special_tokens=False).ids for t in texts]
    got = [np.frombuffer(ids, dtype="<u4").tolist() for ids in encoder(path)(texts)]
    assert got == want and want[0] != want[1]


def test_links_and_word_table_of_regular_words(spark):
    docs = spark.createDataFrame([(1, A.decode()), (2, B.decode()), (3, A.decode())], "doc_id long, text string")
    joined = {r.doc_id: r.component_id for r in ngram_join.join_documents(docs).collect()}
    assert joined == {1: 1, 2: 2, 3: 1}
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = {r.doc_id: (r.ids_sha256, r.decoded_sha256) for r in word_table.encode_and_decode(docs, path).collect()}
    assert ids[1] == ids[3] and ids[1][0] != ids[2][0] and ids[1][1] != ids[2][1]
