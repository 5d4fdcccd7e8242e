"""Token ids of whole texts, with each distinct word of a batch encoded once.

Both tokenizers cut a text into pieces that never depend on what stands beyond a
space, so a text may be encoded word by word. Words are remembered up to a bound, by a
64-bit hash, and from one task of a Python worker to the next; two words of one hash held at
one time would be confused (one chance in 10**7 for a million distinct words).
Texts in which this does not hold (special tokens spelled out, white space other
than single ASCII characters around words) are given to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from threading import get_ident

import numpy as np

from tablewarden.llm.words import SPACE, Words, groups, scan

MAX_REMEMBERED = 1_000_000
GROUP_BYTES = 2 << 20

#: A Latin word, perhaps with one closing mark: the mark is always a token of its own.
_PLAIN = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?]?)")
_LETTERS = re.compile(r" ?[a-z\u00df-\u00f6\u00f8-\u00ff]+")
#: White space as the byte-level pattern sees it.
_WIDE = r"\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WS = rf"\t-\r {_WIDE}"
_WIDE_BYTES = re.compile(
    rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_CHUNK = re.compile(rf" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def encode_many(path: str, texts: Sequence[str]) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    found = tokenizer(path).encode_batch_fast(list(texts), add_special_tokens=False)
    return [np.array(e.ids, dtype="<u4").tobytes() for e in found]


@lru_cache(maxsize=4)
def _plain_tokenizer(path: str, line: bool):
    """The same model for Latin words, one a line, which need no normalising or further splitting.

    With `line` a line feed has an id, else none.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    found.normalizer = None
    found.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split("\n", "isolated" if line else "removed"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return found


@lru_cache(maxsize=4)
def _last_ids(path: str) -> np.ndarray:
    """By id, whether its piece ends a word; no piece does if the model does not mark ends."""
    found = tokenizer(path)
    suffix = found.model.end_of_word_suffix
    vocabulary = found.get_vocab(with_added_tokens=False)
    ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
    if suffix:
        ends[[number for piece, number in vocabulary.items() if piece.endswith(suffix)]] = True
    return ends


def take_runs(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `values` at `starts`, in a row, and where each begins there; the last is the end."""
    stops = np.concatenate([[0], np.cumsum(sizes)])
    return values[np.repeat(starts - stops[:-1], sizes) + np.arange(stops[-1])], stops


def _apart(found, words: list[str]) -> tuple[list[int], list[int]]:
    """The numbers of ids of the words, and their ids, each word encoded as a text."""
    ids = [e.ids for e in found.encode_batch_fast(words, add_special_tokens=False)]
    return [len(i) for i in ids], list(chain.from_iterable(ids))


def _by_lines(found, words: list[str]) -> np.ndarray:
    """The ids of words of letters, many in one text, with a line feed after each."""
    texts = ["\n".join(words[k : k + 500]) + "\n" for k in range(0, len(words), 500)]
    encoded = found.encode_batch_fast(texts, add_special_tokens=False)
    return np.concatenate([np.zeros(0, np.int64), *(np.array(e.ids, dtype=np.int64) for e in encoded)])


def _letters(path: str, words: list[str], line: int | None) -> tuple[list[int], list[int]]:
    """The numbers of ids of words of letters, and their ids."""
    ids = _by_lines(_plain_tokenizer(path, line is not None), words)
    if line is not None:  # a line feed between words is one id
        ends = ids == line
        sizes, ids = np.diff(np.flatnonzero(ends), prepend=-1) - 1, ids[~ends]
    else:
        sizes = np.diff(np.flatnonzero(_last_ids(path)[ids]), prepend=-1)
    if len(sizes) != len(words) or sizes.sum() != len(ids):
        return _apart(tokenizer(path), words)
    return sizes.tolist(), ids.tolist()


def encode_words(path: str, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of ids of single words, perhaps after a space, and all ids in a row."""
    found = tokenizer(path)
    line = found.encode("\n", add_special_tokens=False).ids
    letters = _PLAIN if len(line) == 1 else _LETTERS
    # A Latin word and its closing mark are encoded apart.
    split = [[p for p in m.groups() if p] if (m := _PLAIN.fullmatch(w)) else [w] for w in words]
    parts = list(dict.fromkeys(chain.from_iterable(split)))
    plain = [p for p in parts if (m := letters.fullmatch(p)) and (letters is _LETTERS or not m[2])]
    done = _letters(path, plain, line[0] if len(line) == 1 else None)
    known = set(plain)
    other = [p for p in parts if p not in known]
    sizes, ids = (np.array(a + b, dtype=np.int64) for a, b in zip(done, _apart(found, other)))
    place = {p: k for k, p in enumerate(chain(plain, other))}
    at = np.fromiter((place[p] for ps in split for p in ps), dtype=np.int64)
    ids, stops = take_runs(ids, (np.cumsum(sizes) - sizes)[at], sizes[at])
    bounds = np.cumsum(np.fromiter(map(len, split), dtype=np.int64, count=len(split)))
    return np.diff(stops[bounds], prepend=0), ids.astype("<u4")


def special_tokens(path: str) -> list[str]:
    return [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]


class Remembered:
    """Hashes of words -> ids, held in arrays: some forty bytes a word.

    When they are too many, those stay that were met again since the last time, unless
    these are more than half of what may be held.
    """

    def __init__(self, path: str):
        self.path = path
        self._keep(np.zeros(0, dtype=np.int64))

    def _keep(self, at: np.ndarray) -> None:
        """Forget all words but those at the places `at`, ascending."""
        if len(at):
            self.ids, stops = take_runs(self.ids, self.starts[at], self.sizes[at])
            self.hashes, self.starts, self.sizes = self.hashes[at], stops[:-1], self.sizes[at]
        else:
            self.hashes = np.zeros(0, dtype=np.uint64)
            self.starts = self.sizes = np.zeros(0, dtype=np.int64)
            self.ids = np.zeros(0, dtype="<u4")
        self.again = np.zeros(len(at), dtype=bool)

    def _make_room(self) -> None:
        if len(self.hashes) > MAX_REMEMBERED or len(self.ids) > 8 * MAX_REMEMBERED:
            again = np.flatnonzero(self.again)
            many = 2 * len(again) > MAX_REMEMBERED or self.sizes[again].sum() > 4 * MAX_REMEMBERED
            self._keep(again[:0] if many else again)

    def places(self, hashes: np.ndarray, words_at: Callable[[np.ndarray], list[str]]) -> np.ndarray:
        """Where each of the distinct `hashes`, ascending, stands; `words_at` spells those not yet known."""
        self._make_room()
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), dtype=bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        self.again[at[known]] = True
        missing = np.flatnonzero(~known)
        if len(missing):
            sizes, ids = encode_words(self.path, words_at(missing))
            starts = len(self.ids) + np.cumsum(sizes) - sizes
            self.ids = np.concatenate([self.ids, ids])
            self.hashes = np.insert(self.hashes, at[missing], hashes[missing])
            self.starts = np.insert(self.starts, at[missing], starts)
            self.sizes = np.insert(self.sizes, at[missing], sizes)
            self.again = np.insert(self.again, at[missing], False)
            at = np.searchsorted(self.hashes, hashes)
        return at


@lru_cache(maxsize=1)
def remembered(path: str, kind: type, thread: int) -> Remembered:
    """Words met by the encoders of a kind in this thread, kept from one task to the next."""
    return Remembered(path)


@dataclass
class Split:
    """Words of a group of texts."""

    whole: np.ndarray  # texts that cannot be encoded word by word; they have no words here
    hashes: np.ndarray  # of the distinct words, ascending
    words_at: Callable[[np.ndarray], list[str]]  # spells the words at these places of `hashes`
    order: np.ndarray  # all words of the texts in a row, as places in `hashes`
    bounds: np.ndarray  # text k has order[bounds[k] : bounds[k + 1]]


class _Encoder:
    """Texts -> ids. Words are found, told apart and put together by arrays."""

    fold = only_spaces = False
    cuts = None

    def __init__(self, path: str):
        self.path = path
        self.special = special_tokens(path)
        self.known = remembered(path, type(self), get_ident())

    def _whole(self, texts: Sequence[bytes], words: Words) -> np.ndarray:
        """Which texts cannot be encoded word by word."""
        raise NotImplementedError

    def __call__(self, texts: Sequence[bytes]) -> list[bytes]:
        out: list[bytes] = []
        for begin, end in groups(texts, GROUP_BYTES):
            out += self._group(texts[begin:end])
        return out

    def split(self, texts: Sequence[bytes]) -> Split:
        """The distinct words of the texts, without those texts that must be encoded whole."""
        words = scan(texts, self.fold, self.only_spaces, self.cuts)
        data = words.data.lower() if self.fold else words.data
        counts = np.diff(words.bounds)
        whole = self._whole(texts, words)
        first = np.zeros(len(words.hashes), dtype=bool)
        if self.only_spaces:  # words without a space of their text before them
            first = np.frombuffer(data, dtype=np.uint8)[words.starts - 1] != 32
            first[words.bounds[:-1][counts > 0]] = True
        hashes = np.where(first, ~words.hashes, words.hashes)
        use = np.flatnonzero(np.repeat(~whole, counts))
        distinct, sample, inverse = np.unique(hashes[use], return_index=True, return_inverse=True)

        def words_at(missing: np.ndarray) -> list[str]:
            at = use[sample[missing]]
            begins = words.starts[at] - (self.only_spaces & ~first[at])
            return [data[i:j].decode() for i, j in zip(begins.tolist(), words.ends[at].tolist())]

        bounds = np.concatenate([[0], np.cumsum(np.where(whole, 0, counts))])
        return Split(whole, distinct, words_at, inverse, bounds)

    def _group(self, texts: Sequence[bytes]) -> list[bytes]:
        split = self.split(texts)
        at = self.known.places(split.hashes, split.words_at)[split.order]
        ids, stops = take_runs(self.known.ids, self.known.starts[at], self.known.sizes[at])
        cuts = stops[split.bounds].tolist()
        out = [ids[i:j].tobytes() for i, j in zip(cuts, cuts[1:])]
        odd = np.flatnonzero(split.whole).tolist()
        for i, found in zip(odd, encode_many(self.path, [texts[i].decode() for i in odd])):
            out[i] = found
        return out


class ByteLevelEncoder(_Encoder):
    """Texts -> ids for a byte-level tokenizer, in which a space belongs to the word after it."""

    only_spaces = True

    @staticmethod
    def cuts(raw: np.ndarray) -> np.ndarray:
        """Bytes before which a piece begins whatever follows, though no space stands there.

        A run of letters ends before any other ASCII character; a single line feed
        is a piece, and the line after it begins a new one.
        """
        back, back2 = np.roll(raw, 1), np.roll(raw, 2)
        # The second byte of a letter from U+00C0 to U+024F, but for two signs.
        accented = (back2 >= 0xC3) & (back2 <= 0xC9) & (back >= 0x80)
        accented &= ~((back2 == 0xC3) & ((back == 0x97) | (back == 0xB7)))
        ends = (_LETTER[back] | accented) & (raw < 0x80) & ~_LETTER[raw]
        line = (back == 10) & ~SPACE[back2] & ~SPACE[raw]
        return ends | line

    def _whole(self, texts: Sequence[bytes], words: Words) -> np.ndarray:
        special = [s.encode() for s in self.special]
        found = np.fromiter(
            (bool(_WIDE_BYTES.search(t)) or any(s in t for s in special) for t in texts),
            dtype=bool, count=len(texts),
        )
        # White space at an end of a text, or beside a space.
        raw = np.frombuffer(words.data, dtype=np.uint8)
        met = np.flatnonzero((raw[:-1] == 32) & SPACE[raw[1:]] | SPACE[raw[:-1]] & (raw[1:] == 32))
        for at in (met, met + 1):
            text = np.searchsorted(words.offsets, at, side="right") - 1
            ours = (text >= 0) & (text < len(texts))
            # The space that joins two texts belongs to neither.
            ours[ours] = at[ours] < words.offsets[text[ours] + 1] - 1
            found[text[ours]] = True
        return found


class WordEncoder(_Encoder):
    """Texts -> ids for a tokenizer that lowers case and drops white space."""

    fold = True

    def _whole(self, texts: Sequence[bytes], words: Words) -> np.ndarray:
        marks = {s[:2].encode() for s in self.special}
        return np.fromiter((any(m in t for m in marks) for t in texts), dtype=bool, count=len(texts))


def chunks(text: str) -> list[str]:
    """Words of a text for a byte-level tokenizer; put together they are the text."""
    found = ((c, _PLAIN.fullmatch(c)) for c in _CHUNK.findall(text))
    return [part for c, m in found for part in (m.groups() if m else (c,)) if part]


def byte_pieces(path: str) -> list[bytes]:
    """id -> the bytes it stands for.

    The vocabulary writes printable bytes as themselves and the others, in
    order, as the characters from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in own}
    byte |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(own))}
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=True)
    special = set(special_tokens(path))
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for piece, number in vocabulary.items():
        pieces[number] = piece.encode() if piece in special else bytes(byte[c] for c in piece)
    return pieces


Encoder = Callable[[Sequence[bytes]], list[bytes]]
