"""Words of many texts at once: their 64-bit hashes, and subword ids by encoding each word once.

Words are found and hashed by array operations over the bytes of about a megabyte of texts. A hash mixes
a word's length and eight bytes at a time; words up to eight bytes of one length cannot meet.

A text's words, joined by one space, may be cut before each space for encoding (see `chunks`). So each
distinct word is encoded once with the space before it, many in one call, and a text's ids are put together
from those of its words. Texts with other white space, or the string of an added token, are encoded whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import xxhash

from segmart.llm.common import PIECE_BYTES
from segmart.llm.tokens import TextEncoder, Vocabulary

LONGEST = 64  # longer words are hashed one by one
KNOWN_WORDS = 400_000  # with more, a task forgets all words it remembers
KNOWN_IDS = 4_000_000  # or with more ids of them
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_OTHER_WHITE = re.compile(r"[^\S\x20\x09-\x0d]")
_OTHER_WHITE_ASCII = re.compile(rb"[\x1c-\x1f]")


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


@dataclass(frozen=True)
class Words:
    """The words of some pieces of texts, in their order; A-Z in lower case."""

    buffer: bytes
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray  # number of the piece
    hashes: np.ndarray

    def words(self, chosen: np.ndarray) -> list[bytes]:
        bounds = zip(self.starts[chosen].tolist(), self.ends[chosen].tolist(), strict=True)
        return [self.buffer[start:end] for start, end in bounds]

    @cached_property
    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct hashes in order, a word of each, and the place of each word's hash among them."""
        order = np.argsort(self.hashes)
        ordered = self.hashes[order]
        new = np.append(True, ordered[1:] != ordered[:-1])[: len(order)]
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(new) - 1
        return ordered[new], order[new], inverse


def words_of(pieces: list[bytes]) -> Words:
    size = sum(map(len, pieces)) + len(pieces) + 1
    buffer = b"".join([b" ", b" ".join(pieces).lower(), b" " * (24 - size % 8)])
    data = np.frombuffer(buffer, np.uint8)
    space = data == 32
    space |= (data - np.uint8(9)) < 5
    starts = np.flatnonzero(space[:-1] > space[1:]) + 1
    ends = np.flatnonzero(space[:-1] < space[1:]) + 1
    piece_ends = np.cumsum([len(p) + 1 for p in pieces])
    owner = np.searchsorted(piece_ends, starts, side="right") if len(pieces) else starts
    lengths = ends - starts
    eight = data[: len(data) // 8 * 8].view(np.uint64)
    hashes = _mixed(lengths.astype(np.uint64))
    active = np.arange(len(starts))
    for done in range(0, LONGEST, 8):
        if done:
            active = active[lengths[active] > done]
        at = starts[active] + done
        shift = ((at & 7) << 3).astype(np.uint64)
        at >>= 3
        chunk = eight[at] >> shift
        chunk |= eight[at + 1] << np.uint64(1) << (np.uint64(63) - shift)
        chunk &= _LOW_BYTES[np.minimum(lengths[active] - done, 8)]
        hashes[active] = _mixed(hashes[active] ^ chunk)
    words = Words(buffer, starts, ends, owner, hashes)
    long = np.flatnonzero(lengths > LONGEST)
    hashes[long] = np.array([xxhash.xxh3_64_intdigest(word) for word in words.words(long)], np.uint64)
    return words


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text cut at white space, in the same way wherever it stands."""
    at = 0
    while at + PIECE_BYTES < len(text):
        gap = _SPACE.search(text, at + PIECE_BYTES)
        stop = gap.start() if gap else len(text)
        yield text[at:stop]
        at = stop
    yield text[at:]


def word_groups(texts: list[bytes]) -> Iterator[tuple[Words, np.ndarray, np.ndarray]]:
    """Words of a bounded number of pieces together, and each piece's text and number within it."""
    group, owners, numbers, size = [], [], [], 0
    for i, text in enumerate(texts):
        for number, piece in enumerate(_pieces(text)):
            group.append(piece)
            owners.append(i)
            numbers.append(number)
            size += len(piece)
            if size >= 4 * PIECE_BYTES:
                yield words_of(group), np.array(owners), np.array(numbers)
                group, owners, numbers, size = [], [], [], 0
    if group:
        yield words_of(group), np.array(owners), np.array(numbers)


class WordEncoder:
    """Subword ids of texts whose words are joined by one space, from ids of words seen before."""

    def __init__(self, vocabulary: Vocabulary, narrow: np.dtype) -> None:
        self._encoder: TextEncoder = vocabulary.encoder()
        self._added = [token.encode() for token in vocabulary.added()]
        self._cut_tokens = any(_SPACE.search(token) for token in self._added)
        self._narrow = narrow
        top = vocabulary.size()
        self._length = np.zeros(top, np.int64)  # bytes of each subword
        for token, number in vocabulary.ranks().items():
            self._length[number] = len(token)
        self._forget()

    def _forget(self) -> None:
        self._keys = np.empty(0, np.uint64)
        self._starts = self._counts = np.empty(0, np.int64)
        self._ids = np.empty(0, self._narrow)

    def whole(self, text: bytes) -> bool:
        """Whether a text, in lower case, must be encoded as a whole."""
        if self._cut_tokens or any(token in text for token in self._added):
            return True
        if text.isascii():
            return _OTHER_WHITE_ASCII.search(text) is not None
        return _OTHER_WHITE.search(text.decode()) is not None

    def whole_ids(self, text: bytes) -> bytes:
        joined = b" ".join(text.split()).decode()
        return np.frombuffer(self._encoder.ids(joined), "<u4").astype(self._narrow).tobytes()

    def _learn(self, words: Words, chosen: np.ndarray) -> None:
        """Encode the chosen words, each with the space before it, in one call."""
        texts = words.words(chosen)
        ids = np.frombuffer(self._encoder.ids((b" " + b" ".join(texts)).decode()), "<u4")
        reached = np.cumsum(self._length[ids])
        counts = np.diff(np.searchsorted(reached, np.cumsum([len(text) + 1 for text in texts])) + 1, prepend=0)
        starts = len(self._ids) + np.cumsum(counts) - counts
        every = np.concatenate([self._keys, words.hashes[chosen]])
        order = np.argsort(every)
        self._keys = every[order]
        self._starts = np.concatenate([self._starts, starts])[order]
        self._counts = np.concatenate([self._counts, counts])[order]
        self._ids = np.concatenate([self._ids, ids.astype(self._narrow)])

    def ids(self, words: Words, first: np.ndarray, of_whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each word has.

        `first` marks the first word of a text, which has no space before it, and `of_whole` the words of
        texts encoded whole: they have no ids here.
        """
        distinct, example, inverse = words.distinct
        if len(self._keys) > KNOWN_WORDS or len(self._ids) > KNOWN_IDS:
            self._forget()
        needed = np.zeros(len(distinct), bool)
        needed[inverse[~(first | of_whole)]] = True
        new = needed & ~_among(self._keys, distinct)[1]
        if new.any():
            self._learn(words, example[new])
        place, found = _among(self._keys, distinct)
        counts, at = np.zeros(len(inverse), np.int64), np.zeros(len(inverse), np.int64)
        if found.any():
            counts, at = np.where(found, self._counts[place], 0)[inverse], self._starts[place][inverse]
        counts[of_whole] = 0
        alone = np.flatnonzero(first & ~of_whole)
        encoded = [np.frombuffer(self._encoder.ids(w.decode()), "<u4").astype(self._narrow) for w in words.words(alone)]
        counts[alone] = [len(ids) for ids in encoded]
        at[alone] = len(self._ids) + np.cumsum(counts[alone]) - counts[alone]
        pool = np.concatenate([self._ids, *encoded])
        at -= np.cumsum(counts) - counts
        return pool[np.repeat(at, counts) + np.arange(counts.sum())], counts


def _among(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place in sorted keys for each value, and whether it is there."""
    if not len(keys):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    place = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return place, keys[place] == values
