"""Where texts may be cut for encoding, and encoding chunk by chunk with recent ids remembered.

The pre-token pattern of the byte-level vocabularies never lets a match reach from a
character that is not white space into a following white-space run, and it does not
look back. A text may therefore be cut there, and its ids are those of the pieces, one
after the other. Most chunks are words seen before, so a task encodes each once.

The pattern's look ahead matters only where a white-space run of two or more is followed
by another character: all of the run but its last is one match. Cut there, every piece has
the same matches without the look ahead, and such a pattern is searched several times faster.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

# White space of the pattern's own kind; Python's \s also matches four control characters.
_WHITE = r"[^\S\x1c-\x1f]"
_CHUNK = re.compile(rf"{_WHITE}*[\S\x1c-\x1f]+|{_WHITE}+")
# White space directly before a space or line break: cutting at each of those would be wrong.
_RUN = re.compile(r"\s[ \n]|[\x1c-\x1f]")

LOOK_AHEAD = r"|\s+(?!\S)|\s+"
_PLAIN_RUNS = ("  ", " \n", "\n ", "\n\n")
_OTHER_WHITE = (
    "\t\r\x0b\x0c\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# All of a run but its last, and a place in a long text where it may be cut.
_RUN_BUT_LAST = re.compile(rf"{_WHITE}+(?={_WHITE}[\S\x1c-\x1f])")
_WORD_START = re.compile(r"(?<=\S)(?= \S)")
PIECE_CHARS = 1 << 20

# A task remembers so many chunks, none of them longer than this.
CACHED_CHUNKS = 250_000
LONGEST_CACHED = 64


def without_look_ahead(pattern: str) -> str:
    """The pattern for pieces of texts, the same one if it ends otherwise."""
    return pattern.removesuffix(LOOK_AHEAD) + r"|\s+" if pattern.endswith(LOOK_AHEAD) else pattern


def _cut(text: str, stops: Iterable[int]) -> list[str]:
    bounds = [0, *stops, len(text)]
    return [text[start:stop] for start, stop in pairwise(bounds)]


def pieces(text: str) -> list[str]:
    """A text cut where the pattern looks ahead, and a long one also before words."""
    parts = [text]
    if any(run in text for run in _PLAIN_RUNS) or any(c in text for c in _OTHER_WHITE):
        parts = _cut(text, [run.end() for run in _RUN_BUT_LAST.finditer(text)])
    if len(text) <= PIECE_CHARS:
        return parts
    return [piece for part in parts for piece in _cut(part, _word_starts(part))]


def _word_starts(text: str) -> Iterator[int]:
    at = 0
    while found := _WORD_START.search(text, at + PIECE_CHARS):
        at = found.start()
        yield at


class ChunkEncoder(dict):
    """Maps chunks to their ids as little-endian bytes; at most two generations are held.

    A key without a space stands for the chunk of one space and the key, or for itself
    if it starts with a line break; a key ending in a space for the chunk before it.
    """

    def __init__(self, encode: Callable[[str], bytes], limit: int = CACHED_CHUNKS) -> None:
        super().__init__()
        self._encode = encode
        self._limit = limit
        self._older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        ids = self._older.get(key)
        if ids is None:
            ids = self._encode(
                key[:-1] if key[-1:] == " " else key if key[:1] == "\n" else " " + key
            )
        if len(key) > LONGEST_CACHED:
            return ids
        if len(self) >= self._limit:
            self._older = dict(self)
            self.clear()
        self[key] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """The ids of a whole text."""
        if _RUN.search(text):
            return b"".join([self[chunk + " "] for chunk in _CHUNK.findall(text)])
        first, *rest = text.replace("\n", " \n").split(" ")
        return self[first + " "] + b"".join(map(self.__getitem__, rest))
