"""Token ids of a byte-level vocabulary file, for packing and for token files.

The file is one the tokenizers library reads. Encoding whole texts with that library
took 0.96 MB/s a core here; the pieces of `segmart.llm.chunks` are encoded by tiktoken
over the same vocabulary instead, with the same ids (tests compare the two).
As in that library, the strings of a file's added tokens stand for these tokens in any text.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import tiktoken

from segmart.llm.chunks import ChunkEncoder, pieces, without_look_ahead

_encoders: dict[str, TextEncoder] = {}


def byte_of_char() -> dict[str, int]:
    """The characters that byte-level vocabulary files write for the 256 bytes."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    chars = {chr(b): b for b in printable}
    return chars | {chr(256 + i): b for i, b in enumerate(others)}


class TextEncoder:
    """Ids of texts: added tokens where their strings stand, pieces of the text between them.

    Texts with runs of white space have many short pieces, which are remembered.
    """

    def __init__(self, encode: Callable[[str], bytes], added: dict[str, int]) -> None:
        self._encode = encode
        self._chunks = ChunkEncoder(encode)
        self._added = {text: np.array([number], "<u4").tobytes() for text, number in added.items()}
        longest_first = sorted(added, key=len, reverse=True)
        self._pattern = re.compile("|".join(map(re.escape, longest_first)) or r"(?!)")

    def _plain(self, text: str) -> bytes:
        parts = pieces(text)
        return self._encode(text) if len(parts) == 1 else b"".join([self._chunks[part + " "] for part in parts])

    def ids(self, text: str) -> bytes:
        """The ids of a whole text as little-endian bytes."""
        if not any(token in text for token in self._added):
            return self._plain(text)
        parts, at = [], 0
        for match in self._pattern.finditer(text):
            parts += [self._plain(text[at : match.start()]), self._added[match.group()]]
            at = match.end()
        return b"".join([*parts, self._plain(text[at:])])


@dataclass(frozen=True)
class Vocabulary:
    """A vocabulary file's content, read by the driver and sent to the tasks: a few MB at most."""

    content: bytes
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as file:
            return cls(file.read(), pattern)

    def ranks(self) -> dict[bytes, int]:
        chars = byte_of_char()
        model = json.loads(self.content)
        special = {token["content"] for token in model["added_tokens"]}
        return {
            bytes(chars[c] for c in token): number
            for token, number in model["model"]["vocab"].items()
            if token not in special
        }

    def added(self) -> dict[str, int]:
        """The strings of the file's added tokens, and their ids."""
        return {token["content"]: token["id"] for token in json.loads(self.content)["added_tokens"]}

    def size(self) -> int:
        return 1 + max([*self.ranks().values(), *self.added().values()])

    def encoder(self) -> TextEncoder:
        """The process's encoder for this vocabulary; it outlives a task."""
        key = hashlib.sha256(self.content).hexdigest()
        if key not in _encoders:
            encoding = tiktoken.Encoding(
                key, pat_str=without_look_ahead(self.pattern), mergeable_ranks=self.ranks(), special_tokens={}
            )
            plain = encoding.encode_ordinary
            _encoders[key] = TextEncoder(lambda piece: array("I", plain(piece)).tobytes(), self.added())
        return _encoders[key]
