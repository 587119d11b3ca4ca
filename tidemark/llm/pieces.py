"""Pieces of text that byte-level tokenizers treat independently, and what they encode to.

The pre-token pattern never joins a character with white space that follows it, so a text may
be cut before any white space that follows something else.  A piece is white space with what
stands after it.  Pieces repeat, and so do the pre-tokens in them, so a task remembers their ids
up to a number of bytes and starts afresh beyond it, which changes no result.  At the end of a ``task``
it forgets all, so that the worker, which Spark uses again, holds nothing for other work.

Nearly all texts have single spaces only; Arrow splits those, numbers their distinct pieces and
gathers the ids.  Texts with a space at the start or after other white space are cut one by one.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

REMEMBERED = 64 << 20  # bytes of remembered pieces and ids in a worker, as counted by ``ENTRY``
ENTRY = 200  # bytes of a remembered piece besides its characters and ids
LONG = 64  # characters; longer pieces are not remembered
AT_ONCE = 1_000_000  # bytes of text worked on together
# The characters with the property White_Space, as the pre-token pattern sees them.
BLANK = "\t-\r \x85\xa0  -     　"
_GENERAL = re.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")
_BEFORE = [chr(c) + " " for c in range(0x3001) if re.match(f"[{BLANK}]", chr(c))]


def odd(text: str) -> bool:
    """Whether a space stands at the start of a text or after other white space."""
    return text[:1] == " " or any(pair in text for pair in _BEFORE)


def _strings(coded: pa.DictionaryArray) -> list[str]:
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist()


def gather(values: pa.LargeBinaryArray, index: pa.Array, bounds: np.ndarray) -> list[bytes]:
    """The values at ``index``, joined between each two of the ``bounds`` (positions in ``index``)."""
    joined = values.take(index)
    _, ends, data = joined.buffers()
    cuts = np.frombuffer(ends, np.int64, len(index) + 1)[bounds].tolist()
    data = memoryview(data or b"")
    return [bytes(data[a:b]) for a, b in zip(cuts, cuts[1:])]


def cut(text: str) -> list[str]:
    """Consecutive pieces whose concatenation is ``text``."""
    return _GENERAL.findall(text)


class Pieces(dict):
    """Little-endian 32-bit ids of pieces and pre-tokens.

    ``split`` gives the pre-tokens of a piece, ``encode`` the ids of each of several pre-tokens;
    without ``split`` it is given whole pieces.
    """

    def __init__(
        self, split: Callable[[str], list[str]] | None, encode: Callable[[list[str]], list], most: int = REMEMBERED
    ) -> None:
        super().__init__()
        self.split, self.encode, self.most, self.bytes = split, encode, most, 0

    def forget(self) -> None:
        self.clear()
        self.bytes = 0

    @contextmanager
    def task(self) -> Iterator[Pieces]:
        """Everything remembered within is forgotten at the end, also after a failure."""
        try:
            yield self
        finally:
            self.forget()
            pa.default_memory_pool().release_unused()

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of whole texts."""
        if self.bytes >= self.most:
            self.forget()
        out, plain = [b""] * len(texts), []
        for i, text in enumerate(texts):
            if text and odd(text):
                out[i] = b"".join(self._of(cut(text)))
            elif text:
                plain.append(i)
        for i, coded in zip(plain, self._spaced([texts[i] for i in plain])):
            out[i] = coded
        return out

    def _spaced(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that can be cut before every space."""
        words = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds, words = words.offsets.to_numpy(), words.values
        inner, first = words.dictionary_encode(), words.take(pa.array(bounds[:-1])).dictionary_encode()
        names = list(map(" ".__add__, _strings(inner)))
        index = inner.indices.to_numpy().astype(np.int64)
        index[bounds[:-1]] = len(names) + first.indices.to_numpy()  # nothing stands before the first word
        return gather(pa.array(self._of(names + _strings(first)), pa.large_binary()), pa.array(index), bounds)

    def _of(self, pieces: list[str]) -> list[bytes]:
        unknown = list(dict.fromkeys(p for p in pieces if p not in self))
        own: dict[str, bytes] = {}
        for start in range(0, len(unknown), 20_000):
            self._learn(unknown[start : start + 20_000], own)
        # What was learned just now need not be remembered.
        return [own.get(p) or self[p] for p in pieces] if own else list(map(self.__getitem__, pieces))

    def _learn(self, some: list[str], own: dict[str, bytes]) -> None:
        if self.split is None:
            whole = dict(zip(some, map(_packed, self.encode(some))))
            found = [whole]
        else:
            parts = list(map(self.split, some))
            new = list(set().union(*parts).difference(self))
            ids = dict(zip(new, map(_packed, self.encode(new))))
            whole = {p: b"".join([ids[x] if x in ids else self[x] for x in part]) for p, part in zip(some, parts)}
            found = [ids, whole]
        own.update(whole)
        for pairs in found:
            if self.bytes >= self.most:
                return
            for piece, coded in pairs.items():
                if len(piece) <= LONG and piece not in self:
                    self[piece] = coded
                    # A character takes up to four bytes.
                    self.bytes += ENTRY + (len(piece) if piece.isascii() else 4 * len(piece)) + len(coded)


def _packed(ids: list[int] | np.ndarray) -> bytes:
    return ids.tobytes() if isinstance(ids, np.ndarray) else array("i", ids).tobytes()


def groups(texts: list[str | None], most: int = AT_ONCE) -> list[range]:
    """Consecutive rows of about ``most`` characters together, at least one row each."""
    return _groups([len(t or "") for t in texts], most)


def slices(batch: pa.RecordBatch, column: int, most: int = AT_ONCE) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Consecutive rows of a batch with about ``most`` bytes in a string column, and its values."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for rows in _groups(sizes, most):
        part = batch.slice(rows.start, len(rows))
        yield part, part.column(column).to_pylist()


def _groups(sizes: list[int], most: int) -> list[range]:
    out, start, held = [], 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held >= most:
            out.append(range(start, i + 1))
            start, held = i + 1, 0
    if start < len(sizes):
        out.append(range(start, len(sizes)))
    return out
