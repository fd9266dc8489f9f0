"""Texts as numbered pieces, so that costly work is done once per distinct piece.

A text is cut where neither of the tokenizers used here ever joins what stands
on both sides: before a space, or around a line break, that other characters
than white space border on. A piece is then encoded on its own, and what is
found for it is looked up wherever it comes again.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space that texts seldom have, Python's further separators included.
_RARE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_RUNS = ("  ", " \n", "\n\n\n")
_CUTS = re.compile(r"(?s:.+?)(?=(?<=\S)[ \n]|\Z)")
#: Punctuation marks that are cut off a letter before them.
MARKS = ".,;:!?"
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_MARKED = re.compile(f"(?<=[{LETTERS}])([{MARKS}])")
#: Characters of a text that are cut at a time, and pieces that are handled at
#: a time; both bound the memory that one long text takes.
SLICE, STRETCH = 1 << 20, 1 << 19


def runs_of(text: str, marks: bool = False) -> list:
    """Runs of pieces of a text that follows a space. In a run of text, pieces
    stand with one space between them; each stands for itself after a space, or
    as it is if it opens with a line break. A run in a list has pieces in tuples,
    which stand for exactly what they hold (texts with unusual white space). With
    ``marks`` a text is also cut between a Latin letter and a punctuation mark,
    and pieces that open with a mark stand for what they are."""
    odd = not text or text[0].isspace() or text[-1].isspace() or any(r in text for r in _RUNS) or _rare(text)
    if odd or marks and (text[0] in MARKS or any(" " + m in text for m in MARKS)):
        return [[(p,) for p in _CUTS.findall(" " + text)]]
    return [(_MARKED.sub(r" \1", text) if marks else text).replace("\n", " \n")]


def first_runs(text: str) -> list:
    """Runs of pieces of a text that nothing precedes."""
    if not text:
        return []
    (run,) = runs_of(text)
    if isinstance(run, list):  # without the space that stands before
        first, *rest = run
        return [[(first[0][1:],), *rest] if len(first[0]) > 1 else rest]
    first, _, rest = run.partition(" ")
    return [[(first,)], rest] if rest else [[(first,)]]


def encoded(joined: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Tokens with a space between, as numbers of distinct tokens, those tokens,
    and the places where each token begins and the last one ends, plus one."""
    joined += b" "
    at = np.append(0, np.flatnonzero(np.frombuffer(joined, np.uint8) == 32) + 1)
    # Arrow reads the bytes as they are, so each token has its space at the end.
    held = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(joined)])
    coded = held.dictionary_encode()
    return coded.indices.to_numpy(), pc.binary_slice(coded.dictionary, 0, -1), at


class Pieces:
    """Runs of pieces, which are numbered together."""

    def __init__(self):
        self.runs, self.sizes, self.size = [], [], 0

    def add(self, runs: list) -> None:
        for run in runs:
            n = len(run) if isinstance(run, list) else run.count(" ") + 1
            self.runs.append(run)
            self.sizes.append(n)
            self.size += n

    def numbered(self, numbers: Numbers) -> np.ndarray:
        """The number of each piece; Python sees distinct ones only."""
        texts = [r for r in self.runs if not isinstance(r, list)]
        plain = np.zeros(0, np.int64)
        if texts:
            ids, distinct, _ = encoded(" ".join(texts).encode())
            plain = numbers.of(distinct.cast(pa.string()).to_pylist())[ids]
        odd = numbers.of([p for r in self.runs if isinstance(r, list) for p in r])
        if not len(odd) or not len(plain):
            return odd if len(odd) else plain
        of_list = np.repeat(np.array([isinstance(r, list) for r in self.runs]), self.sizes)
        out = np.empty(self.size, np.int64)
        out[of_list], out[~of_list] = odd, plain
        return out


def pieces_in(runs: list) -> list:
    return [p for run in runs for p in (run if isinstance(run, list) else run.split(" "))]


def pieces_of(text: str, marks: bool = False) -> list:
    """Pieces of a text that follows a space."""
    return pieces_in(runs_of(text, marks))


def first_pieces(text: str) -> list:
    """Pieces of a text that nothing precedes."""
    return pieces_in(first_runs(text))


def _rare(text: str) -> bool:
    # What is not printable holds all white space but the space itself.
    return not text.replace("\n", "").isprintable() and _RARE.search(text) is not None


def slices_of(text: str, most: int = SLICE):
    """Parts of a long text, cut at spaces that follow no white space; each part
    but the first follows a space, which belongs to none."""
    start = 0
    while len(text) - start > most:
        cut = text.find(" ", start + most)
        while cut > 0 and text[cut - 1].isspace():
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut + 1
    yield text[start:]


def stretches(texts: list, spaced: bool, marks: bool = False, most: int = STRETCH):
    """(pieces, owners, ends): the pieces of the texts, about ``most`` at a time,
    and where those of each owner, a number in ``texts``, end. With ``spaced``
    every text counts as following a space. Null and empty texts have none."""
    pieces, owners, ends = Pieces(), [], []
    for k, text in enumerate(texts):
        for n, part in enumerate(slices_of(text) if text else ()):
            pieces.add(runs_of(part, marks) if spaced or n else first_runs(part))
            owners.append(k)
            ends.append(pieces.size)
            if pieces.size >= most:
                yield pieces, owners, ends
                pieces, owners, ends = Pieces(), [], []
    if owners:
        yield pieces, owners, ends


def literal(piece, marks: bool = False) -> str:
    """The characters that a piece stands for."""
    if type(piece) is tuple:
        return piece[0]
    as_is = piece[:1] == "\n" or marks and piece and piece[0] in MARKS
    return piece if as_is else " " + piece


class Numbers(dict):
    """Numbers keys in the order in which they are first looked up."""

    def __init__(self, *args):
        super().__init__(*args)
        self.new: list = []

    def __missing__(self, key) -> int:
        self.new.append(key)
        n = self[key] = len(self)
        return n

    def of(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))

    def keep(self, most: int) -> None:
        """Forgets all but the first ones, which are the common ones."""
        kept = list(islice(self.items(), most))
        self.clear()
        self.update(kept)


class Ragged:
    """Lists of numbers, one after the other."""

    def __init__(self, kind):
        self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, kind)

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes, dtype=np.int64)])
        self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype)])

    def keep(self, most: int) -> None:
        self.starts = self.starts[: most + 1].copy()
        self.flat = self.flat[: self.starts[-1]].copy()

    def sizes(self, at: np.ndarray) -> np.ndarray:
        return self.starts[np.asarray(at, np.int64) + 1] - self.starts[at]

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists with the numbers ``at`` in a row, and their sizes."""
        start = self.starts[at]
        sizes = self.starts[at + 1] - start
        before = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(start - before, sizes) + np.arange(int(sizes.sum()))], sizes
