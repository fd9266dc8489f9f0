"""Token ids of whole texts by a public tokenizer, with a cache of words.

Both vocabularies used here split a text before they merge, and never merge
across a word's edge, so the ids of a text are the ids of its words in order.
Each distinct word goes to the tokenizers library once per worker; a text is
then a look-up per word. Texts in which the edges are not plain (runs of white
space, marks of special tokens) go to the library as a whole. The tests hold
the result against the library on whole texts.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

from martkit.llm.words import encoded

#: Unicode's White_Space, by which the patterns of the vocabularies split.
_WHITE = "\t-\r \x85\xa0  -     　"
_ANY_WHITE = re.compile(f"[{_WHITE}]")
#: White space for Python's split() but not for the patterns, and the mark
#: between words of a joined text.
_ODD = re.compile("[\x01\x1c-\x1f]")
#: Words a worker remembers; beyond, it forgets all but the first, which are
#: the common ones.
CACHE_WORDS, CACHE_KEPT = 500_000, 200_000
#: Words that are joined into one text for the library.
JOINED = 512


class Encoder:
    """Encodes with one tokenizer file. ``spaced`` vocabularies keep the space
    before a word as part of it; the others drop white space."""

    def __init__(self, path: str, cache: int = CACHE_WORDS, cache_kept: int = CACHE_KEPT):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.cache, self.cache_kept = cache, cache_kept
        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = not np.array_equal(self._whole(" a"), self._whole("a"))
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line = self._whole("\n")
        self.mark = int(self._whole("\x01")[0])
        self.opens, self.ends = np.zeros((2, self.tokenizer.get_vocab_size()), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
            self.opens[i] = token[0] in "ĠĊ"  # a space or a line break, as this vocabulary writes them
        self.known: dict[str, int] = {}
        self.starts = np.zeros(2, np.int64)  # the first word is empty, in place of those that are not plain
        self.flat = np.zeros(0, np.uint32)

    @property
    def bits(self) -> int:
        """Bits that hold every id of the vocabulary."""
        return max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())

    def _forget(self) -> None:
        kept = {w: i for w, i in self.known.items() if i < self.cache_kept}
        self.known = kept if len(kept) <= self.cache // 2 else {}
        self.starts = self.starts[: self.cache_kept + 1].copy()
        self.flat = self.flat[: self.starts[-1]].copy()

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _pieces(self, text: str) -> str | None:
        """Pieces with a space between, or nothing where the text has to go to
        the library as a whole."""
        if any(m in text for m in self.marks):
            return None
        if self.spaced:
            # A line's first word has no space before it: it keeps the line break.
            return None if " \n" in text else "\n" + text.replace("\n", " \n")
        if _ODD.search(text):
            return None
        flat = text.replace("\n", " ")
        plain = "  " not in flat and flat[0] != " " != flat[-1] and flat.isprintable()
        return flat if plain else " ".join(text.split())

    def _plain(self, piece: str) -> bool:
        body = piece[1:] if piece[:1] == "\n" else piece
        return bool(body) and not _ANY_WHITE.search(body)

    def _learn(self, pieces: set[str]) -> None:
        """Joins new words into texts in which their edges show in the ids: a
        word opens with its space or line break, or a mark stands between."""
        self.known.update(dict.fromkeys(pieces, -1))
        new = [p for p in pieces if not self.spaced or self._plain(p)]
        # Without spaces in the vocabulary, a word of letters ends where a token does.
        plain = [] if self.spaced else [p for p in new if p.isalpha()]
        other = new if self.spaced else [p for p in new if not p.isalpha()]
        groups = [(k, x[i : i + JOINED]) for k, x in ((True, plain), (False, other)) for i in range(0, len(x), JOINED)]
        if self.spaced:
            texts = ["".join(p if p[0] == "\n" else " " + p for p in g) for _, g in groups]
        else:
            texts = [(" " if k else " \x01 ").join(g) for k, g in groups]
        flats, starts, last = [self.flat], [self.starts], self.starts[-1]
        first = len(self.starts) - 1
        for (letters, group), found in zip(groups, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
            ids = np.array(found.ids, np.uint32)
            if self.spaced:
                edges = np.append(np.flatnonzero(self.opens[ids]), len(ids))
            elif letters:  # each word has an end at least, so as many ends as words are one each
                edges = np.append(0, np.flatnonzero(self.ends[ids]) + 1)
            else:
                at = np.flatnonzero(ids == self.mark)
                edges = np.append(0, np.append(at, len(ids)) - np.arange(len(at) + 1))
                ids = np.delete(ids, at)
            if len(edges) != len(group) + 1:  # a word that looks like several: ask for each
                each = [self._whole(p if p[0] == "\n" or not self.spaced else " " + p) for p in group]
                edges, ids = np.cumsum([0, *map(len, each)]), np.concatenate(each)
            self.known.update(zip(group, range(first, first + len(group))))
            first += len(group)
            starts.append(last + edges[1:].astype(np.int64))
            flats.append(ids)
            last += len(ids)
        self.starts, self.flat = np.concatenate(starts), np.concatenate(flats)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers."""
        if len(self.known) > self.cache:
            self._forget()
        split = [self._pieces(t) if t else "" for t in texts]
        some = [s for s in split if s]
        if not some:
            return [self._whole(t) if s is None else np.zeros(0, np.uint32) for t, s in zip(texts, split)]
        # Python sees each distinct piece of the batch once.
        numbers, distinct, _ = encoded(" ".join(some).encode())
        pieces = distinct.cast(pa.string()).to_pylist()
        new = {p for p in pieces if p not in self.known}
        if new:
            self._learn(new)
        known = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        at = known[numbers]
        ends = np.cumsum(np.fromiter((s.count(" ") + 1 for s in some), np.int64, len(some)))
        # Pieces that are not plain send their text to the library.
        lost = np.minimum.reduceat(at, np.append(0, ends[:-1])) < 0
        at = np.maximum(at, 0)
        start = self.starts[at]
        sizes = self.starts[at + 1] - start
        before = np.cumsum(sizes) - sizes
        ids = self.flat[np.repeat(start - before, sizes) + np.arange(int(sizes.sum()))]
        upto = np.append(before[np.append(0, ends[:-1])], len(ids)).tolist()
        skip = len(self.line) if self.spaced else 0
        out, k = [], 0
        for text, pieces in zip(texts, split):
            if not pieces:
                out.append(self._whole(text) if pieces is None else np.zeros(0, np.uint32))
                continue
            out.append(self._whole(text) if lost[k] else ids[upto[k] + skip : upto[k + 1]])
            k += 1
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)


def by_bytes(batch, column: str, most: int = 8 << 20):
    """Slices of an Arrow batch with about ``most`` bytes of text each, or one
    row; so the memory of a step does not depend on the batch."""
    start, held = 0, 0
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)
