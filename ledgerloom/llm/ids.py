"""Token ids of whole texts by a public tokenizer file.

The tokenizers library encodes each distinct run between two spaces once; texts are put
together from the ids of their runs, the texts of a slice side by side (Arrow). That gives
the ids of the whole text, because both splitting rules in use never put a space and the
character before it into one piece. Nor do they with the end of a line that has no white
space before it: a run ends there too, so that the last word of a line and the first of the
next are not one more run. Where another white space character stands before a space, or
where exotic white space occurs, larger pieces or the whole text go to the library. So does
a text with the name of a special token, in any case, since the library may put that
token's id in its place.

A tokenizer that drops case and white space needs fewer runs: a text of Latin letters is
put in lower case and cut at all its white space first.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import islice, pairwise
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_SPACE_BEFORE_SPACE = re.compile(r" (?<=\s )")
_EXOTIC = re.compile(r"[^\S \t\r\n]")
_RUNS = re.compile(r"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+")
_LINE_END = re.compile(r"\n(?<=\S\n)")
#: Beyond these, case, composed letters or white space may differ between Python and a library.
_NOT_LATIN = re.compile(r"[^\0-\x1b\x20-\x84\x86-\x9f\xa1-\u02ff]")

#: Runs kept in memory by a worker, beyond which only the first half stays: what is frequent is met early.
KEPT_RUNS = 1_000_000
#: Texts of a slice: each distinct run of a slice is looked up once.
SLICE = 256
#: Runs that the library gets at once, with a mark between them.
AT_ONCE = 128
#: Also put before a run that follows no space.
MARK = "\x01"
#: Marks after a word that every splitting rule in use cuts off it, in one piece.
CUT_OFF = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _stays_letters(word: str) -> bool:
    """Letters only, and still so when a tokenizer has composed them and put them in lower case."""
    return word.isalpha() and (word.isascii() or normalize("NFC", word.lower()).isalpha())


def runs(text: str) -> tuple[list[str], list[str]]:
    """Cuts a text where every splitting rule in use cuts it too: whole pieces first,
    then the runs that each follow one space (the space is left out)."""
    if not _SPACE_BEFORE_SPACE.search(text):
        first, *rest = text.split(" ")
        return ([first] if first else []), rest
    if not _EXOTIC.search(text):
        return _RUNS.findall(text), []
    return [text], []


class Encoder:
    """Texts to ids, as little-endian unsigned integers of 2 or 4 bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = re.compile("|".join(re.escape(t.content) for t in added) or r"(?!)", re.IGNORECASE)
        self.width = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # ids that end a word ("...</w>") or, in the other vocabularies, start one after a space
        vocabulary = self.tokenizer.get_vocab()
        self.edge_is_end = sum(token.endswith("</w>") for token in vocabulary) > len(vocabulary) // 10
        self.at_edge = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.at_edge[i] = token.endswith("</w>") if self.edge_is_end else token.startswith("\u0120")
        self.mark = self._ids([" " + MARK])[0]
        apart, folded, *letters = self._ids(["A \t\nB", "a b", "a", "b"])
        self.folds = apart == folded == sum(letters, [])
        self.pieces: dict[str, bytes] = {"": b""}
        self.spaced: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_pieces(self, new: Iterable[str]) -> None:
        new = list(new)
        for piece, ids in zip(new, self._ids(new), strict=True):
            self.pieces[piece] = np.array(ids, self.width).tobytes()

    def _learn_spaced(self, new: Iterable[str]) -> None:
        new = list(new)
        words, plain, odd, marked = {run for run in new if run.isalpha()}, [], [], []
        for run in new:
            if run in words:
                continue
            word = run.rstrip(CUT_OFF)
            if word != run and _stays_letters(word):
                marked.append((run, word, run[len(word) :]))
            elif not run or MARK in run or run[-1].isspace():
                odd.append(run)
            else:
                plain.append(run)
        words.update(word for _, word, _ in marked if word not in self.spaced)
        words = list(words)
        for i in range(0, len(words), AT_ONCE):
            part = words[i : i + AT_ONCE]
            ids = np.array(self._ids(["".join(f" {word}" for word in part)])[0], self.width)
            cuts = np.flatnonzero(self.at_edge[ids]) + self.edge_is_end
            if len(cuts) != len(part):  # not every word is one piece
                plain += part
                continue
            bounds = np.append([0], cuts) if self.edge_is_end else np.append(cuts, len(ids))
            bounds, data = (bounds * self.width.itemsize).tolist(), ids.tobytes()
            self.spaced.update(zip(part, map(data.__getitem__, map(slice, bounds, bounds[1:])), strict=True))
        for i in range(0, len(plain), AT_ONCE):
            part = plain[i : i + AT_ONCE]
            ids = np.array(self._ids(["".join(f" {run} {MARK}" for run in part)])[0], self.width)
            start = 0
            for run, at in zip(part, np.flatnonzero(ids == self.mark[-1]).tolist(), strict=True):
                self.spaced[run] = ids[start : at + 1 - len(self.mark)].tobytes()
                start = at + 1
        texts = [run[1:] if run.startswith(MARK) else " " + run for run in odd]
        for run, ids in zip(odd, self._ids(texts), strict=True):
            self.spaced[run] = np.array(ids, self.width).tobytes()
        self._learn_pieces({marks for _, _, marks in marked}.difference(self.pieces))
        for run, word, marks in marked:
            self.spaced[run] = self.spaced[word] + self.pieces[marks]

    def _cut(self, text: str) -> str | list[str]:
        """The text's runs with one space between them, those that follow no space after a
        mark; or, where it can't be cut that way, whole pieces."""
        if MARK in text or self.added.search(text):
            return [text]
        if self.folds and not _NOT_LATIN.search(text):
            return " ".join(text.lower().split())
        if not _SPACE_BEFORE_SPACE.search(text):
            return MARK + _LINE_END.sub(f" {MARK}\n", text)
        return runs(text)[0]

    def _together(self, texts: list[str]) -> list[memoryview]:
        """The ids of texts that are cut at spaces."""
        if not texts:
            return []
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        found = cut.values.dictionary_encode()
        runs = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn_spaced(run for run in runs if run not in self.spaced)
        ids = pa.array(map(self.spaced.__getitem__, runs), pa.large_binary()).take(found.indices)
        _, ends, data = ids.buffers()
        bounds = np.frombuffer(ends, np.int64)[np.asarray(cut.offsets)].tolist()
        view = memoryview(data or b"")
        return [view[a:b] for a, b in pairwise(bounds)]

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        """The ids of each text, and the id ``end`` after them."""
        out: list[bytes] = []
        last = np.array([end], self.width).tobytes()
        for i in range(0, len(texts), SLICE):
            cut = [self._cut(text) for text in texts[i : i + SLICE]]
            if len(self.spaced) > KEPT_RUNS:
                self.spaced = dict(islice(self.spaced.items(), KEPT_RUNS // 2))
            if len(self.pieces) > KEPT_RUNS // 10:
                self.pieces = {"": b""}
            whole = [c for c in cut if isinstance(c, list)]
            self._learn_pieces(set().union(*whole).difference(self.pieces))
            spaced = iter(self._together([c for c in cut if isinstance(c, str)]))
            for c in cut:
                ids = [next(spaced)] if isinstance(c, str) else map(self.pieces.__getitem__, c)
                out.append(b"".join([*ids, last]))
        return out


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """A worker's encoder, with the runs that its earlier tasks have met. What it keeps
    saves work only; ids are the same without it."""
    return Encoder(path)
