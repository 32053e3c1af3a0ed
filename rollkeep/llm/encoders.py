"""Tokenizer files of public libraries inside tasks, with a bounded cache from pieces of text to ids.

A word-level BPE that drops white space gives each run of other characters the same ids wherever it stands, and a
byte-level BPE gives each match of its pattern the same ids, so a worker encodes a piece once and looks it up after
that. Arrow finds the different pieces of a batch, and only these become Python objects and are looked up. The cache has
two generations of limited size; nothing depends on what it holds.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from itertools import pairwise
from weakref import WeakSet

import numpy as np
import pyarrow as pa

from rollkeep.llm.common import give_back

_CUT = re.compile(r"[^\s](?=[ \n])")


def sections(text: str, size: int = 1 << 18) -> Iterator[str]:
    """A very long text in parts, cut only where white space follows something else, which no pattern here spans."""
    at = 0
    while len(text) - at > size:
        found = _CUT.search(text, at + size)
        if not found:
            break
        yield text[at : found.end()]
        at = found.end()
    yield text[at:] if at else text


def grouped(values: list[str], size: int) -> Iterator[list[tuple[int, str]]]:
    """Sections of the texts, numbered by text, in groups of about so many characters."""
    group, held = [], 0
    for i, text in enumerate(values):
        for part in sections(text):
            group.append((i, part))
            held += len(part)
            if held >= size:
                yield group
                group, held = [], 0
    if group:
        yield group


_CACHES: WeakSet[PieceCache] = WeakSet()


def forget() -> None:
    """Drop this worker's tokenizers and their caches. Spark gives a worker to the next operator's tasks, which need the memory."""
    held = [make for make in (word_encoder, piece_encoder, word_counter) if make.cache_info().currsize]
    full = [cache for cache in _CACHES if cache.young or cache.old]
    for cache in full:
        cache.young, cache.old = {}, {}
    for make in held:
        make.cache_clear()
    if held or full:
        give_back()


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that begins without other operators' caches and ends by returning its own memory."""

    def tidied(batches: Iterator) -> Iterator:
        forget()
        yield from run(batches)
        give_back()

    return tidied


class PieceCache:
    """What ``encode`` gives for each piece, kept for the pieces met lately."""

    def __init__(self, encode: Callable[[list[bytes]], list], limit: int = 600_000):
        self.encode, self.limit = encode, limit
        self.young: dict[bytes, object] = {}
        self.old: dict[bytes, object] = {}
        _CACHES.add(self)

    def all(self, pieces: list[bytes]) -> list:
        found = list(map(self.young.get, pieces))
        if None in found:
            missed = dict.fromkeys(p for p, value in zip(pieces, found) if value is None)
            new = {p: self.old[p] for p in missed if p in self.old}
            unknown = [p for p in missed if p not in new]
            new.update(zip(unknown, self.encode(unknown)))
            if len(self.young) + len(new) > self.limit:
                self.young, self.old = {}, self.young
            self.young.update(new)
            found = [new[p] if value is None else value for p, value in zip(pieces, found)]
        return found


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.array(ids, dtype="<u4").tobytes()


def different(pieces: pa.Array) -> tuple[list[bytes], list[int]]:
    """The different pieces of an array with 64-bit offsets, and for each piece its place among them."""
    coded = pieces.dictionary_encode()
    _, offsets, data = coded.dictionary.buffers()
    ends = np.frombuffer(offsets, dtype="<i8", count=len(coded.dictionary) + 1).tolist()
    held = data.to_pybytes() if data is not None else b""
    return [held[a:b] for a, b in pairwise(ends)], coded.indices.to_numpy().tolist()


LAST_LATIN = "\u017e"  # up to here, letters that stay letters have one lower-case form each, and need no composing
LETTER, NUMBER, SIGN, BLANK, ODD = range(5)


def _latin() -> tuple[np.ndarray, np.ndarray, re.Pattern]:
    """Class and lower-case form of each codepoint up to LAST_LATIN, and of one that stands for all others; a pattern for
    the odd ones, which only the library may split or change: not Latin, or part of a contraction or of a special token."""
    some = [chr(i) for i in range(ord(LAST_LATIN) + 1)]
    kinds, lower = np.full(len(some) + 1, ODD, dtype=np.uint8), np.arange(len(some) + 1, dtype="<u4")
    for i, c in enumerate(some):
        if c.isalpha() and len(c.lower()) == 1:
            kinds[i], lower[i] = LETTER, ord(c.lower())
        elif c in "0123456789":
            kinds[i] = NUMBER
        elif c in " \t\n\x0b\x0c\r":
            kinds[i] = BLANK
        elif c.isascii() and c.isprintable() and c not in "'<":
            kinds[i] = SIGN
    plain = "".join(c for c, kind in zip(some, kinds) if kind != ODD)
    return kinds, lower, re.compile(f"[^{re.escape(plain)}]")


KINDS, LOWER, ODD_SIGN = _latin()


def _byte_names() -> dict[int, int]:
    """The sign that a byte-level vocabulary writes each byte as: itself if it is printed, else one from 256 on."""
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printed]
    return {b: b for b in printed} | {b: 256 + n for n, b in enumerate(others)}


BYTE_NAMES = _byte_names()
BLANK_NAME = chr(BYTE_NAMES[0x20])
if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are packed as the machine's own 32-bit integers, which must be little-endian")


def coded_cuts(points: np.ndarray, at: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bytes of codepoints, and where in them those at ``at`` begin and the last one ends."""
    coded = points.tobytes().decode("utf-32-le").encode()
    if len(coded) != len(points):
        width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        at = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[at]
    return coded, np.append(at, len(coded))


def cut_array(coded: bytes, cuts: np.ndarray) -> pa.Array:
    """The bytes between each cut and the next, none of them copied."""
    offsets = pa.py_buffer(np.ascontiguousarray(cuts, dtype="<i8"))
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(coded)])


def word_pieces(texts: list[str]) -> tuple[pa.Array, list[int]]:
    """What stands between ASCII white space, cut into pre-tokens in lower case unless it holds an odd sign; and how many
    pieces are before the end of each text, from 0 on."""
    lengths = np.array([len(text) for text in texts], dtype=np.int64)
    points, ends = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4"), np.cumsum(lengths)
    place = np.minimum(points, len(KINDS) - 1)
    kinds = KINDS[place]
    kept = kinds != BLANK
    word = kept.copy()
    word[1:] &= ~kept[:-1]
    first = (ends - lengths)[lengths > 0]
    word[first] = kept[first]
    ends = np.concatenate([[0], np.cumsum(kept)])[ends]
    points, place, kinds, word = points[kept], place[kept], kinds[kept], word[kept]
    start, small, odd = kinds == NUMBER, LOWER[place], kinds == ODD
    start[1:] |= kinds[1:] != kinds[:-1]
    if odd.any():
        number = np.cumsum(word) - 1
        whole = np.zeros(number[-1] + 1, dtype=bool)
        whole[number[odd]] = True
        inside = whole[number]
        start, small = start & ~inside, np.where(inside, points, small)
    at = np.flatnonzero(start | word)
    return cut_array(*coded_cuts(small, at)), [0, *np.searchsorted(at, ends).tolist()]


class PieceEncoder:
    """Packed ids of pieces. Pre-tokens go to the library's merging right away; pieces in which ``odd`` finds a sign take the
    library's way through normalising and splitting."""

    def __init__(self, tokenizer, odd: re.Pattern | None = None):
        self.tokenizer, self.tokenize, self.odd = tokenizer, tokenizer.model.tokenize, odd

    def merged(self, piece: bytes) -> bytes:
        named = piece.decode("latin-1")
        # Of the printed ASCII signs the vocabulary writes only the blank as another one.
        named = named.replace(" ", BLANK_NAME) if named.isascii() and named.isprintable() else named.translate(BYTE_NAMES)
        return array("I", [token.id for token in self.tokenize(named)]).tobytes()

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        if self.odd is None:
            return list(map(self.merged, pieces))
        out = [self.merged(piece) if piece.isalpha() or not self.odd.search(piece.decode()) else None for piece in pieces]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, found in zip(rest, self.tokenizer.encode_batch_fast([pieces[i].decode() for i in rest], add_special_tokens=False)):
            out[i] = packed(found.ids)
        return out


GROUP = 1 << 21  # characters of texts whose pieces are looked up together, about


def _looked_up(texts: list[str], lookup: Callable[[list[bytes]], list]) -> Iterator[tuple[int, list]]:
    """For each section of the texts the number of its text and what its pieces are looked up as; many in one go."""
    for group in grouped(texts, GROUP):
        pieces, ends = word_pieces([part for _, part in group])
        known, places = different(pieces)
        values = lookup(known)
        for (i, _), (a, b) in zip(group, pairwise(ends)):
            yield i, [values[place] for place in places[a:b]]


@functools.cache
def word_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Packed ids of texts by a tokenizers file whose white space is dropped."""
    cache = PieceCache(PieceEncoder(_library(path), ODD_SIGN), limit=400_000)

    def encode(texts: list[str]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        for i, ids in _looked_up(texts, cache.all):
            out[i].append(b"".join(ids))
        return [b"".join(parts) for parts in out]

    return encode


@functools.cache
def piece_encoder(path: str) -> tuple[Callable[[list[bytes]], list[bytes]], Callable[[str], bytes], tuple[str, ...]]:
    """For a byte-level tokenizers file without normaliser: packed ids of pre-tokens, packed ids of a whole text, and its
    special strings."""
    tokenizer = _library(path)
    if tokenizer.normalizer is not None:
        raise ValueError("pre-tokens of a tokenizer that changes texts first have no ids of their own")
    special = tuple(str(t) for t in tokenizer.get_added_tokens_decoder().values())
    # Fewer pieces than words get: workers of a pipeline hold other operators' memory too.
    return PieceCache(PieceEncoder(tokenizer), limit=150_000).all, lambda text: packed(tokenizer.encode(text, add_special_tokens=False).ids), special


@functools.cache
def word_counter(path: str) -> Callable[[list[str]], list[int]]:
    """Number of ids of texts: by pieces for a tokenizers file that drops white space, whole for a sentencepiece model."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(model.encode(text)) for text in texts]
    encode = PieceEncoder(_library(path), ODD_SIGN)
    cache = PieceCache(lambda pieces: [len(ids) // 4 for ids in encode(pieces)], limit=400_000)

    def count(texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        for i, counts in _looked_up(texts, cache.all):
            out[i] += sum(counts)
        return out

    return count


@functools.cache
def version(path: str) -> str:
    """Digest of a tokenizer's file and of its library's version."""
    import sentencepiece
    import tokenizers

    library = sentencepiece.__version__ if path.endswith(".model") else tokenizers.__version__
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + library.encode()).hexdigest()
