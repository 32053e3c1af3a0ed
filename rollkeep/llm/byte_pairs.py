"""Byte-level BPE: pre-tokens found by scans over codepoint classes, their ids from cached pair merging.

The pattern's alternatives (contractions, letters, numbers, other signs, white space, each with a blank before it where
the pattern allows one) are a small automaton over classes of codepoints. A class, with what stands right after it, is a
function from state to state; composing functions is associative, and the functions that arise are few, so a table of
compositions turns the automaton into a scan: inside blocks first, over the blocks' totals next, then applied to all.
A boundary is a property of the state before a codepoint and its class. No regular expression is run.

Slices between boundaries go through a cache to pair merging by rank. Each document gives its ids and their end offsets
in bytes, so any run of ids can be cut out and decoded.

Defined results: a null text is empty, with no ids; repeated rows give repeated results; a null id stays null.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain, pairwise, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from rollkeep.llm.common import python_tasks, texts
from rollkeep.llm.encoders import PieceCache, coded_cuts, cut_array, different, grouped

# What can follow an apostrophe at the start of a pre-token: fixed values of the pattern.
SHORT = "stmd"
LONG = ("re", "ve", "ll")

# Codepoint classes. "Last" white space is followed by something else in the same document.
BLANK, BLANK_LAST, SPACE, SPACE_LAST, NUMBER, LETTER, SHORT_END, LONG_START, APOSTROPHE, OTHER = range(10)
CLASSES = 10
# States: what the current pre-token is.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, AFTER_SPACE, AT_APOSTROPHE, IN_LONG, ENDED = range(9)
STATES = 9
BLOCK = 128
# Codepoints scanned at once; a batch of texts is cut into such parts between documents.
PART = 1 << 20
# Up to this length a list of pairs is quicker than a heap.
SHORT_PIECE = 40
NO_RANK = 1 << 60


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The state after a codepoint of this class, and whether a pre-token starts at it."""
    if kind in (BLANK, BLANK_LAST, SPACE, SPACE_LAST):
        run = state in (AFTER_BLANK, AFTER_SPACE)
        return (AFTER_BLANK if kind in (BLANK, BLANK_LAST) else AFTER_SPACE), not run or kind in (BLANK_LAST, SPACE_LAST)
    if state == IN_LONG:
        return ENDED, False
    if kind == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_BLANK)
    if kind in (LETTER, SHORT_END, LONG_START):
        if state == AT_APOSTROPHE and kind != LETTER:
            return (ENDED if kind == SHORT_END else IN_LONG), False
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_BLANK)
    joined = state in (IN_OTHERS, AT_APOSTROPHE, AFTER_BLANK)
    if kind == APOSTROPHE and not joined:
        return AT_APOSTROPHE, True
    return IN_OTHERS, not joined


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Function of each (class, first in its document), compositions of all functions, their values, boundaries."""
    moves = [tuple(_step(s, k)[0] for s in range(STATES)) for k in range(CLASSES)]
    moves += [(_step(START, k)[0],) * STATES for k in range(CLASSES)]
    number: dict[tuple[int, ...], int] = {}
    for f in moves:
        number.setdefault(f, len(number))
    todo = list(number)
    while todo:
        f = todo.pop()
        for g in moves:
            for h in (tuple(g[x] for x in f), tuple(f[x] for x in g)):
                if h not in number:
                    number[h] = len(number)
                    todo.append(h)
    closed = list(number)
    compose = np.zeros((len(closed), len(closed)), dtype=np.uint16)
    for (i, f), (j, g) in product(enumerate(closed), repeat=2):
        compose[i, j] = number[tuple(g[x] for x in f)]
    values = np.array(closed, dtype=np.uint8)
    starts = np.array([[_step(s, k)[1] for k in range(CLASSES)] for s in range(STATES)])
    return np.array([number[f] for f in moves], dtype=np.uint16), compose, values, starts


def _before(functions: np.ndarray) -> np.ndarray:
    """State before each element, from START, by a blocked scan of compositions."""
    _, compose, values, _ = _tables()
    n, width = len(functions), len(compose)
    flat, value = compose.ravel(), values.ravel()
    blocks = -(-n // BLOCK)
    if blocks <= 1:
        state, out = START, np.empty(n, dtype=np.uint8)
        for i, f in enumerate(functions.tolist()):
            out[i] = state
            state = values[f, state]
        return out
    padded = np.zeros(blocks * BLOCK, dtype=np.uint16)
    padded[:n] = functions
    columns = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    for j in range(1, BLOCK):
        columns[j] = flat[columns[j - 1].astype(np.int32) * width + columns[j]]
    first = _before(columns[-1])
    out = np.empty((BLOCK, blocks), dtype=np.uint8)
    out[0] = first
    for j in range(1, BLOCK):
        out[j] = value[columns[j - 1].astype(np.int32) * STATES + first]
    return np.ascontiguousarray(out.T).ravel()[:n]


def _every() -> str:
    return "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))


def _by_tiktoken(pattern: str) -> str:
    import tiktoken

    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    return probe.decode(probe.encode_ordinary(_every()))


def _by_tokenizers(pattern: str) -> str:
    from tokenizers import Regex, pre_tokenizers

    probe = pre_tokenizers.Split(Regex(f"(?:{pattern})+"), "removed", invert=True)
    return "".join(piece for piece, _ in probe.pre_tokenize_str(_every()))


@functools.cache
def class_table_of(path: str) -> np.ndarray:
    """Class of every codepoint, as the library of this file itself sees letters, numbers and white space."""
    matched = _by_tokenizers if path.endswith(".json") else _by_tiktoken
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        table[np.frombuffer(matched(pattern).encode("utf-32-le"), dtype="<u4")] = kind
    table[ord(" ")], table[ord("'")] = BLANK, APOSTROPHE
    for letter in SHORT:
        table[ord(letter)] = SHORT_END
    return table


def boundaries(points: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each codepoint; ``first``: places where documents begin."""
    n = len(points)
    kinds = table[points]
    head = np.zeros(n, dtype=bool)
    head[first] = True
    # What follows, unless it belongs to the next document.
    after = np.zeros(n, dtype=np.uint32)
    after[:-1] = points[1:]
    inside = np.zeros(n, dtype=bool)
    inside[:-1] = ~head[1:]
    blank = (kinds == BLANK) | (kinds == SPACE)
    last = np.zeros(n, dtype=bool)
    last[:-1] = blank[:-1] & ~blank[1:]
    kinds = kinds + (last & inside)
    for a, b in LONG:
        kinds[(points == ord(a)) & (after == ord(b)) & inside] = LONG_START
    functions = _tables()[0][kinds + CLASSES * head]
    starts = _tables()[3][_before(functions), kinds]
    starts[first] = True
    return starts


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(piece[i : i + 2], NO_RANK) for i in range(len(piece) - 1)]
    while pairs and (least := min(pairs)) < NO_RANK:
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NO_RANK)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], NO_RANK)
    return [ranks[part] for part in parts]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank joins first, the leftmost of equals, by a heap over linked parts."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    if n <= SHORT_PIECE:
        return _merge_short(piece, ranks)
    ends, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        end = ends[after[i]]
        if (r := ranks.get(piece[i:end])) is not None:
            heapq.heappush(heap, (r, i, end - i))

    while heap:
        _, i, size = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or ends[after[i]] - i != size:
            continue  # one of its parts has changed since
        j = after[i]
        alive[j], ends[i], after[i] = False, ends[j], after[j]
        if after[i] < n:
            before[after[i]] = i
            offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : ends[i]]])
        i = after[i]
    return out


@functools.cache
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def _cut(parts: list[str], table: np.ndarray) -> tuple[bytes, np.ndarray, list[int]]:
    """The bytes of all texts, where in them the pre-tokens start and the last one ends, and how many pre-tokens are before
    the end of each text, from 0 on."""
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    points, ends = np.frombuffer("".join(parts).encode("utf-32-le"), dtype="<u4"), np.cumsum(lengths)
    if not len(points):
        return b"", np.zeros(1, dtype=np.int64), [0] * (len(parts) + 1)
    at = np.flatnonzero(boundaries(points, (ends - lengths)[lengths > 0], table))
    return *coded_cuts(points, at), [0, *np.searchsorted(at, ends).tolist()]


def slices(parts: list[str], table: np.ndarray) -> list[list[bytes]]:
    """The pre-tokens of each text."""
    coded, cuts, of = _cut(parts, table)
    pieces = [coded[a:b] for a, b in pairwise(cuts.tolist())]
    return [pieces[a:b] for a, b in pairwise(of)]


def different_slices(parts: list[str], table: np.ndarray) -> tuple[list[bytes], list[list[int]]]:
    """The different pre-tokens of the texts, and for each text the places of its own among them."""
    coded, cuts, of = _cut(parts, table)
    known, places = different(cut_array(coded, cuts))
    return known, [places[a:b] for a, b in pairwise(of)]


class BytePairs:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str):
        self.ranks, self.table = ranks_of(path), class_table_of(path)
        self.cache = PieceCache(lambda pieces: [tuple(merge(p, self.ranks)) for p in pieces])
        # All tokens one after the other, and where each id's lies among them.
        self.size = np.zeros(max(self.ranks.values()) + 1, dtype=np.int64)
        by_rank = sorted(self.ranks.items(), key=lambda x: x[1])
        for token, rank in by_rank:
            self.size[rank] = len(token)
        self.begin = np.cumsum(self.size) - self.size
        self.tokens = np.frombuffer(b"".join(token for token, _ in by_rank), dtype=np.uint8)

    def encode(self, values: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in values]
        for group in grouped(values, PART):
            for (i, _), pieces in zip(group, slices([part for _, part in group], self.table)):
                out[i].extend(chain.from_iterable(self.cache.all(pieces)))
        return out

    def ends(self, ids: list[int]) -> np.ndarray:
        """Where each id's bytes end in the decoded bytes."""
        return np.cumsum(self.size[np.array(ids, dtype=np.int64)])

    def between(self, ids: np.ndarray, ends: np.ndarray, start: int, stop: int) -> bytes:
        """Bytes ``start`` to ``stop`` of the text; only ids that the offsets place there are decoded."""
        first, last = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
        begin = int(ends[first - 1]) if first else 0
        some, upto = ids[first:last], ends[first:last] - begin
        sizes = np.diff(upto, prepend=0)
        if not np.array_equal(sizes, self.size[some]):
            raise ValueError("ids and end offsets differ")
        # Each id's bytes go where its offsets say.
        place = np.repeat(self.begin[some] - (upto - sizes), sizes) + np.arange(int(upto[-1]) if len(upto) else 0)
        return self.tokens[place][start - begin : stop - begin].tobytes()

    def decode(self, ids: list[int], ends: np.ndarray, step: int = PART) -> Iterator[bytes]:
        """The text in pieces of ``step`` bytes, found by the offsets."""
        listed, size = np.array(ids, dtype=np.int64), int(ends[-1]) if len(ends) else 0
        if len(listed) != len(ends):
            raise ValueError("ids and end offsets differ")
        for start in range(0, size, step):
            yield self.between(listed, ends, start, min(size, start + step))


@functools.cache
def coder(path: str) -> BytePairs:
    return BytePairs(path)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids and the end offset in bytes of each id."""
    python_tasks(docs.sparkSession, 256)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = coder(path)
        for batch in batches:
            ids = pairs.encode(list(batch["text"]))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": ids, "ends": [pairs.ends(x) for x in ids]})

    return texts(docs, key, text).mapInPandas(run, "doc_id long, ids array<int>, ends array<long>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the decoded bytes of its ids, each placed by its offsets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = coder(path)
        for batch in batches:
            data = [b"".join(pairs.decode(x, np.asarray(e))) for x, e in zip(batch["ids"], batch["ends"])]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "data": data})

    return encoded.mapInPandas(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, and decode by the offsets that encoding gives, in one pass: doc_id, n_tokens and digests of the ids and of the
    decoded bytes."""
    python_tasks(docs.sparkSession, 256)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = coder(path)
        for batch in batches:
            rows = []
            for ids in pairs.encode(list(batch["text"])):
                listed, decoded = ",".join(map(str, ids)).encode(), hashlib.sha256()
                for piece in pairs.decode(ids, pairs.ends(ids)):
                    decoded.update(piece)
                rows.append((len(ids), hashlib.sha256(listed).hexdigest(), decoded.hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            yield out.assign(doc_id=batch["doc_id"].to_numpy())[["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]]

    return texts(docs, key, text).mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
