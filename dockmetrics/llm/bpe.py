"""Byte-level BPE by a pair occurrence index.

All distinct words of a slice of texts are merged together. The index maps each
adjacent pair that has a merge rank to all its positions. Active ranks are applied
in ascending order: all occurrences of the pair are merged at once, the neighbours'
pairs are looked up and their positions are added to the lists of their ranks. A
merge only makes pairs of higher rank, so one ascending pass gives what merging each
word by its lowest rank gives. Stale positions are recognised by their symbols.

Texts are encoded whole, a null text as an empty one (no ids). The special token's
string in a text becomes its id. The vocabulary file's path is a parameter; the file
must be readable on every executor.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmetrics.llm.common import release_memory, whole_text

#: Texts are taken in slices of about so many characters, so that memory is bounded.
SLICE_CHARS = 6_000_000
#: Fixed value of the format: how byte-level BPE cuts text into words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same rule for texts without characters beyond U+00FF, where it runs faster.
LATIN_WORDS = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d"
    "| ?[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+"
    "| ?[0-9\xb2\xb3\xb9\xbc-\xbe]+"
    "| ?[^\\t-\\r \x85\xa0A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+"
    "|[\\t-\\r \x85\xa0]+(?![^\\t-\\r \x85\xa0])|[\\t-\\r \x85\xa0]+"
)


class Numbers(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _is_latin(text: str) -> bool:
    return text.isascii() or max(text) <= "\xff"


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairIndexBPE:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.none = max([*vocab.values(), *self.special.values()]) + 1  # no symbol
        self.width = self.none + 1
        of_byte = byte_symbols()
        self.byte_ids = np.zeros(256, np.int32)
        for symbol, byte in of_byte.items():
            self.byte_ids[byte] = vocab[symbol]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int32)
        self.right = np.array([vocab[b] for _, b in pairs], np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = self.left.astype(np.int64) * self.width + self.right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.tokens = [b""] * self.none
        for token, i in vocab.items():
            self.tokens[i] = bytes(of_byte[c] for c in token)
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 if it has none."""
        key = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.order[at], -1)

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and where each word's ids start (one more at the end)."""
        n = sum(map(len, words))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        starts = ends - np.diff(ends, prepend=0)
        # position n stands for "no neighbour"
        symbols = np.full(n + 1, self.none, np.int32)
        symbols[:n] = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        after = np.arange(1, n + 2, dtype=np.int32)
        before = np.arange(-1, n, dtype=np.int32)
        after[ends - 1], after[n] = n, n
        before[starts], before[n] = n, n
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []
        for begin in range(0, n, 1 << 20):
            at = np.arange(begin, min(n, begin + (1 << 20)), dtype=np.int32)
            self._add(index, heap, at, self.ranks(symbols[at], symbols[after[at]]))
        while heap:
            rank = heapq.heappop(heap)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            if len(at) > 1:
                at = np.sort(at)
                at = at[np.concatenate(([True], at[1:] != at[:-1]))]
            a, b, new = self.left[rank], self.right[rank], self.merged[rank]
            follower = after[at]
            live = (symbols[at] == a) & (symbols[follower] == b)
            at, follower = at[live], follower[live]
            if a == b and len(at) > 1:
                at, follower = _leftmost(at, follower)
            if not len(at):
                continue
            beyond = after[follower]
            symbols[at], symbols[follower] = new, self.none
            after[at], before[beyond] = beyond, at
            ahead = before[at]
            places = np.concatenate((ahead, at))
            found = self.ranks(symbols[places], symbols[np.concatenate((at, beyond))])
            self._add(index, heap, places, found)
        alive = symbols[:n] != self.none
        offsets = np.concatenate(([0], np.cumsum(alive)))
        return symbols[:n][alive], offsets[np.concatenate((starts, ends[-1:]))]

    @staticmethod
    def _add(index: dict, heap: list[int], places: np.ndarray, ranks: np.ndarray) -> None:
        known = ranks >= 0
        places, ranks = places[known], ranks[known]
        if not len(places):
            return
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        bounds = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for low, high in zip(bounds, bounds[1:]):
            rank = int(ranks[low])
            if rank in index:
                index[rank].append(places[low:high])
            else:
                index[rank] = [places[low:high]]
                heapq.heappush(heap, rank)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text. Special tokens stand between the words."""
        numbers = Numbers()
        taken: list[np.ndarray] = []
        for text in texts:
            parts = self.cut.split(text) if self.cut and self.cut.search(text) else [text]
            found = []
            for part in parts:
                if part in self.special:
                    found.append(np.array([-1 - self.special[part]], np.int32))
                else:
                    words = (LATIN_WORDS if _is_latin(part) else WORDS).findall(part)
                    found.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
            taken.append(found[0] if len(found) == 1 else np.concatenate(found))
        if not numbers:
            flat, bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)
        else:
            flat, bounds = self.merge_words([w.encode("utf-8", "surrogatepass") for w in numbers])
        # special tokens are words of their own, behind the others
        specials = sorted(self.special.values())
        place = {-1 - s: len(numbers) + i for i, s in enumerate(specials)}
        flat = np.concatenate((flat, np.array(specials, np.int32)))
        bounds = np.concatenate((bounds, bounds[-1] + 1 + np.arange(len(specials))))
        lengths = np.diff(bounds)
        for words in taken:
            if len(words) and words.min() < 0:
                for code in place:
                    words[words == code] = place[code]
            sizes = lengths[words]
            total = int(sizes.sum())
            first = bounds[words] - (np.cumsum(sizes) - sizes)
            yield flat[np.repeat(first, sizes) + np.arange(total)]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _leftmost(at: np.ndarray, follower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of overlapping occurrences (a run of one symbol) the leftmost ones."""
    taken, used = [], -1
    for i, (p, q) in enumerate(zip(at.tolist(), follower.tolist())):
        if p != used:
            taken.append(i)
            used = q
    return at[taken], follower[taken]


@lru_cache(maxsize=2)
def encoder(path: str) -> PairIndexBPE:
    return PairIndexBPE(path)


def text_slices(texts: Iterable[str], most: int = SLICE_CHARS) -> Iterator[list[str]]:
    taken, size = [], 0
    for text in texts:
        taken.append(text)
        size += len(text)
        if size >= most:
            yield taken
            taken, size = [], 0
    if taken:
        yield taken


def bpe_columns(text_col: str, path: str, keep_ids: bool = False):
    """A struct of ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for,
    ``ids`` (little-endian unsigned 32-bit integers) of a text column."""
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids

    @F.pandas_udf(fields)
    def encoded(texts: pd.Series) -> pd.DataFrame:
        bpe, rows = encoder(path), []
        for some in text_slices(texts):
            for ids in bpe.encode(some):
                raw = ids.astype("<u4").tobytes()
                decoded = bpe.decode(ids).encode("utf-8", "surrogatepass")
                row = (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest())
                rows.append((*row, raw) if keep_ids else row)
            release_memory()
        names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 3 + keep_ids]
        return pd.DataFrame(rows, columns=names)

    return encoded(whole_text(text_col))


def bpe_round_trip(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False
) -> DataFrame:
    """One row per document: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` (and ``ids``)."""
    rows = docs.select(F.col(id_col), bpe_columns(text_col, path, keep_ids).alias("encoded"))
    return rows.select(id_col, "encoded.*")
