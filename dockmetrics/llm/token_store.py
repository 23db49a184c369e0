"""Token-id shards with a minimal perfect hash index for keyed access.

Documents are range-partitioned and sorted by id; each range becomes one shard, in
ascending order:

* ``<shard>.ids``: the documents' ids one after another, little-endian unsigned integers of
  16 bits if the vocabulary fits, else of 32 (the index tells).
* ``<shard>.idx``: a minimal perfect hash of the shard's document keys, then per slot a
  32-bit fingerprint and the key's first row and number of rows, then per row
  its offset in the payload.

The hash has levels of bit maps (Limasset et al., "Fast and scalable minimal perfect
hashing"): a key is placed in the first level where no other key shares its bit; its slot
is the number of set bits before. A lookup computes a slot, compares the stored
fingerprint and reads one byte range, whatever the number of documents. A key that was
never stored is refused by its fingerprint, or in one of 2**32 cases taken for another.

Rows that share an id are neighbours and are returned together; a null id is a key of its
own, sorted first. A null text is an empty one and holds only the end id. The manifest
(one row per shard) is a table; lost executors repeat whole shards under new names.
"""

from __future__ import annotations

import json
import re
import struct
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenizers import Tokenizer

from dockmetrics.llm.bpe import Numbers, byte_symbols
from dockmetrics.llm.common import materialize, release_memory, shuffle_width, whole_text
from dockmetrics.llm.files import attempt_name, open_store, write_file

END_ID = 1
MAGIC = b"TOKIDX1\n"
NULL_KEY = -(1 << 63)
LEVELS, GAMMA = 64, 2.0

# --- minimal perfect hash --------------------------------------------------------


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) of keys and seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        sets = np.concatenate([*levels, np.zeros(0, bool)])
        self.rank = np.concatenate(([0], np.cumsum(sets)))
        self.starts = np.cumsum([0, *map(len, levels)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            if len(levels) == LEVELS:
                raise ValueError("keys are not distinct")
            size = max(8, int(GAMMA * len(left)))
            at = (_mix(left, len(levels)) % np.uint64(size)).astype(np.int64)
            single = np.bincount(at, minlength=size) == 1
            levels.append(single)
            left = left[~single[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level has its bit (then it isn't stored)."""
        slots = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for number, level in enumerate(self.levels):
            at = (_mix(keys[open_], number) % np.uint64(len(level))).astype(np.int64)
            hit = level[at]
            slots[open_[hit]] = self.rank[self.starts[number] + at[hit]]
            open_ = open_[~hit]
        return slots

    def to_bytes(self) -> bytes:
        sizes = [len(level) for level in self.levels]
        head = struct.pack(f"<I{len(sizes)}Q", len(sizes), *sizes)
        return head + b"".join(np.packbits(level).tobytes() for level in self.levels)

    @classmethod
    def read(cls, raw: bytes, at: int) -> tuple[PerfectHash, int]:
        (count,) = struct.unpack_from("<I", raw, at)
        sizes = struct.unpack_from(f"<{count}Q", raw, at + 4)
        at += 4 + 8 * count
        levels = []
        for size in sizes:
            bits = np.frombuffer(raw, np.uint8, -(-size // 8), at)
            levels.append(np.unpackbits(bits, count=size).astype(bool))
            at += -(-size // 8)
        return cls(levels), at


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 1000) >> np.uint64(32)).astype(np.uint32)


def index_bytes(keys: np.ndarray, offsets: np.ndarray, width: int) -> bytes:
    """``keys``: sorted, one per row; ``offsets``: row starts in the payload, in ids, and the
    end; ``width``: bytes of an id."""
    distinct, first, rows = np.unique(keys, return_index=True, return_counts=True)
    mph = PerfectHash.build(distinct.view(np.uint64))
    slots = mph.slots(distinct.view(np.uint64))
    table = np.zeros(len(distinct), [("print", "<u4"), ("rows", "<u4"), ("first", "<u8")])
    table["print"][slots] = _fingerprints(distinct.view(np.uint64))
    table["rows"][slots], table["first"][slots] = rows, first
    return b"".join(
        (MAGIC, struct.pack("<QQQ", len(distinct), len(keys), width), mph.to_bytes(), table.tobytes(), offsets.astype("<u8").tobytes())
    )


class Shard:
    """Keyed access to one shard's files."""

    def __init__(self, folder: str, name: str):
        self.store, base = open_store(folder)
        self.path = f"{base}/{name}"
        with self.store.open_input_stream(f"{self.path}.idx", compression=None) as file:
            raw = file.read()
        if raw[:8] != MAGIC:
            raise ValueError(f"{name} is no token index")
        slots, rows, self.width = struct.unpack_from("<QQQ", raw, 8)
        self.mph, at = PerfectHash.read(raw, 32)
        self.table = np.frombuffer(raw, [("print", "<u4"), ("rows", "<u4"), ("first", "<u8")], slots, at)
        self.offsets = np.frombuffer(raw, "<u8", rows + 1, at + self.table.nbytes).astype(np.int64)
        self.payload = self.store.open_input_file(f"{self.path}.ids")

    def rows_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of each key (0 rows: not stored)."""
        slots = self.mph.slots(keys.view(np.uint64))
        found = self.table[np.maximum(slots, 0)] if len(self.table) else np.zeros(len(keys), self.table.dtype)
        known = (slots >= 0) & (found["print"] == _fingerprints(keys.view(np.uint64)))
        return found["first"].astype(np.int64), np.where(known, found["rows"], 0).astype(np.int64)

    def ids(self, row: int) -> bytes:
        """The ids of a row as little-endian unsigned 32-bit integers."""
        start, end = int(self.offsets[row]), int(self.offsets[row + 1])
        raw = self.payload.read_at(self.width * (end - start), self.width * start)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4").tobytes()


# --- encoding --------------------------------------------------------------------

#: One word per line: Latin letters and ASCII punctuation behind them, or anything else.
_WORD_LINES = re.compile("^(?:([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-/:-@[-`{-~]*)|.+)$", re.MULTILINE)
#: Controls that str.split() takes for white space and Unicode doesn't.
_ODD = re.compile("[\x1c-\x1f]")
_ODD_WORDS = re.compile("[^ \t\n\r\x0b\x0c]+")
CACHE_WORDS = 400_000


class WordEncoder:
    """Encodes whole texts with the tokenizers library, each distinct word once.

    The vocabulary drops white space and never joins across it, so a text's ids are those
    of its words. Plain words (Latin letters, then ASCII punctuation) are lower-cased and
    given to the library's model together; all others go through its whole pipeline.
    Up to ``CACHE_WORDS`` words and those of one more slice are kept.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = spec["normalizer"]["normalizers"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [[step["type"] for step in part] for part in steps]
        if kinds != [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] or model["end_of_word_suffix"] != "</w>":
            raise ValueError("not a lower-casing vocabulary with word ends")
        words = spec | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.words = Tokenizer.from_str(json.dumps(words))
        top = max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
        self.type = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.ends = np.zeros(top + 1, bool)
        self.ends[[i for token, i in model["vocab"].items() if token.endswith("</w>")]] = True
        self.alphabet = {byte: symbol for symbol, byte in byte_symbols().items()}
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.pieces = Numbers(), {"": b""}
        self.flat, self.bounds = np.zeros(0, self.type), np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        if len(self.numbers) > CACHE_WORDS:
            self._forget()
        known, taken = len(self.numbers), []
        for text in texts:
            words = _ODD_WORDS.findall(text) if _ODD.search(text) else text.split()
            taken.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self._learn(list(islice(self.numbers, known, None)))
        lengths = np.diff(self.bounds)
        for words in taken:
            sizes = lengths[words]
            first = self.bounds[words] - (np.cumsum(sizes) - sizes)
            yield self.flat[np.repeat(first, sizes) + np.arange(int(sizes.sum()))]

    def _learn(self, words: list[str]) -> None:
        if not words:
            return
        split = _WORD_LINES.findall("\n".join(words))
        stems = "\n".join(stem for stem, _ in split).lower().split("\n")
        pieces = self.pieces
        fresh = list(dict.fromkeys(stem for stem in stems if stem not in pieces))
        pieces.update(zip(fresh, self._plain(fresh)))
        rest = [word for word, stem in zip(words, stems) if not stem]
        tails = list({tail for _, tail in split if tail not in pieces})
        encoded = self.whole.encode_batch_fast(rest + tails, add_special_tokens=False)
        raw = [np.array(e.ids, self.type).tobytes() for e in encoded]
        pieces.update(zip(tails, raw[len(rest) :]))
        others = iter(raw)
        learned = [pieces[stem] + pieces[tail] if stem else next(others) for stem, (_, tail) in zip(stems, split)]
        sizes = np.fromiter(map(len, learned), np.int64, len(learned)) // self.type.itemsize
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(sizes)))
        self.flat = np.concatenate((self.flat, np.frombuffer(b"".join(learned), self.type)))

    def _plain(self, stems: list[str]) -> list[bytes]:
        """The ids of plain lower-case words, which the library's model gets in one text."""
        if not stems:
            return []
        lined = (s if s.isascii() else s.encode().decode("latin-1").translate(self.alphabet) for s in stems)
        ids = np.array(self.words.encode(" ".join(lined), add_special_tokens=False).ids, self.type)
        bounds = [0, *((np.flatnonzero(self.ends[ids]) + 1) * self.type.itemsize).tolist()]
        if len(bounds) != len(stems) + 1:
            raise ValueError("a word has no or several ends")
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


# --- shards ----------------------------------------------------------------------

MANIFEST = "shard string, part int, first_key long, last_key long, rows long, tokens long"


def write_token_store(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int | None = None,
    slice_chars: int = 8_000_000,
) -> DataFrame:
    """Encodes all documents into shards below ``folder``; returns the manifest with
    ``start``, the number of ids in all shards before."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_KEY))
    rows = docs.select(key.alias("key"), whole_text(text_col).alias("text"))
    ranged = rows.repartitionByRange(shards or shuffle_width(docs.sparkSession), "key").sortWithinPartitions("key")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        sizes: list[int] = []

        def payload() -> Iterator[bytes]:
            encoder = _encoder(vocabulary)
            end = np.array([END_ID], encoder.type).tobytes()
            for batch in batches:
                keys.append(batch.column("key").to_numpy())
                for texts in _slices(batch.column("text"), slice_chars):
                    for ids in encoder.encode(texts):
                        sizes.append(len(ids) + 1)
                        yield ids.tobytes() + end
                release_memory()

        name = attempt_name("shard", "")
        write_file(folder, f"{name}.ids", payload())
        whole = np.concatenate([*keys, np.zeros(0, np.int64)])
        if not len(whole):
            return
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        write_file(folder, f"{name}.idx", [index_bytes(whole, offsets, _encoder(vocabulary).type.itemsize)])
        row = {"shard": name, "part": int(name.split("-")[1]), "first_key": int(whole[0]), "last_key": int(whole[-1])}
        row |= {"rows": len(whole), "tokens": int(offsets[-1])}
        yield pa.RecordBatch.from_pylist([row], _MANIFEST_ARROW)

    manifest = materialize(ranged.mapInArrow(write, MANIFEST), "token-manifest")
    # One small row per shard: their starts are a running sum in the order of the ranges.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


_MANIFEST_ARROW = pa.schema(
    [("shard", pa.string()), ("part", pa.int32()), ("first_key", pa.int64()), ("last_key", pa.int64()), ("rows", pa.int64()), ("tokens", pa.int64())]
)


def _slices(texts: pa.Array, most: int) -> Iterator[list[str]]:
    taken, size = [], 0
    for text in texts:
        taken.append(text.as_py())
        size += len(taken[-1])
        if size >= most:
            yield taken
            taken, size = [], 0
    if taken:
        yield taken


def lookup(manifest: DataFrame, folder: str, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """Per stored row of each key: key, ``start`` (ids of all documents before it), ``ids``.

    Keys are sorted so that a task opens few shards; the manifest (one row per shard) goes
    to the driver and with the tasks."""
    shards = sorted(
        ((r["part"], r["shard"], r["first_key"], r["last_key"], r["start"]) for r in manifest.collect())
    )
    firsts = [s[2] for s in shards]
    key = F.coalesce(F.col(key_col).cast("long"), F.lit(NULL_KEY))
    wanted = keys.select(key.alias("key")).distinct()
    wanted = wanted.repartitionByRange(max(len(shards), 1), "key").sortWithinPartitions("key")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[str, Shard] = {}
        for batch in batches:
            asked = batch.column("key").to_numpy()
            at = np.array([bisect_right(firsts, k) - 1 for k in asked.tolist()], np.int64)
            for number in np.unique(at):
                low = int(number)
                # rows of one key that fill whole shards: walk back to the first of them
                some = asked[at == number]
                for position in _shards_of(shards, low, some):
                    _, name, first, last, start = shards[position]
                    if name not in opened:
                        opened.clear()
                        opened[name] = Shard(folder, name)
                    yield from _rows(opened[name], some[(some >= first) & (some <= last)], start)

    found = wanted.mapInArrow(fetch, "key long, start long, ids binary")
    return found.select(F.when(F.col("key") != NULL_KEY, F.col("key")).alias(key_col), "start", "ids")


def _shards_of(shards: list, low: int, keys: np.ndarray) -> Iterator[int]:
    """The shards that may hold one of the keys: the last that begins at or before them,
    and those before it that end with the same key."""
    if low < 0:  # before the first shard, or there is none
        return
    least = int(keys.min())
    first = low
    while first > 0 and shards[first - 1][3] >= least:
        first -= 1
    yield from range(first, low + 1)


def _rows(shard: Shard, keys: np.ndarray, start: int) -> Iterator[pa.RecordBatch]:
    first, count = shard.rows_of(keys)
    out: list[dict] = []
    held = 0
    for key, row, n in zip(keys.tolist(), first.tolist(), count.tolist()):
        for i in range(row, row + n):
            out.append({"key": key, "start": start + int(shard.offsets[i]), "ids": shard.ids(i)})
            held += len(out[-1]["ids"])
            if held > 8_000_000:
                yield pa.RecordBatch.from_pylist(out, _ROWS_ARROW)
                out, held = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, _ROWS_ARROW)


_ROWS_ARROW = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
