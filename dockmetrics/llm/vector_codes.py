"""Vector code compression: product codes, assigned by slice and intersect bitmasks.

Vectors are scaled to integers and cut into equal parts; each part is replaced by the
index of the nearest of up to 64 entries of that part's codebook. All arithmetic is in
integers, so results do not depend on how rows are dealt.

Nearest entries come from bitmasks. For each dimension the entries' coordinates are sorted,
and prefix masks say which entries stand before each place in that order. The distance to
an entry that is close along one dimension is an initial radius; in each dimension the
coordinates within it form a slice of the order, whose entries are the difference of two
prefix masks, and the AND of these over all dimensions holds every entry within the
radius. Only those are measured, ties going to the lower index.

A training round is one pass: tasks add up counts and sums per part and entry, Spark adds
those up, and a table of parts x entries rows, of one size for any input, reaches the driver.

Rows whose vector is null, or holds null or non-finite components, are dropped. Shorter
vectors count as filled up with zeros to the length of the longest, and that is
rounded up to a multiple of the parts. Integers beyond what keeps a whole vector's squared
distance within 63 bits (about 190 million at 64 dimensions) are cut off there. Null
ids come after all others; rows of one id are ordered by their vector, and repeated rows
each count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockmetrics.llm.common import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Rows that are assigned at a time.
SLICE_ROWS = 4_096


@dataclass(frozen=True)
class Codebooks:
    """Integer entries by part, entry and position within the part."""

    entries: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all components as decimals, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


class PartIndex:
    """Sorted coordinates of one codebook with prefix masks of its entries."""

    def __init__(self, entries: np.ndarray):
        if len(entries) > 64:
            raise ValueError("a mask holds at most 64 entries")
        self.entries = entries
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.values = np.take_along_axis(entries, self.order, axis=0)
        bits = np.uint64(1) << self.order.astype(np.uint64)
        self.prefix = np.zeros((len(entries) + 1, entries.shape[1]), np.uint64)
        np.bitwise_or.accumulate(bits, axis=0, out=self.prefix[1:])

    def _measure(self, x: np.ndarray, entry: np.ndarray | int) -> np.ndarray:
        return np.square(x - self.entries[entry]).sum(axis=1)

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """Masks of entries that hold the nearest of each row, and all that tie with it."""
        n, dims = x.shape
        best = np.full(n, np.iinfo(np.int64).max)
        for d in range(dims):
            at = np.searchsorted(self.values[:, d], x[:, d])
            np.minimum(best, self._measure(x, self.order[np.minimum(at, len(self.entries) - 1), d]), out=best)
        radius = np.ceil(np.sqrt(best.astype(np.float64))).astype(np.int64) + 1
        mask = np.full(n, ~np.uint64(0))
        for d in range(dims):
            low = np.searchsorted(self.values[:, d], x[:, d] - radius, side="left")
            high = np.searchsorted(self.values[:, d], x[:, d] + radius, side="right")
            mask &= self.prefix[high, d] & ~self.prefix[low, d]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each row."""
        mask = self.candidates(x)
        best = np.full(len(x), np.iinfo(np.int64).max)
        index = np.zeros(len(x), np.int64)
        for entry in range(len(self.entries)):
            rows = np.flatnonzero(mask >> np.uint64(entry) & np.uint64(1))
            distance = self._measure(x[rows], entry)
            closer = distance < best[rows]
            best[rows[closer]] = distance[closer]
            index[rows[closer]] = entry
        return index, best


def _matrix(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    """Integer components, a row per vector, filled up with zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), width), np.int64)
    bound = float(_bound(width))
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(values * scale), -bound, bound).astype(np.int64)
    out[np.arange(width) < lengths[:, None]] = whole
    return out


def _bound(width: int) -> int:
    return (isqrt((2**63 - 1) // max(width, 1)) - 1) // 2


def _assigned(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, squared distances), a column per part."""
    parts, _, dims = entries.shape
    index, distance = (np.zeros((len(x), parts), np.int64) for _ in range(2))
    for p in range(parts):
        part = PartIndex(entries[p])
        for begin in range(0, len(x), SLICE_ROWS):
            rows = slice(begin, begin + SLICE_ROWS)
            index[rows, p], distance[rows, p] = part.nearest(x[rows, p * dims : (p + 1) * dims])
    return index, distance


def usable_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(id, label, vector) of the rows that are not dropped."""
    vector = F.col(vector_col).cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.filter(F.col(vector_col).isNotNull() & ~bad)
    return kept.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector"))


def fit_codebooks(
    kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Codebooks | None:
    """Codebooks after the given rounds over all rows of ``usable_vectors``; None without rows."""
    longest = kept.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return None
    dims = max(1, -(-longest // parts))
    start = kept.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()
    first = _matrix(pa.array([r[0] for r in start], pa.list_(pa.float64())), parts * dims, scale)
    book = np.ascontiguousarray(first.reshape(len(first), parts, dims).transpose(1, 0, 2))
    for _ in range(rounds):
        book = _round(kept, book, scale)
    return Codebooks(book)


def _round(kept: DataFrame, book: np.ndarray, scale: int) -> np.ndarray:
    parts, entries, dims = book.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(parts * entries, np.int64)
        sums = np.zeros((parts * entries, dims), np.int64)
        for batch in batches:
            x = _matrix(batch["vector"], parts * dims, scale)
            index, _ = _assigned(x, book)
            slot = (index + np.arange(parts) * entries).ravel()
            np.add.at(sums, slot, x.reshape(-1, dims))
            counts += np.bincount(slot, minlength=len(counts))
        used = np.flatnonzero(counts)
        columns = [pa.array(used, pa.int32()), pa.array(counts[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["slot", "n", "sums"])

    found = kept.select("vector").mapInArrow(partial, "slot int, n long, sums array<long>")
    added = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(dims)]
    new = book.copy().reshape(parts * entries, dims)
    for row in found.groupBy("slot").agg(F.sum("n").alias("n"), *added).collect():
        new[row["slot"]] = [int(row[f"s{d}"]) // row["n"] for d in range(dims)]
    return new.reshape(book.shape)


def encode_vectors(kept: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """(id, label, ``code``, ``error``) of every row of ``usable_vectors``."""
    book = books.entries
    parts, _, dims = book.shape
    fields = {f.name: f for f in kept.schema}
    out = T.StructType(
        [fields["id"], fields["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, distance = _assigned(_matrix(batch["vector"], parts * dims, scale), book)
            codes = [row.tobytes().hex() for row in index.astype(np.uint8)]
            columns = [batch["id"], batch["label"], pa.array(codes, pa.string()), pa.array(distance.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "code", "error"])

    return kept.mapInArrow(encode, out)


def compress_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """One row per usable vector: id, ``code`` (two hex digits per part), ``error``,
    ``label_error`` (over equal labels, null ones together), ``codebooks_sha256``.

    An empty table, or one without a usable vector, gives no rows."""
    kept = usable_vectors(vectors, id_col, vector_col, label_col)
    books = fit_codebooks(kept, parts, entries, rounds, scale)
    empty = Codebooks(np.zeros((parts, 1, 1), np.int64))
    coded = materialize(encode_vectors(kept, books or empty, scale), "vector-codes")
    total = F.sum("error").alias("label_error")
    # written, so that the planner knows its size and broadcasts it only if it is small
    by_label = materialize(coded.groupBy(F.col("label").alias("of")).agg(total), "vector-labels")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_col), "code", "error", "label_error",
        F.lit((books or empty).digest()).alias("codebooks_sha256"),
    )
