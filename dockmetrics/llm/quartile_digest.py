"""Document fingerprints: a digest of bucket quartiles, and how alike two digests are.

Each position of a text's UTF-8 bytes, filled up with zero bytes, gives one byte triplet,
taken over a spread of twelve bytes so that it says more about the text than about its
language. Triplets are hashed into 256 buckets and counted. The digest holds, for each
bucket, which quarter of the counts its count lies in (two bits), and the text's length on
a logarithmic scale. Equal texts have equal digests.

The difference of two digests is the sum of the buckets' quarter differences, at most the
sum of the larger quarters, and a bounded length difference; ``likeness`` is one less its
share of that bound. A short text fills few buckets, so its bound is small too.

Null texts count as empty; an empty text has an all-zero digest, like only to itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockmetrics.llm.common import materialize, release_memory, row_hash, shuffle_width, whole_text

BUCKETS = 256
#: Where the second and third byte of a triplet stand, and the bytes that it spans.
SECOND, THIRD = 5, 11
#: Length steps in a doubling, the most steps that count, and the share of likeness they can cost.
STEPS, MOST_STEPS, LENGTH_SHARE = 8, 32, 0.25
#: Bytes that are hashed at a time.
SLICE_BYTES = 1 << 20
#: Rows in an output batch.
OUT_ROWS = 5_000


def bucket_counts(raw: bytes) -> np.ndarray:
    """How many triplets fall into each bucket; a text of any length in bounded memory."""
    counts = np.zeros(BUCKETS, np.int64)
    for begin in range(0, len(raw), SLICE_BYTES):
        n = min(SLICE_BYTES, len(raw) - begin)
        window = np.zeros(n + THIRD, np.uint8)
        part = np.frombuffer(raw, np.uint8, min(n + THIRD, len(raw) - begin), begin)
        window[: len(part)] = part
        wide = window.astype(np.uint32)
        key = wide[:n] | wide[SECOND : SECOND + n] << np.uint32(8) | wide[THIRD : THIRD + n] << np.uint32(16)
        key *= np.uint32(0x9E3779B1)
        key ^= key >> np.uint32(15)
        key *= np.uint32(0x85EBCA77)
        counts += np.bincount(key >> np.uint32(24), minlength=BUCKETS)
    return counts


def fingerprint(text: str | None) -> str:
    """The digest of a text: two hex digits of length, then 128 of quartile codes."""
    raw = (text or "").encode()
    counts = bucket_counts(raw)
    ordered = np.sort(counts)
    quarter = BUCKETS // 4
    codes = sum((counts > ordered[i * quarter - 1]).astype(np.uint8) for i in (1, 2, 3))
    packed = codes.reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    length = min(int(STEPS * np.log2(1 + len(raw))), 255)
    return f"{length:02x}{packed.astype(np.uint8).tobytes().hex()}"


def _codes(digest: str) -> np.ndarray:
    packed = np.frombuffer(bytes.fromhex(digest[2:]), np.uint8)
    return (packed[:, None] >> np.array([6, 4, 2, 0], np.uint8) & 3).astype(np.int16).ravel()


def likeness(a: str, b: str) -> float:
    """1 for equal digests, 0 for digests without a bucket in common."""
    if a == b:
        return 1.0
    x, y = _codes(a), _codes(b)
    bound = int(np.maximum(x, y).sum())
    alike = 1.0 - int(np.abs(x - y).sum()) / bound if bound else 1.0
    steps = min(abs(int(a[:2], 16) - int(b[:2], 16)), MOST_STEPS)
    return alike * (1.0 - LENGTH_SHARE * steps / MOST_STEPS)


@F.pandas_udf(T.StringType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    found = texts.map(fingerprint)
    release_memory()
    return found


@F.pandas_udf(T.DoubleType())
def _likenesses(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else likeness(x, y) for x, y in zip(a, b)], dtype="float64")


def fingerprint_column(text_col: str | Column) -> Column:
    """The digest of a text column."""
    return _fingerprints(whole_text(text_col))


def likeness_column(a: str | Column, b: str | Column) -> Column:
    """How alike two digest columns are, null if either is null."""
    return _likenesses(a, b)


_FOUND = (
    "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_RUN = f"{_FOUND}, part int, first_text string, last_text string"


def compare_with_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None
) -> DataFrame:
    """Each document against an edited text of its own and against the next document.

    The edited text has its last quarter of code points replaced by as many from the start of
    the next document in ascending id (after the last: the first). One row per document: id,
    ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next``. Null ids come first; rows of one id are ordered by a hash of their text, and
    each repeated row counts. A single document is its own next one. Other columns are not read.

    One range shuffle of the texts; tasks read their rows in order and hold two at a time.
    Each range's last row meets the next range's first one afterwards, a pair per range.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        whole_text(text_col).alias("text"),
        row_hash(text_col).alias("hash"),
        F.monotonically_increasing_id().alias("copy"),  # ranges may cut between equal rows
    )
    width = partitions or shuffle_width(docs.sparkSession)
    ordered = rows.repartitionByRange(width, "id", "hash", "copy").sortWithinPartitions("id", "hash", "copy")
    runs = materialize(ordered.select("id", "text").mapInArrow(_in_order, _RUN), "quartile-digest")

    # One narrow row per range tells which range comes next; texts join by its number.
    order = Window.orderBy("part")
    parts = runs.filter("first_text is not null").select("part")
    lowest = F.first("part").over(order)
    following = parts.select("part", F.coalesce(F.lead("part").over(order), lowest).alias("next_part"))
    lasts = runs.filter("last_text is not null").select("id", "part", F.col("last_text").alias("text"))
    firsts = runs.filter("first_text is not null").select(
        F.col("part").alias("next_part"), F.col("first_text").alias("next_text")
    )
    pairs = lasts.join(following, "part").join(firsts, "next_part").select("id", "text", "next_text")
    inner = runs.filter("last_text is null").drop("part", "first_text", "last_text")
    found = inner.unionByName(pairs.mapInArrow(_pairs, _FOUND))
    return found.withColumnRenamed("id", id_col)


def _compare(text: str, digest: str, after: str, after_digest: str) -> tuple:
    count = len(text) // 4
    edited = text[: len(text) - count] + after[:count]
    edited_digest = fingerprint(edited)
    return (
        len(text),
        hashlib.sha256(edited.encode()).hexdigest(),
        digest,
        edited_digest,
        likeness(digest, edited_digest),
        likeness(digest, after_digest),
    )


_ARROW = pa.schema(
    [
        ("id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("part", pa.int32()),
        ("first_text", pa.string()),
        ("last_text", pa.string()),
    ]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each compared with the one after it. The first row carries its text
    along; the last one its text instead of results."""
    part = TaskContext.get().partitionId()
    held, first, rows = None, None, []
    for batch in batches:
        for i in range(batch.num_rows):
            key, text = batch["id"][i].as_py(), batch["text"][i].as_py()
            digest = fingerprint(text)
            if held is not None:
                rows.append((held[0], *_compare(held[1], held[2], text, digest), part, first, None))
                first = None
            else:
                first = text
            held = key, text, digest
            if len(rows) == OUT_ROWS:
                yield _batch(rows, _ARROW)
                rows = []
        release_memory()
    if held is not None:
        rows.append((held[0], *[None] * 6, part, first, held[1]))
    yield _batch(rows, _ARROW)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(list(_ARROW)[:7])
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            text, after = batch["text"][i].as_py(), batch["next_text"][i].as_py()
            rows.append((batch["id"][i].as_py(), *_compare(text, fingerprint(text), after, fingerprint(after))))
        yield _batch(rows, schema)
