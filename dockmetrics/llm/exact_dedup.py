"""Exact dedup by content sort: sampled splitters, external sort, neighbour comparison.

Two texts are equal when they are identical after deleting every character of
``[\\x20\\x09-\\x0D]``. Rows are dealt over ranges of (first characters, 64-bit
digest, id) of the normalised text, whose splitters Spark samples; the key stays
short however long a text is. Each range is sorted, so equal texts are adjacent,
and each row's whole text is compared with the one before. A group of any size
is cut at the splitters, also one that holds a third of all rows: the first and
last texts of each range are then compared with those of the other ranges, at
most two per range unless digests collide.

Null texts count as empty, so they form one group with blank texts. A null id
sorts last: its row stays only if its group has no other id. Of rows that tie
in length and id exactly one is marked as kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockmetrics.llm.common import BLANKS, materialize, shuffle_width, whole_text

HEAD_CHARS = 64
#: Runs at the ends of ranges that are broadcast at most, some 50 bytes each.
EDGE_RUNS = 200_000


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    The row with the most code points stays, then the smallest id. ``carry``
    names further (narrow) columns to pass on unchanged.
    """
    spark = docs.sparkSession
    text = whole_text(text_col)
    norm = F.regexp_replace(text, f"{BLANKS}+", "")
    passed = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), norm.alias("norm"), F.length(text).alias("n"), *passed
    ).select(
        "*", F.substring("norm", 1, HEAD_CHARS).alias("head"), F.xxhash64("norm").alias("digest")
    )
    width = partitions or shuffle_width(spark)
    ranged = rows.repartitionByRange(width, "head", "digest", "id").sortWithinPartitions(
        "head", "digest", "norm", F.desc("n"), F.asc_nulls_last("id")
    )
    fields = [f for f in ranged.schema if f.name.startswith("carry_")]
    out = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("run", T.LongType()),
            T.StructField("first", T.BooleanType()),
            T.StructField("best_id", T.LongType()),
            T.StructField("best_n", T.IntegerType()),
            T.StructField("size", T.LongType()),
            T.StructField("sha", T.StringType()),
            T.StructField("edge", T.BooleanType()),
            T.StructField("edge_text", T.StringType()),
            *fields,
        ]
    )
    names = [f.name for f in fields]
    runs = materialize(ranged.mapInArrow(_runs_of(names), out), "exact-dedup")

    edges = runs.filter("edge_text is not null").groupBy("edge_text")
    order = F.struct(-F.col("best_n"), F.col("best_id").isNull(), "best_id", "part", "run")
    joined = edges.agg(
        F.min(order).alias("best"),
        F.sum("size").alias("size"),
        F.collect_list(F.struct("part", "run")).alias("runs"),
    ).select("best", "size", F.explode("runs").alias("r"))
    stitched = joined.select(
        F.col("r.part").alias("part"),
        F.col("r.run").alias("run"),
        F.col("best.best_id").alias("all_id"),
        F.col("size").alias("all_size"),
        ((F.col("r.part") == F.col("best.part")) & (F.col("r.run") == F.col("best.run"))).alias("wins"),
    )
    # Two runs for each range at most, collisions of the 64-bit digest aside: counted, and
    # beyond the bound left to the planner.
    stitched = materialize(stitched, "exact-dedup-edges")
    done = runs.join(F.broadcast(stitched) if stitched.count() <= EDGE_RUNS else stitched, ["part", "run"], "left")
    cut = F.col("edge")
    return done.select(
        F.col("id").alias(id_col),
        F.when(cut, F.col("all_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.when(cut, F.col("all_size")).otherwise(F.col("size")).alias("group_size"),
        F.when(cut, F.col("first") & F.col("wins")).otherwise(F.col("first")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)],
    )


def _runs_of(carry: list[str]):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sorted_runs(batches, TaskContext.get().partitionId(), carry)

    return runs


def _starts(column, previous) -> np.ndarray:
    """True where a value differs from the one before it; whole values are compared."""
    differs = np.ones(len(column), dtype=bool)
    if len(column) > 1:
        differs[1:] = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    if previous is not None and len(column):
        differs[0] = column[0].as_py() != previous
    return differs


def _sorted_runs(
    batches: Iterator[pa.RecordBatch], part: int, carry: list[str]
) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours. Rows wait until the next (head, digest) begins."""
    held: list[pa.Table] = []
    text = head = digest = sha = None
    run, key = -1, 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        norm, heads, digests = (table[c].combine_chunks() for c in ("norm", "head", "digest"))
        starts = _starts(norm, text)
        keys = key + np.cumsum(_starts(heads, head) | _starts(digests, digest))
        starts |= np.diff(keys, prepend=key) > 0
        numbers = run + np.cumsum(starts)
        shas: list[str] = []
        texts: list[str | None] = []
        for i, new in enumerate(starts):
            if new:
                value = norm[i].as_py()
                sha = hashlib.sha256(value.encode()).hexdigest()
                # only texts of the first or last key of a range can matter later
                texts.append(value if keys[i] in (1, keys[-1]) else None)
            else:
                texts.append(None)
            shas.append(sha)
        text, head, digest = norm[-1].as_py(), heads[-1].as_py(), digests[-1].as_py()
        run, key = int(numbers[-1]), int(keys[-1])
        held.append(
            pa.table(
                {
                    "id": table["id"], "n": table["n"], "run": numbers, "first": starts, "key": keys,
                    "sha": pa.array(shas, pa.string()), "text": pa.array(texts, pa.string()),
                    **{c: table[c] for c in carry},
                }
            )
        )
        if held[0]["key"][0].as_py() != key:
            waiting = pa.concat_tables(held)
            ready = int(np.searchsorted(waiting["key"].to_numpy(), key))
            yield from _emit(waiting.slice(0, ready), part, carry, last=False)
            held = [waiting.slice(ready)]
    if held:
        yield from _emit(pa.concat_tables(held), part, carry, last=True)


def _emit(rows: pa.Table, part: int, carry: list[str], last: bool) -> Iterator[pa.RecordBatch]:
    run = rows["run"].to_numpy()
    first = rows["first"].to_numpy(zero_copy_only=False)
    at = np.flatnonzero(first)
    sizes = np.diff(np.append(at, len(run)))
    of = np.repeat(at, sizes)  # the index of each row's run
    key = rows["key"].to_numpy()
    edge = (key == 1) | (last & (key == key[-1]))
    out = pa.table(
        {
            "id": rows["id"],
            "part": pa.array(np.full(len(run), part, dtype=np.int32)),
            "run": pa.array(run, pa.int64()),
            "first": pa.array(first),
            "best_id": rows["id"].take(pa.array(of)),
            "best_n": rows["n"].take(pa.array(of)),
            "size": pa.array(np.repeat(sizes, sizes), pa.int64()),
            "sha": rows["sha"],
            "edge": pa.array(edge),
            "edge_text": rows["text"].take(pa.array(np.arange(len(run)), mask=~edge)),
            **{c: rows[c] for c in carry},
        }
    )
    yield from out.to_batches(max_chunksize=10_000)
