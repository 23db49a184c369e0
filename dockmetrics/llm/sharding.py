"""Sharding by balanced label propagation.

Documents with equal texts are linked (through their text, so a group of n has n links).
All documents start spread evenly over the shards. In each round every group looks at
where its members are and those elsewhere ask to move to the shard that holds most of
them: of the shards with space left by linked documents in even rounds, of all in odd ones.
A hash that changes by round breaks ties, so that requests between two shards balance.
Quotas decide how many of each (from, to) ask in vain: requests in opposite directions
swap, the rest shares what space the target has. Rounds end when nobody moves in two in a
row. No move leads to a shard with fewer of the group, so that they do end. Groups that are
still cut then are dealt out over the places they hold and the space left, one after the
other, if that cuts fewer documents off. Documents without links fill the shards up.

The law is ``rows``: counts of any two shards differ by one at most. A group larger than a
shard gathers in several, as far as other groups leave space. The quota table has shards squared numbers and
is the only thing the driver sees. Ranks (who is within a quota, which slot a document
has) are counted in two levels, chunk totals and rows within a chunk, so that no task
holds a whole shard. Groups of more than a small share of all rows are so few that their
keys are broadcast: no join brings the rows of such a group together.

A null text is an empty one; a null id is an id like others. Repeated rows each get a slot.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockmetrics.llm.common import discard, materialize, shuffle_width, whole_text

SHARDS = 24
OVERHEAD = 8
#: A safety limit, logged when it is met.
ROUNDS = 200
#: A group is hot from one row more than total / (HOT_PARTS * chunks): there are fewer than
#: HOT_PARTS * chunks of those, whatever the data.
HOT_PARTS = 8

_log = logging.getLogger(__name__)


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, rounds: int = ROUNDS
) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``,
    ``grown_shard`` (null under this law)."""
    text = whole_text(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.substring(F.sha2(text, 256), 1, 32).alias("key"),
    )
    chunks = shuffle_width(docs.sparkSession)
    ranked = ranked_rows(materialize(rows, "sharding"), [], F.pmod(F.xxhash64("id", "key"), F.lit(chunks)), ["id", "key"])
    base = materialize(ranked.withColumnRenamed("rank", "rid"), "sharding-base")
    total = base.count()
    capacity = [total // shards + (s < total % shards) for s in range(shards)]

    groups = base.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = materialize(groups, "sharding-groups")
    hot = materialize(groups.filter(F.col("n") > total // (HOT_PARTS * chunks)).select("key"), "sharding-hot")
    linked = join_groups(base.select("rid", "key"), groups.select("key"), ["key"], hot).withColumn(
        "shard", F.pmod("rid", F.lit(shards)).cast("int")
    )
    linked = propagate(materialize(linked, "sharding-linked"), capacity, chunks, rounds, hot)
    linked = deal(linked, capacity, chunks, hot)
    held = _held(linked, shards)

    free = base.join(linked.select("rid"), "rid", "left_anti").select("rid")
    spaces = [0]
    for shard in range(shards):
        spaces.append(spaces[-1] + capacity[shard] - held[shard])
    filled = ranked_rows(materialize(free, "sharding-free"), [], F.pmod(F.xxhash64("rid"), F.lit(chunks)), ["rid"])
    upper = F.array(*[F.lit(s).cast("long") for s in spaces[1:]])
    filled = filled.select("rid", F.size(F.filter(upper, lambda u: u <= F.col("rank"))).alias("shard"))
    placed = base.join(linked.select("rid", "shard").unionByName(filled), "rid")
    placed = materialize(placed, "sharding-placed")
    slots = ranked_rows(placed, ["shard"], F.pmod(F.xxhash64("rid"), F.lit(chunks)), ["rid"])
    return slots.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", F.col("rank").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def join_groups(rows: DataFrame, table: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    """The rows with what ``table`` holds for their group (``on`` is its key, or key and
    shard). Entries of ``hot`` groups are broadcast, their number is bounded; all other groups
    are small enough to meet in a task."""
    few = table.join(F.broadcast(hot), "key", "left_semi")
    of_hot = rows.join(F.broadcast(hot), "key", "left_semi").join(F.broadcast(few), on)
    return of_hot.unionByName(rows.join(F.broadcast(hot), "key", "left_anti").join(table, on))


def propagate(linked: DataFrame, capacity: list[int], chunks: int, rounds: int, hot: DataFrame) -> DataFrame:
    """Moves linked rows (rid, key, shard); the table of one round replaces that of the round before."""
    shards, idle = len(capacity), 0
    for number in range(rounds):
        space = [c - h for c, h in zip(capacity, _held(linked, shards))]
        # members of each group by shard: at most as many rows per group as there are shards
        members = linked.groupBy("key", "shard").agg(F.count(F.lit(1)).alias("n"))
        offered = members
        if number % 2 == 0 and any(space):
            offered = members.filter(F.array(*[F.lit(s > 0) for s in space])[F.col("shard")])
        tie = F.xxhash64("key", "shard", F.lit(number))
        target = offered.groupBy("key").agg(F.max(F.struct("n", tie.alias("tie"), "shard")).alias("best")).select(
            "key", F.col("best.shard").alias("to"), F.col("best.n").alias("there")
        )
        moves = members.join(target, "key").filter((F.col("to") != F.col("shard")) & (F.col("there") >= F.col("n")))
        moves = materialize(moves.select("key", "shard", "to"), "sharding-moves")
        asked = join_groups(linked, moves, ["key", "shard"], hot)
        asked = materialize(asked.select("rid", "key", "shard", "to"), "sharding-asked")
        wanted = {(r[0], r[1]): r[2] for r in asked.groupBy("shard", "to").agg(F.count(F.lit(1))).collect()}
        quota = allowed_moves(wanted, space)
        if not any(quota.values()):
            idle += 1
            discard(moves, asked)
            if idle == 2:
                return linked
            continue
        idle = 0
        # a group's members are neighbours in the order, a large group is spread over chunks
        near = F.pmod(F.xxhash64("key"), F.lit(chunks)) * 8 + F.pmod("rid", F.lit(8))
        ranked = ranked_rows(asked, ["shard", "to"], near, ["key", "rid"])
        table = F.lit([quota.get((a, b), 0) for a in range(shards) for b in range(shards)])
        limit = table[F.col("shard") * shards + F.col("to")]
        going = ranked.filter(F.col("rank") < limit).select("rid", "to")
        moved = linked.join(going, "rid", "left").select("rid", "key", F.coalesce("to", "shard").alias("shard"))
        earlier, linked = linked, materialize(moved, "sharding-linked")
        discard(earlier, moves, asked)
    _log.warning("label propagation stopped at its limit of %d rounds with rows still moving", rounds)
    return linked


def deal(linked: DataFrame, capacity: list[int], chunks: int, hot: DataFrame) -> DataFrame:
    """Deals the groups that are cut over the places they hold and the space left, so that
    only those at a shard's end stay cut; as they were if that cuts as many rows off."""
    shards = len(capacity)
    cut = materialize(_cut_groups(linked), "sharding-cut")
    before = _rows_off(cut)
    if not before:
        return linked
    pool = materialize(join_groups(linked, cut.select("key"), ["key"], hot), "sharding-pool")
    rest = linked.join(pool.select("rid"), "rid", "left_anti")
    ends, kept = [], _held(rest, shards)
    for c, h in zip(capacity, kept):
        ends.append((ends[-1] if ends else 0) + c - h)
    groups = cut.select("key", "n", F.pmod(F.xxhash64("key"), F.lit(chunks)).alias("chunk_"))
    totals = groups.groupBy("chunk_").agg(F.sum("n").alias("n_"))
    earlier = Window.orderBy("chunk_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("chunk_", F.coalesce(F.sum("n_").over(earlier), F.lit(0)).alias("offset_"))
    within = Window.partitionBy("chunk_").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.withColumn("before_", F.coalesce(F.sum("n").over(within), F.lit(0))).join(offsets, "chunk_").select(
        "key", (F.col("offset_") + F.col("before_")).alias("start")
    )
    ranked = ranked_rows(pool, ["key"], F.pmod("rid", F.lit(chunks)), ["rid"])
    ranked = join_groups(ranked, materialize(starts, "sharding-starts"), ["key"], hot)
    upper = F.array(*[F.lit(e).cast("long") for e in ends])
    place = F.size(F.filter(upper, lambda u: u <= F.col("start") + F.col("rank")))
    dealt = materialize(ranked.select("rid", "key", place.alias("shard")), "sharding-dealt")
    if _rows_off(_cut_groups(dealt)) >= before:
        return linked
    joined = materialize(rest.unionByName(dealt), "sharding-linked")
    discard(linked, pool, dealt)
    return joined


def _held(linked: DataFrame, shards: int) -> list[int]:
    """How many linked rows each shard holds."""
    held = [0] * shards
    for r in linked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per shard
        held[r["shard"]] = r["n"]
    return held


def _cut_groups(linked: DataFrame) -> DataFrame:
    """(key, n, most): groups in several shards, their rows and those in the shard with most."""
    members = linked.groupBy("key", "shard").agg(F.count(F.lit(1)).alias("here"))
    groups = members.groupBy("key").agg(F.sum("here").alias("n"), F.max("here").alias("most"))
    return groups.filter("most < n")


def _rows_off(cut: DataFrame) -> int:
    return cut.agg(F.sum(F.col("n") - F.col("most"))).first()[0] or 0


def allowed_moves(wanted: dict[tuple[int, int], int], space: list[int]) -> dict[tuple[int, int], int]:
    """How many rows of each (from, to) may move: as many as come back, and for the rest
    the target's space, shared in proportion to the requests."""
    quota = {move: min(n, wanted.get(move[::-1], 0)) for move, n in wanted.items()}
    for to, room in enumerate(space):
        rest = {move: n - quota[move] for move, n in sorted(wanted.items()) if move[1] == to and n > quota[move]}
        asked, room = sum(rest.values()), max(room, 0)
        for move, n in rest.items():
            share = min(n, -(-room * n // asked)) if asked else 0
            quota[move] += share
            room, asked = room - share, asked - n
    return quota


def ranked_rows(df: DataFrame, by: list[str], chunk: Column, order: list[str]) -> DataFrame:
    """The rows with ``rank`` (from 0, gapless) within ``by``, in the order of chunks and,
    within a chunk, of ``order``. ``df`` must give the same rows whenever it is read."""
    rows = df.withColumn("chunk_", chunk)
    counts = rows.groupBy(*by, "chunk_").agg(F.count(F.lit(1)).alias("n_"))
    earlier = Window.partitionBy(*by).orderBy("chunk_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "chunk_", F.coalesce(F.sum("n_").over(earlier), F.lit(0)).alias("offset_"))
    within = Window.partitionBy(*by, "chunk_").orderBy(*order)
    numbered = rows.withColumn("row_", F.row_number().over(within))
    return numbered.join(offsets, [*by, "chunk_"]).withColumn(
        "rank", (F.col("offset_") + F.col("row_") - 1).cast("long")
    ).drop("chunk_", "offset_", "row_")
