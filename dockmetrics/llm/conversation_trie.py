"""Prefix trie over conversations by fixed-length block hashing.

Every distinct sequence of first turns is a node; its members are the conversations that
start with it. Turns are cut into blocks of a fixed length and conversations are grouped by
the digest of one block after the other. Members of a group that all go on with the
same block share all of its inner nodes, which need no look at single turns. Only
inside blocks where siblings diverge are turn boundaries compared, and there one
representative stands for all conversations with the same block.

The digest of a prefix is the XOR of 128-bit hashes (two XXH64) of (position, role, text),
so a prefix is a running aggregate and texts never leave the first scan. Two prefixes are
held equal when depth and digest are.

Sums over subtrees need no walk over ancestors. Each node belongs to its smallest member,
so a conversation owns the end of its path, and

* the leaves below a node are the members whose last owned node has no child;
* the tokens saved below a node of n members are the sum, over members but the smallest, of
  the characters that each shares with an earlier conversation, less n - 1 times those
  before the node.

Both are sums over members of figures per conversation, grouped like the members are.

Skew: every grouping adds up before it shuffles; turns are numbered and prefixes run over
ranges or stretches of a conversation, never over all of one; joins on a parent have one
row per parent on the other side and are left to the adaptive skew join. Lists of
conversation ids are hashed range by range; only pieces of a node's list that spans ranges meet
in a task, which hashes them one after the other.

Null roles and texts are empty, a null turn comes first, rows of one turn are ordered by
the hash of role and text, and repeated rows are turns of their own. Rows without a conversation
id belong to no conversation. An empty table has no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockmetrics.llm.common import materialize, shuffle_width, whole_text
from dockmetrics.llm.sharding import ranked_rows

BLOCK_TURNS = 4
#: Blocks of a conversation over which a prefix runs in one window.
STRETCH_BLOCKS = 4_096
#: Conversation ids in a piece of a list that is hashed across ranges.
PIECE_IDS = 65_536
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

_NODE = ["depth", "ka", "kb"]
_CLASS = ["k", "pa", "pb", "xa", "xb", "len"]


def conversation_turns(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv, pos, a, b, chars): turns numbered from 0 in each conversation, texts as digests."""
    role, text = whole_text(role_col), whole_text(text_col)
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), role, text).alias("b"),
        F.length(text).cast("long").alias("chars"),
    )
    order = ["conv", "turn", "a", "b"]
    width = shuffle_width(conversations.sparkSession)
    ranged = rows.repartitionByRange(width, *order).withColumn("range", F.spark_partition_id())
    ranked = ranked_rows(materialize(ranged, "trie-ranges"), ["conv"], F.col("range"), order[1:])
    return materialize(ranked.select("conv", F.col("rank").alias("pos"), "a", "b", "chars"), "trie-turns")


def with_shared_heads(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt so that neighbours start alike: (turns, conversations).

    Conversation c gets the first h turns of conversation c - c % ``every`` (all if it has
    fewer, none if it is missing), then its own after its first h, where h is the CRC-32 of
    the decimal c modulo ``most``. The second frame has every ``conv``, also one left without a turn.
    """
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("had")).select(
        "conv", "had", head.alias("h"), (F.col("conv") - F.col("conv") % every).alias("base")
    )
    convs = materialize(convs, "trie-convs")
    heads = turns.filter((F.col("conv") % every == 0) & (F.col("pos") < most - 1))
    heads = heads.withColumnRenamed("conv", "base")
    # at most ``every`` conversations and ``most`` - 1 turns meet under a base
    taken = convs.select("conv", "base", "h").join(heads, "base").filter("pos < h")
    # where the base has fewer than h turns, own ones move up
    lengths = convs.select(F.col("conv").alias("base"), F.col("had").alias("base_had"))
    gaps = convs.filter("had > h").join(lengths, "base", "left")
    gaps = gaps.select("conv", (F.col("h") - F.least("h", F.coalesce("base_had", F.lit(0)))).alias("gap"))
    gaps = materialize(gaps.filter("gap > 0"), "trie-gaps")
    own = turns.filter(F.col("pos") >= head).join(gaps, "conv", "left")
    own = own.withColumn("pos", F.col("pos") - F.coalesce("gap", F.lit(0)))
    columns = ["conv", "pos", "a", "b", "chars"]
    rebuilt = taken.select(*columns).unionByName(own.select(*columns))
    return materialize(rebuilt, "trie-rebuilt"), convs.select("conv")


def _xor(a: str | Column, b: str | Column) -> Column:
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return a.bitwiseXOR(b)


def _blocks(turns: DataFrame, block: int, stretch: int) -> DataFrame:
    """(conv, k, pa, pb, xa, xb, len, chars, before): each block of a conversation with the
    digests of the prefixes before and after it and the characters in and before it."""
    numbered = turns.withColumn("k", F.floor(F.col("pos") / block)).withColumn("s", F.floor(F.col("k") / stretch))
    rows = numbered.groupBy("conv", "s", "k").agg(
        F.bit_xor(F.xxhash64("pos", "a")).alias("a"),
        F.bit_xor(F.xxhash64("pos", "b")).alias("b"),
        F.count(F.lit(1)).alias("len"),
        F.sum("chars").alias("chars"),
    )
    total = rows.groupBy("conv", "s").agg(
        F.bit_xor("a").alias("ta"), F.bit_xor("b").alias("tb"), F.sum("chars").alias("tc")
    )
    earlier = Window.partitionBy("conv").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    starts = total.select(
        "conv", "s",
        F.coalesce(F.bit_xor("ta").over(earlier), F.lit(0)).alias("ta"),
        F.coalesce(F.bit_xor("tb").over(earlier), F.lit(0)).alias("tb"),
        F.coalesce(F.sum("tc").over(earlier), F.lit(0)).alias("tc"),
    ).filter("s > 0")  # only conversations longer than a stretch
    within = Window.partitionBy("conv", "s").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = rows.select(
        "*",
        F.bit_xor("a").over(within).alias("ra"),
        F.bit_xor("b").over(within).alias("rb"),
        F.sum("chars").over(within).alias("rc"),
    ).join(starts, ["conv", "s"], "left")
    after_a, after_b = (_xor(r, F.coalesce(t, F.lit(0))) for r, t in (("ra", "ta"), ("rb", "tb")))
    return running.select(
        "conv", "k",
        _xor(after_a, "a").alias("pa"), _xor(after_b, "b").alias("pb"),
        after_a.alias("xa"), after_b.alias("xb"),
        "len", "chars", (F.col("rc") + F.coalesce("tc", F.lit(0)) - F.col("chars")).alias("before"),
    )


def _opened(classes: DataFrame, turns: DataFrame, block: int) -> DataFrame:
    """The turns of each class's block, read from its representative, with the digests of the
    prefixes that end there (ka, kb) and one turn earlier (qa, qb)."""
    of = turns.withColumn("k", F.floor(F.col("pos") / block)).withColumnRenamed("conv", "rep")
    rows = classes.withColumnRenamed("before", "start").join(of, ["rep", "k"]).select(
        *_CLASS, "n", "rep", "splits", "start", "pos", "chars",
        F.xxhash64("pos", "a").alias("a"), F.xxhash64("pos", "b").alias("b"),
    )
    # a class is told by its representative, block and length: at most a block's rows
    upto = Window.partitionBy("rep", "k", "len").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ka, kb = _xor("pa", F.bit_xor("a").over(upto)), _xor("pb", F.bit_xor("b").over(upto))
    return rows.select(
        *_CLASS, "n", "rep", "splits", (F.col("pos") + 1).alias("depth"), ka.alias("ka"), kb.alias("kb"),
        _xor(ka, "a").alias("qa"), _xor(kb, "b").alias("qb"), "chars",
        (F.col("start") + F.sum("chars").over(upto) - F.col("chars")).alias("before"),
    )


def prefix_trie(
    turns: DataFrame, convs: DataFrame, block: int = BLOCK_TURNS, stretch: int = STRETCH_BLOCKS
) -> DataFrame:
    """The nodes of the trie over ``turns`` (conv, pos from 0 without gaps, a, b, chars) of all
    ``convs`` (conv): ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    blocks = materialize(_blocks(turns, block, stretch), "trie-blocks")
    classes = blocks.groupBy(*_CLASS).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("rep"), F.min("before").alias("before")
    )
    classes = materialize(classes, "trie-classes")
    # Only parents whose members diverge, written: a small table then needs no shuffle of the classes.
    family = ["k", "pa", "pb"]
    diverging = classes.groupBy(*family).agg(F.count(F.lit(1)).alias("blocks")).filter("blocks > 1")
    diverging = materialize(diverging.select(*family, F.lit(True).alias("diverges")), "trie-diverging")
    marked = classes.join(diverging, family, "left")
    marked = marked.withColumn("splits", F.coalesce("diverges", F.lit(False))).drop("diverges")
    opened = materialize(_opened(marked, turns, block), "trie-opened")

    ends = convs.select("conv").join(_path_ends(blocks), "conv", "left").select(
        "conv", F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("ka", F.lit(0)).alias("ka"),
        F.coalesce("kb", F.lit(0)).alias("kb"), F.coalesce("chars", F.lit(0)).alias("chars"),
    )
    ends = materialize(ends, "trie-ends")
    nodes = materialize(_nodes(opened, ends), "trie-nodes")

    owned = nodes.groupBy(F.col("rep").alias("conv")).agg(
        F.min("before").alias("shared"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    figures = ends.select("conv", "chars").join(owned, "conv", "left").select(
        "conv", F.coalesce("shared", "chars").alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf")
    )
    figures = materialize(figures, "trie-figures")
    below = _summed_below(blocks, opened, figures)

    hashes = _end_hashes(ends)
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("ka").alias("qa"), F.col("kb").alias("qb"),
        F.col("rep").alias("parent_conv_id"),
    )
    first = figures.select(F.col("conv").alias("rep"), F.col("shared").alias("own"))
    whole = nodes.join(below, _NODE).join(hashes, _NODE, "left").join(first, "rep")
    whole = whole.join(parents, ["depth", "qa", "qb"], "left")
    saved = F.col("shared") - F.col("own") - (F.col("n") - 1) * F.col("before")
    return whole.select(
        F.col("rep").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"),
        F.coalesce("sha", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


def _path_ends(blocks: DataFrame) -> DataFrame:
    last = F.max_by(F.struct("xa", "xb"), "k")
    return blocks.groupBy("conv").agg(
        F.sum("len").alias("depth"), F.sum("chars").alias("chars"), last.alias("last")
    ).select("conv", "depth", F.col("last.xa").alias("ka"), F.col("last.xb").alias("kb"), "chars")


def _nodes(opened: DataFrame, ends: DataFrame) -> DataFrame:
    """(depth, ka, kb, qa, qb, n, rep, before, n_children), the root with a null parent."""
    kept = [*_NODE, "qa", "qb", "n", "rep", "before"]
    alone = opened.filter(~F.col("splits")).select(*kept)
    met = opened.filter("splits").groupBy(*_NODE).agg(
        F.min("qa").alias("qa"), F.min("qb").alias("qb"), F.sum("n").alias("n"), F.min("rep").alias("rep"),
        F.min("before").alias("before"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = ends.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("rep")).filter("n > 0").select(
        zero.alias("depth"), zero.alias("ka"), zero.alias("kb"), none.alias("qa"), none.alias("qb"), "n", "rep",
        zero.alias("before"),
    )
    nodes = materialize(alone.unionByName(met.select(*kept)).unionByName(root), "trie-grouped")
    children = nodes.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("qa").alias("ka"), F.col("qb").alias("kb")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    return nodes.join(children, _NODE, "left").fillna(0, "n_children")


def _summed_below(blocks: DataFrame, opened: DataFrame, figures: DataFrame) -> DataFrame:
    """(depth, ka, kb, shared, leaves): the figures summed over each node's members."""
    sums = [F.sum("shared").alias("shared"), F.sum("leaf").alias("leaves")]
    by_class = blocks.select("conv", *_CLASS).join(figures, "conv").groupBy(*_CLASS).agg(*sums)
    rows = opened.select(*_CLASS, *_NODE, "splits").join(by_class, _CLASS).select(*_NODE, "splits", "shared", "leaves")
    rows = materialize(rows, "trie-sums")
    met = rows.filter("splits").groupBy(*_NODE).agg(F.sum("shared").alias("shared"), F.sum("leaves").alias("leaves"))
    zero = F.lit(0).cast("long")
    root = figures.agg(*sums).select(zero.alias("depth"), zero.alias("ka"), zero.alias("kb"), "shared", "leaves")
    return rows.filter(~F.col("splits")).drop("splits").unionByName(met).unionByName(root)


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(depth, ka, kb, sha) of the nodes at which conversations end."""
    counted = ends.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("m"), F.min("conv").alias("conv"))
    counted = materialize(counted, "trie-counted")
    single = counted.filter("m = 1").select(*_NODE, F.sha2(F.col("conv").cast("string"), 256).alias("sha"))
    many = ends.select(*_NODE, "conv").join(counted.filter("m > 1").select(*_NODE), _NODE, "left_semi")
    width = shuffle_width(ends.sparkSession)
    ordered = many.repartitionByRange(width, *_NODE, "conv").sortWithinPartitions(*_NODE, "conv")
    pieces = "depth long, ka long, kb long, sha string, part int, piece long, ids string"
    hashed = materialize(ordered.mapInArrow(_hash_lists, pieces), "trie-lists")
    whole = hashed.filter("sha is not null").select(*_NODE, "sha")
    cut = hashed.filter("sha is null").select(*_NODE, "part", "piece", "ids")
    chained = cut.repartition(*_NODE).sortWithinPartitions(*_NODE, "part", "piece")
    chained = chained.mapInArrow(_hash_pieces, "depth long, ka long, kb long, sha string")
    return single.unionByName(whole).unionByName(chained)


_LISTS = pa.schema(
    [
        *((name, pa.int64()) for name in _NODE),
        ("sha", pa.string()),
        ("part", pa.int32()),
        ("piece", pa.int64()),
        ("ids", pa.string()),
    ]
)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """(node, begin, end) of neighbouring rows of one node."""
    keys = list(zip(*(batch[name].to_pylist() for name in _NODE)))
    begin = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[begin]:
            yield keys[begin], begin, i
            begin = i


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each node's sorted ids that lie within this range; the pieces of those
    at its ends, which may go on in other ranges."""
    part = TaskContext.get().partitionId()
    key, first, pieces = None, True, []

    def closed(last: bool) -> list[tuple]:
        if first or last:
            return [(*key, None, part, i, ids) for i, ids in enumerate(pieces)]
        return [(*key, hashlib.sha256(",".join(pieces).encode()).hexdigest(), part, 0, None)]

    for batch in batches:
        done = []
        decimals = pc.cast(batch["conv"], pa.string())
        for node, begin, end in _runs(batch):
            if node != key:
                if key is not None:
                    done += closed(False)
                    first = False
                key, pieces = node, []
            for at in range(begin, end, PIECE_IDS):
                pieces.append(",".join(decimals.slice(at, min(PIECE_IDS, end - at)).to_pylist()))
        if done:
            yield _rows(done, _LISTS)
    if key is not None:
        for row in closed(True):
            yield _rows([row], _LISTS)


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per node over its pieces in order, a piece at a time."""
    schema = pa.schema(list(_LISTS)[:4])
    key, state = None, None
    for batch in batches:
        done = []
        for node, begin, end in _runs(batch):
            new = node != key
            if new:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256()
            for i in range(begin, end):
                state.update(b"" if new and i == begin else b",")
                state.update(batch["ids"][i].as_py().encode())
        yield _rows(done, schema)
    if key is not None:
        yield _rows([(*key, state.hexdigest())], schema)


def conversation_trie(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block: int = BLOCK_TURNS,
) -> DataFrame:
    """The prefix trie of conversations as they are."""
    turns = conversation_turns(conversations, conv_col, turn_col, role_col, text_col)
    return prefix_trie(turns, turns.select("conv").distinct(), block)
