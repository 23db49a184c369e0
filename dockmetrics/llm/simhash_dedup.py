"""SimHash near-dedup with a generalised pigeonhole search.

Fingerprint: A-Z are lower-cased, words are the runs without ``[\\x20\\x09-\\x0D]``,
shingles are ``shingle`` words joined by a space, repeats included (fewer words: the
whole sequence). A bit is set if over half the shingles' XXH64 (seed 42) set it;
a text without words has fingerprint zero.

Search: all links between distinct fingerprints at ``radius`` or fewer bits.

1. Correlated bits go into one partition, so that few partitions hold the skew.
2. Each partition i gets a threshold t_i of -1 (not probed) or more, with
   sum(t_i + 1) = radius + 1. Two fingerprints within the radius then differ in at
   most t_i bits of some partition i. A dynamic program picks the thresholds with
   the fewest estimated candidates, from counts over all fingerprints.
   The number of partitions is the one whose best allocation costs least: few and wide
   ones with more probes as the fingerprints grow in number.
3. Fingerprints probe the partitions, candidates are verified on all bits.

Up to a radius of two, a bucket of more than ``bucket_rows`` fingerprints (a large group
of near copies) is not joined with itself or with its probes. These are linked through the
points one bit away that they share: within two bits there is one, and all that share it are within
two bits, so they link to the smallest of them. That is exact and linear in the bucket.
For a larger radius the buckets are compared inside tasks, large ones in blocks, and a
task returns a spanning forest of what it links, never the pairs.

``near_duplicates`` asks for shingle similarity as well: texts that the fingerprints
connect are brought together, compared exactly, and linked if they reach it. Its radius
holds pairs just above the similarity, and so many others that they would connect all
texts. A sketch of the very sets that are compared (the lowest bit of 64 minima) tells
those apart before they connect anything.

Rows of any number with one fingerprint count once. A null id is never named as
a component's smallest id; a component without ids has a null component_id.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations, repeat
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmetrics.llm.common import discard, materialize, release_memory, shuffle_width, whole_text
from dockmetrics.llm.components import connected_components

BITS = 64
_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: str, shingle: int = 3) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = len(words) - shingle + 1
    if n < 1:
        shingles, n = [b" ".join(words)], 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64, n)
    # 255 hashes at most per row, so that the byte counters of a lane hold their sum
    rows = np.zeros((-(-n // 255), 255), np.uint64)
    rows.ravel()[:n] = hashes
    counts = np.empty((8, 8), np.int64)
    for bit in range(8):
        sums = ((rows >> np.uint64(bit)) & _LANES).sum(axis=1)
        counts[:, bit] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts.ravel() * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text_col: str = "text", shingle: int = 3):
    """The fingerprint of a text column as a (signed) long."""

    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        release_memory()
        return pd.Series(found.view(np.int64))

    return fingerprints(whole_text(text_col))


def simhash_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 2,
    bucket_rows: int = 128,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id``
    (smallest id reachable over links, its own included). With ``carry``, the names of
    further columns to pass on, also ``group``, which is never null."""
    passed = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), fingerprint_column(text_col, shingle).alias("fp"), *passed
    )
    rows = materialize(rows, "simhash")
    distinct = materialize(rows.groupBy("fp").agg(F.min("id").alias("id")), "simhash-distinct")
    links = near_links(distinct.select("fp"), radius, bucket_rows)
    roots = connected_components(links)
    of_linked = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root")
    )
    least = of_linked.groupBy("root").agg(F.min("id").alias("component_id"))
    component = of_linked.join(least, "root").select("fp", "component_id", F.col("root").alias("group"))
    return rows.join(component, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)],
        *(["group"] if carry else []),
    )


# --- search -------------------------------------------------------------------


def near_links(points: DataFrame, radius: int = 2, bucket_rows: int = 128) -> DataFrame:
    """Links (a, b) that join all distinct values of ``points`` (fp long) within
    ``radius`` bits: every such pair is linked, directly or through others that are
    themselves within ``radius`` of each other. With a column ``sketch`` (and a radius over
    two), points have an ``id`` too: the links are between ids and need near sketches."""
    if radius == 0:
        return points.sparkSession.createDataFrame([], "a long, b long")
    n, ones, both = _bit_counts(points)
    inside = radius > 2  # compared inside tasks, where a comparison costs far less than a row
    trials = [group_bits(n, ones, both, m) for m in _partition_numbers(radius)]
    pairs = _equal_pairs(points, [part for parts in trials for part in parts])
    best = None
    for number, parts in enumerate(trials):
        before = sum(map(len, trials[:number]))
        own = [pairs.get(before + i, 0.0) for i in range(len(parts))]
        costs = _estimates(n, ones, parts, own, radius, COMPARISON_COST if inside else 1.0)
        chosen = allocate(costs, radius)
        cost = sum(row[t + 1] for row, t in zip(costs, chosen))
        if best is None or cost < best[0]:
            best = (cost, parts, chosen)
    _, parts, thresholds = best
    if inside:
        return _probed_links(points, parts, thresholds, radius)
    buckets = _keyed(points, parts).groupBy("i", "key").agg(F.count(F.lit(1)).alias("n"))
    buckets = materialize(buckets.filter("n > 1"), "simhash-buckets")

    probed = [i for i, t in enumerate(thresholds) if t >= 0]
    keyed = _keyed(points, [parts[i] for i in probed], probed)
    sparse, dense = [], []
    for i in probed:
        own = keyed.filter(F.col("i") == i)
        if thresholds[i] == 0:
            # Only buckets of two or more can link; the large ones take the other way.
            shared = buckets.filter(F.col("i") == i).select("key", (F.col("n") > bucket_rows).alias("hot"))
            own = own.join(shared, "key")
            left = right = own.filter("not hot")
            dense.append(own.filter("hot").select("fp"))
        else:
            # What a large bucket holds and what probes it take the other way together.
            hot = buckets.filter((F.col("i") == i) & (F.col("n") > bucket_rows)).select("key")
            probes = own.select("fp", F.explode(_flips(parts[i], thresholds[i])).alias("flip"), "key").select("fp", F.col("key").bitwiseXOR(F.col("flip")).alias("key"))
            left, right = probes.join(hot, "key", "left_anti"), own.join(hot, "key", "left_anti")
            dense.append(probes.join(hot, "key", "left_semi").select("fp"))  # no flip: the bucket's own points
        sparse.append(
            left.select("key", F.col("fp").alias("a"))
            .join(right.select("key", F.col("fp").alias("b")), "key")
            .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
            .select("a", "b")
        )
    links = [*sparse, *([_star_links(_union(dense).distinct(), radius)] if dense else [])]
    found = materialize(_union(links), "simhash-links")
    discard(buckets)
    return found


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def _star_links(points: DataFrame, radius: int) -> DataFrame:
    """Links between all points within one or two bits, through shared neighbours."""
    flips = [1 << b if b < 63 else -(1 << 63) for b in range(BITS)]
    fp = F.col("fp")
    if radius == 1:  # the pair that differs in bit b shares the value without that bit
        near = F.transform(F.array(*map(F.lit, flips)), lambda b: F.struct(fp.bitwiseAND(F.bitwise_not(b)).alias("near"), b.alias("bit")))
    else:
        near = F.transform(F.array(*map(F.lit, [0, *flips])), lambda b: F.struct(fp.bitwiseXOR(b).alias("near"), F.lit(0).cast("long").alias("bit")))
    spread = points.select("fp", F.inline(near))
    least = spread.groupBy("near", "bit").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return spread.join(least, ["near", "bit"]).filter("fp <> a").select("a", F.col("fp").alias("b")).distinct()


def _keyed(points: DataFrame, parts: list[list[int]], numbers: list[int] | None = None) -> DataFrame:
    """(i, key, fp): the bits of each partition, in their places."""
    masks = [_signed(sum(1 << b for b in part)) for part in parts]
    keys = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
            for i, m in zip(numbers or range(len(masks)), masks)
        ]
    )
    return points.select(*points.columns, F.inline(keys))


def _flips(part: list[int], threshold: int):
    masks = [sum(1 << b for b in bits) for t in range(threshold + 1) for bits in combinations(part, t)]
    return F.array(*[F.lit(_signed(m)) for m in masks])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _equal_pairs(points: DataFrame, parts: list[list[int]]) -> dict[int, float]:
    """Per partition how many pairs of points agree on it."""
    buckets = _keyed(points, parts).groupBy("i", "key").agg(F.count(F.lit(1)).alias("n"))
    sums = buckets.groupBy("i").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs"))
    return {r["i"]: float(r["pairs"]) for r in sums.collect()}  # one row per partition


def _partition_numbers(radius: int) -> list[int]:
    """Numbers of partitions to choose from: one bit more than the radius down to two."""
    return sorted({max(2, -(-(radius + 1) // k)) for k in (1, 2, 3, 4)}, reverse=True)


BLOCK_ROWS = 20_000
#: Cost of comparing two fingerprints inside a task, relative to a probe's row.
COMPARISON_COST = 0.001


def _probed_links(points: DataFrame, parts: list[list[int]], thresholds: list[int], radius: int) -> DataFrame:
    """The links of ``near_links`` for any radius, compared inside tasks. A bucket is cut into
    blocks of ``BLOCK_ROWS`` stored points; its probes go to each of them."""
    probed = [i for i, t in enumerate(thresholds) if t >= 0]
    if "sketch" not in points.columns:
        points = points.select("fp", F.col("fp").alias("id"), F.lit(0).cast("long").alias("sketch"))
    stored = materialize(_keyed(points, [parts[i] for i in probed], probed), "simhash-stored")
    blocks = stored.groupBy("i", "key").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("long").alias("blocks"))
    flips = F.lit(None)
    for i in probed:
        flips = F.when(F.col("i") == i, _flips(parts[i], thresholds[i])).otherwise(flips)
    probes = stored.select("i", "fp", "id", "sketch", "key", F.explode(flips).alias("flip")).select(
        "i", "fp", "id", "sketch", F.col("key").bitwiseXOR(F.col("flip")).alias("key")
    )
    # Probes of empty buckets end here.
    met = probes.join(blocks, ["i", "key"]).select(
        "i", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "fp", "id", "sketch", F.lit(1).alias("kind")
    )
    own = stored.join(blocks, ["i", "key"]).select(
        "i", "key", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), "fp", "id", "sketch", F.lit(0).alias("kind")
    )
    width = shuffle_width(points.sparkSession)
    dealt = own.unionByName(met).repartition(width, "i", "key", "block").sortWithinPartitions("i", "key", "block", "kind")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, bucket, held = _Forest(), None, np.zeros((3, 0), np.int64)
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("i", "key", "block", "kind", "fp", "id", "sketch")]
            changes = np.zeros(batch.num_rows, bool)
            for column in columns[:3]:
                changes[1:] |= column[1:] != column[:-1]
            starts = [0, *np.flatnonzero(changes).tolist(), batch.num_rows]
            kind, values = columns[3], np.stack(columns[4:])
            for low, high in zip(starts, starts[1:]):
                name = tuple(int(c[low]) for c in columns[:3])
                if name != bucket:
                    bucket, held = name, np.zeros((3, 0), np.int64)
                here, of = values[:, low:high], kind[low:high]
                if (of == 0).any():
                    held = np.concatenate((held, here[:, of == 0]), axis=1)
                asking = here[:, of == 1]
                if held.shape[1] == 1 and asking.shape[1] == 1 and held[1, 0] == asking[1, 0]:
                    continue
                for at in range(0, asking.shape[1], 128):
                    fps, ids, sketches = asking[:, at : at + 128]
                    x, y = np.nonzero(np.bitwise_count((fps[:, None] ^ held[0]).view(np.uint64)) <= radius)
                    true = np.bitwise_count((sketches[x] ^ held[2, y]).view(np.uint64)) <= SKETCH_RADIUS
                    true &= ids[x] != held[1, y]
                    for p, q in zip(ids[x[true]].tolist(), held[1, y[true]].tolist()):
                        forest.join(p, q)
        yield from forest.links()
        release_memory()

    found = materialize(dealt.mapInArrow(compare, "a long, b long"), "simhash-links")
    discard(stored)
    return found


class _Forest:
    """Union-find over fingerprints or rows that remembers the links it made."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.made: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    def join(self, a: int, b: int) -> None:
        if a != b and (x := self.root(a)) != (y := self.root(b)):
            self.parent[max(x, y)] = min(x, y)
            self.made.append((a, b))

    def links(self) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.made), 100_000):
            a, b = zip(*self.made[at : at + 100_000])
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


# --- similarity -----------------------------------------------------------------

SIMILARITY_SHINGLE, SIMILARITY = 5, 0.8
#: What pairs of a five-word similarity of 0.8 differ in, and about three deviations more.
NEAR_RADIUS = 16
#: Sketches of such pairs differ in 6.4 of 64 bits; one pair in 100,000 in more than these.
SKETCH_RADIUS = 18
_SKETCH_SEEDS = np.random.default_rng(42).integers(1, 2**63, 64, np.uint64) | np.uint64(1)
GROUP_ROWS = 500


def shingle_set(text: str, shingle: int) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - shingle + 1)
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, n))


def sketch(hashes: np.ndarray) -> int:
    """A bit of each of 64 minima of a set under different hashes, as a signed number: the
    bits of two sets differ with half the odds that the minima do."""
    if not len(hashes):
        return 0
    bits = np.empty(64, np.uint8)
    for i, seed in enumerate(_SKETCH_SEEDS):
        mixed = (hashes ^ seed) * seed
        mixed ^= mixed >> np.uint64(29)
        bits[i] = (mixed * np.uint64(0xBF58476D1CE4E5B9)).min() >> np.uint64(7) & np.uint64(1)
    return int(np.packbits(bits).view(np.int64)[0])


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    similarity_shingle: int = SIMILARITY_SHINGLE,
    shingle: int = 3,
    radius: int = NEAR_RADIUS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per document: id, ``carry``, ``group``. Documents share a group if links lead
    from one to the other; two are linked if their fingerprints are within ``radius`` bits
    and the Jaccard similarity of their shingle sets is at least ``similarity``. Texts
    without words resemble nothing."""
    spark = docs.sparkSession
    passed = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), *passed)
    rows = rows.withColumn("fp", fingerprint_column("text", shingle))
    # Equal rows share a number: they are linked as equal texts are.
    rows = rows.withColumn("node", F.xxhash64("id", "text")).withColumn("worded", F.col("text").rlike("[^\x20\x09-\x0D]"))

    @F.pandas_udf("long")
    def sketches(texts: pd.Series) -> pd.Series:
        found = texts.map(lambda t: sketch(shingle_set(t, similarity_shingle)))
        release_memory()
        return found.astype("int64")

    rows = rows.withColumn("sketch", sketches("text")).withColumn("point", F.xxhash64("fp", "sketch"))
    plain = materialize(rows.drop("text"), "near-rows")
    worded = plain.filter("worded")
    distinct = materialize(
        worded.groupBy("point", "fp", "sketch").agg(F.count_distinct("node").alias("n")), "near-distinct"
    )
    roots = connected_components(near_links(distinct.select("fp", F.col("point").alias("id"), "sketch"), radius))
    # Points that several texts share connect these texts as well.
    close = distinct.join(roots, F.col("point") == F.col("node"), "left").filter("root is not null or n > 1").select(
        "point", F.coalesce("root", "point").alias("part")
    )
    members = materialize(worded.join(close, "point").select("node", "part").distinct(), "near-members")
    sizes = members.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("long").alias("blocks"))
    again = docs.select(F.xxhash64(F.col(id_col).cast("long"), text).alias("node"), text.alias("text"))

    @F.pandas_udf("binary")
    def shingles(texts: pd.Series) -> pd.Series:
        sets = texts.map(lambda t: shingle_set(t, similarity_shingle).tobytes())
        release_memory()
        return sets

    held = again.join(members.join(sizes, "part"), "node").select("part", "blocks", "node", shingles("text").alias("set"))
    held = materialize(held, "near-shingles")
    # A group of many texts is compared block by block: each text meets all blocks in turn.
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    spread = held.select("part", "node", "set", block.alias("block"), other).select(
        "part", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "set"
    )
    width = shuffle_width(spark)
    dealt = spread.repartition(width, "part", "low", "high").sortWithinPartitions("part", "low", "high", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, name, nodes, sets = _Forest(), None, [], []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("part", "low", "high")))
            for i, key in enumerate(keys):
                if key != name:
                    _link_similar(forest, nodes, sets, similarity)
                    name, nodes, sets = key, [], []
                nodes.append(batch.column("node")[i].as_py())
                sets.append(np.frombuffer(batch.column("set")[i].as_py(), np.uint64))
        _link_similar(forest, nodes, sets, similarity)
        yield from forest.links()
        release_memory()

    links = materialize(dealt.mapInArrow(compare, "a long, b long"), "near-verified")
    groups = connected_components(links).withColumnRenamed("node", "linked")
    return plain.join(groups, F.col("node") == F.col("linked"), "left").select(
        F.col("id").alias(id_col),
        *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)],
        F.coalesce("root", "node").alias("group"),
    )


def _link_similar(forest: _Forest, nodes: list[int], sets: list[np.ndarray], similarity: float) -> None:
    """Links all texts of a block pair that are similar enough, skipping what is linked already.
    Shared shingles are counted through an inverted index, one text at a time."""
    if len(nodes) < 2:
        return
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    for i, own in enumerate(sets):
        low = np.searchsorted(values, own, "left")
        count = np.searchsorted(values, own, "right") - low
        at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        shared = np.bincount(owner[at], minlength=len(sets))
        similar = shared >= similarity * (sizes[i] + sizes - shared)
        for j in np.flatnonzero(similar[:i] & (shared[:i] > 0)).tolist():
            forest.join(nodes[i], nodes[j])


# --- partitions and thresholds --------------------------------------------------


def _bit_counts(points: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """How many points there are, set each bit, and set each pair of bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, pairs = 0, np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            fps = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False))
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            bits = bits.astype(np.float32)
            pairs += (bits.T @ bits).astype(np.int64)  # exact: a batch has under 2**24 rows
            total += len(fps)
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_pydict(
            {"i": np.append(i, -1), "j": np.append(j, -1), "n": np.append(pairs[i, j], total)}
        )

    counts = points.mapInArrow(count, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    both, total = np.zeros((BITS, BITS)), 0
    for r in counts.collect():  # one row per pair of bits
        if r["i"] < 0:
            total = int(r["n"])
        else:
            both[r["i"], r["j"]] = both[r["j"], r["i"]] = r["n"]
    return total, np.diag(both).copy(), both


def group_bits(n: int, ones: np.ndarray, both: np.ndarray, m: int) -> list[list[int]]:
    """``m`` partitions of near equal width; each grows by the bits most correlated with it."""
    p = ones / max(n, 1)
    deviation = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-12))
    correlation = np.abs(both / max(n, 1) - np.outer(p, p)) / deviation
    left, parts = set(range(BITS)), []
    for k in range(m):
        width = (BITS - sum(map(len, parts))) // (m - k)
        # start from the strongest pair that is left
        bits = sorted(left)
        strength = correlation[np.ix_(bits, bits)] - 2 * np.eye(len(bits))
        part = [bits[int(np.argmax(strength)) // len(bits)]]
        left.discard(part[0])
        while len(part) < width:
            best = max(sorted(left), key=lambda b: correlation[b, part].sum())
            part.append(best)
            left.discard(best)
        parts.append(sorted(part))
    return parts


def _estimates(n: int, ones: np.ndarray, parts: list[list[int]], pairs: list[float], radius: int, pair_cost: float) -> list[list[float]]:
    """Per partition the estimated cost of thresholds -1, 0, 1, ... radius: candidate
    pairs plus probes. Equal pairs are counted; a differing bit b multiplies them by the
    odds that two points differ there."""
    costs = []
    for i, part in enumerate(parts):
        p = ones[part] / max(n, 1)
        differ = 2 * p * (1 - p)
        odds = differ / np.maximum(1 - differ, 1e-9)
        elementary = [1.0] + [0.0] * radius
        for o in odds:
            for t in range(radius, 0, -1):
                elementary[t] += elementary[t - 1] * o
        row, candidates, probes = [0.0], 0.0, 0
        for t in range(radius + 1):
            candidates += max(pairs[i], 1.0) * elementary[t]
            probes += comb(len(part), t)
            row.append(candidates * pair_cost + n * probes)
        costs.append(row)
    return costs


def allocate(costs: list[list[float]], radius: int) -> list[int]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = radius + 1 of least total cost, by
    dynamic programming over partitions and what is left to allocate."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for extra in range(min(len(row) - 1, radius + 1 - spent) + 1):
                total = (cost + row[extra], [*chosen, extra - 1])
                if spent + extra not in step or total < step[spent + extra]:
                    step[spent + extra] = total
        best = step
    return best[radius + 1][1]
