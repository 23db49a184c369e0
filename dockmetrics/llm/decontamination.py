"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks.

Texts are lower-cased and cut into words at everything that is no letter or digit;
shingles are ``SHINGLE`` words, repeats included (a text of fewer words is one shingle and
can only match texts of just these words). For each item, windows of the item's number of
shingles (the whole document, if it is shorter) are compared with the item:

1. Windows. A window of similarity ``threshold`` shares all but a few of the item's
   shingles, so at least one of any few more than that. Each item's rarest such
   shingles are its anchors; all windows that hold an anchor of an item of their length
   are fingerprinted, whatever item that is. No other window can reach the threshold.
   A text's window starts fall into stretches of an item's length (at most ``STRETCH``);
   of each stretch only the first and last start that an anchor asks for are kept, so
   anchors that share windows cost a narrow row each and every window is printed once.
2. SimHash: bit by bit the majority of the window's 64-bit shingle hashes. The counts of
   eight or more bits are summed at once in the lanes of a long. They are counted for a
   stretch's first window; each next one drops a hash and takes one up.
3. Multi-index: fingerprints are cut into ``BLOCKS`` blocks. Within ``RADIUS`` bits at least
   one block differs in RADIUS // BLOCKS bits or fewer; items are stored under all such
   values, windows look up their own. So all pairs within the radius are found. A pair
   that several blocks find is kept where the first of them does.
4. Weighted similarity: shingles weigh as often as they occur; sum of the smaller weights
   over sum of the larger ones, at least ``threshold``, computed from all shingles. Those
   that both hold count once by set intersection, those that an item repeats are recounted.

Only built-in functions are used. The items are broadcast if they have at most
``BROADCAST_SHINGLES`` shingles in all, else the same joins are shuffled. Null and empty
texts have no shingles and match nothing. Items and documents without an id are judged like
others; repeated rows of a document give one row per item.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmetrics.llm.common import materialize, row_hash, whole_text

SHINGLE = 5
THRESHOLD = 0.8
RADIUS, BLOCKS = 15, 8
#: Window starts printed in one go; bounds a row's memory, not what is covered.
STRETCH = 1024
BROADCAST_SHINGLES = 200_000
_NO_WORD = "[^\\p{L}\\p{N}]+"


def with_shingles(rows: DataFrame, text: str, size: int = SHINGLE) -> DataFrame:
    """``text`` replaced by ``hashes``, the hashes of its word shingles in order."""
    others = [c for c in rows.columns if c != text]
    # The words are a column of their own: within the lambda they would be cut again for each shingle.
    words = rows.select(*others, F.array_remove(F.split(F.lower(text), _NO_WORD), "").alias("words"))
    each = F.when(F.size("words") == 0, F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(1)))
    )
    return words.select(*others, F.transform(each, lambda i: F.xxhash64(F.slice("words", i, size))).alias("hashes"))


def simhash(hashes: Column) -> Column:
    """The majority of each bit, as a long. Lanes are wide enough for the counts."""
    n = F.size(hashes)
    return F.when(n < 128, _lanes(hashes, 8)).when(n < 32768, _lanes(hashes, 16)).otherwise(_lanes(hashes, 32))


def _lanes(hashes: Column, width: int) -> Column:
    """A bit is set if over half the hashes set it. Total k holds the counts of the bits k,
    width + k, ... in lanes; adding ``lift`` carries a majority into a lane's top bit. The
    uppermost lane is lifted apart from the others: with it the sum could overflow."""
    ones = _ones(width)

    def total(bit: int) -> Column:
        add = lambda acc, h: acc + F.shiftrightunsigned(h, bit).bitwiseAND(ones)
        return F.aggregate(hashes, F.lit(0).cast("long"), add)

    return _majorities(F.array(*[total(bit) for bit in range(width)]), F.size(hashes), width)


def _ones(width: int) -> Column:
    return F.lit(_signed(sum(1 << at for at in range(0, 64, width))))


def _majorities(totals: Column, size: Column, width: int) -> Column:
    low = F.lit((1 << (64 - width)) - 1)
    low_ones = F.lit(sum(1 << at for at in range(0, 64 - width, width)))
    lift = F.lit((1 << (width - 1)) - 1) - F.floor(size / 2).cast("long")

    def majority(total: Column, bit: Column) -> Column:
        lower = F.shiftrightunsigned(total.bitwiseAND(low) + lift * low_ones, width - 1).bitwiseAND(low_ones)
        upper = F.shiftrightunsigned(F.shiftrightunsigned(total, 64 - width) + lift, width - 1)
        return F.call_function("shiftleft", lower.bitwiseOR(F.shiftleft(upper, 64 - width)), bit)

    return F.aggregate(F.transform(totals, majority), F.lit(0).cast("long"), lambda acc, part: acc.bitwiseOR(part))


def sliding_simhashes(hashes: Column, size: Column) -> Column:
    """``simhash`` of every window of ``size`` hashes, in order. The first is counted, then a
    step costs two changes of the counts, however long the windows are."""
    return (
        F.when(size < 128, _sliding(hashes, size, 8))
        .when(size < 32768, _sliding(hashes, size, 16))
        .otherwise(_sliding(hashes, size, 32))
    )


def _sliding(hashes: Column, size: Column, width: int) -> Column:
    ones, more = _ones(width), F.size(hashes) - size
    lane = lambda h, bit: F.call_function("shiftrightunsigned", h, bit).bitwiseAND(ones)
    counted = F.aggregate(
        F.slice(hashes, F.lit(1), size),
        F.array(*[F.lit(0).cast("long")] * width),
        lambda totals, h: F.transform(totals, lambda total, bit: total + lane(h, bit)),
    )
    pairs = lambda old, new: F.struct(old.alias("old"), new.alias("new"))
    steps = F.zip_with(F.slice(hashes, F.lit(1), more), F.slice(hashes, size + 1, more), pairs)

    def next_totals(done: Column, step: Column) -> Column:
        change = lambda total, bit: total - lane(step["old"], bit) + lane(step["new"], bit)
        return F.concat(done, F.array(F.transform(F.element_at(done, -1), change)))

    all_totals = F.aggregate(steps, F.array(counted), next_totals)
    return F.transform(all_totals, lambda totals: _majorities(totals, size, width))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _anchored_items(items: DataFrame, threshold: float) -> DataFrame:
    """(item, hashes, n, anchors): anchors are the shingles of which every window of the
    threshold holds at least one."""
    each = items.select("item", F.explode("hashes").alias("h"))
    common = each.groupBy("h").agg(F.count(F.lit(1)).alias("uses"))
    ranked = each.join(common, "h").groupBy("item").agg(F.array_sort(F.collect_list(F.struct("uses", "h"))).alias("rare"))
    # similarity t: at least t of the item's shingles are shared
    needed = F.col("n") - F.ceil(F.col("n") * F.lit(threshold)).cast("int") + 1
    return items.join(ranked, "item").withColumn(
        "anchors", F.array_distinct(F.transform(F.slice("rare", 1, needed), lambda r: r["h"]))
    ).drop("rare")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
) -> DataFrame:
    """The best window of each document and item that match: id, ``row_hash`` (of the text),
    item id, ``similarity``, ``distance`` in bits, ``start`` (word) and ``words``."""
    items = benchmark.select(F.col(item_col).alias("item_id"), whole_text(item_text_col).alias("text"))
    items = with_shingles(items, "text").filter(F.size("hashes") > 0).select(
        F.xxhash64("item_id", "hashes").alias("item"), "item_id", "hashes", F.size("hashes").alias("n")
    ).dropDuplicates(["item"])
    items = items.withColumn("item_fp", simhash(F.col("hashes")))
    items = materialize(_anchored_items(materialize(items, "benchmark"), threshold), "benchmark-items")
    total = items.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hint = F.broadcast if total <= BROADCAST_SHINGLES else (lambda df: df)

    anchors = items.select("n", F.explode("anchors").alias("h")).distinct()
    texts = docs.select(
        F.col(id_col).alias("id"), row_hash(text_col).alias("row_hash"), whole_text(text_col).alias("text")
    )
    shingled = with_shingles(texts, "text")
    # outer: else the optimizer adds a filter on the array's size, for which it is computed again
    at = shingled.select("id", "row_hash", F.size("hashes").alias("length"), F.posexplode_outer("hashes").alias("p", "h"))
    hits = at.join(hint(anchors), "h")
    size = F.least("n", "length")
    low = F.greatest(F.col("p") - size + 1, F.lit(0))
    high = F.least(F.col("p"), F.col("length") - size)
    asked = hits.select("id", "row_hash", "n", low.alias("low"), high.alias("high"), F.least("n", F.lit(STRETCH)).alias("step"))
    stretch = F.explode(F.sequence(F.expr("low div step"), F.expr("high div step"))).alias("stretch")
    inside = asked.select("id", "row_hash", "n", "low", "high", "step", stretch)
    ranges = inside.groupBy("id", "row_hash", "n", "stretch").agg(
        F.min(F.greatest("low", (F.col("stretch") * F.col("step")).cast("int"))).alias("low"),
        F.max(F.least("high", (F.col("stretch") * F.col("step") + F.col("step") - 1).cast("int"))).alias("high"),
    )
    # a row per text that holds anchors: no more entries than the text has shingles per item length
    of_text = ranges.groupBy(F.col("id").alias("id_"), F.col("row_hash").alias("row_hash_")).agg(
        F.collect_list(F.struct("n", "low", "high")).alias("ranges")
    )
    of_text = materialize(of_text, "ranges")
    touched = texts.join(of_text, F.col("id").eqNullSafe(F.col("id_")) & (F.col("row_hash") == F.col("row_hash_")))
    cut = with_shingles(touched.select("id", "row_hash", "text", "ranges"), "text").select(
        "id", "row_hash", "hashes", F.explode("ranges").alias("range")
    ).select(
        "id", "row_hash", "range.n", "range.low", F.least("range.n", F.size("hashes")).alias("size"),
        F.slice("hashes", F.col("range.low") + 1, F.col("range.high") - F.col("range.low") + F.least("range.n", F.size("hashes"))).alias("around"),
    )
    printed = cut.withColumn("fps", sliding_simhashes(F.col("around"), F.col("size")))
    # numbered, so that a probe can be joined to the one row it came from
    stretches = materialize(printed.withColumn("row", F.monotonically_increasing_id()), "stretches")

    width, reach = 64 // BLOCKS, radius // BLOCKS
    of_block = lambda fp, b: F.shiftrightunsigned(fp, b * width).bitwiseAND(F.lit((1 << width) - 1))
    flips = [sum(1 << b for b in bits) for k in range(reach + 1) for bits in combinations(range(width), k)]
    stored = items.select("item", "n", "item_fp", F.explode(F.array(*[F.lit(b) for b in range(BLOCKS)])).alias("block")).select(
        "item", "n", "item_fp", "block",
        F.expr(f"shiftrightunsigned(item_fp, block * {width}) & {(1 << width) - 1}").alias("own"),
    ).select("item", "n", "item_fp", "block", F.explode(F.array(*[F.col("own").bitwiseXOR(F.lit(f)) for f in flips])).alias("value"))
    blocks = F.inline(F.array(*[F.struct(F.lit(b).alias("block"), of_block(F.col("fp"), b).alias("value")) for b in range(BLOCKS)]))
    probed = stretches.select("row", "n", F.posexplode("fps").alias("s", "fp")).select("row", "n", "s", "fp", blocks)
    apart = F.col("fp").bitwiseXOR(F.col("item_fp"))
    first = F.lit(BLOCKS)
    for b in reversed(range(BLOCKS)):
        first = F.when(F.bit_count(of_block(apart, b)) <= reach, b).otherwise(first)
    close = probed.join(hint(stored), ["n", "block", "value"]).filter(
        (F.bit_count(apart) <= radius) & (first == F.col("block"))
    )

    narrow = close.select("row", "s", "item", F.bit_count(apart).alias("distance"))
    occurrences = lambda hashes, h: F.size(F.filter(hashes, lambda x: x == h))
    repeats = items.select("item", "item_id", "hashes", F.explode("hashes").alias("h")).groupBy("item", "h").agg(
        F.count(F.lit(1)).cast("int").alias("uses")
    ).filter("uses > 1").groupBy(F.col("item").alias("item_")).agg(F.collect_list(F.struct("h", "uses")).alias("repeats"))
    counted = items.join(repeats, F.col("item") == F.col("item_"), "left").select(
        "item", "item_id", F.col("hashes").alias("item_hashes"),
        F.coalesce("repeats", F.array().cast("array<struct<h:bigint,uses:int>>")).alias("repeats"),
    )
    counted = materialize(counted, "benchmark-counts")
    found = narrow.join(stretches.drop("fps", "n"), "row").join(hint(counted), "item").select(
        "id", "row_hash", "item_id", "distance", (F.col("low") + F.col("s")).alias("start"), "item_hashes", "repeats",
        F.slice("around", F.col("s") + 1, F.col("size")).alias("window"),
    )
    once = F.size(F.array_intersect("window", "item_hashes"))
    again = F.aggregate(
        "repeats", F.lit(0),
        lambda acc, r: acc + F.greatest(F.least(occurrences(F.col("window"), r["h"]), r["uses"]) - 1, F.lit(0)),
    )
    scored = found.select(
        "id", "row_hash", "item_id", "distance", "start", (F.size("window") + SHINGLE - 1).alias("words"),
        (once + again).alias("shared"), (F.size("window") + F.size("item_hashes")).alias("both"),
    )
    similarity = F.col("shared") / (F.col("both") - F.col("shared"))
    matched = scored.withColumn("similarity", similarity).filter(F.col("similarity") >= threshold)
    best = F.max(
        F.struct("similarity", (-F.col("distance")).alias("near"), (-F.col("start")).alias("early"), "words")
    ).alias("best")
    return matched.groupBy("id", "row_hash", "item_id").agg(best).select(
        F.col("id").alias(id_col), "row_hash", F.col("item_id").alias(item_col),
        F.col("best.similarity").alias("similarity"), (-F.col("best.near")).alias("distance"),
        (-F.col("best.early")).alias("start"), F.col("best.words").alias("words"),
    )
