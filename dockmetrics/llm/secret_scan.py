"""Secret scan: three fixed patterns plus sliding-window entropy over candidate strings.

Patterns (the base spans; leftmost, non-overlapping per kind, whole match):
``assign`` a named value of eight characters or more, ``access`` an access key id,
``hex`` 32 or more hexadecimal digits.

Entropy spans: a candidate is a maximal run of token characters. Its character class
(hex, base36 or base64) sets the threshold. A window slides over it; the Shannon
entropy follows from the counts of the window's characters, of which each step
changes two. The span runs from the first to the last window that reaches the
threshold. Allow-listed candidates are suppressed: without both a letter and a
digit, UUIDs, dates and versions, known dummy words, spans that lie within a base span.

All expressions are Spark's own. Offsets are code points, ends exclusive. A null
text is an empty one and has no spans.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmetrics.llm.common import whole_text

# Fixed values of the contract.
ASSIGN = "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_MIN = 8
ACCESS = "AKIA[A-Z0-9]+"
ACCESS_MIN = 16
HEX = "[0-9a-f]+"
HEX_MIN = 32
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = f"[A-Za-z0-9+/_-]{{{WINDOW},}}={{0,2}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
#: Character classes, narrowest first, and the bits per character that a window
#: of ``WINDOW`` characters must reach (at most log2(WINDOW) = 4.32).
CLASSES = (("^[0-9a-fA-F]+$", 3.2), ("^[0-9a-z]+$|^[0-9A-Z]+$", 3.6), ("", 3.8))
ALLOW = (
    "^[^0-9]*$",
    "^[^A-Za-z]*$",
    "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    "(?i)example|sample|dummy|placeholder|changeme|lorem|abcdefghij|0123456789|(.)\\1{7}",
    "^[A-Za-z]+([-_/][A-Za-z]+)*[-_/]?[0-9]{1,4}$",
)


def secret_spans(
    text: Column, threshold_shift: float = 0.0, allow: tuple[str, ...] = ALLOW
) -> dict[str, Column]:
    """Per kind an array of (start, end) of the text column."""
    assign = F.filter(
        _matches(text, ASSIGN),
        lambda m: F.length(F.regexp_extract(m["value"], f"^{ASSIGN}$", 2)) >= ASSIGN_MIN,
    )
    found = {
        "assign": assign,
        # A run that begins too late to be long enough holds no other match.
        "access": _matches(text, f"AKIA[A-Z0-9]{{{ACCESS_MIN - 4},}}"),
        "hex": _matches(text, f"[0-9a-f]{{{HEX_MIN},}}"),
    }
    base = {kind: F.transform(spans, lambda m: F.struct(m["start"], m["end"])) for kind, spans in found.items()}
    candidates = F.filter(_matches(text, CANDIDATE), lambda m: _suspicious(m["value"], allow))
    scored = F.transform(candidates, lambda m: F.struct(m["start"].alias("start"), _hot_windows(m["value"], threshold_shift).alias("hot")))
    hot = F.transform(
        F.filter(scored, lambda m: m["hot"]["last"] >= 0),
        lambda m: F.struct((m["start"] + m["hot"]["first"]).alias("start"), (m["start"] + m["hot"]["last"] + WINDOW).alias("end")),
    )
    return {**base, "entropy": hot}


def secret_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold_shift: float = 0.0
) -> DataFrame:
    """One row per document: id and the spans of each kind. An entropy span that lies
    within a base span is suppressed, one that reaches beyond it stays whole. A repeated
    row is judged like any other; other columns are not read."""
    rows = docs.select(F.col(id_col), whole_text(text_col).alias("scanned_text"))
    spans = secret_spans(F.col("scanned_text"), threshold_shift)
    rows = rows.select(id_col, *[c.alias(k) for k, c in spans.items()])
    base = F.concat("assign", "access", "hex")
    within = lambda e: F.exists(base, lambda b: (b["start"] <= e["start"]) & (e["end"] <= b["end"]))
    return rows.withColumn("entropy", F.filter("entropy", lambda e: ~within(e)))


def joined_spans(kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` by start, then kind in the listed order, comma-joined."""

    def tagged(kind: str) -> Column:
        number = F.lit(KINDS.index(kind)).alias("kind")
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), number, s["end"].alias("end")))

    names = F.array(*map(F.lit, KINDS))
    parts = F.transform(
        F.array_sort(F.concat(*map(tagged, kinds))),
        lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(parts, ",")


def _matches(text: Column, pattern: str) -> Column:
    """(start, end, value) of all matches: what lies between the matches gives their places."""
    regex = F.lit(pattern)
    values = F.regexp_extract_all(text, regex, F.lit(0))
    between = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.arrays_zip(values.alias("value"), F.slice(between, 1, F.size(values)).alias("gap"))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def step(done: Column, pair: Column) -> Column:
        begin = done["at"] + pair["gap"]
        end = begin + F.length(pair["value"])
        span = F.struct(begin.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    located = F.aggregate(pairs, start, step, lambda done: done["spans"])
    return F.when(text.rlike(pattern), located).otherwise(empty)


def _suspicious(value: Column, allow: tuple[str, ...]) -> Column:
    keep = F.lit(True)
    for pattern in allow:
        keep = keep & ~value.rlike(pattern)
    return keep


def _hot_windows(value: Column, shift: float) -> Column:
    """First and last start of the windows that reach the class's threshold (-1: none).

    State: count per character, sum of c*log2(c) over the counts, place. Entering and
    leaving characters change one count each."""
    threshold = F.lit(CLASSES[-1][1] + shift)
    for pattern, bits in reversed(CLASSES[:-1]):
        threshold = F.when(value.rlike(pattern), bits + shift).otherwise(threshold)
    # Reached when the sum of c*log2(c) is at most this (H = log2 W - sum / W).
    limit = (F.lit(math.log2(WINDOW)) - threshold) * WINDOW + 1e-9
    places = F.filter(F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c)), lambda k: k > 0)
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(0).alias("at"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
        places.alias("places"),
    )

    def step(s: Column, entering: Column) -> Column:
        # slot 0 stands for "no character leaves yet"
        leaving = F.when(s["at"] >= WINDOW, F.try_element_at(s["places"], s["at"] - WINDOW + 1)).otherwise(F.lit(0))
        same = leaving == entering
        c_in, c_out = s["counts"][entering], s["counts"][leaving]
        change = F.when(same, 0.0).otherwise(
            weight[c_in + 1] - weight[c_in]
            + F.when(s["at"] >= WINDOW, weight[c_out - 1] - weight[c_out]).otherwise(0.0)
        )
        total = s["sum"] + change
        counts = F.transform(
            s["counts"],
            lambda c, k: c + F.when(k == entering, 1).otherwise(0) - F.when((k == leaving) & (k > 0), 1).otherwise(0),
        )
        begin = s["at"] + 1 - WINDOW
        hot = (begin >= 0) & (total <= limit)
        return F.struct(
            counts.alias("counts"), total.alias("sum"), (s["at"] + 1).alias("at"),
            F.when(hot & (s["first"] < 0), begin).otherwise(s["first"]).alias("first"),
            F.when(hot, begin).otherwise(s["last"]).alias("last"),
            s["places"].alias("places"),
        )

    return F.aggregate(places, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))
