"""Document fingerprints, vector codes and conversation tries against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockmetrics.llm import conversation_trie as trie
from dockmetrics.llm import quartile_digest as digest
from dockmetrics.llm import vector_codes as codes
from llm_data import EDGE_ROWS, prose

# --- document fingerprints ------------------------------------------------------


def digest_brute(text):
    raw = (text or "").encode()
    padded = raw + bytes(digest.THIRD)
    counts = Counter()
    for i in range(len(raw)):
        key = padded[i] | padded[i + digest.SECOND] << 8 | padded[i + digest.THIRD] << 16
        key = key * 0x9E3779B1 % 2**32
        key = (key ^ key >> 15) * 0x85EBCA77 % 2**32
        counts[key >> 24] += 1
    ordered = sorted(counts[b] for b in range(256))
    quartiles = ordered[63], ordered[127], ordered[191]
    bits = "".join(f"{sum(counts[b] > q for q in quartiles):02b}" for b in range(256))
    return f"{min(int(8 * math.log2(1 + len(raw))), 255):02x}{int(bits, 2):0128x}"


def test_fingerprint_by_definition(monkeypatch):
    texts = [t for _, t in EDGE_ROWS if len(t or "") < 5000] + [prose(i, n) for i, n in enumerate((1, 3, 40, 900))]
    for text in texts:
        assert digest.fingerprint(text) == digest_brute(text)
    whole = [digest.fingerprint(t) for t in texts]
    monkeypatch.setattr(digest, "SLICE_BYTES", 7)
    assert [digest.fingerprint(t) for t in texts] == whole


def test_likeness_is_bounded_and_tells_edits_from_other_texts():
    rng = random.Random(1)
    for n in (5, 30, 300, 5000):
        a, b = prose(n, n, 5000), prose(n + 1, n, 5000)
        words = a.split()
        for _ in range(1 + n // 20):
            words[rng.randrange(n)] = f"w{rng.randrange(5000)}"
        x, y, z = (digest.fingerprint(t) for t in (a, " ".join(words), b))
        assert 0 <= digest.likeness(x, z) < digest.likeness(x, y) < digest.likeness(x, x) == 1
        assert digest.likeness(x, y) == digest.likeness(y, x)
    assert digest.likeness(digest.fingerprint("a text"), digest.fingerprint("")) == 0
    assert digest.likeness(digest.fingerprint(None), digest.fingerprint("")) == 1


def next_brute(rows):
    """Rows in ascending id; ties of one id as the operator orders them are up to a hash."""
    out = []
    for at, (i, text) in enumerate(rows):
        text, after = text or "", rows[(at + 1) % len(rows)][1] or ""
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        x, y, z = (digest.fingerprint(t) for t in (text, edited, after))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((i, len(text), sha, x, y, digest.likeness(x, y), digest.likeness(x, z)))
    return sorted(out, key=str)


FOUND = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("partitions", [1, 3, 9])
def test_documents_against_the_next_one(docs_of, rows_of, partitions):
    rows = [(None, "first of all"), *[(i, t) for i, t in EDGE_ROWS if i is not None]]
    rows += [(20 + i, prose(i, 5 + i, 60)) for i in range(40)]
    docs = docs_of(rows).withColumn("id", F.lit("clash")).withColumn("part", F.lit("clash"))
    assert rows_of(digest.compare_with_next(docs, partitions=partitions), *FOUND) == next_brute(rows)


def test_a_single_document_and_none(docs_of, empty_docs, rows_of):
    assert rows_of(digest.compare_with_next(docs_of([(7, "only one")])), *FOUND) == next_brute([(7, "only one")])
    assert digest.compare_with_next(empty_docs).collect() == []


def test_one_text_that_fills_several_ranges(docs_of):
    found = digest.compare_with_next(docs_of([(1, "the same text")] * 400 + [(2, "another")]), partitions=8)
    counts = {r["edited_sha256"]: r["count"] for r in found.groupBy("edited_sha256").count().collect()}
    same = hashlib.sha256(b"the same tthe").hexdigest()
    cut = hashlib.sha256(b"the same tano").hexdigest()
    assert counts[same] == 399
    assert counts[cut] == 1
    assert sum(counts.values()) == 401


def test_columns_of_fingerprints(docs_of):
    docs = docs_of([(1, "one text"), (2, None)]).withColumn("fp", digest.fingerprint_column("text"))
    rows = {r["doc_id"]: r for r in docs.withColumn("like", digest.likeness_column("fp", F.lit(digest.fingerprint("")))).collect()}
    assert rows[1]["fp"] == digest.fingerprint("one text")
    assert (rows[1]["like"], rows[2]["like"]) == (0.0, 1.0)


# --- vector codes ---------------------------------------------------------------


def codes_brute(rows, parts, entries, rounds, scale=256):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = -(-max(1, max(len(v) for _, v, _ in kept)) // parts) * parts
    d = width // parts
    vectors = [[math.floor(scale * x) for x in v] + [0] * (width - len(v)) for _, v, _ in kept]
    cut = [[v[p * d : (p + 1) * d] for p in range(parts)] for v in vectors]
    book = [[cut[e][p] for e in range(min(entries, len(cut)))] for p in range(parts)]

    def assign(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(v[p], c)), e) for e, c in enumerate(book[p]))

    for _ in range(rounds):
        of = [[assign(v, p)[1] for v in cut] for p in range(parts)]
        for p in range(parts):
            for e in range(len(book[p])):
                own = [v[p] for v, at in zip(cut, of[p]) if at == e]
                if own:
                    book[p][e] = [sum(c) // len(own) for c in zip(*own)]
    sha = hashlib.sha256(",".join(str(x) for p in book for e in p for x in e).encode()).hexdigest()
    found = [[assign(v, p) for p in range(parts)] for v in cut]
    errors = [sum(x for x, _ in f) for f in found]
    by_label = Counter()
    for (_, _, label), error in zip(kept, errors):
        by_label[label] += error
    return sorted(
        ((i, "".join(f"{e:02x}" for _, e in f), error, by_label[label], sha) for (i, _, label), f, error in zip(kept, found, errors)),
        key=str,
    )


VECTORS = "vec_id long, embedding array<float>, label int"
CODED = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def vectors(seed, n, width):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(7)]
    rows = []
    for i in range(n):
        x = [float(np.float32(c + rng.gauss(0, 0.2))) for c in rng.choice(centres)]
        rows.append((i, x, rng.choice([None, 1, 2, 2, 2])))
    return rows


@pytest.mark.parametrize(("parts", "entries", "width"), [(4, 8, 16), (16, 64, 32), (4, 64, 10)])
def test_codes_equal_brute_force(spark, rows_of, parts, entries, width):
    rows = vectors(parts + entries, 150, width)
    rows += [(None, rows[3][1], 5), (7, rows[9][1], 1), (7, rows[9][1], 1), (500, None, 1), (501, [None] * width, 1)]
    rows += [(502, [float("nan")] * width, 2), (503, [float("-inf")] * width, 2), (504, rows[1][1][:-1], None), (505, [], 9)]
    frame = spark.createDataFrame(rows, VECTORS).repartition(5).withColumn("id", F.lit("clash")).withColumn("code", F.lit("x"))
    found = codes.compress_vectors(frame, parts=parts, entries=entries)
    assert rows_of(found, *CODED) == codes_brute(rows, parts, entries, 2)


def test_codes_of_few_or_no_vectors(spark, rows_of):
    few = [(3, [0.5, -0.5], None), (1, [0.25, 1.0], None)]
    assert rows_of(codes.compress_vectors(spark.createDataFrame(few, VECTORS), parts=2), *CODED) == codes_brute(few, 2, 64, 2)
    assert codes.compress_vectors(spark.createDataFrame([], VECTORS)).collect() == []
    assert codes.compress_vectors(spark.createDataFrame([(1, None, 1)], VECTORS)).collect() == []


def test_codes_of_huge_components_are_cut_off(spark):
    rows = [(1, [3e38, 0.0, -3e38, 1.0], 1), (2, [0.0, 0.0, 0.0, 0.0], 1)]
    found = codes.compress_vectors(spark.createDataFrame(rows, VECTORS), parts=2, entries=1, rounds=0).collect()
    bound = codes._bound(4)
    assert {r["vec_id"]: r["error"] for r in found} == {1: 0, 2: 2 * bound**2 + 256**2}


def test_candidates_hold_every_nearest_entry():
    rng = np.random.default_rng(3)
    entries = rng.integers(-6, 6, (64, 3))
    x = rng.integers(-9, 9, (500, 3))
    part = codes.PartIndex(entries)
    mask = part.candidates(x)
    distance = np.square(x[:, None] - entries[None]).sum(axis=2)
    nearest = distance == distance.min(axis=1, keepdims=True)
    held = (mask[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(bool)
    assert not (nearest & ~held).any()
    assert held.sum() < 0.5 * held.size
    index, best = part.nearest(x)
    assert (index == distance.argmin(axis=1)).all()
    assert (best == distance.min(axis=1)).all()


# --- conversation trie ----------------------------------------------------------


def trie_brute(paths):
    """paths: conversation -> list of (role, text)."""
    members, enders = defaultdict(list), defaultdict(list)
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            members[tuple(path[:depth])].append(conv)
        enders[tuple(path)].append(conv)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[: len(n)] == n and len(m) > len(n) for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        sha = hashlib.sha256(",".join(map(str, sorted(enders[node]))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, sha))
    return sorted(out, key=str)


NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string"


def rebuilt_brute(rows, every=100, most=6):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        out[c] = own.get(c - int(math.fmod(c, every)), [])[:h] + turns[h:]
    return out


def shared_starts(n, seed=4):
    """Conversations that start like others, in steps of any length."""
    rng = random.Random(seed)
    paths = [[]]
    for _ in range(n):
        base = rng.choice(paths)
        path = base[: rng.randrange(len(base) + 1)]
        path += [(rng.choice("ua"), "t" * rng.randrange(4)) for _ in range(rng.randrange(6))]
        paths.append(path)
    return {i: p for i, p in enumerate(paths[1:], 1) if p}


def rows_from(paths):
    return [(c, 10 * at, role, text) for c, path in paths.items() for at, (role, text) in enumerate(path)]


@pytest.mark.parametrize("block", [1, 2, 4])
def test_trie_equals_brute_force(spark, rows_of, block):
    paths = shared_starts(150)
    rows = rows_from(paths)
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, TURNS).repartition(5).withColumn("pos", F.lit("clash")).withColumn("a", F.lit("x"))
    assert rows_of(trie.conversation_trie(frame, block=block), *NODES) == trie_brute(paths)


def test_trie_of_shared_heads_and_turnless_conversations(spark, rows_of):
    paths = {c: p for c, p in zip([*range(95, 140), -3, -100, 205, 300, 301, 302], shared_starts(80, 9).values())}
    rows = [*rows_from(paths), (None, 1, "user", "nobody's"), (500, None, None, None), (500, 0, "a", "x"), (501, 0, "a", "x")]
    frame = spark.createDataFrame(rows, TURNS)
    turns, convs = trie.with_shared_heads(trie.conversation_turns(frame))
    rebuilt = rebuilt_brute(rows)
    assert [] in rebuilt.values()
    assert rows_of(trie.prefix_trie(turns, convs), *NODES) == trie_brute(rebuilt)


def test_trie_of_many_equal_conversations_over_all_ranges(spark, rows_of, monkeypatch):
    monkeypatch.setattr(trie, "PIECE_IDS", 10)
    paths = {i: [("u", "hello"), ("a", "hi")] for i in range(300)} | {i: [("u", "hello"), ("a", str(i % 9))] for i in range(300, 400)}
    frame = spark.createDataFrame(rows_from(paths), TURNS).repartition(4)
    assert rows_of(trie.conversation_trie(frame), *NODES) == trie_brute(paths)


def test_trie_of_a_long_conversation_in_stretches(spark, rows_of):
    rng = random.Random(6)
    long = [("u", str(rng.randrange(50))) for _ in range(230)]
    paths = {1: long, 2: long[:97], 3: long[:150] + [("a", "other")] * 20, 4: long}
    frame = spark.createDataFrame(rows_from(paths), TURNS)
    turns = trie.conversation_turns(frame)
    found = trie.prefix_trie(turns, turns.select("conv").distinct(), block=3, stretch=5)
    assert rows_of(found, *NODES) == trie_brute(paths)


def test_trie_of_repeated_and_blank_rows(spark, rows_of):
    rows = [(1, 0, "u", "x"), (1, 0, "u", "x"), (1, None, None, ""), (2, 5, "", None), (2, 7, "u", "x"), (2, 7, "u", "x")]
    expected = {1: [("", ""), ("u", "x"), ("u", "x")], 2: [("", ""), ("u", "x"), ("u", "x")]}
    assert rows_of(trie.conversation_trie(spark.createDataFrame(rows, TURNS)), *NODES) == trie_brute(expected)
    assert trie.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []
    only_null = spark.createDataFrame([(None, 0, "u", "x")], TURNS)
    assert trie.conversation_trie(only_null).collect() == []
