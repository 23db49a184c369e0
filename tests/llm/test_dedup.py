"""Exact dedup, SimHash groups and components against brute force."""

import hashlib
import random
import re
from collections import defaultdict
from pathlib import Path

import pytest
import xxhash
from pyspark.sql import functions as F

from dockmetrics.llm import exact_dedup as exact
from dockmetrics.llm import simhash_dedup as near
from dockmetrics.llm.common import discard, materialize
from dockmetrics.llm.components import connected_components
from dockmetrics.llm.exact_dedup import exact_dedup
from llm_data import EDGE_ROWS, prose


def exact_brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for norm, members in groups.items():
        keep = min(members)[3]
        out += [(m[3], keep, len(members), hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [1, 5])
def test_exact_dedup_equals_brute_force(docs_of, rows_of, partitions):
    rng = random.Random(5)
    rows = EDGE_ROWS + [(100 + i, prose(rng.randrange(40), 30) + " " * rng.randrange(3)) for i in range(200)]
    found = exact_dedup(docs_of(rows), partitions=partitions)
    assert rows_of(found, "doc_id", "keep_id", "group_size", "text_sha256") == exact_brute(rows)
    kept = found.filter("kept").groupBy("text_sha256").count()
    assert kept.filter("count <> 1").count() == 0
    assert kept.count() == found.select("text_sha256").distinct().count()


def test_exact_dedup_joins_a_group_that_fills_several_ranges(docs_of, rows_of):
    rows = [(i, " same text " if i == 70 else "same text") for i in range(100)] + [(200, "zz"), (201, "aa")]
    found = exact_dedup(docs_of(rows), partitions=8)
    assert found.filter("group_size = 100 and keep_id = 70").count() == 100
    assert rows_of(found.filter("kept"), "doc_id") == [(200,), (201,), (70,)]


def test_exact_dedup_carries_columns_and_takes_empty_tables(empty_docs, docs_of, rows_of):
    assert exact_dedup(empty_docs).collect() == []
    docs = docs_of([(1, "a"), (2, "a ")]).withColumn("id", F.lit("clash")).withColumn("run", F.col("doc_id") * 2)
    assert rows_of(exact_dedup(docs, carry=["run", "id"]), "doc_id", "kept", "run", "id") == [(1, False, 2, "clash"), (2, True, 4, "clash")]


def simhash_brute(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_brute(nodes, linked):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {n: root(n) for n in nodes}


def test_fingerprint_by_definition():
    for text in [t for _, t in EDGE_ROWS if len(t or "") < 5000] + [prose(i, n) for i, n in enumerate((1, 2, 3, 4, 254, 255, 256, 900))]:
        assert near.fingerprint(text or "") == simhash_brute(text)


def test_simhash_dedup_equals_brute_force(docs_of, rows_of):
    rows = [(i, prose(i % 25, 12 + i % 3, 30)) for i in range(120)] + EDGE_ROWS[:7]
    found = near.simhash_dedup(docs_of(rows)).collect()
    prints = {simhash_brute(t) for _, t in rows}
    roots = components_brute(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, t in rows:
        root = roots[simhash_brute(t)]
        if i is not None:
            least[root] = min(i, least.get(root, i))
    expected = sorted(((i, f"{simhash_brute(t):016x}", least.get(roots[simhash_brute(t)])) for i, t in rows), key=str)
    assert sorted(((r[0], r[1], r[2]) for r in found), key=str) == expected


def links_connect_as_all_pairs_do(spark, radius, bucket_rows):
    rng = random.Random(radius)
    centres = [rng.getrandbits(64) for _ in range(6)]
    values = set()
    for _ in range(300):
        value = rng.choice(centres)
        for _ in range(rng.randrange(radius + 2)):
            value ^= 1 << rng.randrange(64)
        values.add(value)
    values |= {rng.getrandbits(64) for _ in range(100)}
    signed = [(near._signed(v),) for v in values]
    links = near.near_links(spark.createDataFrame(signed, "fp long"), radius, bucket_rows)
    for a, b in links.collect():
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= radius
    roots = {r["node"]: r["root"] for r in connected_components(links).collect()}
    nodes = [v for (v,) in signed]
    expected = components_brute(nodes, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= radius)
    assert {n: roots.get(n, n) for n in nodes} == expected


@pytest.mark.parametrize(("radius", "bucket_rows"), [(1, 4), (2, 4), (2, 1000), (4, 4), (10, 4)])
def test_near_links_connect_as_all_pairs_do(spark, radius, bucket_rows):
    links_connect_as_all_pairs_do(spark, radius, bucket_rows)


@pytest.mark.parametrize("chosen", [[1, 0], [2, -1], [0, 1]])
def test_near_links_at_any_threshold(spark, monkeypatch, chosen):
    """Large buckets of a partition that is probed with flips too."""
    parts = [list(range(0, 64, 2)), list(range(1, 64, 2))]
    monkeypatch.setattr(near, "_partition_numbers", lambda radius: [2])
    monkeypatch.setattr(near, "group_bits", lambda *args: parts)
    monkeypatch.setattr(near, "allocate", lambda costs, radius: chosen)
    links_connect_as_all_pairs_do(spark, 2, 4)


def test_simhash_dedup_of_clashing_columns(docs_of, rows_of):
    docs = docs_of([(1, "a b c d"), (2, "a b c d"), (None, None)])
    for clash in ("id", "fp", "root", "node", "component_id", "fingerprint", "carry_0"):
        docs = docs.withColumn(clash, F.lit("clash"))
    found = near.simhash_dedup(docs)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((r["doc_id"], r["component_id"]) for r in found.collect() if r["doc_id"]) == [(1, 1), (2, 1)]


def test_discarded_tables_are_gone_and_others_are_left(spark):
    written, other = materialize(spark.range(9), "test"), spark.range(3)
    folder = Path(written.inputFiles()[0].removeprefix("file:")).parent
    assert folder.is_dir()
    discard(written, other)
    assert not folder.exists()
    discard(written, other)
    assert other.count() == 3


def test_exact_dedup_beyond_the_bound_of_its_broadcast(docs_of, rows_of, monkeypatch):
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i % 50}") for i in range(300)]
    columns = ("doc_id", "keep_id", "group_size", "kept")
    within = rows_of(exact_dedup(docs_of(rows), partitions=16), *columns)
    monkeypatch.setattr(exact, "EDGE_RUNS", 0)
    assert rows_of(exact_dedup(docs_of(rows), partitions=16), *columns) == within


def test_allocation_spends_the_radius_and_avoids_costly_partitions():
    costs = [[0, 10, 90, 900], [0, 1000, 9000, 90000], [0, 10, 20, 500]]
    chosen = near.allocate(costs, 2)
    assert sum(t + 1 for t in chosen) == 3
    assert chosen[1] == -1


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 150), 100)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def similarity(a, b):
    x, y = (set(zip(*(t.lower().split()[i:] for i in range(5)))) for t in (a, b))
    return len(x & y) / len(x | y)


def test_near_duplicates_have_the_similarity(docs_of):
    base = {i: prose(i, 200, 5000).split() for i in range(20)}
    rows = []
    for i, words in base.items():
        rows.append((i, " ".join(words)))
        edited = list(words)
        for k in range(1 + i % 8):
            edited[(37 * k + i) % 200] = f"new{k}"
        rows.append((100 + i, " ".join(edited)))
    found = {r["doc_id"]: r["group"] for r in near.near_duplicates(docs_of(rows), radius=16).collect()}
    texts = dict(rows)
    for i in base:
        assert (found[i] == found[100 + i]) == (similarity(texts[i], texts[100 + i]) >= 0.8)
    assert len({found[i] for i in base}) == len(base)


def test_near_duplicates_just_above_the_similarity_by_default(docs_of):
    """At the production radius, pairs with fingerprints over ten bits apart included."""
    rows, far = [], 0
    for i in range(400):
        words = prose(5000 + i, 300, 5000).split()
        edited = list(words)
        for k in range(6):
            edited[50 * k + i % 40] = f"new{k}"
        texts = " ".join(words), " ".join(edited)
        assert 0.8 <= similarity(*texts) < 0.85
        far += 10 < (near.fingerprint(texts[0]) ^ near.fingerprint(texts[1])).bit_count() <= 16
        rows += [(i, texts[0]), (1000 + i, texts[1])]
    found = {r["doc_id"]: r["group"] for r in near.near_duplicates(docs_of(rows)).collect()}
    assert far > 0
    assert sum(found[i] != found[1000 + i] for i in range(400)) <= 1
    assert len(set(found.values())) >= 400


def test_near_duplicates_of_edge_rows(edge_docs, empty_docs):
    assert near.near_duplicates(empty_docs).collect() == []
    found = near.near_duplicates(edge_docs, carry=["text"]).collect()
    groups = defaultdict(set)
    for r in found:
        groups[r["group"]].add(r["doc_id"])
    assert {4, 5} in groups.values()
    assert {8, 9} in groups.values()
    assert len(found) == len(EDGE_ROWS)
    assert near.simhash_dedup(empty_docs).collect() == []


def test_many_near_copies_are_compared_in_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(near, "GROUP_ROWS", 10)
    words = prose(3, 300, 9000).split()
    rows = []
    for i in range(60):
        edited = list(words)
        edited[(5 * i) % 300] = f"x{i}"
        rows.append((i, " ".join(edited)))
    found = near.near_duplicates(docs_of(rows)).collect()
    assert len({r["group"] for r in found}) == 1
