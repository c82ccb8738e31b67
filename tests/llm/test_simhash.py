import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wakeline.llm import simhash
from wakeline.llm.graph import components
from wakeline.llm.simhash import (fingerprint, gray_rank, near_duplicates, near_links, one_of_each,
                                  search)


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    value = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(p, 42) >> bit & 1 for p in parts)
        value |= (2 * ones > len(parts)) << bit
    return value


def plain_groups(values, max_bits=2):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= max_bits:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", [
    None, "", " \t\n", "one", "One two", "a b c", "a b c d", "É x ÀB\x0bc\x1cd e é f", "x " * 70_000])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def clustered(n, seed=1):
    rng = random.Random(seed)
    values = [0, 1, 3, 2**64 - 1]
    while len(values) < n:
        base = rng.choice(values) if rng.random() < 0.6 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 3)):
            base ^= 1 << rng.randrange(64)
        values.append(base)
    return list(dict.fromkeys(values))


def test_gray_order_neighbours_differ_in_one_bit():
    codes = np.array([i ^ i >> 1 for i in range(64)], np.uint64)
    assert gray_rank(codes).tolist() == list(range(64))


@pytest.mark.parametrize("max_bits", [0, 1, 2, 5])
def test_search_finds_every_pair(max_bits):
    values = np.array(clustered(700), np.uint64)
    group = np.arange(len(values)) % 3
    order = np.lexsort((gray_rank(values), group))
    group, values = group[order], values[order]
    found = {(int(a), int(b)) for left, right in search(group, values, max_bits)
             for a, b in zip(left, right)}
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values))
            if group[i] == group[j] and int(values[i] ^ values[j]).bit_count() <= max_bits}
    assert found == want


@pytest.mark.parametrize("route_rows", [5, 8_192])
def test_links_connect_the_same_fingerprints(spark, route_rows):
    values = clustered(260, seed=3)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    found = components(near_links(frame, 2, route_rows)).collect()
    name = dict.fromkeys(signed) | {r.node: r.component for r in found}
    name = {v: v if c is None else c for v, c in name.items()}
    plain = plain_groups(values)
    assert len(set(name.values())) == len(set(plain))
    assert len({(name[v], g) for v, g in zip(signed, plain)}) == len(set(plain))


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(
        spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rows_ties_nulls_and_kept_rows(documents):
    body = " ".join(f"w{i * i % 97}" for i in range(300))
    rows = [(9, body), (4, body.upper()), (7, body + " more"), (12, None), (11, ""), (30, " \n"),
            (None, "alone here now"), (21, "alone here now"), (40, "two"), (40, "two"),
            (50, "clash a b c"), (50, "other words entirely d e f")]
    docs = documents(*rows).withColumns({"component_id": F.lit(1), "fp": F.lit("x")})
    out = near_duplicates(docs).collect()
    prints = {(i, plain_fingerprint(t)) for i, t in rows}
    assert {(r.doc_id, int(r.fingerprint, 16)) for r in out} == prints
    assert len(out) == len(rows)
    values = [plain_fingerprint(t) for _, t in rows]
    plain = plain_groups(values)
    least = {g: min(i for (i, _), h in zip(rows, plain) if h == g and i is not None)
             for g in set(plain)}
    want = sorted(((i, f"{v:016x}", least[g]) for (i, _), v, g in zip(rows, values, plain)),
                  key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in out), key=str) == want
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted({i for (i, t), g in zip(rows, plain) if i == least[g]} | {50, 50}) + [50]
    assert near_duplicates(docs.where("false")).count() == 0
    assert one_of_each(docs.where("false")).count() == 0
