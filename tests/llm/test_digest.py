import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.llm import digest
from wakeline.llm.digest import (as_text, edited, entropies, feature_positions, filters,
                                 fingerprint_documents, from_text, likeness, ranks)


def prose(seed, words):
    rng = random.Random(seed)
    parts = ["the", "ing", "and", "or", "er", "tion", "ble", "sh", "ea", "ü", "st", "ly", "on"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
                    for _ in range(words))


@pytest.mark.parametrize("raw", [prose(1, 60).encode(), b"a" * 100, bytes(range(256)), b"x" * 32])
def test_entropies_by_counting(raw):
    got = entropies(np.frombuffer(raw, np.uint8)) / (digest.WINDOW * digest._SCALE)
    for at, value in enumerate(got):
        counts = Counter(raw[at:at + digest.WINDOW]).values()
        want = -sum(c / digest.WINDOW * math.log2(c / digest.WINDOW) for c in counts)
        assert value == pytest.approx(want, abs=1e-5)


@pytest.mark.parametrize("size", [32, 33, 50, 63, 64, 300, 2000])
def test_features_by_scanning(size):
    raw = np.frombuffer(prose(size, size).encode()[:size], np.uint8)
    rank = ranks(entropies(raw)).tolist()
    run = min(digest.RUN, len(rank))
    noted = Counter()
    for start in range(len(rank) - run + 1):
        noted[min(range(start, start + run), key=lambda i: (rank[i], i))] += 1
    want = sorted(i for i, n in noted.items() if n >= min(digest.NOTED, run))
    assert feature_positions(raw).tolist() == (want or [max(noted, key=lambda i: (noted[i], -i))])


def test_likeness_of_equal_half_and_other_texts():
    halves, others = [], []
    for seed in range(30):
        a, b = prose(seed, 400), prose(seed + 1000, 300)
        fa, fb, fe = (filters(t.encode()) for t in (a, b, edited(a, b)))
        assert likeness(fa, fa) == pytest.approx(1)
        assert likeness(fa, fb) == pytest.approx(likeness(fb, fa))
        halves.append(likeness(fa, fe))
        others.append(likeness(fa, fb))
    assert min(halves) > 0.3 > 0.1 > max(others)
    long = filters(prose(5, 30_000).encode())
    assert len(long) > 3 and likeness(long, long) == pytest.approx(1)
    assert np.array_equal(from_text(as_text(long)), long)
    none = filters(b"")
    assert likeness(none, none) == 1.0 and likeness(none, long) == 0.0
    assert as_text(none) == "" and len(filters(b"a")) == 1 and len(filters(b"a" * 500)) == 1


@pytest.mark.parametrize("range_rows", [3, 4_000])
def test_documents_in_order(documents, range_rows):
    rows = [(i * 13 % 40, prose(i, i * 3)) for i in range(40)]
    rows += [(None, "no id"), (None, None), (7, "same id again"), (7, "same id again"), (90, ""),
             (91, None), (-5, "é" * 41), (92, "a " * 40_000)]
    docs = documents(*rows).withColumns({"k": F.lit(1), "range": F.lit("r")}).repartition(4)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    want = []
    for place, (key, text) in enumerate(order):
        following = order[(place + 1) % len(order)][1] or ""
        text = text or ""
        changed = edited(text, following)
        fa, fe, fn = (filters(t.encode()) for t in (text, changed, following))
        want.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), as_text(fa),
                     as_text(fe), likeness(fa, fe), likeness(fa, fn)))
    got = sorted(map(tuple, fingerprint_documents(docs, range_rows=range_rows).collect()), key=str)
    assert got == sorted(want, key=str)


def test_single_row_and_empty_table(documents):
    one = fingerprint_documents(documents((4, "only one text here"))).first()
    assert one.near_next == 1.0
    assert fingerprint_documents(documents((1, "x")).where("false")).count() == 0
