import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.llm import collocations
from wakeline.llm.shared import shared_folder


def plain(docs, support, longest, percent, limit):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase."""
    counts, totals = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i:i + k])] += 1
    out = []
    for lang, found in counts.items():
        often = {p: a for p, a in found.items() if a >= support}
        inside = {}
        for p, a in often.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    q = p[i:i + size]
                    inside[q] = max(inside.get(q, 0), a)
        rows = []
        for p, a in often.items():
            if len(p) < 2 or 100 * inside.get(p, -1) >= percent * a:
                continue
            cuts = [(1000 * a * totals[lang] // (found[p[:k]] * found[p[k:]]), k)
                    for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        out += [(lang, i, phrase.decode(), -a, left, right, totals[lang], -score)
                for i, (score, a, phrase, left, right) in enumerate(sorted(rows)[:limit], 1)]
    return out


def corpus():
    rng = random.Random(6)
    vocabulary = [f"{rng.choice('abcdeéß日')}{i}" for i in range(40)]
    fixed = ["New york city", "in the end of all", "a a a a", "tab\tsplit word"]
    docs = []
    for i in range(400):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 4)):
            words.insert(rng.randint(0, len(words)), rng.choice(fixed))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", ", ", ".\n", " ! "]) for w in words)
        docs.append((rng.choice(["en", "en", "en", "de", None]), text))
    docs += [("en", None), (None, ""), ("en", "a " * 3000), ("xx", "once"), ("en", "b1;b1:b1\x0bb1")]
    return docs + [docs[0]] * 40


@pytest.mark.parametrize("shards, run_bytes", [(1, 2_000), (4, 20_000), (4, 10_000_000), (30, 5_000)])
@pytest.mark.parametrize("percent", [100, 60])
def test_against_counting_every_phrase(spark, shards, run_bytes, percent):
    shared_folder(spark)
    docs = corpus()
    frame = spark.createDataFrame(docs, "lang string, text string").repartition(3).withColumn(
        "phrase", F.lit("clash")).withColumn("n", F.lit(0))
    got = collocations.collocations(frame, 12, 5, percent, 25, shards=shards, run_bytes=run_bytes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain(docs, 12, 5, percent, 25)
    assert len(want) > 20 and any(row[0] == "und" for row in want)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_ranking_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(collocations, "RANK_ROWS", 10)
    docs = corpus()
    frame = spark.createDataFrame(docs, "lang string, text string")
    got = collocations.collocations(frame, 5, 3, 100, 7).collect()
    assert sorted(map(tuple, got)) == sorted(plain(docs, 5, 3, 100, 7))


def test_a_crowded_filter_changes_nothing(spark, monkeypatch):
    """Phrases that pass the filter by mistake fail the support when counted."""
    hashes = collocations.joined_hash
    monkeypatch.setattr(collocations, "marked", lambda bits, found: hashes(found, found) >= 0)
    docs = corpus()[:120]
    frame = spark.createDataFrame(docs, "lang string, text string")
    got = collocations.collocations(frame, 6, 4, 100, 30).collect()
    assert sorted(map(tuple, got)) == sorted(plain(docs, 6, 4, 100, 30))


def test_large_counts_stay_exact(spark):
    words = spark.createDataFrame(
        [("en", None, 10**13), ("en", "a", 3 * 10**12), ("en", "b", 7 * 10**12)],
        "lang string, word string, n bigint")
    phrases = spark.createDataFrame([("en", "a b", 2 * 10**12)], "lang string, phrase string, a bigint")
    row = collocations._scored(words, phrases, phrases).first()
    assert row.score == 1000 * 2 * 10**12 * 10**13 // (3 * 10**12 * 7 * 10**12)


def test_local_support_loses_no_phrase():
    rng = random.Random(2)
    for _ in range(500):
        sizes = [rng.randint(1, 50) for _ in range(rng.randint(1, 12))]
        counts = [rng.randint(0, s) for s in sizes]
        if sum(counts):
            assert any(c >= collocations._local_support(sum(counts), s, sum(sizes))
                       for c, s in zip(counts, sizes))


def test_empty_table(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(none).count() == 0


def test_no_scan_beyond_the_mining(spark):
    """Words, pairs and longer phrases take a scan each; the recount adds up what these counted."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    docs = corpus()[:200]
    frame = spark.createDataFrame(docs, "lang string, text string").mapInArrow(
        count, "lang string, text string")
    collocations.frequent_phrases(frame, 12, 5, "lang", "text")
    assert seen.value == 3 * len(docs)


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_keys_hold_the_numbers(width):
    ids = np.array([3, 2 ** (8 * width - 1) - 1, 0, 7, -1], np.int32)
    keys = collocations.packed(ids, np.array([0, 1]), 3, width).to_pylist()
    assert [len(key) for key in keys] == [3 * width] * 2
    assert collocations.unpacked(keys, width).tolist() == [*ids[:3], *ids[1:4]]
