import hashlib
import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from wakeline.llm import importance
from wakeline.llm.shared import shared_folder

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, longest):
    words = WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    return [b" ".join(words[i:i + k]) for k in range(1, longest + 1)
            for i in range(len(words) - k + 1)], len(words)


def plain(docs, target, percent, least, seed, longest, buckets):
    def count(texts):
        out = [0] * buckets
        for text in texts:
            for feature in runs(text, longest)[0]:
                out[zlib.crc32(feature) % buckets] += 1
        return out

    s, t = count(x for _, x in docs), count(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets))))
            for a, b in zip(s, t)]
    rows = []
    for key, text in docs:
        features, words = runs(text, longest)
        weight = sum(gain[zlib.crc32(f) % buckets] for f in features)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(features), weight, score, None, words])
    enough = sorted((r for r in rows if r[5] >= least),
                    key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, row in enumerate(enough[:percent * len(enough) // 100], 1):
        row[4] = rank
    return [tuple(r[:5]) for r in rows]


def corpus():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdeé日ß9") for _ in range(rng.randint(1, 40)))
                  for _ in range(60)]
    docs = [(i, "".join(rng.choice(vocabulary).capitalize() + rng.choice([" ", ", ", ".\n", "--"])
                        for _ in range(rng.randint(0, 60)))) for i in range(200)]
    docs += [(200, None), (201, ""), (202, "x" * 50_000), (203, "a " * 30_000), (204, "\t,."),
             (7, docs[7][1]), (7, docs[7][1]), (None, docs[9][1])]
    return docs, [docs[3][1], docs[5][1].upper(), None, ""]


def check(spark, documents, longest, words, monkeypatch):
    docs, target = corpus()
    monkeypatch.setattr(importance, "DICTIONARY_WORDS", words)
    frame = documents(*docs).withColumn("rank", F.lit("clash")).withColumn("key", F.lit(0))
    items = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    got = importance.resample(frame, items, 30, 10, 9, longest=longest, buckets=97)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = plain(docs, target, 30, 10, 9, longest, 97)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_single_words(spark, documents, monkeypatch):
    shared_folder(spark)
    check(spark, documents, 1, 50_000, monkeypatch)


def test_composed_runs_of_words(spark, documents, monkeypatch):
    check(spark, documents, 3, 50_000, monkeypatch)


def test_words_outside_of_the_dictionary():
    docs, _ = corpus()
    known = sorted({w.decode() for _, t in docs for w in runs(t, 1)[0]})
    whole, part, none = (importance.Scanner(words, 2, 101) for words in (known, known[::3], []))
    for _, text in docs:
        want = [zlib.crc32(f) % 101 for f in runs(text, 2)[0]]
        for scanner in (whole, part, none):
            assert scanner.features(text).tolist() == want


def test_ranges_number_all_rows(spark):
    rows = spark.createDataFrame([(i % 5, i % 3) for i in range(600)], "score int, key int")
    got = importance.ranked(rows, [F.desc("score"), F.asc("key")], range_rows=50).orderBy(
        "rank").collect()
    assert [r.rank for r in got] == list(range(1, 601))
    assert [(r.score, r.key) for r in got] == sorted(
        ((r.score, r.key) for r in got), key=lambda r: (-r[0], r[1]))


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(documents(), none).count() == 0
    rows = importance.resample(documents((1, "one two")), none, least_words=1, percent=100).collect()
    assert [(r.doc_id, r.n_features, r.rank) for r in rows] == [(1, 2, 1)]


def test_crc_of_concatenations():
    rng = random.Random(1)
    parts = [rng.randbytes(rng.choice([0, 1, 7, 300, 70_000])) for _ in range(40)]
    left, right = parts[:20], parts[20:]
    crc = lambda items: np.array([zlib.crc32(p) for p in items], np.uint32)
    got = importance.combined(crc(left), crc(right), np.array([len(p) for p in right]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(left, right)]
