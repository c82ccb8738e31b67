import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from wakeline.llm.decontaminate import contamination, find_passages, without_passages

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(lowered)


def plain(docs, items):
    out = []
    for doc_id, text in docs:
        have = words(text)
        hit, names = set(), set()
        for item_id, item in items:
            need = words(item)
            size = min(10, len(need))
            for start in range(len(need) - size + 1 if size else 0):
                window = need[start:start + size]
                for at in range(len(have) - size + 1):
                    if have[at:at + size] == window:
                        hit.update(range(at, at + size))
                        if item_id is not None:
                            names.add(str(item_id))
        listed = ",".join(sorted(names))
        out.append((doc_id, len(have), len(hit), len(names),
                    hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture
def tables(spark, documents):
    rng = random.Random(4)
    some = ["the", "and", "of", "Ünder", "x1", "rare", "Word", "é"]
    items = [(i, " ".join(rng.choice(some) for _ in range(rng.choice([1, 2, 3, 9, 10, 11, 25]))))
             for i in range(30)]
    items += [(31, None), (32, ""), (33, "?!"), (None, "hidden passage of the unnamed benchmark"),
              (2, "another text for the same item id here"), (40, items[5][1])]
    docs = []
    for i in range(60):
        text = " ".join(rng.choice(some + ["filler", "more"]) for _ in range(rng.randint(0, 80)))
        if i % 3 == 0:
            text += ", " + rng.choice(items)[1].upper() if items[i % 30][1] else ""
        docs.append((i, text))
    docs += [(60, None), (61, ""), (7, docs[7][1]), (None, items[8][1]),
             (62, "The hidden-PASSAGE of the unnamed benchmark!"), (63, "the " * 50_000)]
    items.append((50, "the the the the the the the the the the the the"))
    frame = documents(*docs).withColumns({"row": F.lit(1), "spans": F.lit("s"),
                                          "n_hit": F.lit("n")})
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    return docs, items, frame, bench


@pytest.mark.parametrize("chunk_bytes", [2_000_000, 700])
def test_against_every_window(tables, chunk_bytes):
    docs, items, frame, bench = tables
    out = contamination(frame, bench, chunk_bytes=chunk_bytes).collect()
    short = [d for d in docs if d[0] != 63]
    got = sorted(map(tuple, (r for r in out if r.doc_id != 63)), key=str)
    assert got == plain(short, items)
    long = next(r for r in out if r.doc_id == 63)
    assert (long.n_words, long.n_hit, long.contaminated) == (50_000, 50_000, True)


def test_clean_rows_stay_whole(tables):
    docs, items, frame, bench = tables
    kept = without_passages(frame, bench)
    assert kept.columns == frame.columns
    clean = sorted(str(r[0]) for r in plain([d for d in docs if d[0] != 63], items) if not r[5])
    assert sorted(str(r.doc_id) for r in kept.collect()) == clean


def test_empty_tables(tables):
    _, _, frame, bench = tables
    assert contamination(frame.where("false"), bench).count() == 0
    out = contamination(frame, bench.where("false"))
    assert out.where("contaminated").count() == 0
    assert out.count() == frame.count()
    spans = find_passages(frame.where("doc_id = 62"), bench).first().spans
    assert len(spans) % 16 == 0 and spans
