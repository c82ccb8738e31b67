import math
import random
import struct
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from wakeline.llm.sharding import shard_documents


def test_slots_sizes_and_growth(documents):
    rows = [(i, f"text {i % 7}") for i in range(400)] + [(None, None), (5, "é"), (5, "é"), (6, "")]
    out = shard_documents(documents(*rows), [1.0] * 8, bucket_rows=30).collect()
    assert len(out) == len(rows)
    for shard in range(8):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))
    by_id = {}
    for r in out:
        assert r.law == "key"
        assert r.grown_shard in (r.shard, 8)
        assert by_id.setdefault(r.doc_id, r.shard) == r.shard
    texts = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                    for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == texts
    moved = sum(r.grown_shard == 8 for r in out)
    assert 20 < moved < 80


def test_weights_share_rows(documents):
    out = shard_documents(documents(*((i, "x") for i in range(3000))), [1.0, 3.0])
    counts = {r.shard: r["count"] for r in out.groupBy("shard").count().collect()}
    assert 0.68 < counts[1] / 3000 < 0.82
    with pytest.raises(ValueError):
        shard_documents(documents((1, "x")), [1.0, 0.0])


def test_empty_table_and_clashing_columns(documents):
    empty = documents((1, "x")).where("false")
    assert shard_documents(empty, [1.0] * 8).count() == 0
    odd = documents((1, "x"), (2, "y")).withColumns(
        {"shard": F.lit("a"), "slot": F.lit(1), "_bucket": F.lit(2), "size": F.lit("s")})
    assert shard_documents(odd, [1.0] * 8).count() == 2


def plain_shard(key, shards):
    """The shard with the greatest score, by the hash chain over key and shard number."""
    text = b"\0null" if key is None else str(key).encode()
    best = None
    for shard in range(shards):
        h = xxhash.xxh64_intdigest(struct.pack("<i", shard), seed=xxhash.xxh64_intdigest(text, seed=42))
        score = -1.0 / math.log(((h >> 11) + 0.5) / 2**53)
        if best is None or (score, shard) > best:
            best = score, shard
    return best[1]


def test_whole_query_against_a_plain_version(documents):
    rng = random.Random(4)
    rows = [(rng.choice([i, i, i, 7, None]), rng.choice([None, "", f"t{i}", "é" * (i % 9), "same"]))
            for i in range(900)]
    out = shard_documents(documents(*rows), [1.0] * 8, bucket_rows=50).collect()
    want = []
    for key, text in rows:
        raw = (text or "").encode()
        want.append((key, len(raw) + 1, zlib.crc32(raw), plain_shard(key, 8), plain_shard(key, 9)))
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in out) == Counter(
        want)
    for shard, count in Counter(w[3] for w in want).items():
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(count))
