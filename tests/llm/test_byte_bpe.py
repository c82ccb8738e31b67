import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from wakeline.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    out = [None, "", " ", "a" * 3000, "  　 x\u0085y  \n\n z\x1cu", "日本語テキスト" * 20,
           "é́ ñ 🙂🙃 ١٢٣ ½ x²", "<|endoftext|> don't I'll WE'RE", "\t\r\n", '\\"quote\\"{}$', "ab\x00cd",
           "word " * 20_000]
    out += ["".join(rng.choice("abcdeé ߷ñß日🙂 \n.,1's") for _ in range(rng.randint(1, 200)))
            for _ in range(60)]
    return out


def plain(text, library):
    ids = library.encode_ordinary(text or "")
    assert library.decode_bytes(ids) == (text or "").encode()
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_digests_like_the_library(spark, documents, library):
    rows = list(enumerate(texts()))
    docs = documents(*rows, (1, ""), (None, "null key")).withColumn("row", F.lit(1)).withColumn(
        "ids", F.lit("clash"))
    got = byte_bpe.token_digests(docs, PATH, PATTERN, words=500)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = [(i, *plain(t, library)) for i, t in [*rows, (1, ""), (None, "null key")]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_encode_and_decode_keep_the_row(documents, library):
    docs = documents((1, "Hello wörld"), (2, None)).withColumnRenamed("text", "a.b")
    rows = {r.row.doc_id: r for r in byte_bpe.encode_and_decode(
        docs, PATH, PATTERN, text="a.b", words=3).collect()}
    assert rows[1].ids == library.encode_ordinary("Hello wörld")
    assert bytes(rows[1].decoded).decode() == "Hello wörld" and rows[1].row["a.b"] == "Hello wörld"
    assert rows[2].ids == [] and bytes(rows[2].decoded) == b""


def test_both_folds_agree_and_an_empty_table_is_empty(spark, documents, ranks, library):
    fold = byte_bpe.WordFold(ranks, PATTERN)
    words = sorted({w for t in texts()[12:] for w in t.split()})[:200]
    found = spark.createDataFrame([(w,) for w in words], "w string").repartition(2).select(
        "w", fold.fold(F.col("w")).alias("ids")).collect()
    inside = byte_bpe.ByteBpe(ranks, PATTERN, {})
    for row in found:
        assert row.ids == library._encode_single_piece(row.w.encode())
        assert byte_bpe.pack(row.ids) == inside.fold(row.w)
    assert byte_bpe.token_digests(documents(), PATH, PATTERN).count() == 0


def test_a_full_cache_changes_nothing(ranks, library):
    small = byte_bpe.ByteBpe(ranks, PATTERN, {})
    small.others.entries = 2
    for text in texts():
        assert small.encode(text) == byte_bpe.pack(library.encode_ordinary(text or ""))
