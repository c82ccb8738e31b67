import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.llm import pii
from wakeline.llm.pii import (KINDS, base_spans, candidates, fit, labels_under, redacted,
                              span_digests, without_personal_data)

# The rules as stated, tried from every place; slow on long runs.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def stated(text):
    out = []
    for kind, pattern in STATED.items():
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match[0])
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            passed = {
                "email": True,
                "ip": all(int(p) <= 255 for p in match[0].split(".")) if kind == "ip" else False,
                "card": 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if passed:
                out.append(f"{kind}:{match.start()}:{match.end()}")
    return out


TEXTS = [
    "mail a.b@c.de, x@y or @z.w and q@@r.st; é.f@g.h-i.jk.", "a@b.c@d.e@f.g", "a@b@c.d", "1@2.3",
    "1.2.3.4 and 1.2.3.4.5.6.7.8 or 256.1.1.1 001.02.3.255 1.2.3", "9.1.2.3.4",
    "4539 1488 0343 6467, 4539148803436467x 4539-1488-0343-6468", "1 2", "0000000000000",
    "+1 (743) 555-3824 then +49 30 1234567 and +1 2 and ++12345678901", "+1+2345678901",
    "", None, "no marks at all", "７@ｘ.ｙ 1.2.3.４ ٣", "+1 (743) 555-3824 4539148803436467",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_as_stated(text):
    assert pii.listed(base_spans(text or "")).split(",") == (stated(text) or [""])


def test_random_texts_as_stated():
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice("0123456789 .-+@()ax,") for _ in range(rng.randint(0, 40)))
        assert pii.listed(base_spans(text)).split(",") == (stated(text) or [""]), text


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 200_000,
                                  "a@" * 150_000, "+" * 200_000, "+1(" * 90_000, "( " * 150_000,
                                  "1 " * 150_000, "12345678 " * 30_000])
def test_long_runs_end(text):
    spans = base_spans(text)
    field = pii.Field(np.zeros((88, 5)), np.zeros((2, 5, 5)))
    assert field.spans(text)[0] == spans
    ranges = candidates(text)
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    labels_under(spans, ranges)


def corpus(n=300, seed=6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice("the and of ing tion er".split()) for _ in range(60)]
        for _ in range(rng.randint(0, 3)):
            place = rng.randrange(60)
            words[place] = rng.choice([
                f"u{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
                ".".join(str(rng.randrange(256)) for _ in range(4)),
                "4539148803436467", "4716484186341546",
                f"+1 ({rng.randint(200, 999)}) 555-{rng.randrange(10000):04d}",
                str(rng.randrange(10**11)), "1999-2004", "2.0.1", "page 12345678"])
        rows.append((i, " ".join(words)))
    return rows


@pytest.fixture(scope="module")
def field(spark):
    return fit(spark.createDataFrame(corpus(), "doc_id bigint, text string"))


def test_labels_of_clear_tokens_are_learnt(field):
    text = "write to v7@mail3.example.com or 10.20.30.40 or +1 (555) 555-1234 or 4539148803436467"
    looks = [pii.features(text, *r) for r in candidates(text)]
    unary = pii._vector([f for f, _ in looks], [c for _, c in looks]) @ field.weights
    assert unary.argmax(axis=1).tolist() == [0, 1, 3, 2]


def test_repeated_tokens_take_the_clear_label(field):
    clear = "card 4539148803436467 paid"
    text = clear + " the and of " * 30 + "again 4539/1488 no, 4539.148803436467 yes"
    base, spans = field.spans(text)
    assert pii.listed(base) == "card:5:21"
    added = set(spans) - set(base)
    assert added == {(2, text.index("4539.14"), text.index(" yes"))}
    # Without the clear mention the same token is left alone.
    alone = text.replace(clear, "")
    assert field.spans(alone)[1] == []


def test_numbers_side_by_side_are_told_apart(field):
    phone, card = "+1 (605) 555-9305", "4539148803436467"
    for text, want in (
            (f"x {phone} {card} y", [(2, 20, 36), (3, 2, 19)]),
            (f"x {card} {card} y", [(2, 2, 18), (2, 19, 35)]),
            (f"x {card} {phone}", [(2, 2, 18), (3, 19, 36)])):
        base, spans = field.spans(text)
        assert spans == want
        assert set(base) <= set(spans)


def test_plain_documents_gain_nothing(field):
    for _, text in corpus(200, seed=9):
        base, spans = field.spans(text)
        assert set(base) <= set(spans)
        assert len(spans) - len(base) <= 1
    for text in ("version 2.0.1 of 1999", "in 2004-05 about 1234567 people", "no marks"):
        assert field.spans(text) == ([], [])


def test_message_passing_on_a_tree_is_exact():
    rng = np.random.default_rng(3)
    unary, edges = rng.normal(size=(4, 5)), rng.normal(size=(2, 5, 5))
    edges = edges + edges.transpose(0, 2, 1)
    left, right, kind = np.array([0, 1, 1]), np.array([1, 2, 3]), np.array([0, 1, 0])
    got = pii.Field(np.zeros((88, 5)), edges).marginals(unary, left, right, kind, rounds=200)
    total = np.zeros((4, 5))
    for labels in np.ndindex(5, 5, 5, 5):
        score = sum(unary[i, label] for i, label in enumerate(labels))
        score += sum(edges[k, labels[a], labels[b]] for a, b, k in zip(left, right, kind))
        for i, label in enumerate(labels):
            total[i, label] += np.exp(score)
    assert np.allclose(got, total / total.sum(axis=1, keepdims=True), atol=1e-3)


def test_rows_of_every_sort(documents, field):
    rows = list(enumerate(TEXTS)) + [(0, TEXTS[0]), (None, TEXTS[8])]
    docs = documents(*rows).withColumns({"spans": F.lit(1), "row": F.lit("r"), "base": F.lit(0)})
    got = span_digests(docs, field=field).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), hashlib.sha256(",".join(stated(t)).encode()).hexdigest(),
                   [sum(s.startswith(k) for s in stated(t)) for k in KINDS]) for i, t in rows)
    assert sorted((str(r.doc_id), r.base_sha256, [r[f"n_{k}"] for k in KINDS])
                  for r in got) == want
    for r in got:
        assert set(stated(dict(rows)[r.doc_id])) <= set(r.spans.split(",")) | {""}
    assert span_digests(docs.where("false")).count() == 0
    clean = without_personal_data(docs, field=field)
    assert clean.columns == docs.columns
    texts = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert texts[12] == (None, None) and texts[13] == ("no marks at all", 15)
    assert texts[4][0].startswith("<IP> and <IP>.<IP> or") or "<IP>" in texts[4][0]
    assert all(t is None or not stated(t) for t, _ in texts.values())


def test_redacting_overlaps():
    assert redacted("ab12cd34", [(0, 2, 6), (2, 2, 4), (3, 4, 8)]) == "ab<EMAIL>"
    assert redacted("x", []) == "x"


def test_every_token_of_every_text_is_learnt(spark, monkeypatch):
    """The last token of a long text and the last of many texts reach the model, copies once."""
    seen = []
    monkeypatch.setattr(pii, "train", lambda looks, labels, edges, weight: seen.append(
        (looks, labels, edges, weight)))
    long = " ".join(f"call 555 {i:07d} now," for i in range(60)) + " mail last@mail3.example.com"
    texts = [long] + [f"text{'x' * i} has 1234567" for i in range(9_000)]
    rows = [(text,) for text in texts + texts[:50]] + [(None,), ("plain",)]
    fit(spark.createDataFrame(rows, "text string").repartition(5))
    looks, labels, edges, weight = seen[0]
    tokens = [(t, *r) for t in texts for r in candidates(t)]
    assert weight.sum() == len(tokens) > 9_060
    assert weight[labels == 0].sum() == 1
    want = sum(pii._vector([f], [c])[0] for f, c in (pii.features(*t) for t in tokens))
    assert np.allclose(weight @ looks, want)
    assert edges.sum() == sum(len(pii.edges_of([t[a:b] for a, b in candidates(t)],
                                               [a for a, _ in candidates(t)])[0]) for t in texts)
