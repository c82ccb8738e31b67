import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_pii import stated
from tests.llm.test_simhash import plain_fingerprint, plain_groups
from wakeline.llm import toxicity
from wakeline.llm.shared import shared_folder


def prose(rng, n):
    parts = "the ing and or er tion ble sh ea st ly on".split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with planted copies, passages, personal data and insults, written as Parquet."""
    rng = random.Random(8)
    items = [(i, prose(rng, rng.choice([6, 15, 30]))) for i in range(12)]
    docs, toxic = [], set()
    for i in range(240):
        text = prose(rng, rng.randint(40, 160))
        if i % 5 == 0:
            place = text.index(" ", len(text) // 2)
            text = f"{text[:place]} you moron, pathetic scum {text[place:]}"
            toxic.add(i)
        elif i % 7 == 0:
            text += " " + items[i % 12][1].upper()
        elif i % 7 == 1:
            text += f" mail u{i}@mail3.example.com or +1 (743) 555-{i:04d}, {i}.2.3.4"
        elif i % 7 == 2 and i > 20:
            text = docs[i - 7][1] if i % 2 else docs[i - 7][1].upper()
        docs.append((i, text))
    docs += [(300, None), (301, ""), (302, "word"), (3, docs[3][1])]
    folder = tmp_path_factory.mktemp("tables")
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in docs]
    frames = {
        "documents": spark.createDataFrame(
            rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        "benchmark": spark.createDataFrame(items, "item_id bigint, text string"),
        "labels": spark.createDataFrame(
            [(i, 1, int(i in toxic)) for i in range(240)], "doc_id bigint, quality int, toxic int"),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{folder}/{name}.parquet")
    return str(folder), docs, items, toxic


def test_every_stage_against_plain_versions(spark, tables):
    folder, docs, items, _ = tables
    shared_folder(spark)
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    columns = frame.columns
    kept = dict(docs)
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frame, folder).checkpoint()
        rows = out.collect()
        if place < 4:
            assert out.columns == columns
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
        got = {r.doc_id: r for r in rows}
        if place == 0:
            # Labels leave no doubt here, but for the copies of toxic documents.
            clean = {i for i, t in kept.items() if "moron" not in (t or "").lower()}
            assert set(got) == clean
        elif place == 1:
            ids = sorted(kept)
            groups = plain_groups([plain_fingerprint(kept[i]) for i in ids])
            assert set(got) == {min(i for i, h in zip(ids, groups) if h == g) for g in set(groups)}
            assert len(rows) == len(got)
        elif place == 2:
            marked = {r[0] for r in plain_hits(list(kept.items()), items) if r[5]}
            assert marked and set(got) == set(kept) - marked
        elif place == 3:
            assert set(got) == set(kept)
            found = 0
            for i, text in kept.items():
                if stated(text):
                    found += 1
                    assert "<EMAIL>" in got[i].text and not stated(got[i].text)
                else:
                    assert got[i].text == text
            assert found
        else:
            library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            for i, text in kept.items():
                ids = library.encode(text or "", add_special_tokens=False).ids
                assert (got[i].ids, got[i].n_tokens) == (ids, len(ids))
                assert got[i].decoded == library.decode(ids, skip_special_tokens=False)
        frame = out
        if place < 4:
            kept = {r.doc_id: r.text for r in rows}
    whole = corpus_pipeline.run(spark, folder)
    assert {(r.doc_id, tuple(r.ids)) for r in whole.collect()} == {
        (i, tuple(r.ids)) for i, r in got.items()}


def test_empty_documents(spark, tables):
    folder = tables[0]
    frame = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, folder)
        assert frame.count() == 0


def test_toxic_stage_has_a_threshold_for_every_language(spark, tmp_path, monkeypatch):
    """Also for those with a handful of labelled toxic texts, in one fold or in others."""
    rng, docs, bad = random.Random(5), [], set()
    for i in range(360):
        place = 0 if i < 240 else i % 3 + 1
        cues = list(toxicity.LANGUAGES.values())[place]
        if i % 4 == 0:
            bad.add(i)
        docs.append((i, " ".join(rng.choices(cues, k=15) + ["moron" if i in bad else "river"]
                                 + prose(rng, 10).split()), "xx", "s", 1))
    spark.createDataFrame([(i, int(i in bad)) for i in range(360)], "doc_id bigint, toxic int"
                          ).write.parquet(f"{tmp_path}/labels.parquet")
    frame = spark.createDataFrame(
        docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    networks, score = [], toxicity.score_documents

    def watched(rows, network, *rest, **named):
        networks.append(network)
        return score(rows, network, *rest, **named)

    monkeypatch.setattr(toxicity, "score_documents", watched)
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, frame, str(tmp_path)).collect()}
    assert kept == set(range(360)) - bad
    assert set(networks[0].thresholds) == {0, 1, 2, 3}
