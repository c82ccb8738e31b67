import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wakeline.llm import toxicity as tox
from wakeline.llm.toxicity import (Scorer, best_threshold, fit_network, language_of, rows_of_words,
                                   toxicity, train, untrained, without_toxic, word_vectors, words_of)

FILLER = "river stone cloud paper window garden morning table letter number story people".split()


def made(n, seed):
    """Half English, half German; toxic texts hold an insult or a form of a bad stem."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        german, bad = rng.random() < 0.5, rng.random() < 0.3
        cues = tox.LANGUAGES["de" if german else "en"]
        words = [rng.choice(FILLER + cues) for _ in range(rng.randint(20, 60))]
        if bad:
            for _ in range(2):
                stem = "lowei" if german else "scumb"
                words.insert(rng.randrange(len(words)),
                             stem + "".join(rng.choice("abcdefg") for _ in range(3)))
        out.append((i, " ".join(words), int(bad)))
    return out


@pytest.fixture(scope="module")
def network():
    rows = made(600, 1)
    toxic = np.array([r[2] for r in rows])
    return fit_network([r[1] for r in rows], toxic, np.arange(600) % 4 == 0, np.ones(600))


def test_unseen_forms_of_known_stems(network):
    rows = made(400, 2)
    scores = np.array(Scorer(network).scores([r[1] for r in rows]))
    toxic = np.array([r[2] for r in rows])
    assert ((scores >= 0.5) == toxic).mean() > 0.97
    assert scores[toxic == 1].mean() > scores[toxic == 0].mean() + 0.4


def test_texts_of_every_sort(network):
    rare = " ".join(f"{i}lowei" for i in range(30))
    long = "river " * 60_000 + "loweiabc loweibcd " + "stone " * 60_000
    texts = [None, "", "!!", "x", long, rare, "a" * 200_000, "LOWEIABC, loweibcd!"]
    scores = Scorer(network, capacity=10).scores(texts)
    assert scores[0] == scores[1] == scores[2] < 0.5
    assert scores[4] >= 0.5 and all(0 <= s <= 1 for s in scores)
    again = Scorer(network)
    assert scores == [again.scores([t])[0] for t in texts]


def test_pooling_by_hand(network):
    words = words_of("the river scumbabc and window")
    vectors = np.array([word_vectors(*rows_of_words([w]), network.embedding)[0] for w in words])
    vectors = np.concatenate([vectors, np.zeros((2, tox.DIMENSIONS))])
    want = []
    for part in network.filters:
        windows = [sum(vectors[i + k] @ part[k] for k in range(len(part)))
                   for i in range(len(words))]
        want.append(np.max(windows, axis=0))
    scorer = Scorer(network)
    scorer.logits([words])
    assert np.allclose(scorer.pooled(words), np.maximum(np.concatenate(want) + network.bias, 0),
                       atol=1e-4)


def test_rows_of_a_word_do_not_depend_on_its_neighbours():
    words = [b"river", b"a", "über".encode(), b"lowei" * 40]
    flat, sizes = rows_of_words(words)
    starts = np.cumsum(sizes) - sizes
    for word, start, size in zip(words, starts, sizes):
        alone, one = rows_of_words([word])
        assert one[0] == size and alone.tolist() == flat[start:start + size].tolist()


def test_thresholds_and_language():
    logits, toxic = np.array([3.0, 2, 1, 0, -1]), np.array([1, 1, 0, 0, 0])
    assert best_threshold(logits, toxic, np.ones(5)) == 1.5
    assert best_threshold(np.zeros(4), np.array([1, 0, 0, 0]), np.ones(4)) < 0
    assert [language_of(words_of(t)) for t in ("the of and", "der die und", "les des et",
                                               "el los con", "", "xyz")] == [0, 1, 2, 3, -1, -1]
    assert Scorer(untrained()).scores(["any text"])[0] < 0.01
    assert len(train([None, "", "a b"], np.array([0, 1, 1])).filters) == 3


def test_query_learns_from_its_folds_alone(spark, documents):
    rows = made(500, 3)
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(500)]
    docs = documents(*[r[:2] for r in rows], (None, "the loweiabc"), (900, None), (3, rows[3][1]))
    docs = docs.withColumns({"row": F.lit(1), "score": F.lit("s"), "key": F.lit("k")})
    label_rows = [(i, bad) for i, _, bad in rows] + [(None, 1), (901, None), (902, 1), (4, 0)]
    labels = spark.createDataFrame(label_rows, "doc_id bigint, toxic int")
    out = toxicity(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == 503
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].held_out for i in range(500)] == held and by_id[None].held_out
    assert all(r.predicted == (r.score >= 0.5) for r in got)
    right = [by_id[i].predicted == rows[i][2] for i in range(500) if held[i]]
    assert np.mean(right) > 0.95
    # Held-out labels turned round change nothing.
    turned = spark.createDataFrame(
        [(i, 1 - b if i is not None and i < 500 and held[i] else b) for i, b in label_rows],
        "doc_id bigint, toxic int")
    again = {r.doc_id: r.score for r in toxicity(docs, turned).collect()}
    assert again == {r.doc_id: r.score for r in got}
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in got)


def plain_score(net, text):
    """One window after the other, in plain loops; 0.5 at the threshold of the text's language."""
    words = words_of(text)
    vectors = [word_vectors(*rows_of_words([w]), net.embedding)[0].tolist() for w in words]
    vectors += [[0.0] * tox.DIMENSIONS] * tox.WIDTHS[-1]
    total, place = net.out_bias, 0
    for part in net.filters:
        for f in range(tox.FILTERS):
            best = max(sum(vectors[i + k][d] * part[k][d][f] for k in range(len(part))
                           for d in range(tox.DIMENSIONS)) for i in range(max(1, len(words))))
            total += max(0.0, best + net.bias[place]) * net.out[place]
            place += 1
    counts = [sum(w.decode() in cues for w in words) for cues in tox.LANGUAGES.values()]
    language = counts.index(max(counts)) if max(counts) else -1
    return 1 / (1 + math.exp(-(total - net.thresholds.get(language, net.common))))


def test_whole_query_against_a_plain_version(spark, documents):
    rows = made(220, 8)
    docs = documents(*[r[:2] for r in rows], (None, None), (500, ""), (501, "über la der the"))
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows], "doc_id bigint, toxic int")
    net = tox.fit(docs, labels)
    texts = {**{i: t for i, t, _ in rows}, None: None, 500: "", 501: "über la der the"}
    got = toxicity(docs, labels).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain_score(net, texts[r.doc_id])
        assert abs(r.score - want) < 1e-3
        assert r.predicted == (r.score >= 0.5)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)


def test_one_text_of_a_repeated_key_is_learnt(spark, documents):
    rows = made(120, 9)
    docs = documents(*[r[:2] for r in rows])
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows], "doc_id bigint, toxic int")
    many = docs.union(documents(*[(i, "z" + t) for i, t, _ in rows for _ in range(5)]))
    one, again = tox.fit(docs, labels), tox.fit(many, labels)
    assert one.common == again.common and np.array_equal(one.embedding, again.embedding)


def test_empty_tables(spark, documents):
    docs = documents((1, "x"))
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r.predicted for r in toxicity(docs, none).collect()] == [0]
    one_class = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id bigint, toxic int")
    assert toxicity(docs, one_class).count() == 1
    assert toxicity(docs.where("false"), one_class).count() == 0


def test_every_labelled_row_is_learnt(spark, documents, monkeypatch):
    """Shards together see every row, also a long one; their network is as good as one of all."""
    rows = made(900, 12)
    rows[7] = (7, rows[7][1] + " stone" * 20_000, rows[7][2])
    docs = documents(*[r[:2] for r in rows])
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows], "doc_id bigint, toxic int")
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i in range(900)}
    seen, odds = [], tox._log_odds

    def watched(counts, sizes):
        seen.append(sizes.tolist())
        return odds(counts, sizes)

    monkeypatch.setattr(tox, "_log_odds", watched)
    net = tox.fit(docs, labels, shard_rows=150)
    learnt = [r for r in rows if fold[r[0]] > 1]
    assert seen[-1] == [sum(r[2] == c for r in learnt) for c in (0, 1)]
    again = tox.fit(docs.repartition(7), labels, shard_rows=150)
    assert np.array_equal(net.embedding, again.embedding) and net.common == again.common
    test = [r for r in rows if fold[r[0]] == 0]
    scores = np.array(Scorer(net).scores([r[1] for r in test]))
    assert np.mean((scores >= 0.5) == np.array([r[2] for r in test])) > 0.95


def test_one_shard_is_the_training_in_one_place(spark, documents):
    rows = made(300, 13)
    docs = documents(*[r[:2] for r in rows])
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows], "doc_id bigint, toxic int")
    learnt = sorted((t, b) for i, t, b in rows if zlib.crc32(str(i).encode()) % 5 > 1)
    want = train([t for t, _ in learnt], np.array([b for _, b in learnt]))
    got = tox.fit(docs, labels)
    assert np.allclose(got.embedding, want.embedding, atol=1e-6)
    assert np.allclose(got.out, want.out) and np.isclose(got.out_bias, want.out_bias)


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def of_language(place, keys, toxic):
    """Texts of one language, clear in that, with the class as the only other word that matters."""
    rng, cues = random.Random(place), list(tox.LANGUAGES.values())[place]
    return [(i, " ".join(rng.choices(cues, k=12) + rng.choices(FILLER, k=12)
                         + ["scumbabc" if i in toxic else "river"]), int(i in toxic)) for i in keys]


def test_a_language_with_few_toxic_texts_has_its_own_threshold(spark, documents):
    """French has two toxic texts in fold 1; Spanish has toxic ones in the other folds alone."""
    keys = [i for i in range(400) if fold(i) > 0]
    own, others = [i for i in keys if fold(i) == 1], [i for i in keys if fold(i) > 1]
    rows = (of_language(0, own[:40] + others[:120], set(own[:12] + others[:40]))
            + of_language(2, own[40:60] + others[120:160], set(own[40:42] + others[120:130]))
            + of_language(3, own[60:70] + others[160:190], set(others[160:168])))
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows], "doc_id bigint, toxic int")
    net = tox.fit(documents(*[r[:2] for r in rows]), labels)
    scorer, split = Scorer(net), [words_of(t) for _, t, _ in rows]
    logits, toxic = np.array(scorer.logits(split)), np.array([r[2] for r in rows])
    folds, languages = np.array([fold(r[0]) for r in rows]), np.array(list(map(language_of, split)))

    def plain(chosen):
        return best_threshold(logits[chosen], toxic[chosen], np.ones(chosen.sum()))

    spare = folds == 1
    assert net.common == plain(spare)
    assert net.thresholds == {0: plain(spare & (languages == 0)), 2: plain(spare & (languages == 2)),
                              3: plain(~spare & (languages == 3))}
    in_one_place = fit_network([t for _, t, _ in rows], toxic, spare, np.ones(len(rows)))
    assert set(in_one_place.thresholds) == {0, 2, 3}


def test_thresholds_of_few_texts_by_hand():
    net = untrained()
    tox.set_thresholds(net, np.array([3.0, 1, 0, 7, 5, 9]), np.array([0, 0, 0, 1, 1, 2]),
                       np.array([1, 0, 0, 1, 0, 1]), np.ones(6))
    assert net.thresholds == {0: 2.0, 1: 6.0}


@pytest.mark.parametrize("n", [6, 4_000, 250_000])
def test_thresholds_ranked_by_tasks_are_those_of_one_place(spark, n):
    """At any number of texts the very same numbers, also among ties and with one class missing."""
    rng = np.random.default_rng(n)
    toxic, language = (rng.random(n) < 0.2).astype(np.int32), rng.integers(-1, 4, n, np.int32)
    toxic[language == 3] = 1
    logit = rng.normal(0, 2, n) + toxic * (1 + language)
    logit[::7] = np.round(logit[::7], 1)
    toxic[:2], language[:2] = (0, 1), 0
    found = spark.createDataFrame(pa.table({"toxic": toxic, "language": language, "logit": logit}))
    want = {tox.ALL_TEXTS: best_threshold(logit, toxic, np.ones(n))}
    for place in range(4):
        own = language == place
        if len(set(toxic[own])) == 2:
            want[place] = best_threshold(logit[own], toxic[own], np.ones(own.sum()))
    assert 3 not in want and 0 in want
    assert tox.ranked_thresholds(found) == want


def test_every_shard_has_both_classes(spark, documents, monkeypatch):
    """A scarce class is dealt to several shards, or a shard would learn nothing; it counts once."""
    rows = [(i, t.replace("scumb", "lowei"), bad) for i, t, bad in made(900, 14)]
    few = {r[0] for r in [r for r in rows if r[2] and fold(r[0]) > 1][:7]}
    rows = [r for r in rows if not r[2] or r[0] in few or fold(r[0]) < 2]
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows] + [(i, 1) for i in range(-800, 0)],
                                   "doc_id bigint, toxic int")
    dealt, seen, trained, odds = [], [], tox._trained, tox._log_odds

    def watched(shards, *rest):
        dealt.extend(shards.groupBy(F.spark_partition_id()).agg(
            F.collect_set("toxic").alias("classes"), F.count("*").alias("n")).collect())
        return trained(shards, *rest)

    def counted(counts, sizes):
        seen.append((counts.max(axis=1).tolist(), sizes.tolist()))
        return odds(counts, sizes)

    monkeypatch.setattr(tox, "_trained", watched)
    monkeypatch.setattr(tox, "_log_odds", counted)
    net = tox.fit(documents(*[r[:2] for r in rows]), labels, shard_rows=40)
    learnt = [r for r in rows if fold(r[0]) > 1]
    assert len(dealt) > 5 and all(sorted(r.classes) == [0, 1] for r in dealt)
    assert sum(r.n for r in dealt) == len(learnt) + 7 * (len(dealt) - 1)
    assert seen[-1][1] == [len(learnt) - 7, 7] and seen[-1][0][1] <= 7
    test = [r for r in rows if fold(r[0]) == 0]
    scores = np.array(Scorer(net).scores([r[1] for r in test]))
    assert np.mean((scores >= 0.5) == np.array([r[2] for r in test])) > 0.9


def test_subtracting_at_repeated_rows_is_that_of_numpy_to_the_last_bit():
    rng = np.random.default_rng(4)
    for n in (0, 1, 3_000):
        rows = np.concatenate([rng.integers(0, 5, n), rng.integers(0, 4_000, n)]).astype(np.int32)
        values = rng.normal(0, 0.1, (len(rows), 8))
        want = rng.normal(0, 0.1, (4_000, 8)).astype(np.float32)
        got = want.copy()
        np.subtract.at(want, rows, values)
        tox.subtract_at(got, rows, values)
        assert got.dtype == np.float32 and np.array_equal(got, want)
