"""Language model, toxicity, quality model, language: against plain versions, by normalisation and by held-out accuracy."""

import math
import random

import brute
import numpy as np
import pytest
from conftest import SF, odd_texts
from pyspark.sql import functions as F

from dwellframe.llm import katz, language, quality_gam, queries, toxicity
from dwellframe.llm.common import remainder

FIGURES = ("doc_id", "n_tokens", "n_known", "base_score", "score")


def same_scores(got, texts, train):
    model = brute.Katz([t for k, (_, t) in enumerate(texts) if train[k]])
    want = sorted(((d, len(model.tokens(t)), sum(w in model.one for w in model.tokens(t)), model.base(t), model.score(t)) for d, t in texts), key=repr)
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=repr), want, strict=True):
        assert a[:3] == b[:3] and all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(a[3:], b[3:], strict=True)), (a, b)
    return model


def test_katz_query_equals_the_plain_model(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    held = [brute.remainder(d, 5) == 1 for d, _ in texts]
    rows = queries.op2_katz(spark, SF).collect()
    model = same_scores([tuple(r[c] for c in FIGURES) for r in rows], texts, [not h for h in held])
    assert {r["train_tokens"] for r in rows} == {model.n}
    assert sum(r["score"] for r in rows if r["held_out"]) > sum(r["base_score"] for r in rows if r["held_out"])


@pytest.fixture(scope="module")
def small():
    rng = random.Random(2)
    words = "a b c d e f g h i j k l m n o p".split()
    return [(i, " ".join(rng.choices(words, [2**-k for k in range(16)], k=rng.randrange(40)))) for i in range(60)]


def test_katz_on_odd_texts_and_by_both_ways(spark, table, small, monkeypatch):
    texts = small + [(d if d is None else d + 100, t) for d, t in odd_texts()]
    train = F.col("doc_id") % 3 != 0
    marks = [d is not None and d % 3 != 0 for d, _ in texts]
    for size in (katz.BROADCAST_BYTES, 0):
        monkeypatch.setattr(katz, "BROADCAST_BYTES", size)
        monkeypatch.setattr(katz, "BLOCK", 20)
        monkeypatch.setattr(katz, "BUCKET", 7_000)
        got = [tuple(r[c] for c in FIGURES) for r in katz.score(katz.learn(table(texts), train)).collect()]
        same_scores(got, texts, marks)


def test_katz_probabilities_add_up_to_one(table, small):
    plain = brute.Katz([t for _, t in small])
    for h in [*plain.two, "never seen"]:
        assert math.isclose(sum(plain.p2(h, w) for w in plain.one) + plain.p2(h, None), 1)
    model = katz.learn(table(small), F.lit(True))
    assert math.isclose(model.unigrams.agg(F.sum("c")).first()[0], plain.n)
    assert sorted(r["c"] for r in model.bigrams().collect()) == sorted(c for of in plain.two.values() for c in of.values())


def test_katz_without_training_rows(table, small):
    got = katz.score(katz.learn(table(small), F.lit(False))).collect()
    assert {(r["score"], r["n_known"], r["train_tokens"]) for r in got} == {(0.0, 0, 0)}
    assert katz.score(katz.learn(table(small).limit(0), F.lit(True))).count() == 0


def test_good_turing_falls_back():
    plain = katz.good_turing({1: 1000, 2: 333, 3: 167, 4: 100, 5: 67, 6: 48})
    assert all(0 < f < 1 for f in plain[1:]) and all(np.diff(plain[1:]) > 0)
    for odd in ({}, {1: 5}, {3: 2}, {1: 1, 6: 100}):
        assert all(0 < f < 1 for f in katz.good_turing(odd)[1:])


def machine(words):
    return toxicity.clause_score([toxicity.Lexicon.seeded().of(w) for w in words.split()])


def test_grammar_of_clauses():
    assert machine("the house is old") == 0
    assert machine("idiot") > 0 and machine("you idiot") > machine("idiot")
    assert machine("idiot you") > machine("idiot")
    assert machine("not an idiot") < machine("idiot") / 3
    assert machine("not a b c d idiot") == pytest.approx(machine("idiot"))
    assert machine("she said idiot") < machine("idiot") * toxicity.TARGETED
    assert machine("i will kill you") > machine("will kill")
    assert machine("you") == machine("not said you") == 0
    rewritten, factor = toxicity.negation().step(2, "i")[1:]
    assert (rewritten, factor) == ("w", toxicity.NEGATED)
    assert toxicity.negation().then(toxicity.reported()).step((3, 1), "t")[1:] == ("w", toxicity.NEGATED * toxicity.REPORTED)


def by_label(spark, sf, scored, label):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return [(r["held_out"], r[label], r["predicted"], r["score"]) for r in scored.join(labels, "doc_id").collect() if r[label] is not None]


def test_toxicity_on_held_out_rows(spark):
    sf = SF.replace("0.001", "0.01")
    rows = by_label(spark, sf, queries.op5_toxicity(spark, sf), "toxic")
    held = [r for r in rows if r[0]]
    assert sum(r[2] for r in held if r[1] == 0) <= 0.01 * len(held)
    english = sum(r[2] for r in held if r[1] == 1) / sum(1 for r in held if r[1] == 1)
    assert english >= 0.5 and all(0 <= r[3] <= 1 for r in rows)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int, quality int")


def test_toxicity_of_odd_tables(spark, table):
    texts = odd_texts() + [(50, "you idiot"), (50, "you idiot")]
    grammar = toxicity.fit_toxicity(table(texts), labels(spark, [(1, 0, 1), (None, 1, 0), (4, None, None)]), F.lit(True))
    got = toxicity.score_toxicity(table(texts), grammar).collect()
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 50}) == 1 and {r["n_clauses"] for r in got if r["doc_id"] in (1, 2)} == {0}
    kept = toxicity.drop_toxic(table(texts), grammar)
    assert kept.columns == table(texts).columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted((t for t in texts if t[0] != 50), key=repr)
    spans = toxicity.matched_clauses(table([(1, "So it is. You idiot, go! End")]), grammar).collect()
    assert [("So it is. You idiot, go! End")[r["start"] : r["end"]] for r in spans] == [" You idiot, go"]
    assert toxicity.score_toxicity(table(texts).limit(0), grammar).count() == 0


def test_learned_words_and_openings(spark, table):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefgh", k=7))
    texts, marks = [], []
    for i in range(300):
        bad = i % 5 == 0
        words = [word() for _ in range(30)] + (["zurgle", "xoqu" + word()] if bad else [])
        rng.shuffle(words)
        texts.append((i, " ".join(words)))
        marks.append((i, int(bad), 1))
    grammar = toxicity.fit_toxicity(table(texts), labels(spark, marks), F.lit(True))
    assert grammar.lexicon.of("zurgle")[0] == "i" and grammar.lexicon.of("xoquanything")[0] == "i" and grammar.lexicon.of("abcdefg")[0] == "o"
    assert grammar.score("one zurgle two") > 0.7 > grammar.score("one two")


def test_insults_of_a_rare_language_are_learned(spark, table):
    """12 of 812 toxic texts have them, less than 1.5 %; words of one text's many near copies stay out, and exact copies count once."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=7))
    texts, marks = [], []

    def add(words, bad):
        texts.append((len(texts), " ".join(words)))
        marks.append((len(marks), bad, 1))

    for _ in range(8000):
        add([word() for _ in range(8)], 0)
    for _ in range(700):
        add([*(word() for _ in range(8)), "zurgle"], 1)
    for k in range(12):
        add([*(word() for _ in range(8)), "mirkox", "vostibul" if k < 5 else word()], 1)
    copied = [word() for _ in range(40)] + ["quandry"]
    for _ in range(60):
        add([word(), *copied], 1)
    for _ in range(40):
        add(texts[8700][1].split() + ["plomber"], 1)
    lexicon = toxicity.fit_toxicity(table(texts), labels(spark, marks), F.lit(True)).lexicon
    assert [lexicon.of(w)[0] for w in ("zurgle", "mirkox", "vostibul", "quandry", "plomber")] == ["i", "i", "o", "o", "o"]


def test_quality_on_held_out_rows(spark):
    sf = SF.replace("0.001", "0.01")
    rows = [r for r in by_label(spark, sf, queries.op6_quality_gam(spark, sf), "quality") if r[0]]
    assert sum(r[2] == r[1] for r in rows) / len(rows) >= 0.9
    assert sum(r[2] for r in rows if r[1] == 1) >= 0.97 * sum(1 for r in rows if r[1] == 1)


def test_additive_model_learns_single_and_paired_effects():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit_additive(x, y)
    assert ((model.probability(x) > 0.5) == y).mean() > 0.9 and (0, 1) in [p[:2] for p in model.pairs]
    y = (x[:, 2] > 0.3).astype(float)
    assert ((quality_gam.fit_additive(x, y).probability(x) > 0.5) == y).mean() > 0.97
    slow = [model.base + sum(t[np.searchsorted(e, v, side="right")] for v, e, t in zip(row, model.edges, model.tables, strict=True))
            + sum(t[np.searchsorted(model.pair_edges[a], row[a], side="right"), np.searchsorted(model.pair_edges[b], row[b], side="right")] for a, b, t in model.pairs) for row in x[:50]]
    assert np.allclose(model.log_odds(x[:50]), slow)


def test_quality_of_odd_tables(spark, table):
    for marks in ([], [(4, 0, 1)], [(i, 0, i % 2) for i in range(1, 17)]):
        model = quality_gam.fit_quality(table(odd_texts()), labels(spark, marks), F.lit(True))
        got = quality_gam.score_quality(table(odd_texts()), model).collect()
        assert len(got) == len(odd_texts()) and all(0 <= r["score"] <= 1 for r in got) and (model is None) == (len(marks) < 2)
    assert quality_gam.score_quality(table(odd_texts()).limit(0), None).count() == 0


def test_language_on_held_out_rows(spark):
    sf = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = queries.op10_language(spark, sf).join(docs, "doc_id").filter("held_out and lang is not null").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) >= 0.93


def test_network_gradients_agree_with_differences():
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 256, (5, 20)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    net = language.ByteNet.new(["a", "b", "c"], size=3, filters=2)
    for k, p in enumerate(net.parameters()):
        setattr(net, ("embed", "filters", "shifts", "dense", "bias")[k], p.astype(np.float64))
    net.bias += 0.1
    loss = lambda: -np.log(net.probabilities(x)[np.arange(5), y]).mean()
    for p, g in zip(net.parameters(), net.gradients(x, y), strict=True):
        spots = [np.unravel_index(k, p.shape) for k in np.argsort(-np.abs(np.asarray(g)).ravel())[:4]]
        for spot in spots:
            held, step = p[spot], 1e-5
            p[spot] = held + step
            high = loss()
            p[spot] = held - step
            low = loss()
            p[spot] = held
            assert math.isclose((high - low) / (2 * step), g[spot], rel_tol=1e-3, abs_tol=1e-6)


def test_language_of_odd_tables(table):
    texts = [(d, t, "de" if d and d % 2 else "en") for d, t in odd_texts()]
    net = language.fit_language(table(texts), F.lit(True))
    got = language.predict_language(table(texts), net).collect()
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 and r["lang_pred"] in ("de", "en", "und") for r in got)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert language.fit_language(table(texts), F.lit(False)) is None
    assert {r["lang_pred"] for r in language.predict_language(table(texts), None).collect()} == {"und"}
    assert language.predict_language(table(texts).limit(0), net).count() == 0


def test_windows_hold_every_byte():
    raw = bytes(range(256)) * 3 + b"xyz"
    x, weight = language.windows_of(raw)
    assert x.tobytes()[: len(raw)] == raw and weight.sum() == len(raw) and not any(x.tobytes()[len(raw) :])


def test_remainder(spark):
    got = spark.createDataFrame([(1,), (25,), (None,)], "doc_id long").select(remainder("doc_id", 5).alias("r")).collect()
    assert [r["r"] for r in got] == [brute.remainder(d, 5) for d in (1, 25, None)]
