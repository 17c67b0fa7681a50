"""Groups of the Jaccard join: what is opened, how hot groups are split, and hot shingles and clusters."""

import random

import brute
import numpy as np
from pyspark.sql import functions as F

from dwellframe.llm import ngram_jaccard as join


def some_set(rng, n):
    return np.unique(np.array([rng.getrandbits(63) for _ in range(n)], np.uint64))


def test_closed_groups_compare_nothing(monkeypatch):
    rng = random.Random(1)
    compared = []
    plain = join.similar
    monkeypatch.setattr(join, "similar", lambda *a: compared.append(a) or plain(*a))
    base = some_set(rng, 100)
    members = [(k, np.delete(base, k)) for k in range(5)]
    stranger, half, near = some_set(rng, 100), np.unique(np.concatenate([base[:60], some_set(rng, 40)])), np.unique(np.append(base[:95], some_set(rng, 2)))
    assert join.open_group(members, [(10, stranger), (11, half)], False) == [] and compared == []
    assert join.open_group(members, [(12, near)], False)[0] == (12, 0)
    linked = join.open_group(members, [(12, near), (13, base)], True)
    assert len(linked) == 6 and {x for pair in linked for x in pair} == {0, 1, 2, 3, 4, 12, 13}  # a tree: what is connected is not compared again


def test_every_link_comes_from_an_opened_group(spark, table, monkeypatch):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=4))
    passage = " ".join(word() for _ in range(30))
    rows = []
    for c in range(40):
        base = [word() for _ in range(80)]
        for _ in range(rng.randrange(1, 30) if c else 300):  # one hot cluster, beyond a group's size
            own = list(base)
            own[rng.randrange(80)] = word()
            rows.append((len(rows), " ".join(own) + (f" {passage}" if c % 2 else "")))
    rng.shuffle(rows)
    steps, plain = [], join._opened

    def counted(groups, queries, sets):
        found = plain(groups, queries, sets).cache()
        steps.append((groups.groupBy("g").count().agg(F.max("count")).first()[0], found.count()))
        return found

    monkeypatch.setattr(join, "_opened", counted)
    monkeypatch.setattr(join, "GROUP", 32)
    monkeypatch.setattr(join, "QUERIES", 50)
    got = sorted(map(tuple, join.jaccard_components(table(rows)).collect()))
    assert got == sorted(brute.components(rows))
    links = sum(n for _, n in steps)
    distinct = len({t for _, t in rows}) - len({c for *_, c in got})
    assert links >= distinct > 300  # as many as connect all that is similar
    assert links < 4 * distinct  # and not all pairs of a hot cluster
    assert max(size or 0 for size, _ in steps) < 3 * 32


def test_dissimilar_texts_with_one_common_passage(spark, table):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=4))
    passage = " ".join(word() for _ in range(12))
    rows = [(k, f"{passage} " + " ".join(word() for _ in range(rng.choice((3, 4, 25))))) for k in range(400)]
    assert sorted(map(tuple, join.jaccard_components(table(rows)).collect())) == sorted(brute.components(rows))
