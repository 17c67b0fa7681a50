"""Toxicity by a weighted finite-state grammar over clauses.

A text is cut into clauses, a clause into words, a word into a class: insult, threat, target, negation,
reporting word, or other. Four small transducers rewrite the sequence of classes: negation takes the force
from what it governs, reported speech lowers it, a target near an insult or a threat raises it. They are
composed into one machine whose states are the combined states. Its weights multiply the weights of the
words in each matched clause. A clause without an insult or a threat scores nothing.

Which words insult is learned from labelled texts: words, and openings of words for languages that build
compounds, which occur almost only in texts labelled toxic.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellframe.llm.common import labelled_sample, map_texts, stage

#: Words that start each class.
SEEDS = {
    "insult": "idiot idiots moron morons stupid loser losers pathetic worthless disgusting scum trash clown dumb "
    "dummkopf abschaum idioten crétin imbécile ordure estúpido imbécil basura",
    "threat": "kill murder hurt destroy strangle umbringen töten tuer détruire matar destruir",
    "target": "you your they them he she him her people du ihr dich sie tu vous toi ils ustedes ellos tú",
    "negation": "not never no nobody isn't aren't don't nicht kein keine nie pas jamais aucun nunca ningún",
    "report": "said says claimed called wrote quoted reported alleged sagte schrieb nannte dit écrit appelé dijo escribió llamó",
}
CLASSES = {"insult": "i", "threat": "t", "target": "y", "negation": "n", "report": "r"}

CLAUSE = re.compile(r"[.!?;:\n]+")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
#: Openings of words of these lengths may be learned.
STEMS = (4, 5, 6)

#: Bound of the training sample.
SAMPLE = 20_000
#: A word is learned if it is so much likelier in toxic texts, by the log of the ratio, as best guess ...
LEAST_LOG_ODDS = 3.5
#: ... and still so much at ``DEVIATIONS`` standard errors below it: few texts, or classes of like size, need a clearer difference.
LEAST_BOUND, DEVIATIONS = 0.7, 2.0
#: A learned word or opening occurs in so many toxic texts at least that are no copies of each other, however
#: many toxic texts there are: the words of one toxic text and its copies are not taken for insults.
LEAST_TEXTS = 6
#: Texts are copies if more than this share of their word triples agrees, by the ``SKETCH`` least hashes of each.
NEAR, SKETCH = 0.5, 64

REACH = 3
NEGATED, REPORTED, TARGETED = 0.1, 0.5, 1.5


class Transducer:
    """Deterministic: ``step(state, symbol)`` gives the next state, the symbol passed on, and a factor."""

    def __init__(self, states: list, step):
        self.states, self.step = states, step

    def then(self, other: Transducer) -> Transducer:
        """Composition: what this one puts out, the other reads; factors multiply."""

        def step(state, symbol):
            a, mid, f = self.step(state[0], symbol)
            b, out, g = other.step(state[1], mid)
            return (a, b), out, f * g

        return Transducer([(a, b) for a in self.states for b in other.states], step)

    def table(self, alphabet: str) -> dict:
        """All arcs, so that running needs only look-ups."""
        return {(s, c): self.step(s, c) for s in self.states for c in alphabet}


def negation() -> Transducer:
    """A negation governs the next few words: insults and threats in it pass on as weak ones (``w``)."""

    def step(left, c):
        if c == "n":
            return REACH, "o", 1.0
        return max(0, left - 1), *(("w", NEGATED) if left and c in "it" else (c, 1.0))

    return Transducer(list(range(REACH + 1)), step)


def reported() -> Transducer:
    """After a reporting word the rest of the clause is someone else's speech."""

    def step(on, c):
        if c == "r":
            return 1, "o", 1.0
        return on, c, REPORTED if on and c in "itw" else 1.0

    return Transducer([0, 1], step)


def target() -> Transducer:
    """A target shortly before an insult or threat raises it; one shortly after raises it likewise."""

    def step(state, c):
        before, after = state
        if c == "y":
            return (REACH, 0), "a" if after else "o", 1.0
        if c in "it":
            return (0, 0 if before else REACH), c, TARGETED if before else 1.0
        return (max(0, before - 1), max(0, after - 1)), c, 1.0

    return Transducer([(b, a) for b in range(REACH + 1) for a in range(REACH + 1)], step)


def force() -> Transducer:
    """The end of the chain: threats weigh more than insults, other symbols nothing by themselves."""
    weight = {"i": 1.0, "t": 1.2, "w": 1.0, "a": TARGETED - 1}
    return Transducer([0], lambda s, c: (0, c, weight.get(c, 0.0)))


GRAMMAR = negation().then(reported()).then(target()).then(force())
START = (((0, 0), (0, 0)), 0)
ARCS = GRAMMAR.table("itynro")


def clause_score(classes: list[tuple[str, float]]) -> float:
    """Of a clause as (class, weight of the word); a target after an insult repeats that insult's weight in part."""
    state, score, last = START, 0.0, 0.0
    for symbol, weight in classes:
        state, out, factor = ARCS[state, symbol]
        if out == "a":
            score += last * factor
        elif factor:
            last = weight * factor
            score += last
    return score


@dataclass
class Lexicon:
    """Classes of words: ``words`` and ``stems`` to (class, weight)."""

    words: dict[str, tuple[str, float]]
    stems: dict[str, tuple[str, float]] = field(default_factory=dict)

    @classmethod
    def seeded(cls) -> Lexicon:
        return cls({w: (CLASSES[k], 3.0) for k, words in SEEDS.items() for w in words.split()})

    def of(self, word: str) -> tuple[str, float]:
        if found := self.words.get(word):
            return found
        for n in STEMS:
            if len(word) > n and (found := self.stems.get(word[:n])):
                return found
        return "o", 0.0


@dataclass
class Grammar:
    lexicon: Lexicon
    weights: np.ndarray = field(default_factory=lambda: np.array([-3.0, 2.0, 1.5, 0.0]))

    def clauses(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, score) of the clauses that match, in code points."""
        found, at = [], 0
        for m in [*CLAUSE.finditer(text), None]:
            end = m.start() if m else len(text)
            part = [self.lexicon.of(w.lower()) for w in WORD.findall(text, at, end)]
            if any(c in "it" for c, _ in part) and (score := clause_score(part)) > 0:
                found.append((at, end, score))
            at = m.end() if m else end
        return found

    def measures(self, text: str | None) -> tuple[float, float, float]:
        """Largest clause score, log of their sum, and their sum for each hundred words, limited to 1."""
        text = text or ""
        words = WORD.findall(text.lower())
        if not self.strong(words):
            return 0.0, 0.0, 0.0
        scores = [s for *_, s in self.clauses(text)]
        if not scores:
            return 0.0, 0.0, 0.0
        return min(max(scores), 20.0) / 3, float(np.log1p(sum(scores))), min(1.0, sum(scores) * 100 / len(words) / 10)

    def strong(self, words: list[str]) -> bool:
        """Whether any word is an insult or a threat: most texts have none and are done with here."""
        seen = set(words)
        if any(self.lexicon.words[w][0] in "it" for w in self.lexicon.words.keys() & seen):
            return True
        stems = self.lexicon.stems
        return bool(stems) and any(not stems.keys().isdisjoint({w[:n] for w in seen if len(w) > n}) for n in STEMS)

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-(self.weights @ [1.0, *self.measures(text)]))))


def _term_counts(sample: DataFrame) -> DataFrame:
    """(term, pos, neg): labelled texts with each word and each opening (marked ``*``), first counted by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            for text, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = set(WORD.findall((text or "").lower()))
                counts[y].update(words)
                for n in STEMS:
                    counts[y].update({w[:n] + "*" for w in words if len(w) > n})
            terms = list(counts[1])  # only terms of toxic texts can be learned ...
            rest = [t for t in counts[0] if t not in counts[1]]  # ... but other batches may have them
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms + rest), pa.array([counts[1][t] for t in terms] + [0] * len(rest)), pa.array([counts[0][t] for t in terms + rest])],
                ["term", "pos", "neg"],
            )

    return sample.select("text", "y").mapInArrow(run, "term string, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _sketch(words: list[str]) -> np.ndarray:
    """The least hashes of a text's word triples; of a text under three words, of all its words as one."""
    triples = {" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))}
    return np.array(sorted({zlib.crc32(t.encode()) for t in triples})[:SKETCH], np.uint32)


def _near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sketches are of copies: the share of common ones among the least of both together."""
    least = np.union1d(a, b)[:SKETCH]
    return int((np.isin(least, a) & np.isin(least, b)).sum()) > NEAR * len(least)


def _supported(toxic: DataFrame, terms: list[str]) -> set[str]:
    """Those of ``terms`` that occur in ``LEAST_TEXTS`` texts of which none is a copy of another.

    Each text comes as its sketch and the places of its terms, so the driver holds no more than the sample's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: k for k, t in enumerate(terms)}
        for batch in batches:
            sketches, held = [], []
            for text in batch.column(0).to_pylist():
                words = WORD.findall((text or "").lower())
                seen = set(words)
                seen |= {w[:n] + "*" for w in seen for n in STEMS if len(w) > n}
                if found := sorted(place[t] for t in seen & place.keys()):
                    sketches.append(_sketch(words).tobytes())
                    held.append(np.array(found, np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sketches, pa.binary()), pa.array(held, pa.binary())], ["sketch", "terms"])

    rows = toxic.select("text").mapInArrow(run, "sketch binary, terms binary").collect()
    rows = sorted((bytes(r["sketch"]), bytes(r["terms"])) for r in rows)
    sketches = [np.frombuffer(sketch, np.uint32) for sketch, _ in rows]
    apart: dict[int, list[int]] = {}
    for n, (_, held) in enumerate(rows):
        near: dict[int, bool] = {}  # many terms of a text have the same texts to compare with
        for k in np.frombuffer(held, np.int32).tolist():
            others = apart.setdefault(k, [])
            if len(others) < LEAST_TEXTS:
                for o in others:
                    if o not in near:
                        near[o] = _near(sketches[n], sketches[o])
                    if near[o]:
                        break
                else:
                    others.append(n)
    return {terms[k] for k, others in apart.items() if len(others) >= LEAST_TEXTS}


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Seeds, and all words and openings surely likelier in toxic texts which enough texts have.

    Exact copies count once. The test is of the ratio of the word's shares in toxic and other texts, given how many there are,
    so it does not depend on how many of the labelled texts are toxic, and the insults of a language that few toxic texts
    are in are learned too.
    """
    made = Lexicon.seeded()
    sample = stage(sample.select("text", "y").distinct(), "toxicity-sample")
    total = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    pos, neg = total.get(1, 0), total.get(0, 0)
    if not pos or not neg:
        return made
    odds = F.log((F.col("pos") + 0.5) / (pos + 1)) - F.log((F.col("neg") + 0.5) / (neg + 1))
    error = F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    sure = (F.col("w") >= LEAST_LOG_ODDS) & (F.col("w") - DEVIATIONS * error >= LEAST_BOUND)
    rows = _term_counts(sample).filter(F.col("pos") >= LEAST_TEXTS).withColumn("w", odds).filter(sure).collect()
    enough = _supported(sample.filter("y = 1"), sorted(r["term"] for r in rows))
    for r in rows:
        term, entry = r["term"], ("i", min(r["w"], 8.0) / 2)
        if term not in enough:
            continue
        if term.endswith("*"):
            made.stems[term[:-1]] = entry
        elif made.words.get(term, ("i",))[0] in "it":
            made.words[term] = entry
    return made


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps, with the intercept first and not penalised."""
    a, w = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    penalty = np.diag([1e-3, *[ridge] * x.shape[1]])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a.T * (p * (1 - p))) @ a + penalty, a.T @ (y - p) - penalty @ w)
        w += np.clip(step, -2, 2)
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, train_rows: Column, rows: int = SAMPLE) -> Grammar:
    """Learn the lexicon and the weights from at most ``rows`` labelled texts; seeds alone if a class is missing."""
    sample = labelled_sample(docs, labels, "toxic", train_rows, rows)
    grammar = Grammar(learn_lexicon(sample))

    def make():
        return lambda texts: list(zip(*(grammar.measures(t) for t in texts), strict=True))

    fields = [T.StructField(f"x{k}", T.DoubleType()) for k in range(3)]
    got = map_texts(sample, make, fields, keep=("y",)).groupBy("y", "x0", "x1", "x2").count().toPandas()
    got = got.sort_values(["y", "x0", "x1", "x2"])
    if got["y"].nunique() == 2:
        times = got["count"].to_numpy()
        x = np.repeat(got[["x0", "x1", "x2"]].to_numpy(float), times, axis=0)
        grammar.weights = _fit(x, np.repeat(got["y"].to_numpy(float), times))
    return grammar


FIELDS = [
    T.StructField("score", T.DoubleType()), T.StructField("n_clauses", T.LongType()), T.StructField("top_clause", T.DoubleType()),
]


def score_toxicity(docs: DataFrame, grammar: Grammar, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, ``score`` (0 to 1), the number of matching clauses and the largest clause score.

    Row by row: a null or empty text has no clauses and gets the score of a text without matches; a null id
    stays null; repeated rows get equal scores; other columns are ignored; texts are read whole.
    """

    def make():
        def work(texts):
            out = []
            for text in texts:
                measures = grammar.measures(text)
                matched = grammar.clauses(text) if measures[0] else []
                score = float(1 / (1 + np.exp(-(grammar.weights @ [1.0, *measures]))))
                out.append((score, len(matched), max((s for *_, s in matched), default=0.0)))
            return list(zip(*out, strict=True))

        return work

    return map_texts(docs, make, FIELDS, keep=keep)


def matched_clauses(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id, start, end and score of every matching clause, in code points of the text."""
    kind = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))
    make = lambda: lambda texts: [[[dict(zip(("start", "end", "score"), c, strict=True)) for c in grammar.clauses(t or "")] for t in texts]]
    return map_texts(docs, make, [T.StructField("clauses", kind)]).select("doc_id", F.inline("clauses"))


def drop_toxic(docs: DataFrame, grammar: Grammar, least: float = 0.7) -> DataFrame:
    """``docs`` without the rows that score ``least`` or more; columns unchanged, whatever their names.

    Null and empty texts have the score of texts without matches; repeated rows stay or go alike.
    """

    def make():
        return lambda texts: [[grammar.score(t) for t in texts]]

    packed = docs.select(F.struct(*docs.columns).alias("row"))
    scored = map_texts(packed, make, [T.StructField("score", T.DoubleType())], keep=["row"], text="row.text")
    return scored.filter(F.col("score") < least).select("row.*")
