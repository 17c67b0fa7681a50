"""What bounds, prefixes and names must not cut off."""

import random
import string

import corpus_pipeline
import pytest
from conftest import SF
from pyspark.sql import functions as F

from dwellframe.llm import decontaminate, language, quality_gam, quality_rules, queries, secrets, toxicity


def test_every_language_is_learned(spark):
    rows = [(i, f"text number {i} of language {i % 250}", f"l{i % 250:03d}") for i in range(1000)] + [(5, "another text", "l005"), (5, "a text", "l005")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.sample_windows(docs, F.lit(True), per_language=3).collect()
    assert {r["lang"] for r in got} == {f"l{k:03d}" for k in range(250)}
    assert len(got) <= 250 * 3 * language.SAMPLE_WINDOWS


def test_number_signs_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "½ 123"), (2, "Ⅷ ①"), (3, "² + 2"), (4, "a ½"), (5, "字")], "doc_id long, text string")
    net = language.ByteNet.new(["en", "fr"])
    assert [r["lang_pred"] == "und" for r in language.predict_language(docs, net).orderBy("doc_id").collect()] == [True, True, True, False, False]


def test_a_random_tail_under_one_chunk_is_judged():
    import zstandard

    compress = zstandard.ZstdCompressor(level=3).compress
    rng = random.Random(4)
    words = [f"{rng.choice(['river', 'stone', 'garden', 'window', 'never', 'again'])}{rng.randrange(60)}" for _ in range(9000)]
    prose = " ".join(words)
    noise = "".join(rng.choices(string.ascii_letters + string.digits + "+/", k=4090))
    assert quality_rules.judge(prose[:4500], compress)[6] and quality_rules.judge(prose, compress)[6]
    assert not quality_rules.judge(f"{prose[:4500]} {noise}", compress)[6]
    assert not quality_rules.judge(f"{noise} {prose[:4500]}", compress)[6]
    assert quality_rules.judge(prose + noise, compress)[6]  # a small part of a long text
    for n in (0, 1, 4095, 4096, 4097, 8192, 10_000):
        raw = bytes(rng.randrange(97, 123) for _ in range(n))
        chunks = quality_rules.chunks_of(raw)
        assert all(len(c) == 4096 for c in chunks) and len(chunks) == (-(-n // 4096) if n >= 4096 else 0)
        assert not chunks or (raw.startswith(chunks[0]) and raw.endswith(chunks[-1]))


def toxic_lexicon(spark, toxic, clean):
    rng = random.Random(6)
    words = [f"w{a}{b}" for a in string.ascii_lowercase for b in string.ascii_lowercase]
    texts = [(k, " ".join(rng.choices(words, k=40)) + (f" {own}" if own else ""), y) for k, (y, own) in enumerate([*((1, o) for o in toxic), *((0, o) for o in clean)])]
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
    marks = spark.createDataFrame([(k, y) for k, _, y in texts], "doc_id long, toxic int")
    return toxicity.fit_toxicity(docs, marks, F.lit(True)).lexicon


@pytest.mark.parametrize("clean", [500, 4500])
def test_words_are_learned_whatever_the_share_of_toxic_texts(spark, clean):
    toxic = ["blork"] * 20 + [None] * 480
    lexicon = toxic_lexicon(spark, toxic, ["plain"] * 20 + [None] * (clean - 20))
    assert lexicon.of("blork")[0] == "i" and lexicon.of("plain")[0] == "o"
    assert [w for w in lexicon.words if w[0] == "w" and len(w) == 3] == []  # the common words of both


def test_random_strings_of_one_kind_are_found():
    encode = secrets.tokenizer(queries.vocabulary(queries.SECRET_VOCABULARY))
    rng = random.Random(7)

    def share(alphabet, n=32, times=200):
        runs = ["".join(rng.choices(alphabet, k=n)) for _ in range(times)]
        return sum(any(s[0] == "random" for s in secrets.scan(f"see {r} there", encode)) for r in runs) / times

    assert share(string.ascii_lowercase) > 0.95 and share(string.ascii_uppercase) > 0.95
    assert share(string.ascii_uppercase + "234567") > 0.95 and share("0123456789ABCDEF") > 0.95
    letters = string.ascii_letters + string.digits
    dotted = [".".join("".join(rng.choices(letters, k=12)) for _ in range(4)) for _ in range(100)]
    found = [secrets.scan(f"see {d} there", encode) for d in dotted]
    assert sum([s[:3] for s in spans] == [("random", 4, 4 + len(d))] for d, spans in zip(dotted, found, strict=True)) > 90
    digest = "".join(rng.choices("0123456789ABCDEF", k=32))
    assert secrets.scan(f"md5: {digest}", encode) == [] != secrets.scan(f"key: {digest}", encode)
    for plain in ("Donaudampfschifffahrtsgesellschaft", "www.documentation.example-site.something.html", "pneumonoultramicroscopicsilicovolcanoconiosis", "12345678901234567890123"):
        assert secrets.scan(f"see {plain} there", encode) == [], plain


CLASHING = ("y", "hits", "items", "n_words", "__copy", "__score", "__id", "__doc", "row", "label", "score", "class", "__text", "shingles", "block")


@pytest.fixture(scope="module")
def clashing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs.withColumns({c: F.lit("own") for c in CLASHING})


def test_stages_keep_columns_of_any_name(spark, clashing):
    rows = clashing
    for name, step in corpus_pipeline.STAGES[:-1]:
        rows = step(spark, rows, SF)
        assert rows.columns == clashing.columns, name
    rows = rows.cache()
    assert rows.count() > 100 and rows.filter(" or ".join(f"`{c}` <> 'own'" for c in CLASHING)).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, rows, SF).count() == rows.count()
    rows.unpersist()


def test_models_and_spans_read_tables_with_columns_of_any_name(spark, clashing):
    labels = spark.read.parquet(f"{SF}/labels.parquet").withColumns({c: F.lit(1) for c in ("y", "text", "__id")})
    assert toxicity.score_toxicity(clashing, toxicity.fit_toxicity(clashing, labels, F.lit(True))).count() == clashing.count()
    assert quality_gam.score_quality(clashing, quality_gam.fit_quality(clashing, labels, F.lit(True))).count() == clashing.count()
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet").withColumns({c: F.lit("own") for c in ("window", "item", "part")})
    spans = decontaminate.hit_spans(clashing, benchmark)
    assert spans.columns == ["doc_id", "items", "spans"] and spans.count() > 0
