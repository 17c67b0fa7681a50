"""SentencePiece against its library, the Jaccard join against all pairs, and the pipeline against plain steps."""

import random

import brute
import corpus_pipeline
import pytest
import sentencepiece
from conftest import SF, odd_texts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as pb

from dwellframe.llm import components, ngram_jaccard, pieces, queries

PATH = queries.vocabulary(queries.PIECE_MODEL)
ODD = [t or "" for _, t in odd_texts()] + ["▁", "▁▁a", " a", "a ", "a  b", "\n", " \n ", "a▁b  c▁ ", "ﬁ Ａ①", "日本語 テキスト", "😀😀", "  ", "á é"]


@pytest.fixture(scope="module")
def own():
    return pieces.model(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def with_map(rule):
    """The model with a compiled character map of the library in place of none."""
    model = pb.ModelProto.FromString(open(PATH, "rb").read())
    blob = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True).serialized_model_proto()
    model.normalizer_spec.CopyFrom(pb.ModelProto.FromString(blob).normalizer_spec)
    return model.SerializeToString()


def test_encodes_as_the_library(own, library):
    got = own.encode_batch(ODD)
    assert [g[0].tolist() for g in got] == library.encode(ODD)
    for text, (ids, starts, ends) in zip(ODD, got, strict=True):
        raw = text.encode()
        assert ends[-1] == len(raw) if len(ids) else not raw
        assert list(starts[1:]) == list(ends[:-1]) and all(starts <= ends)
        for i, a, b in zip(ids.tolist(), starts, ends, strict=True):
            piece = library.id_to_piece(i)
            assert raw[a:b] == (bytes([int(piece[3:5], 16)]) if library.is_byte(i) else raw[a:b])
            if not library.is_byte(i):
                assert raw[a:b].decode().replace(" ", "▁") == piece or (a == 0 and "▁" + raw[a:b].decode().replace(" ", "▁") == piece)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab ▁\n.é"), st.characters(codec="utf-8")), max_size=60))
def test_encodes_any_text_as_the_library(text):
    own = pieces.model(PATH)
    ids = own.encode(text)[0].tolist()
    assert ids == own.whole.encode(text) and own.decode([ids]) == [own.whole.decode(ids)]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
def test_character_map_as_the_library(rule):
    blob = with_map(rule)
    own, library = pieces.Pieces.from_bytes(blob), sentencepiece.SentencePieceProcessor(model_proto=blob)
    texts = [*ODD, "ﬁne Ａbc ①②  ｶﾞ x　y", " ㍿ ", "Ｔｈｅ  Ｅｎｄ ", "ｶﾞｷﾞ"]
    assert own.map.units and [g[0].tolist() for g in own.encode_batch(texts)] == library.encode(texts)
    made, at = own.normalise("x ﬁ")
    assert made == "▁x▁fi" and [int(k) for k in at] == [0, 0, 0, 0, 1, 1, 1, 2, 2, 5]


def test_model_without_byte_fallback():
    model = pb.ModelProto.FromString(open(PATH, "rb").read())
    model.trainer_spec.byte_fallback = False
    for p in model.pieces:
        if p.type == pb.ModelProto.SentencePiece.BYTE:
            p.type = pb.ModelProto.SentencePiece.NORMAL
    blob = model.SerializeToString()
    own, library = pieces.Pieces.from_bytes(blob), sentencepiece.SentencePieceProcessor(model_proto=blob)
    texts = ["plain text", "odd 😀😀 and 😀 x", ""]
    got = own.encode_batch(texts)
    assert [g[0].tolist() for g in got] == library.encode(texts)
    assert [int(g[2][-1]) for g in got if len(g[2])] == [len(t.encode()) for t in texts if t]


def test_pieces_query(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op7_pieces(spark, SF).collect():
        ids = [*library.encode(texts[r["doc_id"]]), library.eos_id()]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(library.decode(ids)))
        assert r["n_bytes"] == len(texts[r["doc_id"]].encode())


def test_pieces_of_odd_tables(table, library, monkeypatch):
    texts = odd_texts()
    got = pieces.encode_texts(table(texts), PATH).collect()
    want = sorted(((d, [*library.encode(t or ""), library.eos_id()]) for d, t in texts), key=repr)
    assert sorted(((r["doc_id"], list(r["ids"])) for r in got), key=repr) == want
    assert all(len(r["ids"]) == len(r["starts"]) == len(r["ends"]) for r in got)
    assert pieces.encode_texts(table(texts).limit(0), PATH).count() == 0
    back = pieces.decode_ids(pieces.encode_texts(table(texts), PATH).drop("decoded"), PATH).collect()
    assert all(r["decoded"] == library.decode(list(r["ids"])) for r in back)


def test_forgetting_chunks_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    own = pieces.Pieces(PATH)
    texts = ["a b c d e", "e d c b a f g h", "x y z"]
    for _ in range(2):
        assert [g[0].tolist() for t in texts for g in [own.encode(t)]] == library.encode(texts)


def near_copies(seed=4):
    """Clusters around the threshold: chains, stars, exact copies, shared passages, short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=4))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(14):
        base = [word() for _ in range(rng.choice((6, 8, 20, 80, 200)))]
        if rng.random() < 0.4:
            base[3:3] = passage
        for _ in range(rng.randrange(1, 9)):
            own = list(base)
            for _ in range(rng.randrange(0, max(1, len(own) // 40) + 2)):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own))
            if rng.random() < 0.3:
                base = own  # chains drift away from where they began
    texts += texts[::9]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("rounds,group", [(2, 64), (0, 3)])
def test_components_equal_all_pairs(table, monkeypatch, rounds, group):
    """With leaders first, and by the matrix alone with small groups."""
    monkeypatch.setattr(ngram_jaccard, "ROUNDS", rounds)
    monkeypatch.setattr(ngram_jaccard, "GROUP", group)
    monkeypatch.setattr(ngram_jaccard, "LEAST", 2)
    monkeypatch.setattr(ngram_jaccard, "BUCKET", 2000)
    rows = near_copies(4 + rounds) + [(None if d is None else d + 1000, t) for d, t in odd_texts()]
    got = sorted(map(tuple, ngram_jaccard.jaccard_components(table(rows)).collect()), key=repr)
    want = sorted(brute.components(rows), key=repr)
    # texts without words are alone, even where their id is null or shared
    assert got == [w if w[1] else (w[0], 0, w[0]) for w in want]
    assert len({w[2] for w in want}) < len(want) - 20


def test_jaccard_query_equals_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op9_ngram_jaccard(spark, SF).collect())) == sorted(brute.components(rows))


def test_jaccard_of_an_empty_table(table):
    assert ngram_jaccard.jaccard_components(table([(1, "x")]).limit(0)).count() == 0
    assert ngram_jaccard.keep_one(table([(1, "x")]).limit(0)).count() == 0


def test_keep_one_of_each(table):
    a, b = "a b c d e f g h i j", "k l m n o p q r s t"
    rows = [(3, a), (1, a), (1, a), (2, b), (2, b + " " + b), (None, "x y z"), (None, "x y z"), (4, None), (4, None), (5, ""), (6, "X y Z"), (None, a)]
    out = ngram_jaccard.keep_one(table(rows))
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    # b + b has shingles beyond those of b, so it is another text that only shares the id
    assert got == sorted([(1, a), (2, b), (2, b + " " + b), (4, None), (4, None), (5, ""), (6, "X y Z")], key=repr)
    assert out.columns == table(rows).columns


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 9), (9, 9)] + [(50, k) for k in range(51, 80)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {3: 3, 7: 3, 9: 3} | {k: 50 for k in range(50, 80)}


def plain_pipeline(spark, sf):
    """Each stage by its plain version; toxicity by the operator's own grammar, text by text."""
    docs = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    grammar = queries.toxicity_grammar(spark, sf)
    docs = [d for d in docs if grammar.score(d["text"]) < 0.7]
    own = {d: c for d, _, c in brute.components([(d["doc_id"], d["text"]) for d in docs])}
    docs = [d for d in docs if own[d["doc_id"]] == d["doc_id"]]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    hits = brute.contamination([(d["doc_id"], d["text"]) for d in docs], items)
    return [d for d in docs if not hits[d["doc_id"]][1]]


def test_pipeline_equals_the_plain_steps(spark, library):
    want = {d["doc_id"]: d["text"] for d in plain_pipeline(spark, SF)}
    got = {r["doc_id"]: list(r["ids"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(want) and len(got) < 200
    for d, text in want.items():
        if brute.base_secrets(text)[:3] == (0, 0, 0):
            assert got[d] == [*library.encode(text), library.eos_id()]
        else:
            assert "[secret]" in library.decode(got[d])


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(20).unionByName(spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0)], docs.schema)).withColumn("score", F.lit("s"))
    for _, step in corpus_pipeline.STAGES[:-1]:
        odd = step(spark, odd, SF)
        assert odd.columns == [*docs.columns, "score"]
    assert corpus_pipeline.STAGES[-1][1](spark, odd, SF).count() > 10
