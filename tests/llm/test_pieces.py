"""Encoding, spans and decoding against the library, character maps against its own normalizers."""

import hashlib
import random

import numpy as np
import pytest

from farebox.llm import pieces

library = pytest.importorskip("sentencepiece")
P = pytest.importorskip("public_tokenizers")
MODEL = P.path("piece_bpe_32k.model")
PARTS = [
    *"aets", " ", "  ", "\n", "\t", "\r", "▁", "é", "ß", "Ж", "日本", "한", "😀", "ﬁ", "\x00", "<s>", "<unk>", "<0x0A>",
    "th", "ing", "ation", "==", "_", "123", "://", " ", "é",
]
WIDE = ["Ａ", "　", "①", "㌀", "ﾊﾞ", "​", "Å", "ＡＢ", "が", "が"]


@pytest.fixture(scope="module")
def sp():
    return library.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def model():
    return pieces.Model.load(MODEL)


def drawn(sp, n):
    draw = random.Random(7)
    known = [sp.id_to_piece(i).replace("▁", " ") for i in range(259, sp.get_piece_size())]
    for k in range(n):
        text = "".join(draw.choices(PARTS if k % 2 else known, k=draw.randint(0, 40)))
        yield text.replace(" ", "") * 4 if k % 50 == 0 else text


def test_ids_and_spans(sp, model):
    for text in drawn(sp, 2000):
        want = [(p.id, p.begin, p.end) for p in sp.encode(text, return_type="proto").pieces] if text else []
        ids, begins, ends = model.encode(text.encode())
        assert list(zip(ids.tolist(), begins.tolist(), ends.tolist())) == want, repr(text)


def test_spans_cover_the_text(model):
    text = "A naïve 日本 line\nwith  ▁ marks 😀.".encode()
    _, begins, ends = model.encode(text)
    assert b"".join(text[a:b] for a, b in zip(begins, ends)) == text


def test_decoding_any_ids(sp, model):
    draw = random.Random(8)
    for text in drawn(sp, 500):
        ids = sp.encode(text, add_bos=True, add_eos=True)
        assert model.decode(ids) == sp.decode(ids), repr(text)
        ids = [draw.choice([draw.choice(ids), draw.randrange(259), draw.randrange(32_000)]) for _ in range(12)]
        assert model.decode(ids) == sp.decode(ids), ids


@pytest.mark.parametrize("rules", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_character_maps(rules):
    theirs = library.SentencePieceNormalizer(rule_name=rules)
    ours = pieces.Normalizer.read(dict(pieces.fields(theirs.serialized_model_proto()))[pieces.NORMALIZER])
    draw = random.Random(9)
    for _ in range(1500):
        text = "".join(draw.choices(PARTS + WIDE, k=draw.randint(0, 25)))
        want, offsets = theirs.normalize(text, with_offsets=True)
        norm, origin = ours(text.encode())
        assert norm.decode() == want.replace("▁", " "), repr(text)
        if origin is not None:
            starts = np.cumsum([0, *(len(c.encode()) for c in norm.decode())])
            assert [len(text.encode()[: origin[s]].decode()) for s in starts] == offsets, repr(text)


def test_words_may_be_forgotten(sp, monkeypatch):
    monkeypatch.setattr(pieces, "MOST_WORDS", 10)
    text = "Words that were seen are kept until there are too many of them, then they are made anew. " * 5
    assert pieces.Model.load(MODEL).encode(text.encode())[0].tolist() == sp.encode(text)


def digests(sp, text):
    ids = sp.encode(text or "", add_bos=True, add_eos=True)
    packed = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def check(sp, docs):
    got = sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.judge(docs, MODEL).collect())
    assert got == sorted((repr(r.doc_id), *digests(sp, r.text)) for r in docs.select("doc_id", "text").collect())


def test_documents(sp, small):
    check(sp, small.documents)


def test_odd_rows(sp, odd):
    check(sp, odd)


def test_long_texts(spark, sp):
    texts = ["word " * 700_000, "z" * 400_000 + "日" * 20_000, "\n" * 1_000_000]
    check(sp, spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))


def test_spans_as_rows(spark, sp):
    docs = spark.createDataFrame([(1, " héllo 𝄞"), (2, None), (3, "")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in pieces.encode(docs, MODEL).collect()}
    want = sp.encode(" héllo 𝄞", return_type="proto").pieces
    assert got[1].ids == [1, *(p.id for p in want), 2]
    assert got[1].begins == [0, *(p.begin for p in want), 12] and got[1].ends == [0, *(p.end for p in want), 12]
    assert [(got[k].ids, got[k].begins, got[k].ends) for k in (2, 3)] == [([1, 2], [0, 0], [0, 0])] * 2
    assert pieces.encode(docs, MODEL, ends=False).where("doc_id = 3").first().ids == []


def test_decoding_rows(spark, sp, odd):
    encoded = pieces.encode(odd, MODEL)
    got = sorted((repr(r.doc_id), r.decoded) for r in pieces.decode(encoded, MODEL).collect())
    assert got == sorted((repr(r.doc_id), sp.decode(sp.encode(r.text or ""))) for r in odd.collect())


def test_empty_table(no_docs):
    assert pieces.judge(no_docs, MODEL).count() == 0


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        pieces.Model(bytes([pieces.TRAINER << 3 | 2, 2, pieces.MODEL_TYPE << 3, 1]))  # a unigram model
