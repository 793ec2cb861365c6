import random

import pytest

import farebox.llm.tokens as tokens

library = pytest.importorskip("sentencepiece")
P = pytest.importorskip("public_tokenizers")
MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sp():
    return library.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def transducer():
    return tokens.Transducer.load(MODEL)


def count(t, text, chunk):
    body = (" " + text.replace(tokens.MARK, " ")).encode() if text else b""
    return t.scan([t.chunk_map(body[i : i + chunk]) for i in range(0, len(body), chunk)] or [t.chunk_map(b"")])


def test_random_texts_in_chunks_of_any_size(sp, transducer):
    draw = random.Random(1)
    parts = [
        *"aets", " ", "  ", "\n", "\t", "\r", tokens.MARK, "é", "ß", "Ж", "日本", "한", "😀", "ﬁ", "\x00", "<s>", "<unk>",
        "<0x0A>", "th", "ing", "ation", "==", "_", "123", "://", "\u00a0", "e\u0301",
    ]
    pieces = [p.replace(tokens.MARK, " ") for p in transducer.scores]
    for k in range(1500):
        text = "".join(draw.choices(parts if k % 2 else pieces, k=draw.randint(0, 40)))
        want = len(sp.encode(text))
        assert [count(transducer, text, c) for c in (1, 2, 5, 17, 1 << 20)] == [want] * 5, repr(text)


def test_texts_without_spaces_by_tables(sp, monkeypatch):
    """Every part of a text gets a table; the states that arrive are found in it, or walk along the bytes."""
    monkeypatch.setattr(tokens, "SHORT", 40)
    t = tokens.Transducer.load(MODEL)
    draw, walked = random.Random(4), []
    plain = t.onward
    monkeypatch.setattr(t, "onward", lambda now, part: (walked.append(part[1] is None and len(part[0]) > 200), plain(now, part))[1])
    texts = ["=" * 3001, "ab" * 1500, "日本語한" * 400, "internationalization" * 120, "𝄞é" * 500, "x" * 999 + " " + "y" * 999]
    texts += ["".join(draw.choices("abcdeinorst", k=2500)) for _ in range(20)]
    texts += ["".join(draw.choices(["th", "ing", "ß", "日", "😀", "0", "9", "_", "/"], k=1500)) for _ in range(20)]
    for text in texts:
        for c in (500, 701):
            assert count(t, text, c) == len(sp.encode(text)), text[:40]
    assert sum(walked) < 0.2 * len(walked)


def test_states_may_be_forgotten(sp, monkeypatch):
    t = tokens.Transducer.load(MODEL)
    monkeypatch.setattr(tokens, "MOST_STATES", 50)
    monkeypatch.setattr(tokens, "MOST_WORDS", 20)
    text = "The tokenizer compiles its states anew when there are too many of them, word by word. " * 20
    assert count(t, text, 64) == len(sp.encode(text))


def test_documents(sp, small):
    texts = {r.doc_id: r.text for r in small.documents.collect()}
    for r in tokens.count_tokens(small.documents, MODEL).collect():
        n = len(sp.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def test_odd_rows(sp, odd, monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK", 1000)  # many chunks for the long texts, cut within characters
    texts = sorted((repr(r.doc_id), len((r.text or "").encode()), len(sp.encode(r.text or ""))) for r in odd.collect())
    rows = tokens.count_tokens(odd, MODEL).collect()
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == texts


def test_texts_of_many_chunks(spark, sp):
    """Texts of 3 MiB by the default chunk, with and without spaces, give one row each."""
    assert tokens.CHUNK == 1 << 20
    texts = ["one two, three " * 210_000, "ab" * 1_600_000, "日本語" * 400_000, "x y" + "=" * 3_200_000, "\n" * 3_200_000, "a"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] * 2, "doc_id bigint, text string").repartition(4)
    got = sorted(map(tuple, tokens.count_tokens(docs, MODEL).collect()))
    want = [(k, len(t.encode()), n, n > 4096) for k, t in enumerate(texts) for n in [len(sp.encode(t))] * 2]
    assert got == want


def test_empty_table(no_docs):
    assert tokens.count_tokens(no_docs, MODEL).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        tokens.Transducer({"a" + tokens.MARK + "b": -1.0})
