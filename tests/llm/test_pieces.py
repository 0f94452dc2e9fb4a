"""The piece tokenizer against its library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from rebuy.llm import merge_rounds
from rebuy.llm.merge_rounds import MODEL, PieceModel, decode, decode_documents, encode, encode_documents, merge_rounds as merged
from rebuy.llm.registry import QUERIES
from tests.llm.conftest import ROWS

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def model():
    with open(MODEL, "rb") as f:
        return PieceModel(f.read())


def library(text):
    return LIBRARY.encode(text or "", add_bos=True, add_eos=True)


def random_texts(seed, n):
    rnd = random.Random(seed)
    pieces = [LIBRARY.id_to_piece(i).replace("▁", " ") for i in range(259, 32_000)]
    letters = ["ab ", "aeiou nst▁", "日本語中文的 ", "=-* ", "\x00\n\t x", "éèüß ", "😀👍🏽 a", "a", " ", " the", "<s></s>"]
    for k in range(n):
        if k % 2:
            text = "".join(rnd.choice(pieces)[:: rnd.choice((1, 1, -1))] for _ in range(rnd.randint(0, 12)))
            yield text[:6] * rnd.randint(2, 6) if k % 3 == 0 else text
        else:
            some = rnd.choice(letters) + rnd.choice(letters)
            yield "".join(rnd.choice(some) for _ in range(rnd.randint(0, 60)))


def test_encoding_equals_the_library(model):
    texts = list(random_texts(3, 3000))
    for text, ids in zip(texts, encode(model, texts), strict=True):
        assert ids.tolist() == library(text), repr(text)
        assert decode(model, ids) == LIBRARY.decode(ids.tolist())


def test_decoding_any_ids(model):
    rnd = random.Random(5)
    kinds = (lambda: rnd.randint(0, 2), lambda: rnd.randint(3, 258), lambda: rnd.randint(3, 258), lambda: rnd.randint(0, 31_999))
    for _ in range(3000):
        ids = [rnd.choice(kinds)() for _ in range(rnd.randint(0, 8))]
        assert decode(model, np.array(ids, int)) == LIBRARY.decode(ids), ids
    for bad in (-1, 32_000):
        with pytest.raises(ValueError):
            decode(model, np.array([bad]))


def one_at_a_time(model, symbols):
    """The same merges, one after the other."""
    s = list(symbols)
    while len(s) > 1:
        joined = model.pairs(np.array(s[:-1]), np.array(s[1:]))
        ranks = model.ranks(joined)
        at = int(np.argmin(ranks))
        if joined[at] < 0:
            break
        s[at : at + 2] = [int(joined[at])]
    return s


def message(fields):
    """A protocol buffer message of ``(number, value)``."""

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + np.float32(value).tobytes()
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def tiny_model(scored, **changes):
    pieces = [(b"<unk>", 0.0, 2), (b"<s>", 0.0, 3), (b"</s>", 0.0, 3)]
    pieces += [(f"<0x{i:02X}>".encode(), 0.0, 6) for i in range(256)] + [(p.encode(), s, 1) for p, s in scored]
    trainer = {3: 2, 35: 1} | changes.get("trainer", {})
    normalizer = {1: b"identity", 3: 1, 4: 0} | changes.get("normalizer", {})
    fields = [(1, message([(1, p), (2, s), (3, kind)])) for p, s, kind in pieces]
    return message([*fields, (2, message(trainer.items())), (3, message(normalizer.items()))])


def test_odd_orders_of_scores():
    """Random vocabularies, where longer pieces may score above their parts and scores may be equal."""
    rnd = random.Random(7)
    for _ in range(150):
        words = {"".join(rnd.choice("abc") for _ in range(rnd.randint(2, 4))) for _ in range(rnd.randint(3, 12))}
        scored = [(p, float(-rnd.randint(1, 6))) for p in [*"abc", "▁", *sorted(words)]]
        data = tiny_model(scored)
        made, theirs = PieceModel(data), sentencepiece.SentencePieceProcessor(model_proto=data)
        for _ in range(20):
            text = "".join(rnd.choice("abc ") for _ in range(rnd.randint(1, 30)))
            ids = encode(made, [text])[0].tolist()
            assert ids == theirs.encode(text, add_bos=True, add_eos=True), (scored, text)
        symbols = made.symbol[[ord(c) for c in text]]
        flat, sizes = merged(made, symbols, np.array([len(symbols)]))
        assert flat.tolist() == one_at_a_time(made, symbols.tolist()) and sizes.tolist() == [len(flat)]


@pytest.mark.parametrize("changes", [{"trainer": {3: 1}}, {"trainer": {35: 0}}, {"normalizer": {1: b"nmt_nfkc"}}, {"normalizer": {4: 1}}])
def test_other_models_are_refused(changes):
    with pytest.raises(ValueError, match="isn't BPE"):
        PieceModel(tiny_model([("a", -1.0)], **changes))


def test_slices_and_hash_ties(model, monkeypatch):
    text = "A word, another one; 日本語 text\n" * 40 + "x" * 500 + "=" * 300
    expected = library(text)
    monkeypatch.setattr(merge_rounds, "SLICE", 37)
    assert encode(model, [text, "", text])[2].tolist() == expected
    # Words that share a hash aren't taken for each other.
    monkeypatch.setattr(np, "unique", lambda v, **kw: (v[:1], np.array([0]), np.zeros(len(v), int)) if kw.get("return_index") else _unique(v, **kw))
    assert encode(model, [text])[0].tolist() == expected


_unique = np.unique


def test_operator_on_odd_rows(spark, odd):
    rows = [*ROWS, (90, "<s> </s> <0x41> ▁ ▁▁", "en", "a", 1), (91, "\x00 �", "en", "a", 1), (92, "x" * 300_000, "en", "a", 1)]
    got = decode_documents(encode_documents(odd(rows))).collect()
    assert len(got) == len(rows)
    expected = sorted((str(r[0]), np.array(library(r[1]), "<u4").tobytes(), LIBRARY.decode(library(r[1]))) for r in rows)
    assert sorted((str(r["_id"]), bytes(r["ids"]), r["text"]) for r in got) == expected
    assert encode_documents(odd([])).count() == 0
    empty = spark.createDataFrame([(1, None)], "_id int, ids binary")
    assert decode_documents(empty).first()["text"] == ""


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op11_merge_rounds"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = library(text)
        r = got[doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
    assert dict(QUERIES["op11_merge_rounds"](spark, sf).dtypes)["n_tokens"] == "bigint"
