"""Pieces, spans and decoding against the sentencepiece library, whole and with its character maps."""

import hashlib
import random

import numpy as np
import pytest

from starmart.llm import pieces, queries

public = pytest.importorskip("public_tokenizers")
library = pytest.importorskip("sentencepiece")
PATH = public.path("piece_bpe_32k.model")

ODD = [
    "", " ", "a", "  x", " a b ", "\n\n a\tb", "▁▁a b▁", "▁", "é" * 10, "日本語テキスト 中文", "😀😀 a😀", "\0a\0", "a" * 500, " " * 300 + "x", "=-" * 200, "ab" * 100 + " " + "0123456789" * 20,
    "<s> </s> <unk> <0x0A>", "\xa0x　y", "ﬁ ﬂ ½ Ａ①", "ȩ́ ẛ̣", "﻿a", "x\r\ny", "  ".join(["q"] * 50), "한국어 한", "​z­", "㍿ ｶﾞ",
]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab 出é😀▁\n\t0.-=<>½ﬁ　́") for _ in range(rng.randint(0, 120))) for _ in range(n)]


def length(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def with_normaliser(raw, name, **flags):
    """The model with the library's normaliser ``name`` in place of its own, and its field values changed."""
    theirs = dict(pieces.fields(library.SentencePieceNormalizer(rule_name=name).serialized_model_proto()))[pieces.NORMALIZER]
    spec = dict(pieces.fields(theirs)) | {getattr(pieces, k): v for k, v in flags.items()}
    body = b"".join(length(f << 3 | 2) + length(len(v)) + v if isinstance(v, bytes) else length(f << 3) + length(v) for f, v in spec.items())
    out = b""
    for field, value in pieces.fields(raw):
        value = body if field == pieces.NORMALIZER else value
        out += length(field << 3 | 2) + length(len(value)) + value
    return out


def compare(model, texts):
    sp = library.SentencePieceProcessor(model_proto=model)
    ours = pieces.Model(model)
    for part in ([t] for t in texts), [texts], [texts[::-1], []]:
        for group in part:
            counts, ids, starts, ends = ours.encode(group)
            decoded = ours.decode_many(ids, counts)
            assert len(counts) == len(group) and counts.sum() == len(ids) == len(starts) == len(ends)
            for k, (t, n, last) in enumerate(zip(group, counts, counts.cumsum(), strict=True)):
                proto = sp.encode(t, return_type="proto")
                assert ids[last - n : last].tolist() == [p.id for p in proto.pieces], repr(t)
                assert list(zip(starts[last - n : last].tolist(), ends[last - n : last].tolist(), strict=True)) == [(p.begin, p.end) for p in proto.pieces], repr(t)
                assert decoded[k].decode() == ours.decode(ids[last - n : last].tolist()).decode() == sp.decode(ids[last - n : last].tolist())


def raw_model():
    with open(PATH, "rb") as f:
        return f.read()


def test_pieces_and_spans_equal_the_library():
    compare(raw_model(), ODD + random_texts(300, 1))


@pytest.mark.parametrize("name", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("prefix", [0, 1])
@pytest.mark.parametrize("fewer", [0, 1])
def test_character_maps_equal_the_library(name, prefix, fewer):
    compare(with_normaliser(raw_model(), name, DUMMY_PREFIX=prefix, FEWER_SPACES=fewer, ESCAPE_SPACES=1), ODD + random_texts(60, 2))


def test_table_of_parts_starts_anew(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_PARTS", 20)
    monkeypatch.setattr(pieces, "KEPT_CHARS", 3)
    monkeypatch.setattr(pieces, "HEAP_CHARS", 2)
    compare(raw_model(), ODD + random_texts(60, 3))


def test_decoding_any_ids():
    sp, ours, rng = library.SentencePieceProcessor(model_file=PATH), pieces.Model(raw_model()), random.Random(4)
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(100, 258), 259, rng.randint(259, 31999)]) for _ in range(rng.randint(0, 8))]
        assert ours.decode(ids).decode() == ours.decode_many(np.array(ids, np.int64), np.array([len(ids)]))[0].decode() == sp.decode(ids)


def test_other_models_are_refused():
    raw = raw_model()
    fields = [(f, v) for f, v in pieces.fields(raw) if f != pieces.TRAINER]
    with pytest.raises(ValueError):
        pieces.Model(b"".join(length(f << 3 | 2) + length(len(v)) + v for f, v in fields))


def test_odd_rows_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(pieces, "SLICE_CHARS", 100)
    monkeypatch.setattr(pieces, "SLICE_IDS", 50)
    texts = [None, *ODD, "w é " * 30000, *ODD[2:4]]
    df = spark.createDataFrame([(i if i % 4 else None, t, "mine", [5]) for i, t in enumerate(texts)], "doc_id long, text string, pieces string, ids array<int>")
    sp = library.SentencePieceProcessor(model_file=PATH)
    found = pieces.encode(df, PATH)
    got = pieces.decode(found.select("*", found["pieces_.ids"].alias("back")), PATH, "back").collect()
    assert len(got) == len(texts) and all(r["pieces"] == "mine" and r["ids"] == [5] for r in got)
    for r in got:
        raw = (r["text"] or "").encode()
        want = sp.encode(r["text"] or "")
        assert r["pieces_"]["ids"] == want and r["decoded"] == sp.decode(want)
        assert b"".join(raw[a:b] for a, b in zip(r["pieces_"]["starts"], r["pieces_"]["ends"], strict=True)) == raw
    assert pieces.encode(df.limit(0), PATH).collect() == []
    assert [r["decoded"] for r in pieces.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), PATH).collect()] == [None, ""]


def test_query_equals_the_library(spark, sf):
    sp = library.SentencePieceProcessor(model_file=PATH)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for doc, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = sp.encode(text or "")
        want.append((doc, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)), len((text or "").encode())))
    assert sorted(tuple(r) for r in queries.op12_sentence_pieces(spark, sf).collect()) == sorted(want)
