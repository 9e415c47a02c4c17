import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as pb

from hourlake.llm import bpe, queries
from hourlake.llm.bpe import BITS, merge, merge_all, pair_arrays, pair_value
from hourlake.llm.sentencepiece_codec import CharacterMap, SentencePieceCodec, decode_documents, encode_documents, round_trip
from hourlake.llm.token_counts import TokenCounter, count_tokens

MODEL, VOCABULARY = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
CODEC, LIBRARY = SentencePieceCodec(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
COUNTER, COUNTED = TokenCounter(VOCABULARY), tokenizers.Tokenizer.from_file(VOCABULARY)
ODD = ["", " ", "  ", "a", " a", "a ", "▁", "▁▁a", "<s>", "<0x41>", "a<|endoftext|> b", "\n\n x", "don't 12's", "日本\U0001f600", "\x00\x1c\x85", "ab" * 5000, "日" * 3000, " " * 300, "é" * 99]
texts = st.text(st.sampled_from("ab cde  f\n\t\r0123.,'s▁ \xa0　é日本\U0001f600²Ⅷ\x1c\x85\x00"), max_size=40)


def unpacked(data):
    return np.frombuffer(data, "<u4").tolist()


def check_codec(text):
    ids, ends = map(unpacked, CODEC.encode(text))
    assert ids == LIBRARY.encode(text, add_bos=True, add_eos=True)
    assert CODEC.decode(struct.pack(f"<{len(ids)}I", *ids)) == LIBRARY.decode(ids)
    assert len(ends) == len(ids) and ends == sorted(ends)
    inner = [0, *ends[1:-1]]
    spans = [text.encode()[a:b].decode() for a, b in zip(inner, inner[1:], strict=False)]
    assert spans == [p.surface for p in LIBRARY.encode(text, return_type="proto").pieces]


@settings(max_examples=300, deadline=None)
@given(texts)
def test_codec_as_the_library(text):
    check_codec(text)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    check_codec(text)
    assert COUNTER.count(text) == len(COUNTED.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_counts_as_the_library(text):
    assert COUNTER.count(text) == len(COUNTED.encode(text, add_special_tokens=False).ids)


def test_any_ids_decode_as_the_library():
    rnd = random.Random(2)
    for _ in range(3000):
        ids = [rnd.randrange(32000) if rnd.random() < 0.6 else rnd.randrange(259) for _ in range(rnd.randint(0, 12))]
        assert CODEC.decode(struct.pack(f"<{len(ids)}I", *ids)) == LIBRARY.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_character_maps(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
    proto = pb.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    codec = SentencePieceCodec(MODEL)
    codec.map, codec.trim = CharacterMap(proto.normalizer_spec.precompiled_charsmap), True
    for text in [*ODD, "ﬁ①Ａｶﾞ…㍿ x", "  Å  É ", "ＡＢＣ　ｄ"]:
        normal, starts = codec.normalise(text)
        assert normal == library.normalize(text)
        assert len(starts) == len(normal) + 1 and starts == sorted(starts)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_spans_through_a_character_map(rule, tmp_path):
    """With a model whose map is not empty, pieces and the source bytes that each stands for are the library's."""
    proto, other = pb.ModelProto(), pb.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    other.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True).serialized_model_proto())
    proto.normalizer_spec.CopyFrom(other.normalizer_spec)
    path = tmp_path / "mapped.model"
    path.write_bytes(proto.SerializeToString())
    codec, library = SentencePieceCodec(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
    assert codec.map.units
    rnd = random.Random(4)
    letters = ["a", "b", "ab", "é", "É", "e\u0301", "ﬁ", "①", "Ａ", "ｶﾞ", "…", "㍿", "日本", "\U0001f600", "²", "Ⅷ", "ß", "İ", "x1", "."]
    for _ in range(2000):
        text = " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 6))) for _ in range(rnd.randint(1, 5)))
        ids, ends = map(unpacked, codec.encode(text))
        pieces = library.encode(text, return_type="proto").pieces
        assert ids[1:-1] == [p.id for p in pieces]
        inner = [0, *ends[1:-1]]
        spans = [text.encode()[a:b] for a, b in zip(inner, inner[1:], strict=False)]
        assert b"".join(spans) == text.encode() and spans == [p.surface.encode() for p in pieces]
    for text in ["  a  b ", "a   ﬁ  ", " ", "ｶﾞ \u3000 ①"]:
        assert unpacked(codec.encode(text)[0])[1:-1] == library.encode(text)


def test_merge_takes_lowest_rank_leftmost():
    a, b, ab, aba = 1, 2, 3, 4
    table = {a << BITS | b: pair_value(0, ab), ab << BITS | a: pair_value(1, aba)}
    assert merge([a, b, a, b, a], table) == ([ab, -1, aba, -1, -1], 3)
    assert merge([], table) == ([], 0) and merge([b], table) == ([b], 0)


def test_many_sequences_merge_as_each_alone():
    """Ranks in any order and shared by pairs, so that a merge may make a pair that goes first."""
    rnd = random.Random(5)
    none = (1 << BITS) - 1
    for _ in range(300):
        pairs = [(rnd.randint(1, 9), rnd.randint(1, 9)) for _ in range(25)]
        table = {a << BITS | b: pair_value(rnd.randrange(8), rnd.randint(1, 9)) for a, b in pairs}
        rows = [[rnd.randint(1, 9) if rnd.random() < 0.7 else 1 for _ in range(rnd.randint(1, 14))] for _ in range(40)]
        symbols = np.array([none] + [s for row in rows for s in [*row, none]], np.int64)
        owner = np.array([-1] + [k for k, row in enumerate(rows) for k in [k] * len(row) + [-1]])
        merged = merge_all(symbols, owner, pair_arrays(table)).tolist()
        assert merged == [none] + [s for row in rows for s in [*merge(row, table)[0], none]]


def made_up(rnd, n):
    syllables = "th he in er an re on ti é ç qu ent eau sch ung ß ü ▁ 日本 \U0001f600 ² 3 . , !".split()
    return ["".join(rnd.choice(syllables) for _ in range(rnd.randint(2, 6))) for _ in range(n)]


def test_new_words_of_many_texts_are_merged_together(monkeypatch):
    """Words that no text had before cost one heap of ranks for all texts, not a heap each."""
    codec, rnd, popped, pop = SentencePieceCodec(MODEL), random.Random(6), [], bpe.heappop
    words = made_up(rnd, 20_000)
    texts = [" ".join(words[k : k + 40]) for k in range(0, len(words), 40)]
    monkeypatch.setattr(bpe, "heappop", lambda heap: popped.append(1) or pop(heap))
    coded = list(codec.encode_all(texts)) if hasattr(codec, "encode_all") else [codec.encode(t) for t in texts]
    assert [unpacked(ids) for ids, _ in coded] == LIBRARY.encode(texts, add_bos=True, add_eos=True)
    assert 0 < len(popped) < len(set(words))


def test_full_tables_of_units():
    """Units that a full table drops are learned again; texts that are under way keep theirs."""
    codec, rnd = SentencePieceCodec(MODEL), random.Random(7)
    codec.unit_pieces.most = 200
    for _ in range(12):
        texts = [" ".join([*made_up(rnd, 30), "the", "of", "x" * 70]) for _ in range(5)]
        under_way = codec.encode_all(texts)
        coded = [next(under_way)]
        assert unpacked(codec.encode("the other one")[0]) == LIBRARY.encode("the other one", add_bos=True, add_eos=True)
        coded += under_way
        assert [unpacked(ids) for ids, _ in coded] == LIBRARY.encode(texts, add_bos=True, add_eos=True)
        for text, (_, ends) in zip(texts, coded, strict=True):
            assert unpacked(ends) == unpacked(CODEC.encode(text)[1])
    assert len(codec.unit_pieces) < 1000 and "▁the" in codec.unit_pieces
    with pytest.raises(UnicodeEncodeError):
        codec.encode("the \ud800")
    assert unpacked(codec.encode("the other one")[0]) == LIBRARY.encode("the other one", add_bos=True, add_eos=True)


def test_frames(spark):
    rows = [(1, "a b", None, "x"), (2, None, "y", None), (None, "", "", "z"), (1, "a b", None, "x"), (3, "w " * 30000, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pieces string, n_tokens string")
    out = {r["doc_id"]: r for r in decode_documents(encode_documents(df, MODEL).select("doc_id", "pieces.ids"), MODEL, "ids").collect()}
    assert out[1]["decoded"] == "a b" and unpacked(out[2]["ids"]) == [1, 2] and out[2]["decoded"] == "" and out[3]["decoded"] == "w " * 30000
    assert round_trip(df, MODEL).count() == 5
    counted = count_tokens(df, VOCABULARY).collect()
    assert sorted(r["n_tokens"] for r in counted)[:2] == [0, 0] and len(counted) == 5
    assert count_tokens(df.limit(0), VOCABULARY).count() == 0 and encode_documents(df.limit(0), MODEL).count() == 0


def test_queries_as_the_libraries(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for row in queries.QUERIES["op1_sentencepiece"](spark, sf).collect():
        ids = LIBRARY.encode(docs[row["doc_id"]], add_bos=True, add_eos=True)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
    for row in queries.QUERIES["op10_token_counts"](spark, sf).collect():
        n = len(COUNTED.encode(docs[row["doc_id"]], add_special_tokens=False).ids)
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(docs[row["doc_id"]].encode()), n, n > 1024)
