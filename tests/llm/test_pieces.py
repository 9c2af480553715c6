"""Encoding against the library: ids, spans and decoded texts."""

from __future__ import annotations

import hashlib
import itertools
import random
import struct

import numpy as np
import public_tokenizers
import pytest

sentencepiece = pytest.importorskip("sentencepiece")
from sentencepiece import sentencepiece_model_pb2  # noqa: E402

from tests.llm import tables  # noqa: E402
from tidemark.llm import pieces  # noqa: E402
from tidemark.llm.queries import QUERIES  # noqa: E402

PATH = public_tokenizers.path(pieces.MODEL)
ALPHABET = "ab .,\n▁ é中\U0001f600\x00ß\t-_()'\"thein1　ﬁＡ́が①㍿ガ​　\xa0가"
ODD = ["", "  Hi  there\n\tx　ﬁ Ａ é é ▁ <s> <0x41> \x00 \U0001f600 ", " ", "▁", "   ", " ▁ ▁", "a" * 1000, "\n\n\n  \n", "x" + "é" * 5]


def variant(rule: str, trim: bool, dummy: bool, fallback: bool) -> bytes:
    """The model with other ways to normalise."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    spec = proto.normalizer_spec
    if rule != "identity":
        known = sentencepiece_model_pb2.NormalizerSpec()
        known.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec())
        spec.name, spec.precompiled_charsmap = rule, known.precompiled_charsmap
    spec.remove_extra_whitespaces, spec.add_dummy_prefix = trim, dummy
    if not fallback:
        proto.trainer_spec.byte_fallback = False
        for piece in proto.pieces:
            piece.type = 1 if piece.type == pieces.BYTE else piece.type
    return proto.SerializeToString()


def test_normalised_text_like_the_library():
    draw = random.Random(2)
    for rule, trim, dummy in itertools.product(("identity", "nmt_nfkc", "nfkc_cf"), (False, True), (False, True)):
        model = variant(rule, trim, dummy, True)
        own, library = pieces.Encoder(model), sentencepiece.SentencePieceProcessor(model_proto=model)
        for text in [*ODD, *("".join(draw.choices(ALPHABET, k=draw.randint(0, 40))) for _ in range(200))]:
            normal, origin = own.normalise(text)
            assert normal.decode() == library.normalize(text)
            assert len(origin) == len(normal) + 1 and (np.diff(origin) >= 0).all()


@pytest.mark.parametrize("rule,trim,dummy,fallback", [*itertools.product(("identity", "nmt_nfkc"), *[(False, True)] * 3)])
def test_ids_and_spans_like_the_library(rule, trim, dummy, fallback):
    model = variant(rule, trim, dummy, fallback)
    own, library = pieces.Encoder(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    draw = random.Random(3)
    for text in [*ODD, *("".join(draw.choices(ALPHABET, k=draw.randint(0, 60))) for _ in range(300))]:
        ids, spans = own.encode(text)
        assert ids == library.encode(text, add_bos=True, add_eos=True)
        assert spans[1:-1].tolist() == [[p.begin, p.end] for p in library.encode(text, return_type="proto").pieces]
        assert own.decode(ids) == library.decode(ids)


def test_spans_cover_the_text():
    own = pieces.Encoder(variant("nmt_nfkc", False, True, True))
    text = "ﬁne  ①  é́ ㍿ x"
    ids, spans = own.encode(text)
    covered = b"".join(text.encode()[a:b] for a, b in spans.tolist())
    assert covered.decode() == text and len(ids) == len(spans)


def test_models_that_are_not_known_are_refused():
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(variant("identity", False, True, True))
    proto.pieces[400].type = pieces.USER_DEFINED
    with pytest.raises(ValueError, match="user-defined"):
        pieces.Encoder(proto.SerializeToString())


def digest_row(library, text: str | None) -> tuple:
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_query_like_the_library(spark, tmp_path):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    odd = tables.write_tables(spark, str(tmp_path), tables.frame(spark, tables.odd_rows()))
    for folder in (odd, "/root/testdata/sf0.01"):
        rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
        found = QUERIES["op12_sentencepiece"](spark, folder).collect()
        names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
        assert sorted((tuple(r[n] for n in names) for r in found), key=str) == sorted(
            ((r["doc_id"], *digest_row(library, r["text"])) for r in rows), key=str
        )


def test_general_operator_gives_ids_spans_and_texts(spark):
    df = spark.createDataFrame([(1, "née  x", "mine"), (2, None, "mine")], "id int, t string, spans string")
    found = {r["id"]: r for r in pieces.encoded(df, "t", PATH, ("id", "spans")).collect()}
    spans = np.frombuffer(found[1]["spans"], "<u4").reshape(-1, 2).tolist()
    text = "née  x".encode()
    assert b"".join(text[a:b] for a, b in spans) == text and found[1]["decoded"] == "née  x"
    assert found[2]["ids"] == struct.pack("<2I", 1, 2) and found[2]["decoded"] == ""
