"""SentencePiece encoding that knows where in the text every piece comes from.

A text is normalised here: at every place the longest key of the model's compiled character
map that matches is replaced, spaces become U+2581, and for each byte of the result the byte
of the text it stems from is recorded.  The library finds the pieces of the normalised text,
and their ends are carried back through that record to byte spans of the text.

Odd input: a null text is an empty one and gives the begin and end ids alone; a text of any
length is encoded whole; repeated rows are encoded alike; an empty table gives no rows.  A
column of the caller that is kept gives way to a new one of its name.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField

from tidemark.llm.batches import annotate

MODEL = "piece_bpe_32k.model"
_SPACE = "▁".encode()
# Largest model sent to all executors.
MAX_MODEL_BYTES = 64 << 20

# Kinds of pieces in a model file.
USER_DEFINED, BYTE = 4, 6


def public_model() -> str:
    """Path of the public model the query uses."""
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class CharacterMap:
    """The compiled map of a model: a double-array trie over UTF-8 and the replacements.

    The map is the length of the trie in bytes, the trie as 32-bit units, and the
    replacements, each ended by a zero byte.
    """

    def __init__(self, compiled: bytes):
        self.units = np.zeros(0, dtype=np.uint32)
        self.replacements = b""
        if compiled:
            size = int(np.frombuffer(compiled[:4], dtype="<u4")[0])
            self.units = np.frombuffer(compiled[4 : 4 + size], dtype="<u4")
            self.replacements = compiled[4 + size :]

    def longest(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places where a key starts, the length of the longest one and its replacement's offset.

        All places walk the trie together, one byte a round; most leave it in the first.
        """
        found_length = np.zeros(len(data), dtype=np.int64)
        found_value = np.zeros(len(data), dtype=np.int64)
        if len(self.units):
            at = np.arange(len(data))
            node = np.full(len(data), self._child(self.units[:1])[0], dtype=np.int64)
            depth = 0
            while len(at):
                byte = data[at + depth].astype(np.int64)
                node = node ^ byte
                inside = node < len(self.units)
                unit = self.units[np.where(inside, node, 0)]
                # the label has its top bit set in units that hold a value
                fits = inside & ((unit & np.uint32(0x800000FF)) == byte)
                at, node, unit = at[fits], node[fits] ^ self._child(unit[fits]), unit[fits]
                depth += 1
                ends = ((unit >> np.uint32(8)) & np.uint32(1)) == 1
                found_length[at[ends]] = depth
                found_value[at[ends]] = self.units[node[ends]] & np.uint32(0x7FFFFFFF)
                more = at + depth < len(data)
                at, node = at[more], node[more]
        places = np.flatnonzero(found_length)
        return places, found_length[places], found_value[places]

    @staticmethod
    def _child(unit: np.ndarray) -> np.ndarray:
        unit = unit.astype(np.int64)
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def replacement(self, offset: int) -> bytes:
        return self.replacements[offset : self.replacements.index(b"\0", offset)]

    def apply(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The mapped bytes, and for each the byte it stems from; one more entry for the end."""
        places, lengths, values = self.longest(data)
        origin = np.arange(len(data) + 1)
        if not len(places):
            return data, origin
        parts, origins, done = [], [], 0
        for place, length, value in zip(places.tolist(), lengths.tolist(), values.tolist()):
            if place < done:  # inside a longer key
                continue
            new = np.frombuffer(self.replacement(value), dtype=np.uint8)
            parts += [data[done:place], new]
            origins += [origin[done:place], np.full(len(new), place)]
            done = place + length
        parts.append(data[done:])
        origins.append(origin[done:])
        return np.concatenate(parts), np.concatenate(origins)


class Encoder:
    """A model read from its file: normalisation here, merging and decoding by the library.

    The library gets text that is normalised already, with a copy of the model that leaves
    it as it is, so that every byte of every piece has a place in the record of origins.
    """

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        kinds = np.array([p.type for p in proto.pieces])
        if (kinds == USER_DEFINED).any():
            raise ValueError("models with user-defined pieces are not known")
        if proto.trainer_spec.treat_whitespace_as_suffix or not spec.escape_whitespaces:
            raise ValueError("only models that write a space before its word are known")
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy_prefix = spec.add_dummy_prefix
        self.trim = spec.remove_extra_whitespaces
        self.own = SentencePieceProcessor(model_proto=model)
        self.edges = [[k] if k >= 0 else [] for k in (self.own.bos_id(), self.own.eos_id())]
        spec.name, spec.precompiled_charsmap = "identity", b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.merger = SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.is_byte = kinds == BYTE
        self.size = np.where(self.is_byte, 1, [len(p.piece.encode()) for p in proto.pieces])
        self.unknown = proto.trainer_spec.unk_id

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised text as UTF-8 and, for each of its bytes and its end, a byte of the text."""
        data, origin = self.map.apply(np.frombuffer(text.encode(), dtype=np.uint8))
        blank = data == 0x20
        if self.trim:
            # of a run of spaces the first stays; none at either end
            keep = ~blank
            keep[1:] |= ~blank[:-1]
            solid = np.flatnonzero(~blank)
            if not len(solid):
                return b"", origin[-1:]
            keep[: solid[0]] = keep[solid[-1] + 1 :] = False
            data, blank, origin = data[keep], blank[keep], np.append(origin[:-1][keep], origin[solid[-1] + 1])
        if not len(data):
            return b"", origin[-1:]
        if self.dummy_prefix:
            data, blank, origin = np.insert(data, 0, 0x20), np.insert(blank, 0, True), np.insert(origin, 0, origin[0])
        size = np.where(blank, len(_SPACE), 1)
        out = np.repeat(data, size)
        at = (np.cumsum(size) - size)[blank]
        for k, byte in enumerate(_SPACE):
            out[at + k] = byte
        normal, origin = out.tobytes(), np.append(np.repeat(origin[:-1], size), origin[-1])
        while self.trim and normal.endswith(_SPACE):  # U+2581 of the text itself
            normal, origin = normal[: -len(_SPACE)], origin[: -len(_SPACE)]
        return normal, origin

    def encode(self, text: str) -> tuple[list[int], np.ndarray]:
        """Ids with begin and end, and for each the pair of byte offsets it covers in the text."""
        normal, origin = self.normalise(text)
        ids = self.merger.encode(normal.decode()) if normal else []
        end = len(text.encode())
        spans = np.concatenate([[[0, 0]] * len(self.edges[0]), self._spans(ids, normal, origin), [[end, end]] * len(self.edges[1])])
        return [*self.edges[0], *ids, *self.edges[1]], spans

    def _spans(self, ids: list[int], normal: bytes, origin: np.ndarray) -> np.ndarray:
        if not ids:
            return np.zeros((0, 2), dtype=np.int64)
        coded = np.array(ids)
        if (coded == self.unknown).any():  # as long as the characters unknown there
            found = self.merger.encode(normal.decode(), return_type="proto").pieces
            size = np.array([len(p.surface.encode()) for p in found])
        else:
            size = self.size[coded]
        ends = np.cumsum(size)
        starts = ends - size
        if self.is_byte[coded].any():
            # of the bytes of a character the last covers it, the others nothing
            data = np.frombuffer(normal + b" ", dtype=np.uint8)
            opens = (data & 0xC0) != 0x80
            first = np.maximum.accumulate(np.where(opens, np.arange(len(data)), 0))
            byte = self.is_byte[coded]
            starts = np.where(byte, first[starts], starts)
            ends = np.where(byte & ~opens[ends], starts, ends)
        return np.column_stack([origin[starts], origin[ends]])

    def decode(self, ids: list[int]) -> str:
        return self.own.decode(ids)


@functools.lru_cache(maxsize=2)
def _encoder(model: bytes) -> Encoder:
    return Encoder(model)


def _packed(numbers) -> bytes:
    return np.asarray(numbers).astype("<u4").tobytes()


FIELDS = [
    StructField("ids", BinaryType()),
    StructField("spans", BinaryType()),
    StructField("decoded", StringType()),
]


def encoded(df: DataFrame, text: str, model_path: str, keep: Sequence[str]) -> DataFrame:
    """The ``keep`` columns of every row with packed ``ids`` and ``spans`` and the ``decoded`` text.

    The model is read from ``model_path`` on the driver and sent to the executors; its size
    is checked.  Numbers are packed as little-endian unsigned 32-bit.  ``spans`` has a pair of
    byte offsets into the text for every id: begin and end ids have empty ones, and so have
    all but the last byte of a character that is written as bytes.
    """
    with open(model_path, "rb") as file:
        model = file.read(MAX_MODEL_BYTES + 1)
    if len(model) > MAX_MODEL_BYTES:
        raise ValueError(f"a model of more than {MAX_MODEL_BYTES} bytes")
    _encoder(model)  # an unknown kind of model fails here
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[pa.Array], Sequence[pa.Array]]:
        encoder = _encoder(sent.value)

        def work(column: pa.Array) -> Sequence[pa.Array]:
            rows = []
            for text in column:
                ids, spans = encoder.encode(text.as_py() or "")
                rows.append((_packed(ids), _packed(spans), encoder.decode(ids)))
            types = (pa.binary(), pa.binary(), pa.string())
            return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(types)]

        return work

    return annotate(df, text, make, FIELDS, keep)


def digests(df: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256) of every document."""
    found = encoded(df, "text", model_path, ("doc_id",))
    return found.select(
        "doc_id",
        F.expr("octet_length(ids) DIV 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2("spans", 256).alias("spans_sha256"),
    )
