"""Token counts of a piece vocabulary, by whole-token lookup.

The vocabulary's pieces hold the space sign only at their front and its normaliser
changes nothing but spaces, both checked when the table is made. So no merge
crosses the front of a run of spaces, and a text's count is the sum over its
segments (spaces and what follows up to the next space). Which pieces encode alone
as one token is proved beforehand by encoding each of them; such segments are
counted by lookup. Only the rest is merged, once per distinct segment of a task.

Null and empty texts have no tokens. Texts of any length are counted whole;
repeated rows are counted each; other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE = "▁"
MAX_TOKENS = 4096
# Bytes of segments that one task remembers, about; beyond, it starts anew.
REMEMBERED = 1 << 26
ROWS_AT_ONCE = 256


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def whole_tokens(model: bytes) -> frozenset[str]:
    """Segments without their first space that the library gives one token; ValueError if segments could merge."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as spec

    proto = spec.ModelProto()
    proto.ParseFromString(model)
    rules, trained = proto.normalizer_spec, proto.trainer_spec
    if (
        rules.precompiled_charsmap
        or rules.remove_extra_whitespaces
        or not (rules.add_dummy_prefix and rules.escape_whitespaces)
        or trained.treat_whitespace_as_suffix
    ):
        raise ValueError("the model's normaliser does more than mark spaces")
    normal = [p.piece for p in proto.pieces if p.type == spec.ModelProto.SentencePiece.NORMAL]
    if any(SPACE in p.lstrip(SPACE) for p in normal):
        raise ValueError("a piece spans a space, so segments are not independent")
    if any(p.type == spec.ModelProto.SentencePiece.USER_DEFINED for p in proto.pieces):
        raise ValueError("user-defined pieces are matched before merging")
    library = SentencePieceProcessor(model_proto=model)
    fronted = [p[1:].replace(SPACE, " ") for p in normal if p.startswith(SPACE) and len(p) > 1]
    return frozenset(s for s, ids in zip(fronted, library.encode(fronted, num_threads=1), strict=True) if len(ids) == 1)


class Counts(dict):
    """Tokens of a segment without its first space. Misses are merged and remembered."""

    def __init__(self, model: bytes, whole: frozenset[str]):
        from sentencepiece import SentencePieceProcessor

        super().__init__()
        self.library = SentencePieceProcessor(model_proto=model)
        self.whole, self.size = whole, 0
        self.restart()

    def restart(self) -> None:
        self.clear()
        self.update(dict.fromkeys(self.whole, 1))
        self.size = 0

    def __missing__(self, segment: str) -> int:
        if not segment:
            return 1  # a lone space
        self.pending.append(segment)
        return 0

    def of(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text. Unknown segments of the texts are merged together."""
        self.pending = []
        counts, upto = [], []
        for text in texts:
            # The library puts a space in front of a text, so every segment has its first one.
            segments = text.replace(SPACE, " ").split(" ") if text else []
            if "" in segments:
                segments = _joined(segments)
            counts.append(sum(map(self.__getitem__, segments)))
            upto.append(len(self.pending))
        if self.pending:
            pending, new = self.pending, list(dict.fromkeys(self.pending))
            self.update(zip(new, map(len, self.library.encode(new, num_threads=1)), strict=True))
            start = 0
            for i, stop in enumerate(upto):
                counts[i] += sum(map(self.__getitem__, pending[start:stop]))
                start = stop
            self.size += sum(map(len, new)) + 64 * len(new)
            if self.size > REMEMBERED:
                self.restart()
        return counts


def _joined(parts: list[str]) -> list[str]:
    """Further spaces of a run belong to the segment that follows, those at the end to one of their own."""
    out, spaces = [], 0
    for p in parts[:-1]:
        if p:
            out.append(" " * spaces + p)
            spaces = 0
        else:
            spaces += 1
    # What is left may be spaces only: their first one is the segment's front.
    return [*out, " " * spaces + parts[-1]]


def count_tokens(docs: DataFrame, model: bytes, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, n_bytes (UTF-8) and n_tokens."""
    kind = docs.schema[doc].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((model, whole_tokens(model)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(*shared.value)
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(k, ROWS_AT_ONCE)
                n = pa.array(counts.of(part.column(1).to_pylist()), pa.int64())
                yield pa.record_batch([part.column(0), part.column(2), n], [doc, "n_bytes", "n_tokens"])

    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    return docs.select(F.col(doc), F.col(text).alias("_text"), n_bytes.alias("_bytes")).mapInArrow(
        scan, f"`{doc}` {kind}, n_bytes bigint, n_tokens bigint"
    )
