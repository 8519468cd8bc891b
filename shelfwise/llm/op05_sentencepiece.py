"""SentencePiece encoding and decoding over a table of distinct chunks.

A BPE merge needs a piece that spans both sides. If no piece of the model
holds a whitespace marker after another character, and none holds a line
break, a text can be cut before every marker run and around line breaks without
changing its segmentation. Texts are cut into such marked chunks, every
distinct chunk is segmented once by the sentencepiece library, and the ids
are joined back by position; decoding joins the chunks' decoded bytes.

The table of distinct chunks belongs to a task (chunk -> ids, decoded bytes):
an exploded (document, position, chunk) join over the whole corpus would
shuffle many times the input, while a task's table serves all its documents
and needs no shuffle. It holds at most TABLE_CHUNKS entries and is then begun
anew; a chunk met again is only segmented again, so results never change.

Defined cases: a null text is an empty one; an empty text is the begin and end
ids alone and decodes to an empty text; very long texts are cut at chunk
borders into pieces of about PIECE_CHARS, so memory stays bounded; repeated
rows give repeated results; an empty table gives no rows; the input columns
named in ``keep`` come back, others (whatever their names) are ignored.
Models whose pieces do cross markers are refused.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import python_tasks, table

MARK = "▁"  # a space and the library's own marker are one to it
TABLE_CHUNKS = 250_000
PIECE_CHARS = 1 << 20
CHUNK = re.compile(f"[ {MARK}]*[^ {MARK}\n]+|[ {MARK}]+|\n")
BORDER = re.compile(f"[^ {MARK}][ {MARK}]")
OUTPUTS = {"ids": T.ArrayType(T.IntegerType()), "n_tokens": T.LongType(), "ids_sha256": T.StringType(),
           "decoded": T.StringType(), "decoded_sha256": T.StringType()}


class ChunkTable:
    """Distinct chunks and their segmentation."""

    def __init__(self, proto: bytes):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        if any("\n" in p or re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("pieces of this model cross whitespace markers or line breaks")
        self.fence = self.sp.encode("\n")[-1]
        self.begin, self.end = (np.array([x], "<u4").tobytes() for x in (self.sp.bos_id(), self.sp.eos_id()))
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, bytes] = {"\n": np.array([self.fence], "<u4").tobytes()}
        self.text: dict[str, bytes] = {"\n": b"\n"}

    def add(self, new: list[str]) -> None:
        """Segment chunks, none of which holds a line break, fenced off from each other by line breaks."""
        ids = self.sp.encode("\n" + "\n".join(new), num_threads=1)
        found = np.array(ids, "<u4")
        at = np.flatnonzero(found == self.fence)
        raw, starts, ends = found.tobytes(), ((at + 1) * 4).tolist(), (np.append(at[1:], len(found)) * 4).tolist()
        self.ids.update(zip(new, (raw[a:b] for a, b in zip(starts, ends, strict=True)), strict=True))
        self.text.update(zip(new, self.sp.decode(ids).encode().split(b"\n")[1:], strict=True))

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """Ids of a text as little-endian 32-bit integers, and the decoded text."""
        if not text:
            return self.begin + self.end, b""
        marked = " " + text  # the library puts a marker before any text, and takes one off again
        ids, out = [self.begin], []
        for a, b in cuts(marked):
            chunks = CHUNK.findall(marked, a, b)
            distinct = set(chunks)
            new = distinct.difference(self.ids)
            if len(self.ids) + len(new) > TABLE_CHUNKS:
                self.clear()
                new = distinct.difference(self.ids)
            if new:
                self.add(list(new))
            ids += map(self.ids.__getitem__, chunks)
            out += map(self.text.__getitem__, chunks)
        return b"".join([*ids, self.end]), b"".join(out)[1:]


def cuts(marked: str) -> Iterator[tuple[int, int]]:
    """Pieces of about PIECE_CHARS that begin at a chunk's border: a marker after another character."""
    a = 0
    while a < len(marked):
        border = BORDER.search(marked, a + PIECE_CHARS)
        b = border.start() + 1 if border else len(marked)
        yield a, b
        a = b


def encode(docs: DataFrame, model: str, outputs: tuple[str, ...] = ("ids", "n_tokens"), text: str = "text",
           keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the chosen OUTPUTS of every row. ``model``: path of a model file on the driver."""
    spark = docs.sparkSession
    python_tasks(spark, 1000)
    with open(model, "rb") as f:
        proto = spark.sparkContext.broadcast(f.read())  # a model file, of fixed size
    fields = [docs.schema[k] for k in keep] + [T.StructField(o, OUTPUTS[o]) for o in outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = ChunkTable(proto.value)
        for batch in batches:
            got: dict[str, list] = {o: [] for o in outputs}
            for value in batch.column(len(keep)):
                ids, decoded = chunks.encode(value.as_py() or "")
                for o in outputs:
                    got[o].append(np.frombuffer(ids, "<u4").astype("int32") if o == "ids" else len(ids) // 4
                                  if o == "n_tokens" else hashlib.sha256(ids).hexdigest() if o == "ids_sha256" else
                                  decoded.decode() if o == "decoded" else hashlib.sha256(decoded).hexdigest())
            kinds = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64()}
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + [pa.array(got[o], kinds.get(o, pa.string())) for o in outputs],
                names=[*keep, *outputs])
    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, T.StructType(fields))


def decode(encoded: DataFrame, model: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``decoded``, from a column ``ids``; null ids decode to an empty text."""
    spark = encoded.sparkSession
    python_tasks(spark, 1000)
    with open(model, "rb") as f:
        proto = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto.value)
        for batch in batches:
            texts = [sp.decode(v.as_py() or []) for v in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(texts, pa.string())],
                                             names=[*keep, "decoded"])
    fields = [encoded.schema[k] for k in keep] + [T.StructField("decoded", T.StringType())]
    return encoded.select(*keep, "ids").mapInArrow(run, T.StructType(fields))


def digests(docs: DataFrame) -> DataFrame:
    import public_tokenizers
    return encode(docs, public_tokenizers.path("piece_bpe_32k.model"), ("n_tokens", "ids_sha256", "decoded_sha256"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
