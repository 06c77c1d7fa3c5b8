"""Token ids in bit-plane blocks: fixed-size blocks, transposed, each plane compressed, indexed.

A stored table has one row per block: its place (``part``, ``block``, ``first`` id within the
part, ``n`` ids), a self-contained ``payload``, and ``docs``, the pieces of documents in it.
Parts follow each other in document order. The small columns are the chunk index: a reader
that wants some ids fetches the payload of their blocks only, since Parquet reads columns apart.
"""

from __future__ import annotations

import json
import os
import string
import struct
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverloom.llm.common import ship_code, table
from silverloom.session import scratch_path

BLOCK = 65_536
END_ID = 1
_HEAD = struct.Struct("<4sBBI")  # magic, bits per plane, planes, ids
_MAGIC = b"BPL1"
#: Chunks of text kept with their ids in each Python worker; emptied when full.
_CACHE = 400_000
_LONGEST_CHUNK = 64

_BLOCK_SCHEMA = (
    "part int, block long, first long, n int, payload binary, "
    "docs array<struct<seq: long, doc_id: long, at: int, skip: long, n: int, doc_n: long>>"
)


def pack_block(ids: np.ndarray, bits: int = 8, level: int = 3) -> bytes:
    """Transpose unsigned 32-bit ids into planes of 8 bits (bytes) or 1 bit and compress each."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits == 8:
        planes = octets.T
    elif bits == 1:
        planes = np.packbits(np.unpackbits(octets, axis=1, bitorder="little").T, axis=1)
    else:
        raise ValueError("planes have 8 bits or 1")
    zip_ = zstandard.ZstdCompressor(level=level)
    packed = [zip_.compress(p.tobytes()) for p in planes]
    sizes = struct.pack(f"<{len(packed)}I", *map(len, packed))
    return _HEAD.pack(_MAGIC, bits, len(packed), len(ids)) + sizes + b"".join(packed)


def unpack_block(payload: bytes) -> np.ndarray:
    """The ids of one block; raises ValueError for bytes that are none."""
    if len(payload) < _HEAD.size or payload[:4] != _MAGIC:
        raise ValueError("not a block of token ids")
    _, bits, count, n = _HEAD.unpack_from(payload)
    at = _HEAD.size + 4 * count
    planes = []
    unzip = zstandard.ZstdDecompressor()
    for size in struct.unpack_from(f"<{count}I", payload, _HEAD.size):
        planes.append(np.frombuffer(unzip.decompress(payload[at : at + size]), np.uint8))
        at += size
    if bits == 1:
        flat = np.unpackbits(np.array(planes), axis=1, count=n).T
        octets = np.packbits(flat, axis=1, bitorder="little")
    else:
        octets = np.array(planes).reshape(count, n).T
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)


# The steps before the model of the tokenizers whose texts may be cut into chunks.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write a byte that is no printable Latin-1 character as 256 + its
    place among those."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


def _may_cut(spec: dict) -> bool:
    """Whether a tokenizer file is of the kind that :class:`ChunkEncoder` encodes by chunks."""
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    split, *level = before.get("pretokenizers", [{}])
    return (
        (spec.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
        and split.get("pattern") == {"Regex": _SPLIT}
        and (split.get("behavior"), split.get("invert")) == ("Removed", True)
        and [(x["type"], x["add_prefix_space"], x["use_regex"]) for x in level]
        == [("ByteLevel", False, False)]
        and model["type"] == "BPE"
        and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix"))
        # No token that is looked for in the text itself spans a cut.
        and all(
            not (t["content"][0].isalpha() or t["content"][-1] in ".,")
            and not any(t[x] for x in ("single_word", "lstrip", "rstrip", "normalized"))
            and not any(map(str.isspace, t["content"]))
            for t in spec["added_tokens"]
        )
    )


class _Known(dict):
    """Chunks with their ids; a chunk that is not there is encoded."""

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode(chunk)
        if len(chunk) <= _LONGEST_CHUNK:
            if len(self) > _CACHE:
                self.clear()
            self[chunk] = ids
        return ids


class ChunkEncoder:
    """Ids of whole texts as the tokenizers library gives them.

    Texts are encoded by chunks between blanks and line breaks, kept once seen, if the tokenizer
    normalises to NFC and lower case and its pieces are runs of letters, single digits or runs
    of other signs, without white space. There a cut at a blank or line break, before a full
    stop or comma after a letter, and between a word and ASCII signs up to the chunk's end changes
    no id, and a word of Latin letters is one piece that the model can be asked for without the
    steps before it. For any other tokenizer each text is encoded whole by the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.known = _Known(self._new)
        with open(path, encoding="utf-8") as file:
            self.by_chunks = _may_cut(json.load(file))

    @staticmethod
    def _is_word(chunk: str) -> bool:
        if chunk.isascii() or not chunk.isalpha():
            return chunk.isalpha()
        latin = max(chunk) < "\u0250" and unicodedata.is_normalized("NFC", chunk)
        return latin and chunk.lower().isalpha()

    def _whole(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(found, "<u4").tobytes()

    def _new(self, chunk: str) -> bytes:
        if self._is_word(chunk):
            word = chunk.lower()
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(self.letters)
            return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
        head = chunk.rstrip(string.punctuation)
        if head != chunk and self._is_word(head):
            return self.known[head] + self.known[chunk[len(head) :]]
        if len(chunk) > 1 and chunk[-1] in ".," and chunk[-2].lower().isalpha():
            return self.known[chunk[:-1]] + self.known[chunk[-1]]
        return self._whole(chunk)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit integers."""
        if not self.by_chunks:
            return self._whole(text)
        return b"".join(map(self.known.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def _chunk_encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


_PIECE = pa.struct(
    [("seq", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int32()), ("skip", pa.int64())]
    + [("n", pa.int32()), ("doc_n", pa.int64())]
)


class _Blocks:
    """Cuts the ids of documents, fed in order, into blocks."""

    def __init__(self, part: int, size: int, bits: int):
        self.part, self.size, self.bits = part, size, bits
        self.block = self.first = self.held = self.seq = 0
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple] = []

    def feed(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        skip = 0
        while skip < len(ids):
            piece = ids[skip : skip + self.size - self.held]
            self.docs.append((self.seq, doc_id, self.held, skip, len(piece), len(ids)))
            self.ids.append(piece)
            self.held += len(piece)
            skip += len(piece)
            if self.held == self.size:
                yield self.close()
        self.seq += 1

    def close(self) -> pa.RecordBatch:
        """The block as one row of the stored table."""
        fields = [pa.array(v, f.type) for v, f in zip(zip(*self.docs), _PIECE)]
        docs = pa.StructArray.from_arrays(fields, fields=list(_PIECE))
        row = {
            "part": pa.array([self.part], pa.int32()),
            "block": pa.array([self.block], pa.int64()),
            "first": pa.array([self.first], pa.int64()),
            "n": pa.array([self.held], pa.int32()),
            "payload": pa.array([pack_block(np.concatenate(self.ids), self.bits)], pa.binary()),
            "docs": pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
        }
        self.block += 1
        self.first += self.held
        self.held, self.ids, self.docs = 0, [], []
        return pa.RecordBatch.from_pydict(row)


def write_token_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int | None = END_ID,
    block: int = BLOCK,
    bits: int = 8,
) -> None:
    """Encode every whole text and store the ids in ascending ``doc_id`` order.

    ``tokenizer`` is a file of the tokenizers library; :class:`ChunkEncoder` tells which kind is
    encoded by chunks.

    Null texts are empty; null ids come first; rows with one doc_id are ordered by their texts
    and all kept. Without ``end_id`` an empty document has no ids and leaves no trace. Documents
    are range partitioned, with the text's hash and the reading task as tie-breaks, so repeated
    ids can be cut apart. A task holds one block and one batch of documents.
    """
    ship_code(docs.sparkSession)
    task = "__task"
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col(task)]
    sorted_docs = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .withColumn(task, F.spark_partition_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop(task)
    )
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _chunk_encoder(tokenizer)
        blocks = _Blocks(TaskContext.get().partitionId(), block, bits)
        for batch in batches:
            for key, text in zip(batch.column("doc_id"), batch.column("text")):
                ids = np.frombuffer(encoder.encode(text.as_py() or "") + end, "<u4")
                yield from blocks.feed(key.as_py(), ids)
        if blocks.held:
            yield blocks.close()

    stored = sorted_docs.mapInArrow(cut, _BLOCK_SCHEMA)
    stored.write.option("compression", "uncompressed").mode("errorifexists").parquet(path)


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """``part, block, first, n`` of every block and ``start``, the ids of all blocks before it."""
    index = spark.read.schema(_BLOCK_SCHEMA).parquet(path).select("part", "block", "first", "n")
    return index.join(F.broadcast(_part_starts(index)), "part").select(
        *index.columns, (F.col("part_start") + F.col("first")).alias("start")
    )


def _part_starts(index: DataFrame) -> DataFrame:
    """One row for each task that wrote: bounded by the number of partitions."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = index.groupBy("part").agg(F.sum("n").alias("ids"))
    return totals.select(
        "part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start")
    )


def read_documents(spark: SparkSession, path: str, keep_ids: bool = True) -> DataFrame:
    """One row per document from stored blocks: ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens``, ``ids_crc32``, and ``ids`` (their bytes) if asked for.

    Blocks are decoded apart. Only documents cut by a block's edge carry ids through the
    shuffle unless all are asked for.
    """
    ship_code(spark)
    schema = (
        "part int, seq long, doc_id long, at long, skip long, doc_n long, crc long, ids binary"
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                octets = unpack_block(row["payload"]).tobytes()
                out: dict[str, list] = {x.split()[0]: [] for x in schema.split(", ")}
                for d in row["docs"]:
                    ids = octets[4 * d["at"] : 4 * (d["at"] + d["n"])]
                    whole = d["n"] == d["doc_n"]
                    values = (
                        row["part"], d["seq"], d["doc_id"], row["first"] + d["at"], d["skip"],
                        d["doc_n"], zlib.crc32(ids), ids if keep_ids or not whole else None,
                    )
                    for name, value in zip(out, values):
                        out[name].append(value)
                types = [pa.int32(), *[pa.int64()] * 6, pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(out.values(), types)], list(out)
                )

    blocks = spark.read.schema(_BLOCK_SCHEMA).parquet(path)
    pieces = blocks.select("part", "first", "payload", "docs").mapInArrow(decode, schema)
    docs = (
        pieces.groupBy("part", "seq")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.min("at").alias("at"),
            F.first("doc_n").alias("n_tokens"),
            F.count(F.lit(1)).alias("count"),
            F.first("crc").alias("crc"),
            F.expr("listagg(ids) WITHIN GROUP (ORDER BY skip)").alias("ids"),
        )
        .join(F.broadcast(_part_starts(blocks.select("part", "n"))), "part")
        .select(
            "doc_id",
            (F.col("part_start") + F.col("at")).alias("start"),
            "n_tokens",
            F.when(F.col("count") == 1, F.col("crc")).otherwise(F.crc32("ids")).alias("ids_crc32"),
            "ids",
        )
    )
    return docs if keep_ids else docs.drop("ids")


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    docs = table(spark, sf_dir, "documents")
    write_token_ids(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return read_documents(spark, path, keep_ids=False)
