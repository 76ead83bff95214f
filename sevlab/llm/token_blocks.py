"""Token ids in patched frame-of-reference blocks.

A segment is one self-contained binary value (little-endian throughout):

* header: magic ``PFB1``, ids, documents, blocks, block size (uint32 each);
* document table: doc_id (int64 each), whether it is null (a byte each), ids (uint32 each);
* block index: where each block starts among the packed bytes and where the last one ends (uint32);
* block heads: minimum (uint32), width (uint8), exceptions (uint16), as three arrays;
* packed bits: every id minus its block's minimum, at the block's width, the lowest bit first;
* exceptions of all blocks in order: positions in their block (uint16), then differences (uint32).

A block's width holds ``PERCENTILE`` of its differences; larger ones are exceptions. The index and the
heads let a reader decode any block alone. Segments hold whole documents in ascending order and about
``SEGMENT_IDS`` ids; they are rows of a Parquet table in the shared folder, so Spark's writer commits
them and a lost executor's segments are simply written again.

Encoding: rows are sorted by range of (doc_id, text hash), so each task writes a run of documents and
no order is kept by the driver. The tokenizer treats whitespace-separated pieces one by one, so the ids
of a piece are kept in a bounded dictionary and only unseen pieces are encoded.

Defined results: null and empty texts have the end id alone; documents come in ascending doc_id order,
nulls first, ties by text hash; equal rows follow each other; empty tables give empty results.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sevlab.llm.common import written

MAGIC = b"PFB1"
BLOCK = 512
SEGMENT_IDS = 1 << 18
PERCENTILE = 0.9
KNOWN_PIECES = 1_000_000


def _bit_length(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment."""
    n_blocks = -(-len(ids) // BLOCK)
    block = np.arange(len(ids)) // BLOCK
    starts = np.arange(n_blocks) * BLOCK
    low = np.minimum.reduceat(ids, starts) if n_blocks else ids[:0]
    rest = ids - low[block]
    counts = np.diff(np.append(starts, len(ids)))
    width = np.zeros(n_blocks, np.uint8)
    for at, size in ((slice(0, len(ids) // BLOCK), BLOCK), (slice(len(ids) // BLOCK, n_blocks), len(ids) % BLOCK)):
        if at.start < at.stop:
            kth = int(np.ceil(PERCENTILE * size)) - 1
            values = rest[at.start * BLOCK:at.start * BLOCK + (at.stop - at.start) * size].reshape(-1, size)
            width[at] = _bit_length(np.partition(values, kth, axis=1)[:, kth])
    patched = rest >= (np.uint64(1) << width.astype(np.uint64))[block]
    n_bytes = (counts * width + 7) // 8
    index = np.concatenate([[0], np.cumsum(n_bytes)]).astype("<u4")
    packed = np.zeros(int(index[-1]), np.uint8)
    inside = np.where(patched, 0, rest).astype("<u4")
    for w in np.unique(width[width > 0]):
        for full in (True, False):
            at = np.flatnonzero((width == w) & ((counts == BLOCK) == full))
            if len(at):
                size = BLOCK if full else int(counts[-1])
                values = inside[starts[at][:, None] + np.arange(size)]
                bits = np.unpackbits(values[:, :, None].view(np.uint8), axis=2, bitorder="little")[:, :, :w]
                out = np.packbits(bits.reshape(len(at), -1), axis=1, bitorder="little")
                packed[index[at].astype(np.int64)[:, None] + np.arange(out.shape[1])] = out
    head = np.array([len(ids), len(doc_ids), n_blocks, BLOCK], "<u4")
    parts = [MAGIC, head, np.array([d or 0 for d in doc_ids], "<i8"), np.array([d is None for d in doc_ids], np.uint8), lengths.astype("<u4"), index, low.astype("<u4"), width,
             np.bincount(block[patched], minlength=n_blocks).astype("<u2"), packed, (np.flatnonzero(patched) % BLOCK).astype("<u2"), rest[patched].astype("<u4")]
    return b"".join(p if isinstance(p, bytes) else p.tobytes() for p in parts)


def unpack(segment: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, lengths and ids of one segment."""
    if segment[:4] != MAGIC:
        raise ValueError("not a segment of token blocks")
    at = 4

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(segment, kind, n, at)
        at += out.nbytes
        return out

    n_ids, n_docs, n_blocks, size = (int(x) for x in take("<u4", 4))
    docs, missing, lengths = take("<i8", n_docs), take("u1", n_docs), take("<u4", n_docs)
    index, low, width, n_patched = take("<u4", n_blocks + 1), take("<u4", n_blocks), take("u1", n_blocks), take("<u2", n_blocks)
    packed = take("u1", int(index[-1]))
    ids = np.zeros(n_ids, "<u4")
    counts = np.minimum(size, n_ids - np.arange(n_blocks) * size)
    for w in np.unique(width[width > 0]):
        bytes_each = 2 if w <= 16 else 4
        for full in (True, False):
            blocks = np.flatnonzero((width == w) & ((counts == size) == full))
            if len(blocks):
                n = size if full else int(counts[-1])
                raw = packed[index[blocks].astype(np.int64)[:, None] + np.arange((n * int(w) + 7) // 8)]
                bits = np.zeros((len(blocks), n, 8 * bytes_each), np.uint8)
                bits[:, :, :w] = np.unpackbits(raw, axis=1, bitorder="little")[:, :n * int(w)].reshape(len(blocks), n, w)
                values = np.packbits(bits, axis=2, bitorder="little").view(f"<u{bytes_each}")[:, :, 0]
                ids[(blocks * size)[:, None] + np.arange(n)] = values
    total = int(n_patched.sum())
    position, value = take("<u2", total), take("<u4", total)
    ids[np.repeat(np.arange(n_blocks) * size, n_patched) + position] = value
    ids += np.repeat(low, counts)
    return [None if m else int(d) for d, m in zip(docs, missing, strict=True)], lengths, ids


def read_block(segment: bytes, block: int) -> np.ndarray:
    """The ids of one block of a segment: only its heads, packed bytes and exceptions are decoded."""
    if segment[:4] != MAGIC:
        raise ValueError("not a segment of token blocks")
    n_ids, n_docs, n_blocks, size = (int(x) for x in np.frombuffer(segment, "<u4", 4, 4))
    if not 0 <= block < n_blocks:
        raise IndexError(f"block {block} of {n_blocks}")
    index_at = 20 + n_docs * (8 + 1 + 4)
    low_at = index_at + 4 * (n_blocks + 1)
    width_at, patched_at = low_at + 4 * n_blocks, low_at + 5 * n_blocks
    packed_at = patched_at + 2 * n_blocks
    start, end = (int(x) for x in np.frombuffer(segment, "<u4", 2, index_at + 4 * block))
    packed_bytes = int(np.frombuffer(segment, "<u4", 1, index_at + 4 * n_blocks)[0])
    low, width = int(np.frombuffer(segment, "<u4", 1, low_at + 4 * block)[0]), segment[width_at + block]
    patched = np.frombuffer(segment, "<u2", n_blocks, patched_at).astype(np.int64)
    before, here, every = int(patched[:block].sum()), int(patched[block]), int(patched.sum())
    count = min(size, n_ids - block * size)
    bits = np.zeros((count, 32), np.uint8)
    bits[:, :width] = np.unpackbits(np.frombuffer(segment, np.uint8, end - start, packed_at + start), bitorder="little")[:count * width].reshape(count, width)
    ids = np.packbits(bits, axis=1, bitorder="little").view("<u4")[:, 0].copy()
    exceptions_at = packed_at + packed_bytes
    position = np.frombuffer(segment, "<u2", here, exceptions_at + 2 * before)
    ids[position] = np.frombuffer(segment, "<u4", here, exceptions_at + 2 * every + 4 * before)
    return ids + np.uint32(low)


def byte_letters() -> dict[int, str]:
    """The letter that byte-level models write for each byte: itself if printable in Latin-1, else the next
    code points from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(rest)) for b in range(256)}


#: Letters and then signs: two pieces for the tokenizer, whose normal form is the lower case.
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\[-`{-~]*)")


class PieceEncoder(dict):
    """The ids (little-endian uint32) of pieces between ASCII white space, made when first asked for, by a
    byte-level tokenizer that lower-cases and whose own pieces never cross white space. Plain words and
    signs go straight to its model, all else through the whole tokenizer."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.parts: dict[str, bytes] = {"": b""}

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            letters = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
            found = self.parts[part] = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        return found

    def __missing__(self, piece: bytes) -> bytes:
        text = piece.decode()
        if m := _PLAIN.fullmatch(text):
            ids = self._part(m[1].lower()) + self._part(m[2])
        else:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self[piece] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        if len(self) > KNOWN_PIECES:
            self.clear()
            self.parts = {"": b""}
        return b"".join(map(self.__getitem__, text.split()))


_encoders: dict[str, PieceEncoder] = {}


def _encoded(batches: Iterable[pa.RecordBatch], path: str, end: bytes) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, ids) of each row."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    encode = _encoders[path].encode
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            part = batch.slice(k, 256)
            texts = part.column(1).cast(pa.large_string()).cast(pa.large_binary()).to_pylist()
            for doc_id, text in zip(part.column(0).to_pylist(), texts, strict=True):
                yield doc_id, encode(text or b"") + end


def write_segments(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """The table of segments (part, segment, n_ids, payload), written to the shared folder and read back."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ranged = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def segments(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            payload = pack(doc_ids, np.array([len(h) // 4 for h in held]), ids)
            return pa.RecordBatch.from_pydict({"part": [part], "segment": [segment], "n_ids": [len(ids)], "payload": [payload]},
                                              schema=pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("n_ids", pa.int64()), ("payload", pa.binary())]))

        for doc_id, ids in _encoded(it, tokenizer, end):
            doc_ids.append(doc_id)
            held.append(ids)
            size += len(ids) // 4
            if size >= SEGMENT_IDS:
                yield flush()
                segment, size, doc_ids, held = segment + 1, 0, [], []
        if held:
            yield flush()

    return written(ranged.mapInArrow(segments, "part int, segment int, n_ids long, payload binary"), "token-segments")


def read_documents(segments: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document (and its ids), decoded from the segments."""

    def documents(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part, segment, payload in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                doc_ids, lengths, ids = unpack(payload)
                ends = np.cumsum(lengths, dtype=np.int64)
                starts = ends - lengths
                out = {"doc_id": pa.array(doc_ids, pa.int64()), "part": pa.array([part] * len(doc_ids), pa.int32()), "segment": pa.array([segment] * len(doc_ids), pa.int32()),
                       "start": pa.array(starts), "n_tokens": pa.array(lengths.astype(np.int64)),
                       "ids_crc32": pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)], pa.int64())}
                if with_ids:
                    out["ids"] = pa.array([ids[a:b].astype(np.int64) for a, b in zip(starts, ends, strict=True)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, part int, segment int, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    rows = segments.select("part", "segment", "payload").mapInArrow(documents, schema)
    sizes = segments.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn("before_part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = sizes.withColumn("before", F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    offsets = inside.join(parts, "part").select("part", "segment", (F.col("before") + F.col("before_part")).alias("offset"))
    return rows.join(offsets, ["part", "segment"]).select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
