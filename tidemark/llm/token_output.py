"""Training-order output: fixed-stride shards of token ids in the order of a keyed permutation.

Documents, each closed by END, are strung together and cut into sequences of SEQUENCE ids; only the last sequence
of a scanned partition is filled with PAD. Sequences get global numbers in the order of the scan, and the permuted
number is the slot. Slots s * RECORDS .. (s + 1) * RECORDS - 1 make shard s: rows go to the task of their range of shards, are
sorted by slot and written as records of equal length, so the ids of slot x lie at byte (x mod RECORDS) * SEQUENCE * width of shard
x div RECORDS, and a reader resumes at any slot by a seek.

With a ``vocabulary`` (number of ids), documents are (doc_id, ids array<int>, or binary of 4 bytes an id, little-endian) and an id takes 2 or 4 bytes, little-endian;
the two ids after the vocabulary are END and PAD. Without one, documents are (doc_id, text) and ids are the bytes of
the UTF-8 text, one byte each; END and PAD are bytes that UTF-8 never uses.

On their way to the shards (staged once, shuffled once) sequences of ids are packed: a byte for each of 255 common ids, the others
spelled out behind, and zstd. Which ids are common is taken from the first documents; it changes sizes, never results.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import new_path, stage, uri
from .permutation import permuted
from .words import SLICE, slices

SEQUENCE, RECORDS, SEED = 1024, 4096, 77
TASKS = 16_384  # that write shards, at most
FEW_SPLITS = 200_000  # whose offsets go to all tasks
HEAD, RARE = 256, 255  # documents, and ids of each, that tell which ids are common; the byte of all other ids
END, PAD = 0xFF, 0xFE
TOGETHER = 1024  # sequences unpacked at once
_zstd = pa.Codec("zstd")
BEGINS = "begins array<struct<doc_id bigint, start int, n_ids bigint>>"
ROW = f"slot bigint, shard bigint, at bigint, row_no bigint, doc_id bigint, offset bigint, n_tokens int, {BEGINS}"


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def layout(vocabulary: int | None) -> tuple[np.dtype, int, int]:
    """(stored type of an id, END, PAD)."""
    if vocabulary is None:
        return np.dtype("u1"), END, PAD
    return np.dtype("<u2" if vocabulary + 2 <= 1 << 16 else "<u4"), vocabulary, vocabulary + 1


def _id_slices(column: pa.ListArray, vocabulary: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, ids, offsets from 0) of runs of rows of about SLICE ids."""
    if pa.types.is_list(column.type):
        values, offsets = column.flatten(), column.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
    else:
        column = column.cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        body = column.buffers()[2]
        if (offsets % 4).any():
            raise ValueError("an id has 4 bytes")
        values = pa.array(np.frombuffer(body, "<i4")[offsets[0] // 4 : offsets[-1] // 4] if body is not None and body.size else np.zeros(0, np.int32))
        offsets = (offsets - offsets[0]) // 4
    if values.null_count or len(values) and not (0 <= pc.min(values).as_py() and pc.max(values).as_py() < vocabulary):
        raise ValueError(f"ids must be 0 to {vocabulary - 1}")
    ids, at, n = values.to_numpy(), 0, len(column)
    while at < n:
        to = min(n, max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1))
        yield at, to, ids[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


class Packing:
    """Sequences of ids as short byte strings, and back. ``common``: up to 255 ids that take one byte."""

    def __init__(self, common: list[int], vocabulary: int):
        self.kind, _, pad = layout(vocabulary)
        self._code = np.full(pad + 1, RARE, np.uint8)
        self._code[common] = np.arange(len(common))
        self._id = np.zeros(RARE + 1, self.kind)
        self._id[: len(common)] = common

    def pack(self, ids: np.ndarray, length: int) -> list[bytes]:
        """Every run of ``length`` ids."""
        codes, wide = self._code[ids], self.kind.itemsize
        at = np.flatnonzero(codes == RARE)
        planes = [np.ascontiguousarray(x).tobytes() for x in ids[at].view(np.uint8).reshape(-1, wide).T]
        codes, starts, out = codes.tobytes(), range(0, len(ids), length), []
        edges = np.searchsorted(at, [*starts, len(ids)]).tolist()
        for k, x in enumerate(starts):
            raw = codes[x : x + length] + b"".join([p[edges[k] : edges[k + 1]] for p in planes])
            out.append(struct.pack("<II", min(length, len(ids) - x), len(raw)) + _zstd.compress(raw, asbytes=True))
        return out

    def unpack(self, column: pa.Array) -> Iterator[bytes]:
        """The stored bytes of every packed sequence."""
        wide = self.kind.itemsize
        for a in range(0, len(column), TOGETHER):
            some = column[a : a + TOGETHER].to_pylist()
            sizes = [struct.unpack_from("<II", x) for x in some]
            raw = [_zstd.decompress(memoryview(x)[8:], size, asbytes=True) for x, (_, size) in zip(some, sizes)]
            codes = np.frombuffer(b"".join([r[:n] for r, (n, _) in zip(raw, sizes)]), np.uint8)
            ids = self._id[codes]
            rest = [(r, n, (size - n) // wide) for r, (n, size) in zip(raw, sizes)]
            planes = [np.frombuffer(b"".join([r[n + k * m : n + k * m + m] for r, n, m in rest]), np.uint8) for k in range(wide)]
            ids[codes == RARE] = np.stack(planes, axis=1).view(self.kind).ravel()
            body, at = ids.tobytes(), 0
            for n, _ in sizes:
                yield body[at : at + n * wide]
                at += n * wide

def _packing(docs: DataFrame, vocabulary: int | None) -> Packing | None:
    if vocabulary is None:
        return None
    head = F.substring("ids", 1, 4 * HEAD) if _in_bytes(docs) else F.slice("ids", 1, HEAD)
    found = Counter({vocabulary: 1})  # END
    for (ids,) in docs.select(head).take(HEAD):
        ids = np.frombuffer(ids[: len(ids) // 4 * 4], "<i4").tolist() if isinstance(ids, (bytes, bytearray)) else ids or ()
        found.update(i for i in ids if i is not None and 0 <= i < vocabulary)
    return Packing([i for i, _ in found.most_common(RARE)], vocabulary)


def _in_bytes(docs: DataFrame) -> bool:
    return docs.schema["ids"].dataType.typeName() == "binary"


def numbered_sequences(docs: DataFrame, length: int = SEQUENCE, vocabulary: int | None = None) -> tuple[DataFrame, int]:
    """row_no, doc_id, offset, tokens (binary, as stored) and begins of every sequence of ``docs``, and their number.

    doc_id and offset tell where a sequence begins: so many ids into that document. begins lists every document whose
    first id (or END) stands in the sequence: its doc_id, the place there, and its number of ids without END; what does
    not fit goes on in the following row_no. Each row of ``docs`` is in one such list. Null and empty documents are END
    alone; an empty table has no sequence. Every task strings its own documents together, so the documents are not
    shuffled to number them: the cut sequences are written once with their split and their place in it, and the numbers of
    sequences of the splits before give the rest. How uneven the splits are makes no difference.
    """
    packing = _packing(docs, vocabulary)
    rows, n = _numbered(docs, length, vocabulary, packing)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("tokens")
            yield batch.set_column(at, "tokens", pa.array(list(packing.unpack(batch.column(at))), pa.binary()))

    return (rows if packing is None else rows.mapInArrow(of, rows.schema)), n


def _numbered(docs: DataFrame, length: int, vocabulary: int | None, packing: Packing | None) -> tuple[DataFrame, int]:
    """numbered_sequences with the tokens still packed."""
    kind, end, _ = layout(vocabulary)
    if vocabulary is None:
        content = F.col("text")
    else:
        content = F.coalesce("ids", F.lit(b"") if _in_bytes(docs) else F.array().cast("array<int>")).alias("ids")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, base = TaskContext.get().partitionId(), 0
        # ids not yet cut, where their documents begin in them, which those are and how long
        rest, starts, ids, sizes = np.zeros(0, kind), np.zeros(0, np.int64), [], np.zeros(0, np.int64)

        def cut(whole):
            nonlocal base
            at = np.arange(whole) * length
            k = np.searchsorted(starts, at, "right") - 1
            body = rest[: whole * length]
            tokens = [body[x : x + length].tobytes() for x in at.tolist()] if packing is None else packing.pack(body, length)
            first = pa.array([ids[i] for i in k.tolist()], pa.int64())
            x, y = np.searchsorted(starts, (0, whole * length))
            here = pa.StructArray.from_arrays([pa.array(ids[x:y], pa.int64()), pa.array((starts[x:y] % length).astype(np.int32)), pa.array(sizes[x:y] - 1)],
                                              ["doc_id", "start", "n_ids"])
            edges = np.append(np.searchsorted(starts[x:y], at), y - x).astype(np.int32)
            begins = pa.ListArray.from_arrays(pa.array(edges), here)
            rows = pa.RecordBatch.from_arrays([pa.array(np.full(whole, split, np.int32)), pa.array(np.arange(base, base + whole)), first, pa.array(at - starts[k]), pa.array(tokens, pa.binary()), begins],
                                              ["split", "place", "doc_id", "offset", "tokens", "begins"])
            base += whole
            return rows

        for batch in batches:
            names, column = batch.column(0).to_pylist(), batch.column(1)
            for a, b, data, offsets in slices(column) if vocabulary is None else _id_slices(column, vocabulary):
                size = np.diff(offsets) + 1
                closed = np.full(len(data) + b - a, end, kind)
                inner = np.ones(len(closed), bool)
                inner[np.cumsum(size) - 1] = False
                closed[inner] = data
                starts, ids = np.concatenate((starts, len(rest) + np.cumsum(size) - size)), ids + names[a:b]
                sizes = np.concatenate((sizes, size))
                rest = np.concatenate((rest, closed))
                whole = len(rest) // length
                if whole:
                    yield cut(whole)
                    k = int(np.searchsorted(starts, whole * length, "right")) - 1
                    rest, starts, ids, sizes = rest[whole * length :].copy(), starts[k:] - whole * length, ids[k:], sizes[k:]
        if len(rest):
            yield cut(1)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), content)
    cut = stage(rows.mapInArrow(of, f"split int, place bigint, doc_id bigint, offset bigint, tokens binary, {BEGINS}"), "sequences")
    sizes = cut.groupBy("split").agg(F.count("*").alias("_n"))
    before = stage(sizes.select("split", (F.sum("_n").over(W.orderBy("split")) - F.col("_n")).alias("_before")), "offsets")  # one row a split
    if before.count() <= FEW_SPLITS:  # a few MB; else Spark joins as it sees fit
        before = F.broadcast(before)
    numbered = cut.join(before, "split").select((F.col("_before") + F.col("place")).alias("row_no"), "doc_id", "offset", "tokens", "begins")
    return numbered, cut.count()


def _writer(path: str, length: int, records: int, vocabulary: int | None, packing: Packing | None):
    kind, _, pad = layout(vocabulary)
    wide, blank = kind.itemsize, np.full(length, pad, kind).tobytes()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(path)
        shard, out, temp = None, None, ""

        def close():
            out.close()
            store.move(temp, f"{folder}/{shard_name(shard)}")  # whole or not at all; a rerun writes the same bytes

        for batch in batches:
            slots, tokens = batch.column("slot").to_numpy(), batch.column("tokens")
            sizes = np.zeros(len(batch), np.int32)
            bodies = (t.as_py() for t in tokens) if packing is None else packing.unpack(tokens)
            for i, (slot, body) in enumerate(zip(slots.tolist(), bodies)):
                if slot // records != shard:
                    if out is not None:
                        close()
                    shard = slot // records
                    temp = f"{folder}/.{shard_name(shard)}-{uuid.uuid4().hex}"
                    out = store.open_output_stream(temp)
                sizes[i] = len(body) // wide
                out.write(body + blank[len(body) :])
            yield pa.RecordBatch.from_arrays(
                [batch.column("slot"), pa.array(slots // records), pa.array(slots % records * length * wide), *map(batch.column, ("row_no", "doc_id", "offset")),
                 pa.array(sizes), batch.column("begins")],
                ["slot", "shard", "at", "row_no", "doc_id", "offset", "n_tokens", "begins"])
        if out is not None:
            close()

    return of


def write_shards(docs: DataFrame, path: str, length: int = SEQUENCE, records: int = RECORDS, seed: int = SEED,
                 vocabulary: int | None = None) -> DataFrame:
    """Write all sequences as shards below ``path`` (a URI that executors share); returns the index, a staged table.

    The index has slot, shard, at (byte offset), row_no, doc_id and offset of the first id, n_tokens (without PAD) and begins
    (the documents that start in the record; they go on in the following row_no), in shard order.
    """
    packing = _packing(docs, vocabulary)
    rows, n = _numbered(docs, length, vocabulary, packing)
    store, folder = fs.FileSystem.from_uri(path)
    store.create_dir(folder, recursive=True)
    slots = rows.select(permuted("row_no", n, seed).alias("slot"), "row_no", "doc_id", "offset", "begins", "tokens").withColumn("shard", F.expr(f"slot div {records}"))
    # a task writes one or more whole shards, one after the other
    shards = max(1, -(-n // records))
    each = -(-shards // TASKS)
    dealt = slots.repartitionById(-(-shards // each), F.expr(f"CAST(shard div {each} AS INT)")).sortWithinPartitions("slot").select("slot", "row_no", "doc_id", "offset", "begins", "tokens")
    return stage(dealt.mapInArrow(_writer(path, length, records, vocabulary, packing), ROW), "index")


def read_shards(index: DataFrame, path: str, length: int = SEQUENCE, vocabulary: int | None = None, with_tokens: bool = True) -> DataFrame:
    """The index rows with ``tokens`` (binary, with a vocabulary array<int>; without PAD) read from the shards.

    tokens_crc32 is the checksum of the stored bytes of these ids; with_tokens=False returns it alone.
    """
    kind, _, _ = layout(vocabulary)
    wide = kind.itemsize

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(path)
        shard, file = None, None
        for batch in batches:
            tokens = []
            for s, at, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "at", "n_tokens"))):
                if s != shard:
                    if file is not None:
                        file.close()
                    shard, file = s, store.open_input_file(f"{folder}/{shard_name(s)}")
                tokens.append(file.read_at(length * wide, at)[: n * wide])
            if not with_tokens:
                column = None
            elif vocabulary is None:
                column = pa.array(tokens, pa.binary())
            else:
                ends = np.cumsum([0, *(len(t) // wide for t in tokens)])
                column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(tokens), kind).astype(np.int32)))
            sums = pa.array([zlib.crc32(t) for t in tokens], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, *[column] * with_tokens, sums], [*batch.schema.names, *["tokens"] * with_tokens, "tokens_crc32"])
        if file is not None:
            file.close()

    kinds = f", tokens {'binary' if vocabulary is None else 'array<int>'}" if with_tokens else ""
    return index.mapInArrow(of, f"{ROW}{kinds}, tokens_crc32 bigint")


def materialised(docs: DataFrame, path: str | None = None, vocabulary: int | None = None) -> DataFrame:
    """Write the shards and read them back: the index with crc32 of each record's ids."""
    path = uri(docs.sparkSession, path or new_path(docs.sparkSession, "shards"))
    index = write_shards(docs, path, vocabulary=vocabulary)
    return read_shards(index, path, vocabulary=vocabulary, with_tokens=False)
