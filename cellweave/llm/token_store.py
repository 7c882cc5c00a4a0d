"""Token ids in binary files: frequency-ranked, byte-aligned variable-length, with separate control bytes.

A file holds consecutive documents in ascending doc_id order:

    magic "CWTS", version u32, documents u32, ids u64, ids before this file u64, bytes of data u64,
    doc_id i64 each, ids of each document u32, control bytes, data bytes

An id is stored as its rank among all ids of the corpus, the most frequent first, in as many bytes as the rank needs (1 to 4,
little-endian). A control byte holds the sizes, less one, of four ranks, two bits each. The ranks are kept in `ranks.parquet` beside
the files. Decoding looks up the four sizes of all control bytes in one table and gathers the data bytes by them.

Documents are dealt by ranges of doc_id, so no task holds more than a range. The files are written to their final name by a rename; a
task that runs again writes the same bytes. A null text counts as empty, a null doc_id comes first, equal rows are all kept, and rows that share a doc_id follow
each other in any order. Texts are read whole, however long: a file ends after the document with which it has FILE_IDS ids. Ids that are equally frequent are ranked
by id. An empty table gives no files and an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import id_and_text, slices, table, written
from cellweave.llm.tokens import word_bpe

MAGIC, HEADER = b"CWTS", struct.Struct("<4sIIQQQ")
SIZES = (np.arange(256)[:, None] >> (np.arange(4) * 2) & 3) + 1  # of the four ranks that a control byte stands for
#: Ids that one file holds at least before it ends.
FILE_IDS = 4 << 20
NULL_ID = -(2**63)
#: Bytes of text that are encoded at once: a word that stands twice among them is looked up once.
TEXT = 8 << 20


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes."""
    ranks = np.ascontiguousarray(ranks, dtype="<u4")
    sizes = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    padded[: len(ranks)] = sizes - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    held = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < sizes[:, None]]
    return control.tobytes(), held.tobytes()


def decode_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    sizes = SIZES[control].ravel()[:n]
    first = np.cumsum(sizes) - sizes
    data = np.concatenate([data, np.zeros(4, dtype=np.uint8)])
    ranks = data[first].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(sizes > k)
        ranks[more] |= data[first[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def pack_file(doc_ids: np.ndarray, counts: np.ndarray, ranks: np.ndarray, before: int) -> bytes:
    control, data = encode_ranks(ranks)
    return b"".join([HEADER.pack(MAGIC, 1, len(doc_ids), len(ranks), before, len(data)), doc_ids.astype("<i8").tobytes(), counts.astype("<u4").tobytes(), control, data])


def unpack_file(held: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Document ids, their numbers of ids, all ranks, and the ids before this file."""
    magic, kind, documents, n, before, size = HEADER.unpack_from(held)
    if magic != MAGIC or kind != 1:
        raise ValueError("not a token file of this kind")
    at = HEADER.size
    doc_ids = np.frombuffer(held, "<i8", documents, at)
    counts = np.frombuffer(held, "<u4", documents, at := at + 8 * documents).astype(np.int64)
    control = np.frombuffer(held, np.uint8, -(-n // 4), at := at + 4 * documents)
    data = np.frombuffer(held, np.uint8, size, at + len(control))
    return doc_ids, counts, decode_ranks(control, data, n), before


def tokenised(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """In ascending doc_id order: part, ids before the row in its part, doc_id, n_tokens and the ids; written once."""
    schema = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, library = TaskContext.get().partitionId(), 0, word_bpe(tokenizer)
        for batch in slices(batches, most=TEXT):
            ids, counts = library.encode(batch.column("text"))
            ends = np.cumsum(counts)
            whole = np.insert(ids, ends, np.array(end_id, dtype=ids.dtype))
            sizes = counts + 1
            ends = np.cumsum(sizes)
            offsets = np.concatenate([[0], ends * ids.dtype.itemsize]).astype(np.int32)
            held = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(whole.tobytes())])
            yield table(schema, part=np.full(len(sizes), part), before=before + ends - sizes, doc_id=batch.column("doc_id"), n_tokens=sizes, ids=held)
            before += int(sizes.sum())

    dealt = id_and_text(docs).repartitionByRange(F.col("doc_id")).sortWithinPartitions("doc_id")
    return written(dealt.mapInArrow(run, "part int, before long, doc_id long, n_tokens long, ids binary"), "tokens", compression="zstd")


def frequencies(tokens: DataFrame, dtype: str) -> DataFrame:
    """How often each id stands in the corpus."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in slices(batches, "ids"):
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype=dtype)
            found = np.bincount(ids, minlength=len(total))
            found[: len(total)] += total
            total = found
        there = np.flatnonzero(total)
        yield table(schema, id=there, n=total[there])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1) -> None:
    """Writes all documents' ids, each document's end id included, to files below the path."""
    spark = docs.sparkSession
    dtype = word_bpe(tokenizer).dtype.str
    tokens = tokenised(docs, tokenizer, end_id)
    counted = frequencies(tokens, dtype).orderBy(F.desc("n"), "id").collect()  # at most the vocabulary
    spark.createDataFrame([(rank, i, n) for rank, (i, n) in enumerate(counted)], "rank long, id long, n long").coalesce(1).write.parquet(f"{path}/ranks.parquet")
    sums = sorted(tokens.groupBy("part").agg(F.sum("n_tokens")).collect())  # a row for each range
    start = dict(zip([p for p, _ in sums], np.cumsum([0, *(n for _, n in sums)]).tolist(), strict=False))
    rank = np.zeros(max([i for i, _ in counted], default=0) + 1, dtype=np.uint32)
    rank[[i for i, _ in counted]] = np.arange(len(counted))
    shared = spark.sparkContext.broadcast((rank, start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        ranks, starts = shared.value
        store.create_dir(f"{root}/ids", recursive=True)
        held: list[tuple] = []

        def flush() -> None:
            part, before = held[0][0], held[0][1]
            ids = np.frombuffer(b"".join(x[4] for x in held), dtype=dtype)
            blob = pack_file(np.array([NULL_ID if x[2] is None else x[2] for x in held]), np.array([x[3] for x in held]), ranks[ids], starts[part] + before)
            name = f"{root}/ids/{part:06d}-{before:015d}.cwts"
            with store.open_output_stream(other := f"{root}/.{uuid.uuid4().hex}") as out:
                out.write(blob)
            store.move(other, name)
            held.clear()

        size = 0
        for batch in slices(batches, "ids"):
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "before", "doc_id", "n_tokens", "ids")), strict=True):
                if held and (row[0] != held[0][0] or row[1] != held[-1][1] + held[-1][3] or size >= FILE_IDS):
                    flush()
                    size = 0
                held.append(row)
                size += row[3]
        if held:
            flush()
        yield from ()

    tokens.mapInArrow(run, "done int").write.format("noop").mode("overwrite").save()


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens and its ids (32-bit little-endian)."""
    ids = np.array([i for i, in spark.read.parquet(f"{path}/ranks.parquet").orderBy("rank").select("id").collect()], dtype="<u4")
    shared = spark.sparkContext.broadcast(ids)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in batch.column("content"):
                doc_ids, counts, ranks, before = unpack_file(held.as_py())
                whole = shared.value[ranks]
                ends = np.cumsum(counts)
                each = [whole[a:b].tobytes() for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                for a in range(0, len(each), 2000):
                    part = each[a : a + 2000]
                    yield table(schema, doc_id=pa.array(doc_ids[a : a + 2000], mask=doc_ids[a : a + 2000] == NULL_ID), start=(before + ends - counts)[a : a + 2000], n_tokens=counts[a : a + 2000], ids_crc32=[zlib.crc32(x) for x in part], ids=part)

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(f"{path}/ids")
    return files.select("content").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
