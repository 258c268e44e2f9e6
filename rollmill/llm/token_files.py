"""Token ids of documents in compressed files that are read document by document.

A file is a run of independent zstandard frames, so any zstandard reader can decompress it. Each
frame holds the documents of about ``FRAME_IDS`` ids and ends with zstandard's content checksum. Two
skippable frames follow the data:

* an index with the documents and ids of each frame and its first and last doc_id;
* the seek table of the public seekable format: per frame its compressed and decompressed size and
  the lower half of xxHash64 of its content, then the number of frames, a flag byte and a magic number.

A reader takes the last bytes, the table and the index, and fetches only the frames whose range of
doc_ids holds a document it wants. Content of a frame: u32 number of documents; i64 doc_ids; u8 flags
(1: the doc_id is null); u32 lengths; u32 ids, all little-endian.

Results: null text counts as empty; each document ends with ``end_id``; a null doc_id comes first and
is kept; rows that repeat a doc_id are kept, ordered by a hash of their text; an empty table gives no
rows. A task writes under a name of its own and renames when done, so a repeated task changes nothing.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollmill.llm.base import fresh, texts_of
from rollmill.llm.bpe import WIDTH, encoder
from rollmill.session import scratch_path, stage

# Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
INDEX = 0x184D2A50
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80

FRAME_IDS = 1 << 17
ENTRY = struct.Struct("<III")
FOOTER = struct.Struct("<IBI")
RANGE = struct.Struct("<IQqqB")
LEVEL = 1
MANIFEST = "file_no long, path string, n_docs long, n_tokens long"
READ = "doc_id long, file_no long, before long, n_tokens long, ids_crc32 long, ids array<long>"


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI; every task opens its own."""
    return fs.FileSystem.from_uri(path)


class Writer:
    def __init__(self, out):
        self.out, self.at = out, 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.entries: list[bytes] = []
        self.ranges: list[bytes] = []
        self.held: list[tuple[int | None, bytes]] = []
        self.held_ids = self.docs = self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.held.append((doc_id, ids))
        self.held_ids += len(ids) // WIDTH
        self.docs += 1
        self.tokens += len(ids) // WIDTH
        if self.held_ids >= FRAME_IDS:
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        keys = np.array([d or 0 for d, _ in self.held], dtype="<i8")
        nulls = np.array([d is None for d, _ in self.held], dtype="u1")
        lengths = np.array([len(i) // WIDTH for _, i in self.held], dtype="<u4")
        head = struct.pack("<I", len(self.held)) + keys.tobytes() + nulls.tobytes() + lengths.tobytes()
        content = head + b"".join(i for _, i in self.held)
        frame = self.packer.compress(content)
        self.out.write(frame)
        digest = xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
        self.entries.append(ENTRY.pack(len(frame), len(content), digest))
        own = keys[nulls == 0]
        low, high = (int(own[0]), int(own[-1])) if len(own) else (0, -1)
        self.ranges.append(RANGE.pack(len(self.held), self.held_ids, low, high, int(nulls.any())))
        self.held, self.held_ids = [], 0

    def close(self) -> None:
        self.flush()
        index, table = b"".join(self.ranges), b"".join(self.entries)
        self.out.write(struct.pack("<II", INDEX, len(index)) + index)
        table += FOOTER.pack(len(self.entries), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


def read_file(source, wanted: set[int] | None = None) -> Iterator[tuple[int | None, int, bytes]]:
    """(doc_id, ids of the file before it, its ids) of every document, or of the wanted ones only."""
    size = source.size()
    source.seek(size - FOOTER.size)
    frames, _, magic = FOOTER.unpack(source.read(FOOTER.size))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the file")
    table_at = size - FOOTER.size - frames * ENTRY.size
    index_at = table_at - 8 - frames * RANGE.size
    source.seek(index_at)
    index = source.read(frames * RANGE.size)
    source.seek(table_at)
    table = source.read(frames * ENTRY.size)
    unpacker = zstandard.ZstdDecompressor()
    at = before = 0
    for k in range(frames):
        packed, plain, digest = ENTRY.unpack_from(table, k * ENTRY.size)
        _, tokens, low, high, _ = RANGE.unpack_from(index, k * RANGE.size)
        if wanted is None or any(low <= w <= high for w in wanted):
            source.seek(at)
            content = unpacker.decompress(source.read(packed), max_output_size=plain)
            if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != digest:
                raise ValueError(f"frame {k} does not match its checksum")
            (n,) = struct.unpack_from("<I", content)
            keys = np.frombuffer(content, "<i8", n, 4).tolist()
            nulls = content[4 + 8 * n : 4 + 9 * n]
            lengths = np.frombuffer(content, "<u4", n, 4 + 9 * n).tolist()
            place, so_far = 4 + 13 * n, before
            for key, null, length in zip(keys, nulls, lengths):
                if wanted is None or (not null and key in wanted):
                    yield (None if null else key), so_far, content[place : place + length * WIDTH]
                place += length * WIDTH
                so_far += length
        at += packed
        before += tokens


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` in ascending doc_id order below ``folder``, a path all executors reach.

    Returns the files in order: file_no, path, n_docs, n_tokens.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        end = np.array([end_id], dtype="<u4").tobytes()
        number = TaskContext.get().partitionId()
        name = f"{folder}/part-{number:06d}.zst"
        store, path = open_fs(name)
        draft = f"{path}.{uuid.uuid4().hex}"
        writer = out = None
        for batch in batches:
            if writer is None:
                store.create_dir(path.rpartition("/")[0], recursive=True)
                out = store.open_output_stream(draft)
                writer = Writer(out)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts_of(batch))):
                writer.add(doc_id, ids + end)
        if writer is not None:
            writer.close()
            out.close()
            store.move(draft, path)
            yield pa.RecordBatch.from_pydict(
                {"file_no": [number], "path": [name], "n_docs": [writer.docs], "n_tokens": [writer.tokens]}
            )

    tie = fresh(docs, "tie")
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias(tie))
        .repartitionByRange("doc_id", tie)
        .sortWithinPartitions("doc_id", tie)
        .select("doc_id", "text")
    )
    return stage(ordered.mapInArrow(write, MANIFEST), scratch_path(docs.sparkSession, "token-manifest"))


def read_token_files(files: DataFrame, doc_ids: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """Documents of the listed files: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 and ids. With ``doc_ids`` only the frames that may hold them are fetched."""
    wanted = None if doc_ids is None else set(doc_ids)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, pa.int64()) for n in ("doc_id", "file_no", "before", "n_tokens", "ids_crc32")]
            + [("ids", pa.list_(pa.int64()))]
        )

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
            )

        for batch in batches:
            for file in batch.to_pylist():
                store, path = open_fs(file["path"])
                rows = []
                with store.open_input_file(path) as source:
                    for doc_id, before, ids in read_file(source, wanted):
                        shown = np.frombuffer(ids, "<u4").tolist() if with_ids else None
                        rows.append([doc_id, file["file_no"], before, len(ids) // WIDTH, zlib.crc32(ids), shown])
                        if len(rows) == 500:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    # One row a file: its ids come after those of all files before it.
    earlier = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    base = files.select("file_no", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("base"))
    # A task a file: by number and not by hash, so none has two, and adaptive execution puts none together.
    last = files.agg(F.max("file_no")).first()[0]
    spread = files.repartitionById((last or 0) + 1, F.col("file_no").cast("int"))
    found = spread.mapInArrow(read, READ)
    out = found.join(F.broadcast(base), "file_no").withColumn("start", F.col("base") + F.col("before"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
