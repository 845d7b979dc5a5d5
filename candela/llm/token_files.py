"""Token ids in binary shard files of independent zstandard frames with a trailing seek table.

File format (all integers little-endian, unsigned 32-bit unless said otherwise):

* one zstandard frame per document: its token ids, with the end id, as 32-bit integers;
* one skippable frame with the seek table: magic 0x184D2A5E and the payload's length; per frame its
  compressed size, decompressed size and checksum (low 32 bits of the xxh64 of the decompressed bytes);
  then the number of frames, a descriptor byte (bit 7: checksums present) and magic 0x8F92EAB1.

This is the layout of seekable zstandard files, so any zstandard reader can read a whole shard as well. A
reader fetches the last nine bytes, the table, and then only the frames of the documents it wants.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm.common import ship, shared_folder, slices, texts
from candela.llm.tokens import tokenizer_path, word_ids, words_of

END_ID = 1
LEVEL = 3
# Fixed values of the format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<III")


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path for a URI (file, hdfs, s3, gs ...) or a plain path."""
    return pafs.FileSystem.from_uri(path)


class ShardWriter:
    """Writes one shard under a name of its own attempt; ``close`` moves it to its place, so a task that is
    run again, or twice at once, leaves one complete file with the same bytes."""

    def __init__(self, path: str, level: int = LEVEL):
        self.fs, self.path = _open(path)
        self.temporary = f"{self.path}.{np.random.default_rng().integers(1 << 62):x}.part"
        self.out = self.fs.open_output_stream(self.temporary)
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.entries = bytearray()

    def write(self, payload: bytes) -> None:
        frame = self.compressor.compress(payload)
        self.out.write(frame)
        self.entries += ENTRY.pack(len(frame), len(payload), xxhash.xxh64_intdigest(payload) & 0xFFFFFFFF)

    def close(self) -> None:
        frames = len(self.entries) // ENTRY.size
        table = bytes(self.entries) + FOOTER.pack(frames, 0x80, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()
        self.fs.move(self.temporary, self.path)


class ShardReader:
    """Random access to the documents of a shard."""

    def __init__(self, path: str):
        fs, inner = _open(path)
        self.file = fs.open_input_file(inner)
        size = self.file.size()
        frames, flags, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flags & 0x80:
            raise ValueError(f"{path}: no seek table")
        table = np.frombuffer(self._at(size - FOOTER.size - frames * ENTRY.size, frames * ENTRY.size), "<u4").reshape(-1, 3)
        self.sizes, self.lengths, self.checks = table[:, 0].astype(np.int64), table[:, 1].astype(np.int64), table[:, 2]
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        self.decompressor = zstandard.ZstdDecompressor()

    def _at(self, offset: int, n: int) -> bytes:
        self.file.seek(int(offset))
        return self.file.read(int(n))

    def __len__(self) -> int:
        return len(self.sizes)

    def read(self, i: int) -> np.ndarray:
        """Token ids of document ``i`` of the shard; its checksum is verified."""
        payload = self.decompressor.decompress(self._at(self.offsets[i], self.sizes[i]), max_output_size=max(1, int(self.lengths[i])))
        if len(payload) != self.lengths[i] or xxhash.xxh64_intdigest(payload) & 0xFFFFFFFF != int(self.checks[i]):
            raise ValueError(f"frame {i}: checksum or length differs")
        return np.frombuffer(payload, "<u4")

    def close(self) -> None:
        self.file.close()


def write_shards(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID, id_column: str = "doc_id", text_column: str = "text", shards: int | None = None) -> DataFrame:
    """Encode every whole text and write it in ascending id order (null ids first); one shard per task.

    Null counts as empty: such a document has its end id alone. Rows with equal ids follow one another.
    Gives the manifest, one row per shard: shard, path, doc_ids, n_docs, n_ids.
    """
    spark = docs.sparkSession
    ship(spark)
    path = tokenizer or tokenizer_path()
    end = struct.pack("<I", end_id)
    fs, inner = _open(folder)
    fs.create_dir(inner, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memo, shard = word_ids(path), TaskContext.get().partitionId()
        target, writer, ids, total = f"{folder}/shard-{shard:06d}.zst", None, [], 0
        for batch in batches:
            for start, stop in slices(batch):
                part = texts(batch, start, stop)
                if part and writer is None:
                    writer = ShardWriter(target)
                for text in part:
                    payload = b"".join(memo.ids(words_of(text))) + end
                    writer.write(payload)
                    total += len(payload) // 4
                ids.extend(batch.column("doc_id").slice(start, stop - start).to_pylist())
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([target]), pa.array([ids], pa.list_(pa.int64())), pa.array([len(ids)], pa.int64()), pa.array([total], pa.int64())],
                names=["shard", "path", "doc_ids", "n_docs", "n_ids"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    rows = rows.repartitionByRange(shards, "doc_id") if shards else rows.repartitionByRange("doc_id")
    manifest = rows.sortWithinPartitions("doc_id").mapInArrow(write, "shard long, path string, doc_ids array<long>, n_docs long, n_ids long")
    where = f"{folder}/manifest"
    manifest.write.mode("overwrite").parquet(where)
    return spark.read.parquet(where)


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, one row per document, read back
    from the files. Only (shard, n_ids) of the manifest reaches the driver."""
    spark = manifest.sparkSession
    starts, total = [], 0
    for r in manifest.select("shard", "n_ids").orderBy("shard").collect():
        starts.append((r["shard"], total))
        total += r["n_ids"]
    bases = F.broadcast(spark.createDataFrame(starts, "shard long, base long"))  # a row per shard file

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = ShardReader(row["path"])
                if len(reader) != len(row["doc_ids"]):
                    raise ValueError(f"{row['path']}: {len(reader)} frames, {len(row['doc_ids'])} documents")
                n, crc = [], []
                for i in range(len(reader)):
                    ids = reader.read(i)
                    n.append(len(ids))
                    crc.append(zlib.crc32(ids.tobytes()))
                reader.close()
                start = row["base"] + np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array([row["path"]] * len(n))], names=["doc_id", "start", "n_tokens", "ids_crc32", "path"])

    files = manifest.select("shard", "path", "doc_ids").join(bases, "shard")
    width = max(1, min(len(starts), 10_000))
    return files.repartition(width, "shard").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, path string")


def token_files(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the documents' ids in shard files and read them back: see ``write_shards`` and ``read_shards``.
    An empty table gives no files and an empty result. Extra columns are not read."""
    folder = folder or shared_folder(docs.sparkSession, "token-files")
    return read_shards(write_shards(docs, folder, **options))


def read_documents(path: str, wanted: list[int]) -> dict[int, np.ndarray]:
    """Ids of some documents of one shard, by position; other frames are not fetched."""
    reader = ShardReader(path)
    try:
        return {i: reader.read(i) for i in wanted}
    finally:
        reader.close()


def open_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/manifest")
