"""Token ids in files of length-delimited binary records, with an index of offsets beside them.

A file is a sequence of records, each followed by one line feed:

    length of the payload   unsigned 64-bit, little-endian
    checksum of the length  unsigned 32-bit, little-endian, masked
    payload                 format number (1 byte), bytes per id (1 byte: 2 or 4), 1 where the
                            document has no id, else 0 (1 byte), five zero bytes,
                            document id (signed 64-bit), ids
    checksum of the payload unsigned 32-bit, little-endian, masked

Checksums are CRC-32, rotated right by 15 bits with a constant added, so that a checksum of data
that holds checksums stays sound. Files follow one another in order of document id.

The task that writes a file writes its index, too: ``kind=index`` holds a text file for each one of
``kind=records``, of the same name, with a line per record: byte offset, length, document id (empty
if NULL), ids, and ids of the file before it. Spark's own writer commits both together, so a lost or
repeated task leaves no torn file and no file without its index. Readers take offsets from the index
and seek; no file is ever loaded whole.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesloom.llm.common import bounded_batches, stage, utf8
from salesloom.llm.tokenizing import PartEncoder, slices, worker_bytes
from salesloom.sources.storage import fresh_path, short_lived_shuffles

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
FILE_BYTES = 48 << 20  # of text, before encoding
READ_BYTES = 32 << 20  # of records that one task reads back
_MASK = 0xA282EAD8
_FORMAT = 1


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload)))
    )


def payload_of(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return struct.pack("<BBB5xq", _FORMAT, width, doc_id is None, doc_id or 0) + ids.astype(f"<u{width}").tobytes()


def read_record(data: bytes | memoryview) -> tuple[int | None, np.ndarray]:
    """(document id, ids) of one whole record with its line feed; checks all of it."""
    length_bytes = bytes(data[:8])
    if len(data) < 17 or struct.unpack_from("<I", data, 8)[0] != masked(length_bytes):
        raise ValueError("broken record length")
    end = 16 + struct.unpack("<Q", length_bytes)[0]
    payload = data[12 : end - 4]
    if len(data) != end + 1 or data[end] != 10 or struct.unpack_from("<I", data, end - 4)[0] != masked(payload):
        raise ValueError("broken record")
    kind, width, without_id, doc_id = struct.unpack_from("<BBB5xq", payload)
    if kind != _FORMAT or width not in (2, 4):
        raise ValueError("unknown record format")
    return None if without_id else doc_id, np.frombuffer(payload[16:], dtype=f"<u{width}")


class IdEncoder(PartEncoder):
    """The library's ids of whole texts, part by part."""

    def __init__(self, path: str, most_bytes: int):
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 1 << 16 else 4
        lengths = np.zeros(size, dtype=np.int64)
        added = self.tokenizer.get_added_tokens_decoder()
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            # In the vocabulary of a byte-level model each character stands for one byte.
            lengths[i] = len(token.encode()) if i in added else len(token)
        super().__init__(most_bytes, lengths, self._fine(), [t.content.encode() for t in added.values()])

    def _fine(self) -> bool:
        """Byte-level pre-tokens by the usual pattern, and no added token that looks beyond itself or holds a blank."""
        own = json.loads(self.tokenizer.to_str())
        first = own["pre_tokenizer"] or {}
        plain = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first["add_prefix_space"]
        apart = not any(
            t["single_word"] or t["lstrip"] or t["rstrip"] or any(map(str.isspace, t["content"])) for t in own["added_tokens"]
        )
        return plain and not own["normalizer"] and apart

    def ids(self, texts: list[str]) -> np.ndarray:
        # One text a call: of several, the library would encode each on a thread of its own.
        found = [self.tokenizer.encode_batch_fast([t], add_special_tokens=False)[0].ids for t in texts]
        return np.fromiter(chain.from_iterable(found), dtype=np.int64)


@lru_cache(maxsize=1)
def _encoder(path: str, most_bytes: int) -> IdEncoder:
    return IdEncoder(path, most_bytes)


def write_records(
    docs: DataFrame,
    folder: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Encode every text, add ``end_id``, and write records and index to ``folder`` by ascending id.

    NULL counts as empty: a record with the end id alone. Rows with a NULL id come first. Repeated
    ids follow each other in the order of their texts. An empty table writes no record.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    most_bytes = worker_bytes(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, offset, before = _encoder(path, most_bytes), 0, 0
        for part in slices(batches, "text"):
            packed = encoder.encode(part.column("text"))
            framed, lines, places = [], [], []
            for doc, data in zip(part.column("doc_id").to_pylist(), packed, strict=True):
                ids = np.append(np.frombuffer(data, "<u4"), np.uint32(end_id))
                framed.append(frame(payload_of(doc, ids, encoder.width)))
                size = len(framed[-1]) + 1
                lines.append(f"{offset},{size},{'' if doc is None else doc},{len(ids)},{before}".encode())
                places.append(offset)
                offset, before = offset + size, before + len(ids)
            for kind, content in (("records", framed), ("index", lines)):
                columns = [pa.array([kind] * len(content)), pa.array(places, pa.int64()), pa.array(content, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["kind", "at", "content"])

    bounded_batches(docs.sparkSession)
    text = utf8(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    ordered = rows.repartitionByRange(size // file_bytes + 1, "doc_id", "text")
    written = ordered.sortWithinPartitions("doc_id", "text").mapInArrow(run, "kind string, at long, content binary")
    # The writer asks for rows sorted by kind; sorting by offset as well keeps the records in order.
    written = written.sortWithinPartitions("kind", "at").select("kind", F.col("content").cast("string"))
    with short_lived_shuffles(docs.sparkSession):
        written.write.partitionBy("kind").option("lineSep", "\n").text(folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index of a folder: file, offset, length, doc_id, n_tokens, start.

    ``start`` counts the ids of all records before it, those of earlier files included. Only index
    files are read. A folder without any record gives no rows.
    """
    if not _has_records(spark, folder):
        return spark.createDataFrame([], "file string, offset long, length long, doc_id long, n_tokens long, start long")
    columns = "offset long, length long, doc_id long, n_tokens long, within long"
    lines = spark.read.schema(columns).csv(f"{folder}/kind=index").select(F.col("_metadata.file_name").alias("file"), "*")
    # One row per file, so this window is as small as the list of files.
    files = lines.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    number = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")
    before = Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return lines.join(stage(files, "files"), "file").select(
        "file", "offset", "length", "doc_id", "n_tokens", (F.col("before") + F.col("within")).alias("start")
    )


def _has_records(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/kind=index")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _open_folder(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of the record files: local, HDFS or an object store, as the folder says."""
    if "://" not in folder and not folder.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), f"{folder}/kind=records"
    if folder.startswith("file:"):  # with one slash or three
        return pyarrow.fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/") + "/kind=records"
    files, path = pyarrow.fs.FileSystem.from_uri(folder)
    return files, f"{path}/kind=records"


def read_records(index: DataFrame, folder: str, *, ids: bool = True) -> DataFrame:
    """The records of the index rows given, in any selection: index columns, ``ids_crc32`` and ``ids``.

    Each row is read by seeking to its offset, and its framing, checksums, document id and count are
    checked; what doesn't fit raises. ``ids_crc32`` is of the ids as little-endian unsigned 32-bit
    integers. Rows keep their partitions and order, so index rows as read give sequential reads.
    """
    names = ["file", "offset", "length", "doc_id", "n_tokens", "start"]
    schema = "file string, offset long, length long, doc_id long, n_tokens long, start long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _encoder.cache_clear()  # workers are used again; what they learnt while writing has no use here
        files, root = _open_folder(folder)
        opened, source = None, None
        for batch in batches:
            for part in slices([batch], "length", by_value=True):
                crcs, found = [], []
                columns = [part.column(c).to_pylist() for c in names[:5]]
                for name, offset, length, doc_id, n in zip(*columns, strict=True):
                    if name != opened:
                        if source is not None:
                            source.close()
                        opened, source = name, files.open_input_file(f"{root}/{name}")
                    own, tokens = read_record(source.read_at(length, offset))
                    if own != doc_id or len(tokens) != n:
                        raise ValueError(f"{name} has another record at byte {offset} than its index says")
                    crcs.append(zlib.crc32(tokens.astype("<u4")))
                    if ids:
                        found.append(tokens.astype("int32"))
                out = [*(part.column(c) for c in names), pa.array(crcs, pa.int64())]
                if ids:
                    out.append(pa.array(found, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, [*names, "ids_crc32", "ids"][: len(out)])
        if source is not None:
            source.close()

    bounded_batches(index.sparkSession)
    return index.select(*names).mapInArrow(run, schema + ", ids array<int>" * ids)


def token_records(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` to a new folder of record files, and read every record back by its index."""
    folder = fresh_path(docs.sparkSession, "records")
    write_records(docs, folder, **options)
    index = stage(read_index(docs.sparkSession, folder), "record-index")
    # Index rows are small beside their records, so they are dealt out by the bytes they stand for.
    size = index.agg(F.sum("length").alias("n")).first()["n"] or 0
    dealt = index.repartitionByRange(size // READ_BYTES + 1, "start").sortWithinPartitions("start")
    return read_records(dealt, folder, ids=False)
