"""Token-id files: one zstandard frame per document under a shared dictionary.

A folder holds `dictionary`, shard files and `manifest.json`. A shard is its frames, then an index
row (doc_id, has doc_id, frame offset, frame bytes, tokens) per document, then a footer (index
offset, documents, tokens, hash of the dictionary, magic). Shards and their documents are in
ascending doc_id order, a null doc_id first, so a document is found by two binary searches and one
small read. The manifest alone says which shards count: what a lost or repeated task left behind
isn't in it.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from tillstream.llm.common import small_batches
from tillstream.llm.tokens import default_path, encoder
from tillstream.session import work_dir

END_ID = 0
# The dictionary serves short documents: it is trained on at most so many of at most so many
# characters, those with the smallest hash of their text.
TRAIN_DOCS, TRAIN_CHARS, DICTIONARY_BYTES = 1_024, 20_000, 65_536
LEVEL = 3
MAGIC = b"TOKZ0001"
INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("at", "<u8"), ("bytes", "<u4"), ("tokens", "<u8")])
FOOTER = struct.Struct("<QQQ32s8s")


def _trained(path: str, end_id: int, size: int):
    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        texts = [t for b in batches for t in b["text"]]
        end = int(end_id).to_bytes(4, "little")
        samples = [x + end for x in encoder(path).encode(texts)]
        try:
            data = zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:  # too little to learn from: frames without a dictionary
            data = b""
        yield pd.DataFrame({"data": [data]})
    return train


def train_dictionary(texts: DataFrame, path: str, end_id: int = END_ID, size: int = DICTIONARY_BYTES) -> bytes:
    """Dictionary bytes from the bounded sample; empty where there is too little to learn from."""
    sample = (texts.where(F.length("text") <= TRAIN_CHARS)
              .orderBy(F.xxhash64("text"), "text").limit(TRAIN_DOCS).select("text").coalesce(1))
    found = sample.mapInPandas(_trained(path, end_id, size), "data binary").collect()
    return bytes(found[0]["data"]) if found else b""


def _compression(data: bytes):
    import zstandard
    given = {"dict_data": zstandard.ZstdCompressionDict(data)} if data else {}
    return zstandard.ZstdCompressor(level=LEVEL, **given), zstandard.ZstdDecompressor(**given)


def _place(path: str) -> tuple[FileSystem, str]:
    return FileSystem.from_uri(path)


def _read(fs: FileSystem, path: str) -> bytes:
    with fs.open_input_file(path) as f:
        return f.read()


def _write(fs: FileSystem, path: str, data: bytes) -> None:
    with fs.open_output_stream(path, compression=None) as f:
        f.write(data)


@dataclass
class Shard(WriterCommitMessage, InputPartition):
    """One file: its place among the files, and what it holds."""
    order: int
    name: str
    docs: int
    tokens: int
    start: int = 0


class TokenWriter(DataSourceArrowWriter):
    def __init__(self, path: str, tokenizer: str, end_id: int):
        self.path, self.tokenizer, self.end = path, tokenizer, int(end_id).to_bytes(4, "little")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Shard:
        fs, folder = _place(self.path)
        data = _read(fs, f"{folder}/dictionary")
        compressor = _compression(data)[0]
        order = TaskContext.get().partitionId()
        name = f"shard-{order:06d}-{uuid.uuid4().hex[:12]}"  # another name for each attempt
        index, at, tokens = [], 0, 0
        with fs.open_output_stream(f"{folder}/{name}", compression=None) as out:
            rows = ((d, t.as_py()) for b in iterator for d, t in zip(b.column("doc_id").to_pylist(), b.column("text")))
            for doc_id, ids in encoder(self.tokenizer).encode_rows(rows):
                ids += self.end
                frame = compressor.compress(ids)
                out.write(frame)
                index.append((doc_id or 0, doc_id is not None, at, len(frame), len(ids) // 4))
                at += len(frame)
                tokens += len(ids) // 4
            out.write(np.array(index, dtype=INDEX).tobytes())
            out.write(FOOTER.pack(at, len(index), tokens, hashlib.sha256(data).digest(), MAGIC))
        return Shard(order, name, len(index), tokens)

    def commit(self, messages: list[Shard]) -> None:
        fs, folder = _place(self.path)
        kept = sorted((m for m in messages if m and m.docs), key=lambda m: m.order)
        rows = [{"name": m.name, "docs": m.docs, "tokens": m.tokens} for m in kept]
        _write(fs, f"{folder}/manifest.json", json.dumps({"shards": rows}).encode())

    def abort(self, messages: list[Shard]) -> None:
        """Nothing to undo: files count only once the manifest names them."""


class TokenReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Shard]:
        return shards(self.path) or [Shard(0, "", 0, 0)]

    def read(self, partition: Shard) -> Iterator[tuple]:
        if not partition.name:
            return
        fs, folder = _place(self.path)
        decompressor = _compression(_read(fs, f"{folder}/dictionary"))[1]
        start = partition.start
        with fs.open_input_file(f"{folder}/{partition.name}") as f:
            for row in _index(fs, folder, f):
                ids = _ids(f, row, decompressor)
                yield (int(row["doc_id"]) if row["has_id"] else None, start, len(ids) // 4, ids)
                start += len(ids) // 4


class TokenFiles(DataSource):
    """The folder as a Spark source, of rows (doc_id, start, n_tokens, ids), and sink, of (doc_id, text)."""

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema) -> TokenReader:
        return TokenReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        return TokenWriter(self.options["path"], self.options["tokenizer"], int(self.options["end_id"]))


def shards(path: str) -> list[Shard]:
    """The files that count, in order, each with the number of tokens before it."""
    fs, folder = _place(path)
    found, start = [], 0
    for k, x in enumerate(json.loads(_read(fs, f"{folder}/manifest.json"))["shards"]):
        found.append(Shard(k, x["name"], x["docs"], x["tokens"], start))
        start += x["tokens"]
    return found


def _index(fs: FileSystem, folder: str, f) -> np.ndarray:
    size = f.size()
    f.seek(size - FOOTER.size)
    at, docs, _, digest, magic = FOOTER.unpack(f.read(FOOTER.size))
    if magic != MAGIC or digest != hashlib.sha256(_read(fs, f"{folder}/dictionary")).digest():
        raise ValueError("not a token file of this folder's dictionary")
    f.seek(at)
    return np.frombuffer(f.read(docs * INDEX.itemsize), dtype=INDEX)


def _ids(f, row, decompressor) -> bytes:
    f.seek(int(row["at"]))
    return decompressor.decompress(f.read(int(row["bytes"])), max_output_size=4 * int(row["tokens"]))


def document(path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents of this doc_id, by the offset index alone."""
    fs, folder = _place(path)
    decompressor = _compression(_read(fs, f"{folder}/dictionary"))[1]
    found = []
    for shard in shards(path):
        with fs.open_input_file(f"{folder}/{shard.name}") as f:
            index = _index(fs, folder, f)
            index = index[index["has_id"] == 1]
            low, high = (np.searchsorted(index["doc_id"], doc_id, s) for s in ("left", "right"))
            found += [np.frombuffer(_ids(f, row, decompressor), "<u4") for row in index[low:high]]
        if len(index) and index["doc_id"][-1] > doc_id:
            break
    return found


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Write the ids of every document, the end id after each, in ascending doc_id order.

    Reads doc_id and text, whatever else the table has. A null text has only the end id; a null
    doc_id sorts first; rows with the same doc_id stand in the order of their texts; an empty
    table gives a folder without shards.
    """
    tokenizer = tokenizer or default_path()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    fs, folder = _place(path)
    fs.create_dir(folder, recursive=True)
    _write(fs, f"{folder}/dictionary", train_dictionary(texts, tokenizer, end_id))
    small_batches(docs.sparkSession)
    docs.sparkSession.dataSource.register(TokenFiles)
    (texts.withColumn("tie", F.xxhash64("text"))
     .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
     .select("doc_id", "text")
     .write.format("token_files").options(tokenizer=tokenizer, end_id=end_id).mode("append").save(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the folder: doc_id, start (tokens before it), n_tokens, ids."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").load(path)


def fresh_folder(spark: SparkSession) -> str:
    """A new folder below the shared work folder, as a URL."""
    path = work_dir(spark, "llm-token-files")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
