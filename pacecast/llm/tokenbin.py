"""Token files: Arrow IPC files of fixed-size-list rows, so that row i is found by arithmetic and read without a copy.

Layout of a folder: `part-N.arrow` holds rows `ids` (fixed_size_list<uint16 or uint32>[row_length]) and `mask`
(fixed_size_list<bool>[row_length]); every record batch but a file's last has `batch_rows` rows. The ids of a file's
documents follow each other without gaps, the end id after each; only the last row is padded, with mask false there.
`part-N.docs.arrow` lists the file's documents: doc_id, start (within the file), n_tokens. N ascends with doc_id.

Null text counts as empty (the end id alone). Null doc_ids sort first. Repeated rows each keep their own ids; equal
doc_ids are ordered by a hash of the text, then the text, and may span files, so that null or repeated ids do not meet
in one task. A text stays whole, however long: its ids follow each other over as many rows as they need. An empty table
makes no files and no rows. Other columns of the documents are not read.
"""

from __future__ import annotations

import zlib
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs, ipc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacecast.llm.common import rows_for, scratch, small_batches, staged, texts_of
from pacecast.llm.wordcache import word_cache

ROW_LENGTH = 2048
BATCH_ROWS = 256
FILE_BYTES = 64 << 20  # of text
MANIFEST = "file_no int, file string, n_docs long, n_tokens long"
DOC_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or plain path; tasks reach the shared folder through it."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if urlparse(uri).scheme == "file":
        return fs.LocalFileSystem(), urlparse(uri).path
    return fs.FileSystem.from_uri(uri)


def row_schema(dtype: np.dtype, row_length: int) -> pa.Schema:
    return pa.schema(
        [("ids", pa.list_(pa.from_numpy_dtype(dtype), row_length)), ("mask", pa.list_(pa.bool_(), row_length))]
    )


class RowWriter:
    """Packs ids into rows and writes one token file with its list of documents, in place only when complete."""

    def __init__(self, folder: str, name: str, attempt: str, dtype: np.dtype, row_length: int, batch_rows: int):
        self.store, self.folder = _open(folder)
        self.name, self.dtype, self.row_length, self.batch_ids = name, dtype, row_length, row_length * batch_rows
        self.store.create_dir(self.folder, recursive=True)
        self.unfinished = f"{self.folder}/_unfinished-{name}-{attempt}"
        self.sink = self.store.open_output_stream(self.unfinished)
        self.rows = ipc.new_file(self.sink, row_schema(dtype, row_length))
        self.held, self.n_held, self.docs, self.n_tokens = [], 0, [], 0

    def add(self, doc_id: int | None, packed: bytes) -> None:
        ids = np.frombuffer(packed, self.dtype)
        self.docs.append((doc_id, self.n_tokens, len(ids)))
        self.n_tokens += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.batch_ids:
            whole = np.concatenate(self.held)
            full = len(whole) // self.batch_ids * self.batch_ids
            for at in range(0, full, self.batch_ids):
                self._batch(whole[at : at + self.batch_ids], self.batch_ids)
            self.held, self.n_held = [whole[full:].copy()], len(whole) - full

    def _batch(self, ids: np.ndarray, valid: int) -> None:
        mask = np.zeros(len(ids), bool)
        mask[:valid] = True
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.row_length) for x in (ids, mask)]
        self.rows.write_batch(pa.RecordBatch.from_arrays(columns, names=["ids", "mask"]))

    def close(self) -> str:
        rest = np.concatenate(self.held) if self.held else np.zeros(0, self.dtype)
        if len(rest):
            padded = np.zeros(-(-len(rest) // self.row_length) * self.row_length, self.dtype)
            padded[: len(rest)] = rest
            self._batch(padded, len(rest))
        self.rows.close()
        self.sink.close()
        columns = [pa.array(c, t.type) for c, t in zip(zip(*self.docs), DOC_SCHEMA)]
        listing = f"{self.unfinished}.docs"
        with self.store.open_output_stream(listing) as sink, ipc.new_file(sink, DOC_SCHEMA) as out:
            for b in pa.Table.from_arrays(columns, schema=DOC_SCHEMA).to_batches(max_chunksize=65_536):
                out.write_batch(b)
        final = f"{self.folder}/{self.name}"
        self.store.move(listing, f"{final}.docs.arrow")
        self.store.move(self.unfinished, f"{final}.arrow")
        return final


class TokenFile:
    """Random access to a token file: `file[i]` is (ids, mask) of row i, views into the mapped file where it is local.

    ids is a numpy array. mask is an Arrow array, as the file holds it in bits, which numpy cannot view.
    """

    def __init__(self, path: str):
        store, name = _open(path)
        local = isinstance(store, fs.LocalFileSystem)
        self.source = pa.memory_map(f"{name}.arrow") if local else store.open_input_file(f"{name}.arrow")
        self.reader = ipc.open_file(self.source)
        with store.open_input_file(f"{name}.docs.arrow") as listing:
            self.docs = ipc.open_file(listing).read_all()
        self.row_length = self.reader.schema.field("ids").type.list_size
        self.batch_rows = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 0

    def __len__(self) -> int:
        n = self.reader.num_record_batches
        return (n - 1) * self.batch_rows + self.reader.get_batch(n - 1).num_rows if n else 0

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= i < len(self):
            raise IndexError(i)
        batch, at = self.reader.get_batch(i // self.batch_rows), (i % self.batch_rows) * self.row_length
        ids = batch.column(0).flatten().slice(at, self.row_length).to_numpy()
        return ids, batch.column(1).flatten().slice(at, self.row_length)

    def batches(self):
        """(ids, valid ids in it) of each record batch, in file order."""
        for k in range(self.reader.num_record_batches):
            batch = self.reader.get_batch(k)
            yield batch.column(0).flatten().to_numpy(), pc.sum(batch.column(1).flatten()).as_py() or 0

    def documents(self):
        """(doc_id, start in the file, n_tokens, crc32 of the ids as little-endian uint32) of each document."""
        sizes = self.docs.column("n_tokens").to_numpy()
        crc, done, at = 0, 0, 0
        out = np.zeros(len(sizes), np.int64)
        for ids, valid in self.batches():
            ids = ids[:valid].astype("<u4")
            taken = 0
            while taken < valid:
                n = int(min(sizes[at] - done, valid - taken))
                crc = zlib.crc32(ids[taken : taken + n], crc)
                taken, done = taken + n, done + n
                if done == sizes[at]:
                    out[at] = crc
                    crc, done, at = 0, 0, at + 1
        if at != len(sizes):
            raise ValueError(f"the rows end after {at} of {len(sizes)} documents")
        return self.docs.append_column("ids_crc32", pa.array(out))


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, row_length: int = ROW_LENGTH, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Encode all documents in ascending doc_id order into token files below `path`; returns their manifest.

    One shuffle moves the texts into ranges of doc_id; a task encodes its range as it streams by and writes one file.
    A repeated task writes the same file again under its own name first, so a lost executor leaves no half files.
    """
    spark, texts = docs.sparkSession, texts_of(docs)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = min(spark.sparkContext.defaultParallelism, 1 + total // (1 << 20))
    parts = rows_for(total, file_bytes, least=least)

    def write(batches):
        from pyspark import TaskContext

        task, cache, writer = TaskContext.get(), word_cache(tokenizer), None
        end = np.array([end_id], cache.dtype).tobytes()
        for batch in small_batches(batches):
            if writer is None:
                name, attempt = f"part-{task.partitionId():05d}", str(task.taskAttemptId())
                writer = RowWriter(path, name, attempt, cache.dtype, row_length, BATCH_ROWS)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, packed in zip(batch.column("doc_id").to_pylist(), cache.encode(texts)):
                writer.add(doc_id, packed + end)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "file_no": pa.array([task.partitionId()], pa.int32()),
                    "file": [f"{path}/{name}"],
                    "n_docs": [len(writer.docs)],
                    "n_tokens": [writer.n_tokens],
                }
            )

    # The row's number parts wholly equal rows, whose order shows nowhere.
    told = texts.select("*", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    ranged = told.repartitionByRange(parts, "doc_id", "_hash", "_row").sortWithinPartitions("doc_id", "_hash", "text")
    ranged = ranged.select("doc_id", "text")
    return staged(ranged.mapInArrow(write, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of each document, from the files alone."""
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    placed = manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    parts = max(1, manifest.count())

    def read(batches):
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                found = TokenFile(name).documents()
                at = found.schema.get_field_index("start")
                found = found.set_column(at, "start", pc.add(found.column("start"), base))
                yield from found.to_batches(max_chunksize=65_536)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return placed.repartition(parts).mapInArrow(read, schema)


def token_files(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write the files and read every document back from them."""
    path = path or scratch(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, path, tokenizer, end_id))
