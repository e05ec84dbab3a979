"""Token ids in Parquet files made for selective reads (operator 10).

Each file holds documents in ascending id order: ``doc_id``, ``start`` (ids
before it in the file) and ``n_tokens`` delta-encoded, and the ids as a list
column with dictionary encoding, in row groups of bounded size, with small
pages and a page index.  A manifest (one row a file) gives the files that
were committed and the ids before each, so a metadata read never touches the
id column and a filter on ``doc_id`` skips row groups and pages.

Null or empty texts give the end id alone.  Null ids sort first; equal ids
are ordered by a hash of the text; other columns are ignored.  An empty table gives no file
and empty reads.  A retried task writes another file name, and only names in
the manifest are read.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm import storage, textkit
from cohortlens.llm.bpe_text import LibraryEncoder, task_done, worker_encoder
from cohortlens.llm.storage import open_fs

FILE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                         ("ids", pa.list_(pa.field("element", pa.int32(), False)))])
GROUP_TOKENS = 1 << 20


def write_token_files(docs: DataFrame, folder: str, tokenizer_json: str, end_id: int = 1,
                      id_col: str = "doc_id", text_col: str = "text",
                      group_tokens: int = GROUP_TOKENS, page_bytes: int = 64 << 10) -> DataFrame:
    """Encode every document and write the files; returns the manifest."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(tokenizer_json)
    data = f"{folder}/tokens"

    def write(batches):
        import pyarrow.parquet as pq
        from pyspark import TaskContext
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.parquet"
        fs, path = open_fs(data)
        encoder = worker_encoder(LibraryEncoder, model.value)
        writer, held, n_held, start, docs_done = None, [], 0, 0, 0

        def flush():
            nonlocal held, n_held
            writer.write_table(pa.Table.from_batches(held), row_group_size=1 << 30)
            held, n_held = [], 0

        for batch in batches:
            for part in textkit.row_blocks(batch, "text", 2 << 20):
                if writer is None:
                    fs.create_dir(path, recursive=True)
                    out = fs.open_output_stream(f"{path}/{name}")
                    writer = pq.ParquetWriter(
                        out, FILE_SCHEMA, compression="zstd", write_page_index=True, data_page_size=page_bytes,
                        use_dictionary=["ids.list.element"], dictionary_pagesize_limit=4 << 20,
                        column_encoding={c: "DELTA_BINARY_PACKED" for c in ("doc_id", "start", "n_tokens")})
                flat, at = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                flat = np.insert(flat, at[1:], end_id)
                at = at + np.arange(len(at))
                held.append(pa.record_batch([part.column(0), pa.array(start + at[:-1]), pa.array(np.diff(at)),
                                             pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat),
                                                                      type=FILE_SCHEMA.field("ids").type)],
                                            schema=FILE_SCHEMA))
                start, docs_done, n_held = start + int(at[-1]), docs_done + part.num_rows, n_held + int(at[-1])
                if n_held >= group_tokens:
                    flush()
        if writer is not None:
            if held:
                flush()
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([task.partitionId()], pa.int32()), "file": [name],
                                              "n_docs": [docs_done], "file_tokens": [start]})
        task_done()

    # the range's sample of keys goes to the driver, so a hash stands for the text
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
               .withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h")
               .sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text"))
    manifest = ordered.mapInArrow(write, "part int, file string, n_docs long, file_tokens long")
    return storage.stage(manifest, folder, "manifest")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row a file, with ``base``: the ids in all files before it (one row a file, so one task sums them)."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.parquet(f"{folder}/manifest").withColumn("base", F.coalesce(F.sum("file_tokens").over(before), F.lit(0)))


def read_token_files(spark: SparkSession, folder: str, columns: tuple = ("doc_id", "start", "n_tokens", "ids"),
                     where=None) -> DataFrame:
    """Rows of the files with ``part_file``; only the named columns are read, and ``where`` reaches the page index."""
    schema = "doc_id long, start long, n_tokens long, ids array<int>"
    if spark.read.parquet(f"{folder}/manifest").isEmpty():
        rows = spark.createDataFrame([], schema + ", part_file string")
    else:
        rows = spark.read.schema(schema).parquet(f"{folder}/tokens").withColumn("part_file", F.col("_metadata.file_name"))
    rows = rows if where is None else rows.where(where)
    return rows.select(*columns, "part_file")


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start over all documents, n_tokens, ids_crc32."""
    def digest(batches):
        for b in batches:
            lists = b.column(3)
            at = np.asarray(lists.offsets)
            flat = np.asarray(lists.values).astype("<u4")
            crc = np.fromiter((zlib.crc32(flat[at[i]:at[i + 1]].tobytes()) for i in range(len(at) - 1)), np.int64, len(at) - 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(crc), b.column(4)],
                                             names=["doc_id", "local_start", "n_tokens", "ids_crc32", "part_file"])

    rows = read_token_files(spark, folder).mapInArrow(
        digest, "doc_id long, local_start long, n_tokens long, ids_crc32 long, part_file string")
    files = read_manifest(spark, folder).select(F.col("file").alias("part_file"), "base")
    return rows.join(files, "part_file").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"),
                                                "n_tokens", "ids_crc32")


def tokenizer_text(path: str) -> str:
    with open(os.fspath(path), encoding="utf-8") as f:
        return f.read()
