"""Token ids of a corpus in flat binary files.

Layout below one folder: ``ids/*.bin`` flat little-endian unsigned integers (16 bit if the vocabulary fits, else 32);
``offsets/*.bin`` for the same documents 64-bit start positions in the whole corpus, one more than documents;
``docs`` and ``manifest`` Parquet tables that name, per document and per file, where it is. Documents are in
ascending id order over the files in partition order.

A task writes a file under a name of its own attempt and reports it in its rows; only reported files are in the
manifest. So a task that runs again, or twice, leaves at most a file that nobody reads.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.texts import filled, ragged, slices, words_of

_TOKENIZERS: dict[str, object] = {}


def tokenizer_at(path: str):
    """The tokenizer of the file, loaded once per worker process."""
    if path not in _TOKENIZERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


def id_type(path: str, end_id: int) -> str:
    """The smallest flat type that holds every id."""
    return "<u2" if max(tokenizer_at(path).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


#: Words kept encoded per worker process, in each of two generations; only the time depends on it.
KEPT_WORDS = 300_000
_WORD_IDS: dict[str, tuple[dict, dict]] = {}


def _word_ids(path: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words one after the other, and the number of each; words met lately are not encoded again."""
    new, old = _WORD_IDS.get(path, ({}, {}))
    got = list(map(new.get, words))
    unknown = []
    for i in [i for i, ids in enumerate(got) if ids is None]:
        ids = old.get(words[i])
        if ids is None:
            unknown.append(i)
        else:
            got[i] = new[words[i]] = ids
    texts = [words[i] for i in unknown]
    for i, w, e in zip(unknown, texts, tokenizer_at(path).encode_batch_fast(texts, add_special_tokens=False)):
        got[i] = new[w] = array("I", e.ids).tobytes()
    _WORD_IDS[path] = ({}, new) if len(new) > KEPT_WORDS else (new, old)
    size = np.fromiter(map(len, got), np.int64, len(got)) // array("I").itemsize
    return np.frombuffer(b"".join(got), np.uintc).astype(np.int64), size


def encode_texts(texts: pa.Array, path: str, by_word: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and the number of each.

    ``by_word``: encode each distinct word once. Only for tokenizers that lower-case, drop white space and never join
    characters across it; then the ids are those of the whole text.
    """
    tokenizer = tokenizer_at(path)
    if not by_word:
        got = [e.ids for e in tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        lengths = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for ids in got for i in ids), np.int64, int(lengths.sum())), lengths
    found = words_of(texts, lower=True)
    flat, size = _word_ids(path, found.vocabulary.to_pylist())
    starts = np.cumsum(size) - size
    ids = flat[ragged(starts[found.codes], size[found.codes])] if len(found.codes) else flat[:0]
    before = np.concatenate(([0], np.cumsum(size[found.codes])))
    return ids, np.diff(before[found.bounds])


def _with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(lengths + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.int64)
    keep = np.ones(len(out), bool)
    keep[ends - 1] = False
    out[keep] = ids
    return out, lengths + 1


def _files(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, by_word: bool = False, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encodes every row's whole text, appends ``end_id`` and writes the files; returns the manifest, one row per file.

    ``folder`` must be reachable for driver and executors through a file system that pyarrow knows (file, hdfs, s3,
    gs). NULL and empty texts are one ``end_id``. Rows come in ascending id order, NULL ids first, equal ids by the
    hash of their text and their text; equal rows stay as often as they come. Other columns are not read. An empty
    table gives an empty manifest.
    """
    spark = docs.sparkSession
    dtype = id_type(tokenizer_path, end_id)
    kind = docs.schema[doc_id].dataType.simpleString()
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = picked.repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, fs, seq, out = task.partitionId(), None, 0, None
        name = f"ids/part-{part:07d}-{task.taskAttemptId()}.bin"
        try:
            for batch in batches:
                for rows in slices(batch, "text"):
                    if out is None:
                        fs, root = _files(folder)
                        fs.create_dir(f"{root}/ids", recursive=True)
                        out = fs.open_output_stream(f"{root}/{name}")
                    ids, lengths = _with_end(*encode_texts(filled(rows.column("text")), tokenizer_path, by_word), end_id)
                    out.write(ids.astype(dtype).tobytes())
                    n = len(lengths)
                    yield pa.record_batch(
                        [pa.array(np.full(n, part)), pa.array([name] * n, pa.string()), pa.array(np.arange(seq, seq + n)), rows.column("doc_id"), pa.array(lengths)],
                        names=["part", "file", "seq", "doc_id", "n_tokens"],
                    )
                    seq += n
        finally:
            if out is not None:
                out.close()

    ordered.mapInArrow(write, f"part long, file string, seq long, doc_id {kind}, n_tokens long").write.parquet(f"{folder}/docs")
    written = token_docs(spark, folder)
    # one row per file: the bases of the partitions are the sums of all files before
    parts = written.groupBy("part", "file").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def offsets(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("seq")
        base = rows.column("base")[0].as_py()
        starts = base + np.concatenate(([0], np.cumsum(rows.column("n_tokens").to_numpy())))
        fs, root = _files(folder)
        name = rows.column("file")[0].as_py().replace("ids/", "offsets/", 1)
        fs.create_dir(f"{root}/offsets", recursive=True)
        with fs.open_output_stream(f"{root}/{name[:-4]}-{TaskContext.get().taskAttemptId()}.bin") as out:
            out.write(starts.astype("<i8").tobytes())
        done = {"part": key[0].as_py(), "ids_file": rows.column("file")[0].as_py(), "offsets_file": f"{name[:-4]}-{TaskContext.get().taskAttemptId()}.bin"}
        done |= {"base": int(base), "n_docs": rows.num_rows, "n_tokens": int(starts[-1] - base), "id_type": dtype}
        return pa.Table.from_pylist([done])

    joined = written.select("part", "file", "seq", "n_tokens").join(based.select("part", "base"), "part")
    manifest = joined.groupBy("part").applyInArrow(offsets, "part long, ids_file string, offsets_file string, base long, n_docs long, n_tokens long, id_type string")
    manifest.write.parquet(f"{folder}/manifest")
    return token_manifest(spark, folder)


def token_manifest(spark, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/manifest")


def token_docs(spark, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/docs")


def _mapped(uri: str, dtype: str) -> np.ndarray:
    fs, path = _files(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype=dtype)


def read_token_files(spark, folder: str) -> DataFrame:
    """Per document, from the files alone: ``part``, ``seq``, ``start`` in the corpus and ``ids``; one task per file at most."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = _mapped(f"{folder}/{row['ids_file']}", row["id_type"])
                starts = np.asarray(_mapped(f"{folder}/{row['offsets_file']}", "<i8"))
                for at in range(0, row["n_docs"], 1024):
                    some = starts[at : min(at + 1024, row["n_docs"]) + 1]
                    flat = np.asarray(ids[some[0] - row["base"] : some[-1] - row["base"]]).astype(np.int32)
                    n = len(some) - 1
                    lists = pa.ListArray.from_arrays(pa.array((some - some[0]).astype(np.int32)), pa.array(flat))
                    yield pa.record_batch([pa.array(np.full(n, row["part"])), pa.array(np.arange(at, at + n)), pa.array(some[:-1]), lists], names=["part", "seq", "start", "ids"])

    return _by_file(spark, folder).mapInArrow(read, "part long, seq long, start long, ids array<int>")


def _by_file(spark, folder: str) -> DataFrame:
    return token_manifest(spark, folder).repartition("part")


def token_file_digests(spark, folder: str) -> DataFrame:
    """Per document: ``doc_id``, ``start``, ``n_tokens`` and the CRC-32 of its ids as little-endian 32-bit integers, read from the files."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = _mapped(f"{folder}/{row['ids_file']}", row["id_type"])
                starts = np.asarray(_mapped(f"{folder}/{row['offsets_file']}", "<i8"))
                local = starts - row["base"]
                crc = np.fromiter((zlib.crc32(np.asarray(ids[a:b]).astype("<u4").tobytes()) for a, b in zip(local[:-1], local[1:])), np.int64, row["n_docs"])
                n = row["n_docs"]
                yield pa.record_batch([pa.array(np.full(n, row["part"])), pa.array(np.arange(n)), pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(crc)], names=["part", "seq", "start", "n_tokens", "ids_crc32"])

    got = _by_file(spark, folder).mapInArrow(read, "part long, seq long, start long, n_tokens long, ids_crc32 long")
    return got.join(token_docs(spark, folder).select("part", "seq", "doc_id"), ["part", "seq"]).select("doc_id", "start", "n_tokens", "ids_crc32")
