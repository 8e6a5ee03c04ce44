"""Writers: one file a row for small outputs, and text tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _store(folder: str):
    """(file system, path in it) of a local folder or an address on a shared store (file, s3, s3a, hdfs)."""
    from pyarrow import fs

    if "://" not in folder:
        return fs.LocalFileSystem(), os.path.abspath(folder)
    return fs.FileSystem.from_uri("s3://" + folder.removeprefix("s3a://") if folder.startswith("s3a://") else folder)


def write_files(rows: DataFrame, folder: str, compress: bool = False) -> DataFrame:
    """Write column `content` (text or binary) of each row to folder/`file_path`; return file_path and n_bytes.

    folder must be one that all executors share, by path or by address. A file is written under a name of its task attempt and
    moved, so a repeated task, or one that runs twice at once, leaves the same result. Of rows with one file_path one wins. With
    compress, contents are zstd frames and `.zst` is added. Nothing is written before the result is used.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyspark import TaskContext

        store, root = _store(folder)
        attempt = f"{uuid.uuid4().hex}-{TaskContext.get().taskAttemptId()}"
        for pdf in batches:
            sizes = []
            for path, content in zip(pdf.file_path, pdf.content):
                data = content.encode() if isinstance(content, str) else bytes(content)
                if compress:
                    data, path = zstandard.ZstdCompressor().compress(data), f"{path}.zst"
                target = f"{root}/{path}"
                store.create_dir(target.rpartition("/")[0], recursive=True)
                part = f"{target}.{attempt}.part"
                with store.open_output_stream(part) as out:
                    out.write(data)
                store.move(part, target)
                sizes.append(len(data))
            yield pd.DataFrame({"file_path": pdf.file_path, "n_bytes": sizes})

    return rows.where("file_path is not null and content is not null").select("file_path", "content").mapInPandas(run, "file_path string, n_bytes long")


def write_branches(links: DataFrame, path: str) -> None:
    """parent, child, hamming, train_test as tab-separated text with a header, `?` for a missing distance."""
    rows = links.select("parent", "child", F.coalesce(F.col("hamming").cast("string"), F.lit("?")).alias("hamming"), F.coalesce("split", F.lit("")).alias("train_test"))
    rows.write.option("sep", "\t").option("header", True).option("emptyValue", "").csv(path)


def write_summary(entries: DataFrame, path: str) -> None:
    """dataset, entry (JSON text) as one JSON object a line, `{dataset: entry}`; read_summary() reads them back."""
    line = F.concat(F.lit("{"), F.to_json(F.array("dataset")).substr(F.lit(2), F.length(F.to_json(F.array("dataset"))) - 2), F.lit(":"), F.col("entry"), F.lit("}"))
    entries.where("dataset is not null and entry is not null").select(line.alias("value")).write.text(path)


def write_metadata(lines: DataFrame, path: str) -> None:
    """record_id, place, line: one folder a document of text files whose lines are in the order of their places."""
    rows = lines.repartitionByRange("record_id", "place").sortWithinPartitions("record_id", "place")
    rows.select("record_id", F.col("line").alias("value")).write.partitionBy("record_id").text(path)


def write_fasta(records: DataFrame, path: str) -> None:
    """Text files of the column `record`, each record with its line ends."""
    records.select(F.regexp_replace("record", r"\n$", "").alias("value")).write.text(path)
