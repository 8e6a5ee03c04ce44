"""Readers of the pipeline's file formats: FASTA, tab-separated branch tables, tree documents, settings."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The settings of an analysis, besides its name and address.
SETTINGS = ["gene", "trim_begin", "trim_end", "seq_length", "test_proportion", "mutations_back", "max_clade_proportion", "seed"]


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """path, id, description, seq of the records of FASTA files (one path, a folder or a pattern).

    The id ends at the first white space of the header; lines of a sequence are joined, blanks in them dropped.
    Records may be empty; a file starts with a header. Files are split into records by the
    reader, so that a file may be of any size.
    """
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    # the reader takes away the mark of every record but a file's first
    record = F.regexp_replace(F.regexp_replace("value", "\r", ""), "^>", "")
    header = F.regexp_extract(record, r"^([^\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace(record, r"^[^\n]*\n?", ""), r"\s+", "")
    parsed = rows.select(
        "path",
        F.regexp_extract(header, r"^(\S*)", 1).alias("id"),
        F.trim(F.regexp_replace(header, r"^\S*", "")).alias("description"),
        body.alias("seq"),
    )
    return parsed.where("id <> ''")


def read_branches(spark: SparkSession, path: str) -> DataFrame:
    """parent, child, hamming (null for `?`), train_test (null for blank) of tab-separated branch tables with a header."""
    raw = spark.read.option("sep", "\t").option("header", True).schema("parent string, child string, hamming string, train_test string").csv(path)
    return raw.select("parent", "child", F.col("hamming").try_cast("int").alias("hamming"), F.nullif(F.trim("train_test"), F.lit("")).alias("train_test"))


def read_tree_documents(spark: SparkSession, path: str) -> DataFrame:
    """record_id, dataset (the file's name), tree_json: one document a file; sidecars of root sequences are left out."""
    rows = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("tree_json"))
    rows = rows.where(~F.endswith("file", F.lit("_root-sequence.json")))
    return rows.select(F.xxhash64("file").alias("record_id"), F.regexp_replace("file", r"\.json$", "").alias("dataset"), "tree_json")


def read_root_sequences(spark: SparkSession, path: str) -> DataFrame:
    """dataset, gene, seq of sidecar files `{dataset}_root-sequence.json`."""
    rows = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("j"))
    rows = rows.where(F.endswith("file", F.lit("_root-sequence.json")))
    dataset = F.regexp_replace("file", r"_root-sequence\.json$", "").alias("dataset")
    return rows.select(dataset, F.explode(F.from_json("j", "map<string,string>")).alias("gene", "seq"))


def list_files(spark: SparkSession, path: str, excluded: tuple[str, ...] = (".DS_Store", ".snakemake_timestamp")) -> DataFrame:
    """path, n_bytes of all files below a folder but the excluded names; contents aren't read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("n_bytes"))
    return rows.where(~F.element_at(F.split("path", "/"), -1).isin(*excluded))


def new_datasets(found: DataFrame, configured: DataFrame) -> DataFrame:
    """Discovered datasets that aren't configured by hand; both have a column dataset."""
    return found.join(configured.select("dataset"), "dataset", "left_anti")


def resolve_source(location: str) -> str:
    """Where a dataset's document is read from: local paths and file:// as they are, s3:// by the s3a connector.

    Documents behind http have to be fetched first; that is refused with a ValueError.
    """
    if location.startswith("s3://"):
        return "s3a://" + location.removeprefix("s3://")
    if location.startswith("http"):
        raise ValueError(f"{location} must be fetched before it can be read")
    return location


def discover_subtrees(spark: SparkSession, base: str, families: list[str]) -> DataFrame:
    """dataset, path of the documents `{base}/{family}/subtrees/{family}_{serial}.json`, in any number."""
    found = list_files(spark, base).where(F.endswith("path", F.lit(".json")))
    pattern = r"/([^/]+)/subtrees/\1_([^/]+)\.json$"
    family, serial = F.regexp_extract("path", pattern, 1), F.regexp_extract("path", pattern, 2)
    return found.where(family.isin(families)).select(F.concat_ws("_", F.concat(family, F.lit("-xs")), serial).alias("dataset"), "path")


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """dataset, entry (JSON text) of summary documents `{dataset: {...}}`, whole or one object a line; no files give no rows."""
    rows = spark.read.text(path, wholetext=False).where("trim(value) <> ''") if not path.endswith(".json") else spark.read.text(path, wholetext=True)
    return rows.select(F.explode(F.from_json("value", "map<string,string>")).alias("dataset", "entry"))


def read_analyses(spark: SparkSession, path: str, targets: list[str] | None = None) -> DataFrame:
    """The settings `{"analysis": {name: {dataset, gene, trim_begin, ...}}}` of a JSON or YAML file as the analyses table.

    targets keeps only the analyses named; a name that isn't configured is an error.
    """
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())  # one small file
    try:
        loaded = json.loads(text)
    except ValueError:
        import yaml

        loaded = yaml.safe_load(text)
    rows = []
    if unknown := set(targets or ()) - loaded["analysis"].keys():
        raise ValueError(f"not configured: {sorted(unknown)}")
    for name, given in loaded["analysis"].items():
        if targets is not None and name not in targets:
            continue
        rows.append((name, given.get("dataset"), *(given.get(k) for k in SETTINGS)))
    types = ["string", "int", "int", "int", "double", "int", "double", "int"]
    return spark.createDataFrame(rows, "analysis string, dataset_url string, " + ", ".join(f"{k} {t}" for k, t in zip(SETTINGS, types)))
