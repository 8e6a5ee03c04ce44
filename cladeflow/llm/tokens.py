"""Token ids of a whole corpus: every distinct word is encoded once.

Texts are cut into pre-tokens, block by block with array operations. A block keeps, for each text, the
numbers of its pre-tokens in order (their positions) and its own list of distinct words; only the latter
are exploded and shuffled. Each distinct word of the corpus is encoded once, its ids are joined back to
(block, word number), and the blocks put their texts together by position. A word that is everywhere
costs one row a block, not one an occurrence.
"""

from __future__ import annotations

import base64
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeflow.session import written

TOKENIZER_DIR = "/opt/tokenizers"
TOKENIZER = "byte_bpe_50k"
#: Characters of one block; bounds a worker's memory.
BLOCK_CHARS = 3_000_000
#: Blocks whose common words go to one task.
WORD_BLOCKS = 4096

# The pre-token pattern of the byte-level vocabularies is
# 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
# over the classes letter, number, white space and other.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]
OTHER, LETTER, NUMBER, SPACE, END = range(5)

_state: dict = {}


def _classes() -> np.ndarray:
    """The class of every code point; END is for the mark between texts, which no text can hold."""
    if "classes" not in _state:
        table = np.zeros(0x110001, np.uint8)
        points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
        every = "".join(map(chr, points))
        at = np.array(points)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, every):
                table[at[m.start() : m.end()]] = kind
        table[0x110000] = END
        _state["classes"] = table
    return _state["classes"]


def code_points(texts: list[str]) -> np.ndarray:
    """The texts' code points in one array, the mark 0x110000 after each text."""
    arrays, mark = [], np.array([0x110000], np.uint32)
    for t in texts:
        arrays += [np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32), mark]
    return np.concatenate(arrays) if arrays else np.zeros(0, np.uint32)


def word_starts(points: np.ndarray) -> np.ndarray:
    """True where a pre-token starts; marks between texts are pre-tokens of their own."""
    kind = _classes()[points]
    n = len(points)
    start = np.ones(n, bool)
    if n == 0:
        return start
    same = kind[1:] == kind[:-1]
    start[1:] = ~same | (kind[1:] == END)
    space = kind == SPACE
    # before a word the last character of white space leaves its run, and joins the word if it is U+0020
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & (kind[1:] != END)
    start |= last
    joins = np.flatnonzero(last & (points == 0x20))
    start[joins + 1] = False
    quotes = np.flatnonzero((points == 0x27) & start)
    if len(quotes):
        near = np.full((len(quotes), 2), 0x110000, np.uint32)
        for k in (1, 2):
            inside = quotes + k < n
            near[inside, k - 1] = points[quotes[inside] + k]
        for tail in CONTRACTIONS:
            hit = near[:, 0] == ord(tail[0])
            if len(tail) == 2:
                hit &= near[:, 1] == ord(tail[1])
            begin = quotes[hit]
            start[begin + 1] = False
            behind = begin + 1 + len(tail)
            start[behind[behind < n]] = True
    return start


def _mixed(points: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """A 64-bit mix of each code point with its place in its word."""
    x = offset.astype(np.uint64)
    x += np.uint64(1)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x += points
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def split_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(pre-tokens a text, number of each pre-token's word, the distinct words) of a block of texts."""
    points = code_points(texts)
    start = np.flatnonzero(word_starts(points))
    if not len(start):
        return np.zeros(0, np.int32), np.zeros(0, np.int32), []
    length = np.diff(np.append(start, len(points)))
    offset = np.arange(len(points), dtype=np.int64) - np.repeat(start, length)
    first = np.add.reduceat(_mixed(points, offset), start)
    real = points[start] != 0x110000
    number, _ = pd.factorize(first[real])
    start, length = start[real], length[real]
    sample = np.zeros(int(number.max()) + 1 if len(number) else 0, np.int64)
    sample[number[::-1]] = np.arange(len(number))[::-1]
    ends = np.append(np.flatnonzero(points == 0x110000), len(points))[: len(texts)]
    counts = np.diff(np.searchsorted(start, np.append(0, ends))) if len(texts) else np.zeros(0)
    same = np.array_equal(length, length[sample][number])
    if same and len(start):  # equal hashes must mean equal words
        mine = points != 0x110000
        same = np.array_equal(points[mine], points[np.repeat(start[sample][number], length) + offset[mine]])
    if not same:
        words, table = [], {}  # number them by their text instead
        for a, k in zip(start, length):
            word = points[a : a + k].tobytes().decode("utf-32-le")
            words.append(table.setdefault(word, len(table)))
        return counts.astype(np.int32), np.array(words, np.int32), list(table)
    words = [points[a : a + k].tobytes().decode("utf-32-le") for a, k in zip(start[sample], length[sample])]
    return counts.astype(np.int32), number.astype(np.int32), words


def rank_file(directory: str, name: str) -> bytes:
    with open(os.path.join(directory, f"{name}.tiktoken"), "rb") as lines:
        return lines.read()


def ranks_of(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}


def load_tokenizer(raw: bytes, name: str):
    """The tiktoken encoding of a rank file, once a worker."""
    import tiktoken

    key = (name, hash(raw))
    if key not in _state:
        _state[key] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks_of(raw), special_tokens={})
    return _state[key]


def shipped(df: DataFrame, directory: str, name: str):
    """The rank file as the driver has it, broadcast to the workers: its size is fixed, and they need no copy of their own."""
    return df.sparkSession.sparkContext.broadcast(rank_file(directory, name))


def token_bytes(spark: SparkSession, directory: str = TOKENIZER_DIR, name: str = TOKENIZER) -> DataFrame:
    """The token-byte table as one row, `tokens`: the bytes of id 0, 1, ... in hexadecimal digits; null for unused ids."""
    ranks = ranks_of(rank_file(directory, name))
    tokens: list[str | None] = [None] * (max(ranks.values()) + 1)
    for raw, token in ranks.items():
        tokens[token] = raw.hex()
    return spark.createDataFrame([(tokens,)], "tokens array<string>")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress

    def block(keys: list[int], texts: list[str]) -> pa.RecordBatch:
        counts, numbers, words = split_words(texts)
        columns = [
            pa.array([uuid.uuid4().hex]),
            pa.array([pack(np.array(keys, np.int64).tobytes())], pa.binary()),
            pa.array([pack(counts.tobytes())], pa.binary()),
            pa.array([pack(numbers.tobytes())], pa.binary()),
            pa.array([words], pa.list_(pa.string())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "keys", "counts", "numbers", "words"])

    keys, texts, chars = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            if texts and chars + len(text) > BLOCK_CHARS:
                yield block(keys, texts)
                keys, texts, chars = [], [], 0
            keys.append(key)
            texts.append(text)
            chars += len(text)
    if texts:
        yield block(keys, texts)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for row in range(batch.num_rows):
            keys, counts, numbers = (
                np.frombuffer(unpack(batch.column(c)[row].as_py()), kind) for c, kind in (("keys", np.int64), ("counts", np.int32), ("numbers", np.int32))
            )
            entries = batch.column("entries")[row].values
            if entries is None or len(entries) == 0:
                flat, length = np.zeros(0, np.int32), np.zeros(0, np.int64)
            else:
                order = np.argsort(entries.field("no").to_numpy(zero_copy_only=False))
                raw = entries.field("ids").take(pa.array(order))
                joined = b"".join(raw.to_pylist())
                flat = np.frombuffer(joined, np.int32)
                length = np.fromiter(map(len, raw.to_pylist()), np.int64, len(order)) // 4
            first = np.concatenate([[0], np.cumsum(length)])[:-1] if len(length) else length
            size = length[numbers] if len(numbers) else np.zeros(0, np.int64)
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            at = np.arange(total) - np.repeat(ends - size - first[numbers], size) if total else np.zeros(0, np.int64)
            text_ends = np.concatenate([[0], np.cumsum(counts)])
            offsets = np.concatenate([[0], ends])[text_ends]
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat[at] if total else flat[:0], pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(keys), ids], ["doc_id", "ids"])


def encode_corpus(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", directory: str = TOKENIZER_DIR, name: str = TOKENIZER
) -> DataFrame:
    """doc_id, ids (array of int): the token ids of every text, without special tokens.

    Empty and null texts have an empty list; the spelling of a special token is plain text. Repeated
    rows are encoded each; rows with a null id are left out. Other columns are ignored. An empty table
    gives no rows; a text of any length is encoded whole, in a block of its own beyond BLOCK_CHARS.

    Both shuffles have as many partitions as there are blocks, so a task's share stays the same whatever the corpus. A word in every
    block has one row a block; beyond WORD_BLOCKS blocks it is split by groups of blocks, and encoded once in each.
    """
    file = shipped(documents, directory, name)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = load_tokenizer(file.value, name).encode_ordinary
        for batch in batches:
            ids = [np.array(ids_of(w), np.int32).tobytes() for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], ["word", "part", "ids"])

    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).where("doc_id is not null")
    blocks = written(
        texts.mapInArrow(_cut, "block string, keys binary, counts binary, numbers binary, words array<string>"), "blocks"
    )
    n = max(1, blocks.count())
    part = F.pmod(F.xxhash64("block"), F.lit(-(-n // WORD_BLOCKS))).cast("int").alias("part")
    words = blocks.select("block", part, F.posexplode("words").alias("no", "word")).repartition(n, "word", "part")
    encoded = words.select("word", "part").distinct().mapInArrow(encode, "word string, part int, ids binary").repartition(n, "word", "part")
    entries = words.join(encoded, ["word", "part"]).select("block", "no", "ids").repartition(n, "block")
    entries = entries.groupBy("block").agg(F.collect_list(F.struct("no", "ids")).alias("entries"))
    whole = blocks.select("block", "keys", "counts", "numbers").repartition(n, "block").join(entries, "block", "left")
    return whole.select("keys", "counts", "numbers", F.coalesce("entries", F.array().cast("array<struct<no:int,ids:binary>>")).alias("entries")).mapInArrow(
        _joined, "doc_id long, ids array<int>"
    )


def decode_corpus(encoded: DataFrame, directory: str = TOKENIZER_DIR, name: str = TOKENIZER) -> DataFrame:
    """doc_id, text from doc_id, ids: every row is joined with the token-byte table, one row of the vocabulary's size.

    An empty or null list gives the empty text; unknown ids add nothing. Bytes that are no UTF-8 become U+FFFD.
    """
    table = F.broadcast(token_bytes(encoded.sparkSession, directory, name))
    parts = F.transform("ids", lambda i: F.coalesce(F.get("tokens", i), F.lit("")))
    text = F.make_valid_utf8(F.unhex(F.array_join(parts, "")).cast("string"))
    return encoded.crossJoin(table).select("doc_id", F.coalesce(text, F.lit("")).alias("text"))


def token_counts(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", directory: str = TOKENIZER_DIR, name: str = TOKENIZER
) -> DataFrame:
    """doc_id, n_tokens of every text; 0 for empty and null texts."""
    file = shipped(documents, directory, name)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = load_tokenizer(file.value, name).encode_ordinary
        for batch in batches:
            n = [len(ids_of(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).where("doc_id is not null")
    return texts.mapInArrow(count, "doc_id long, n_tokens long")
