"""The same or nearly the same sequences on both sides of a split.

Sequences are compared position by position, so a shingle is a window of bases together with its place;
windows with a masked base are no shingles. Exact copies are folded into classes first. Minwise hashes
of the shingles are banded into buckets, only pairs from different splits become candidates, and every
candidate is verified on the sequences themselves.

Three bandings cover three kinds of pairs. Long bands find pairs that mismatches alone keep apart. Rows that
lost windows to masked bases take short bands as well, against all rows of the other split; rows that lost
windows to many single masked bases, so that few are left, meet by the bases at places drawn once for each length. Short bands are
built only at lengths at which the other split has a row that needs them, keys of drawn places only where such a row
may have the same, as bits of a fixed number tell. As a
pair may differ in length, each row is hashed over its two longest prefixes of a length 1.25**q; two
rows whose lengths differ by up to a fifth share one of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeflow.functions.names import clean_name, is_tip_name, split_of
from cladeflow.session import spread, written

#: Bases of a shingle.
SHINGLE = 4
#: Bands and hashes a band; a pair with Jaccard similarity s is missed with probability (1 - s**rows)**bands.
LONG_BANDS, LONG_ROWS = 24, 10
SHORT_BANDS, SHORT_ROWS = 40, 4
#: Keys of drawn places and places a key. Where a fifth of the places is masked and 1 % differs, a pair is missed with probability 6e-5.
DRAWN_KEYS, DRAWN_PLACES = 96, 10
#: Bits that stand for the drawn keys that one split needs; more keys set more bits, and fewer others are kept out.
BITS = 1 << 18
#: Share of a prefix's windows that a row may lose to masked bases and still count as clean.
CLEAN = 0.02
#: Share of a prefix's windows lost beyond its masked bases from which a row takes drawn places: blocks of masked bases
#: lose few windows more than bases, single ones up to four windows each.
TORN_SHARE = 0.1
#: Bytes of bases that one comparison holds.
COMPARED_BYTES = 16_000_000
#: Fixed values of the comparison: share of the longer row that must be comparable, share that may differ.
COMPARABLE, DIFFERENT = 0.8, 0.01
STEP = 1.25

_HASHES = max(LONG_BANDS * LONG_ROWS, SHORT_BANDS * SHORT_ROWS)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def masked(bases: np.ndarray) -> np.ndarray:
    return (bases == ord("N")) | (bases == ord("-"))


def shingles(seq: bytes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of a sequence's windows without masked bases."""
    bases = np.frombuffer(seq, np.uint8)
    n = len(bases) - size + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value, bad = np.zeros(n, np.uint64), np.zeros(n, bool)
    for k in range(size):
        value = value << np.uint64(8) | bases[k : k + n].astype(np.uint64)
        bad |= masked(bases[k : k + n])
    at = np.flatnonzero(~bad)
    return at, _mix(value[at] ^ _mix(at.astype(np.uint64) + np.uint64(1)))


def prefix_lengths(n: int) -> list[int]:
    """The two longest lengths floor(1.25**q) up to n (one if n is 1)."""
    found, at, q = [], 0, 0
    while at <= n:
        if at and (not found or at > found[-1]):
            found.append(at)
        q += 1
        at = int(STEP**q)
    return found[-2:]


_SEEDS = (_mix(np.arange(1, _HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minima of the hashes under _HASHES multiplications modulo 2**32."""
    return (hashes.astype(np.uint32)[None, :] * _SEEDS[:, None]).min(axis=1).astype(np.uint64)


def band_keys(values: np.ndarray, bands: int, rows: int, salts: np.ndarray) -> np.ndarray:
    """Bucket keys, one row per signature in values, salted by what must agree besides."""
    parts = values[:, : bands * rows].reshape(len(values), bands, rows)
    keys = np.repeat(salts[:, None], bands, axis=1)
    for k in range(rows):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return _mix(keys + np.arange(bands, dtype=np.uint64)).view(np.int64)


CLEAR, UNCLEAN, TORN = 0, 1, 2


def _state(inside: int, bases: int, length: int) -> int:
    """Whether a prefix with so many windows and unmasked bases left is CLEAR, UNCLEAN, or TORN by single masked bases."""
    windows = length - SHINGLE + 1
    if windows < 1 or (windows - inside) - (length - bases) > TORN_SHARE * windows:
        return TORN
    return CLEAR if inside >= (1 - CLEAN) * windows else UNCLEAN


BANDINGS = {0: (LONG_BANDS, LONG_ROWS), 1: (SHORT_BANDS, SHORT_ROWS)}
BUCKETS = "rep long, in_a boolean, in_b boolean, state byte, kind byte, bucket long"


def drawn_keys(seqs: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, whether they hold no masked base) of sequences of one length: a row a sequence, a column a key."""
    bases = np.frombuffer(b"".join(seqs), np.uint8).reshape(len(seqs), length)
    places = _mix(np.arange(DRAWN_KEYS * DRAWN_PLACES, dtype=np.uint64) + np.uint64(length << 20)) % np.uint64(length)
    keys, whole = np.tile(np.arange(DRAWN_KEYS, dtype=np.uint64) + np.uint64(length << 8), (len(seqs), 1)), np.ones((len(seqs), DRAWN_KEYS), bool)
    for at in places.astype(np.int64).reshape(DRAWN_PLACES, DRAWN_KEYS):
        picked = bases[:, at]
        keys *= np.uint64(0x9E3779B97F4A7C15)
        keys += picked
        whole &= ~masked(picked)
    return _mix(keys).view(np.int64), whole


def _needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct (in_a, in_b, length, bit) of the prefixes that are unclean (bit -1) or torn (a bit a key, length 0)."""
    found = set()
    for batch in batches:
        for seq, in_a, in_b in zip(*(batch.column(c).to_pylist() for c in ("seq", "in_a", "in_b"))):
            seq = seq.encode()
            ok = ~masked(np.frombuffer(seq, np.uint8))
            run = ok[: max(len(ok) - SHINGLE + 1, 0)].copy()
            for k in range(1, SHINGLE):
                run &= ok[k : k + len(run)]
            left, bases = (np.concatenate([[0], np.cumsum(x)]) for x in (run, ok))
            for length in prefix_lengths(len(seq)):
                state = _state(int(left[max(length - SHINGLE + 1, 0)]), int(bases[length]), length)
                if state == UNCLEAN:
                    found.add((in_a, in_b, length, -1))
                elif state == TORN:
                    keys, whole = drawn_keys([seq[:length]], length)
                    found |= {(in_a, in_b, 0, int(k) % BITS) for k in keys[whole]}
    rows = list(zip(*found)) or [()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.bool_(), pa.bool_(), pa.int64(), pa.int64()))], ["in_a", "in_b", "length", "bit"])


def _asked(classes: DataFrame) -> tuple[set, dict[str, np.ndarray]]:
    """What rows of the other side ask of a side: (length, side) for short bands, and per side the bits of drawn keys.

    At most a row a length (powers of 1.25 up to the longest sequence) and BITS rows a combination of sides come to the driver.
    """
    rows = classes.select("seq", "in_a", "in_b").mapInArrow(_needs, "in_a boolean, in_b boolean, length long, bit long").distinct().toArrow().to_pylist()
    short_at, bits = set(), {"a": np.zeros(BITS, bool), "b": np.zeros(BITS, bool)}
    for r in rows:
        for side in ("b" if r["in_a"] else "") + ("a" if r["in_b"] else ""):
            if r["bit"] < 0:
                short_at.add((r["length"], side))
            else:
                bits[side][r["bit"]] = True
    return short_at, bits


def _banded(short_at: set, bits: dict[str, np.ndarray]):
    """Rows to buckets of kind 0 (long bands), 1 (short bands) and 2 (drawn places)."""
    packed, torn_ones = {side: np.packbits(b).tobytes() for side, b in bits.items()}, any(b.any() for b in bits.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = {side: np.unpackbits(np.frombuffer(b, np.uint8)).astype(bool) for side, b in packed.items()} if torn_ones else None
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                yield _buckets(batch.slice(at, 1024), short_at, asked)

    return run


def _buckets(batch: pa.RecordBatch, short_at: set, asked: dict[str, np.ndarray] | None) -> pa.RecordBatch:
    found = {kind: [] for kind in BANDINGS}  # (rep, in_a, in_b, state, length, minima)
    drawn: dict[int, list] = {}  # the same by length, with the prefix
    for rep, seq, in_a, in_b in zip(*(batch.column(c).to_pylist() for c in ("rep", "seq", "in_a", "in_b"))):
        seq = seq.encode()
        at, hashes = shingles(seq)
        bases = np.cumsum(~masked(np.frombuffer(seq, np.uint8)))
        minima, done = None, 0
        for length in prefix_lengths(len(seq)):
            inside = int(np.searchsorted(at, length - SHINGLE + 1))
            state = _state(inside, int(bases[length - 1]), length)
            if inside > done:  # the longer prefix adds its own windows to the minima of the shorter
                more = signature(hashes[done:inside])
                minima, done = more if minima is None else np.minimum(minima, more), inside
            row = (rep, in_a, in_b, state, length)
            if inside:
                found[0].append((*row, minima))
                if state == UNCLEAN or (in_a and (length, "a") in short_at) or (in_b and (length, "b") in short_at):
                    found[1].append((*row, minima))
            if asked is not None:
                drawn.setdefault(length, []).append((*row, seq[:length]))
    parts = []
    for kind, (bands, _) in BANDINGS.items():
        if found[kind]:
            reps, in_a, in_b, states, lengths, minima = zip(*found[kind])
            keys = band_keys(np.stack(minima), *BANDINGS[kind], np.array(lengths, np.uint64) * np.uint64(4) + np.uint64(kind)).ravel()
            each = [np.repeat(np.array(c, t), bands) for c, t in ((reps, np.int64), (in_a, bool), (in_b, bool), (states, np.int8))]
            parts.append([*each, np.full(len(keys), kind, np.int8), keys])
    for length, rows in drawn.items():
        *columns, _, prefixes = zip(*rows)
        keys, whole = drawn_keys(prefixes, length)
        reps, in_a, in_b, states = (np.array(c, t)[:, None] for c, t in zip(columns, (np.int64, bool, bool, np.int8)))
        bit = keys % BITS
        kept = whole & ((states == TORN) | (in_a & asked["a"][bit]) | (in_b & asked["b"][bit]))
        each = [np.broadcast_to(c, keys.shape)[kept] for c in (reps, in_a, in_b, states)]
        parts.append([*each, np.full(int(kept.sum()), 2, np.int8), keys[kept]])
    types = [pa.int64(), pa.bool_(), pa.bool_(), pa.int8(), pa.int8(), pa.int64()]
    columns = [pa.array(np.concatenate(c), t) for c, t in zip(zip(*parts), types)] if parts else [pa.array([], t) for t in types]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in BUCKETS.split(", ")])


def compare(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Comparable and differing positions, longer length and exact Jaccard similarity of each pair."""
    n = len(a)
    longest = max([1, *map(len, a), *map(len, b)])
    x = np.frombuffer("".join(s.ljust(longest, "N") for s in a).encode(), np.uint8).reshape(n, longest)
    y = np.frombuffer("".join(s.ljust(longest, "N") for s in b).encode(), np.uint8).reshape(n, longest)
    kx, ky = ~masked(x), ~masked(y)
    both = kx & ky
    equal = both & (x == y)
    width = longest - SHINGLE + 1

    def windows(ok: np.ndarray) -> np.ndarray:
        if width < 1:
            return np.zeros(n, np.int64)
        every = ok[:, :width].copy()
        for k in range(1, SHINGLE):
            every &= ok[:, k : k + width]
        return every.sum(axis=1)

    shared = windows(equal)
    union = windows(kx) + windows(ky) - shared
    comparable = both.sum(axis=1)
    longer = np.maximum(np.fromiter(map(len, a), np.int64, n), np.fromiter(map(len, b), np.int64, n))
    return comparable, comparable - equal.sum(axis=1), longer, shared / np.maximum(union, 1)


def same_or_near(comparable: np.ndarray, differing: np.ndarray, longer: np.ndarray) -> np.ndarray:
    return (comparable >= 1) & (comparable * 5 >= longer * 4) & (differing * 100 <= comparable)


def _slices(a: list[str], b: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of pairs that fit COMPARED_BYTES when all are as long as their longest; at least one pair each."""
    start, longest = 0, 1
    for k, n in enumerate(max(len(x), len(y)) for x, y in zip(a, b)):
        if k > start and max(longest, n) * (k + 1 - start) > COMPARED_BYTES:
            yield start, k
            start, longest = k, 1
        longest = max(longest, n)
    if a:
        yield start, len(a)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            a, b = part.column("seq_a").to_pylist(), part.column("seq_b").to_pylist()
            for low, high in _slices(a, b):
                comparable, differing, longer, jaccard = compare(a[low:high], b[low:high])
                ids = [part.column(c).slice(low, high - low) for c in ("a", "b")]
                out = pa.RecordBatch.from_arrays([*ids, pa.array(differing), pa.array(jaccard)], ["a", "b", "differing", "jaccard"])
                yield out.filter(pa.array(same_or_near(comparable, differing, longer)))


def node_splits(branches: DataFrame) -> DataFrame:
    """dataset, name, split: of a node's rows the one exported last, then the label last in order, counts."""
    at = F.struct("exported_at", split_of("train_test").alias("split"))
    rows = branches.select("dataset", clean_name("child").alias("name"), at.alias("at")).where("dataset is not null and name is not null")
    return rows.groupBy("dataset", "name").agg(F.max("at").alias("at")).select("dataset", "name", F.col("at.split").alias("split"))


def tip_sequences(alignment: DataFrame, branches: DataFrame) -> DataFrame:
    """seq_id, dataset, split, seq (upper case) of the tips' rows with a non-empty sequence."""
    rows = alignment.where(is_tip_name("name") & (F.length("seq") > 0)).select(
        "seq_id", "dataset", clean_name("name").alias("name"), F.upper("seq").alias("seq")
    )
    split = F.coalesce("split", F.lit("train")).alias("split")
    return rows.join(node_splits(branches), ["dataset", "name"], "left").select("seq_id", "dataset", split, "seq")


def cross_split_pairs(tips: DataFrame, held_out: str = "test", training: str = "train") -> tuple[DataFrame, DataFrame]:
    """Pairs of classes of equal sequences, (a, b, differing, jaccard), and members (rep, seq_id, dataset, split).

    a has held-out members and b training members; a = b for copies on both sides. Rows of other splits
    take no part. Sequences that are masked throughout pair with none. An empty side gives no pairs. Copies are folded by an
    aggregation that combines them where they are; members meet their class by a digest of the sequence.
    """
    rows = written(tips.where(F.col("split").isin(held_out, training)).withColumn("digest", F.md5("seq")), "tips")
    side = lambda name: F.max(F.col("split") == name)
    classes = rows.groupBy("digest", "seq").agg(F.min("seq_id").alias("rep"), side(held_out).alias("in_a"), side(training).alias("in_b"))
    classes = written(spread(classes, "rep"), "classes")
    members = written(rows.drop("seq").join(classes.select("digest", "rep").hint("merge"), "digest").select("rep", "seq_id", "dataset", "split"), "members")
    bands = written(classes.select("rep", "seq", "in_a", "in_b").mapInArrow(_banded(*_asked(classes)), BUCKETS), "bands")
    # kind 0 meets kind 0; of the others only pairs that one of the two needs, each in a lane of its own, which takes three bits of the key
    needs = F.col("state") == F.when(F.col("kind") == 1, UNCLEAN).otherwise(TORN)
    lane = F.col("kind") * 2
    key = lambda c: F.col("bucket").bitwiseAND(F.lit(~7)).bitwiseOR(c.cast("long"))
    left = bands.where("in_a").select(key(F.when((F.col("kind") == 0) | needs, lane).otherwise(lane + 1)).alias("key"), F.col("rep").alias("a"))
    lanes = F.when((F.col("kind") > 0) & needs, F.array(lane, lane + 1)).otherwise(F.array(lane))
    right = bands.where("in_b").select("bucket", F.explode(lanes).alias("lane"), F.col("rep").alias("b")).select(key(F.col("lane")).alias("key"), "b")
    candidates = left.join(right, "key").where("a <> b").select("a", "b").distinct()
    same = classes.where("in_a and in_b").select(F.col("rep").alias("a"), F.col("rep").alias("b"))
    every = candidates.unionByName(same)
    seq = classes.select("rep", "seq")
    texts = every.join(seq.toDF("a", "seq_a"), "a").join(seq.toDF("b", "seq_b"), "b")
    pairs = texts.select("a", "b", "seq_a", "seq_b").mapInArrow(_verified, "a long, b long, differing long, jaccard double")
    return written(pairs, "pairs"), members


def expanded_pairs(pairs: DataFrame, members: DataFrame, held_out: str = "test", training: str = "train") -> DataFrame:
    """held_out_id, training_id, held_out_dataset, training_dataset, differing, jaccard: all pairs of rows."""

    def side(label: str, key: str, name: str) -> DataFrame:
        return members.where(F.col("split") == label).select(
            F.col("rep").alias(key), F.col("seq_id").alias(f"{name}_id"), F.col("dataset").alias(f"{name}_dataset")
        )

    return pairs.join(side(held_out, "a", "held_out"), "a").join(side(training, "b", "training"), "b").drop("a", "b")


def overlap_report(pairs: DataFrame, members: DataFrame, held_out: str = "test", training: str = "train") -> DataFrame:
    """split, dataset, n_pairs, n_rows, n_equal: confirmed pairs of rows, the rows in them, and pairs without a difference.

    Counted from the pairs of classes and the sizes of the classes; no pair of rows is built. A class member with a null dataset
    counts under null.
    """
    sizes = written(members.groupBy("rep", "split", "dataset").agg(F.count("*").alias("n")), "sizes")

    def side(split: str, own: str, other_split: str, other: str) -> DataFrame:
        partners = sizes.where(F.col("split") == other_split).groupBy(F.col("rep").alias(other)).agg(F.sum("n").alias("m"))
        met = pairs.join(partners, other).groupBy(F.col(own).alias("rep")).agg(
            F.sum("m").alias("partners"), F.sum(F.when(F.col("differing") == 0, F.col("m")).otherwise(0)).alias("equal")
        )
        return sizes.where(F.col("split") == split).join(met, "rep").groupBy("dataset").agg(
            F.lit(split).alias("split"), F.sum(F.col("n") * F.col("partners")).alias("n_pairs"), F.sum("n").alias("n_rows"), F.sum(F.col("n") * F.col("equal")).alias("n_equal")
        )

    every = side(held_out, "a", training, "b").unionByName(side(training, "b", held_out, "a"))
    return every.select("split", "dataset", "n_pairs", "n_rows", "n_equal")
