"""Sequences and mutations as column expressions, all within the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data formats.
MASKS = ["-", "N"]
STOP = "*"
LINE = 60


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def masked_hamming(a, b) -> Column:
    """Positions at which two sequences differ, those masked in either left out.

    The longer sequence is cut to the length of the shorter; an empty one gives 0, a null one null. Letters
    of another case differ: upper-case first where they shouldn't.
    """
    a, b = _col(a), _col(b)
    differs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y) & ~x.isin(MASKS) & ~y.isin(MASKS))
    n = F.size(F.filter(differs, lambda d: d))
    return F.when(a.isNull() | b.isNull(), None).when((F.length(a) == 0) | (F.length(b) == 0), 0).otherwise(n)


def trim(seq, begin, end) -> Column:
    """The part from begin to end (1-based, both included); all of it unless both bounds are given."""
    seq, begin, end = _col(seq), _col(begin), _col(end)
    return F.when(begin.isNotNull() & end.isNotNull(), F.substring(seq, begin, F.greatest(end - begin + 1, F.lit(0)))).otherwise(seq)


def strip_stops(seq) -> Column:
    """Without the stop codons at the end."""
    return F.rtrim(_col(seq), F.lit(STOP))


def has_inner_stop(seq) -> Column:
    return F.contains(strip_stops(seq), F.lit(STOP))


def mutation_position(m) -> Column:
    """The position in `<from><position><to>`; null where it is no number."""
    m = _col(m)
    return F.substring(m, F.lit(2), F.greatest(F.length(m) - 2, F.lit(0))).try_cast("int")


def mutation_base(m) -> Column:
    return F.right(_col(m), F.lit(1))


def count_mutations(entries, begin, end) -> Column:
    """Number of entries; with both bounds given only those at positions from begin to end, malformed ones not."""
    entries, begin, end = _col(entries), _col(begin), _col(end)
    inside = F.size(F.filter(entries, lambda m: mutation_position(m).between(begin, end)))
    return F.when(begin.isNotNull() & end.isNotNull(), inside).otherwise(F.size(entries))


def fasta_record(header: Column, seq: Column) -> Column:
    """`>header`, then lines of 60 characters, each line ended."""
    body = F.regexp_replace(seq, "(.{%d})(?=.)" % LINE, "$1\n")
    return F.concat(F.lit(">"), header, F.lit("\n"), body, F.when(F.length(seq) > 0, F.lit("\n")).otherwise(F.lit("")))


def substituted(seq: Column, changes: Column) -> Column:
    """seq with the bases of changes, an array of (pos, base), put in; positions beyond its ends do nothing."""
    put = lambda s, c: F.when(
        c["pos"].between(1, F.length(s)),
        F.concat(F.substring(s, F.lit(1), c["pos"] - 1), c["base"], F.substring(s, c["pos"] + 1, F.length(s))),
    ).otherwise(s)
    return F.aggregate(changes, seq, put)
