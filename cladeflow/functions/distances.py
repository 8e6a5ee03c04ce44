"""Masked distances of many sequences at once, with numpy: a letter's bits lie in as many planes, 64 positions a word.

The same comparison as masked_hamming(), for tasks that hold many sequences and compare each of them with many others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cladeflow.functions.sequences import MASKS


def _letters(seqs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(codes, known), a row a sequence and a column a position; known is false past its end and where it is masked."""
    lengths = pc.utf8_length(seqs).to_numpy(zero_copy_only=False)
    text = "".join(seqs.to_pylist())
    flat = np.frombuffer(text.encode("ascii"), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), np.uint32)
    width = -(-int(lengths.max(initial=0)) // 64) * 64
    inside = np.arange(width) < lengths[:, None]
    codes = np.zeros(inside.shape, flat.dtype)
    codes[inside] = flat
    for mask in MASKS:
        inside &= codes != ord(mask)
    return codes, inside


def _packed(flags: np.ndarray) -> np.ndarray:
    """A row a word of 64 positions, a column a sequence."""
    n, width = flags.shape
    return np.ascontiguousarray(np.packbits(flags, axis=1).view(np.uint64).reshape(n, width // 64).T)


def _planes(*tables: pa.Array) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """(known, planes) of each table; bits in which no two known letters of any table differ have no plane."""
    read = [_letters(t) for t in tables]
    known = [codes[inside] for codes, inside in read]
    first = next((k[0] for k in known if len(k)), 0)
    varying = int(np.bitwise_or.reduce([np.bitwise_or.reduce(k.astype(np.uint32) ^ np.uint32(first), initial=0) for k in known]))
    bits = [b for b in range(varying.bit_length()) if varying >> b & 1]
    return [(_packed(inside), [_packed(codes >> b & 1) for b in bits]) for codes, inside in read]


def each_with_each(first: pa.Array, second: pa.Array) -> np.ndarray:
    """The distance of every sequence of first (rows) to every one of second (columns)."""
    (known1, planes1), (known2, planes2) = _planes(first, second)
    total = np.zeros((len(first), len(second)), np.int32)
    for w in range(min(len(known1), len(known2))):
        differs = np.zeros(total.shape, np.uint64)
        for p, q in zip(planes1, planes2):
            differs |= p[w][:, None] ^ q[w]
        differs &= known1[w][:, None] & known2[w]
        total += np.bitwise_count(differs)
    return total


def side_by_side(seqs: pa.Array, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The distances of the sequences at the places first to those at the places second."""
    ((known, planes),) = _planes(seqs)
    total = np.zeros(len(first), np.int32)
    for w in range(len(known)):
        differs = np.zeros(len(first), np.uint64)
        for p in planes:
            differs |= p[w][first] ^ p[w][second]
        total += np.bitwise_count(differs & known[w][first] & known[w][second])
    return total
