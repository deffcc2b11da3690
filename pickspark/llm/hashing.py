"""64-bit names of byte strings in bulk.

A name is a chain over the bytes, eight at a time, of a step that is bijective in what it adds and not linear, begun
with the length. So strings of equal length up to eight bytes never share a name, and no arrangement of repeated parts
cancels out, as it does in a sum of powers modulo 2**64 whatever the base.
"""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Keeps so many first bytes of eight.
MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], U)
#: Bytes that must follow the last string.
PAD = b" " * 8
#: Longer strings are hashed one by one.
LONG = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the last step of MurmurHash3)."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of two names, in this order."""
    return mix(mix(a + U(0x9E3779B97F4A7C15)) * U(0xD6E8FEB86659FD93) + b)


def names(data: np.ndarray, begin: np.ndarray, length: np.ndarray, lanes: int = 1) -> list[np.ndarray]:
    """``lanes`` independent names (two at most) of the strings of ``data``, which ends with ``PAD``."""
    with np.errstate(over="ignore"):
        eights = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
        part = eights[begin] & MASKS[np.minimum(length, 8)]
        size = length.astype(U)
        out = [joined(size + U(1 << (32 + i)), part) for i in range(lanes)]
        more, at = np.flatnonzero(length > 8), 8
        while len(more) and at < LONG:
            part = eights[begin[more] + at] & MASKS[np.minimum(length[more] - at, 8)]
            for h in out:
                h[more] = joined(h[more], part)
            at += 8
            more = more[length[more] > at]
        for i in more.tolist():
            digest = np.frombuffer(hashlib.blake2b(data[begin[i] : begin[i] + length[i]].tobytes(), digest_size=16).digest(), "<u8")
            for h, d in zip(out, digest):
                h[i] = d
    return out


def word_names(data: np.ndarray, lanes: int = 1) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where the words (stretches without ASCII white space) of ``data`` begin, and their names."""
    edges = np.flatnonzero(np.diff(IS_SPACE[data], prepend=True))
    begin = edges[::2]
    return begin, names(data, begin, edges[1::2] - begin, lanes)
