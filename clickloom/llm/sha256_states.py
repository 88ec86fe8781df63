"""SHA-256 as a step from state to state, over many messages at once.

A digest in hexadecimal is 64 bytes, exactly one block.  So the hash of a list of
digests passes through one state of eight words after each of them, and such a state can
be kept, copied and resumed later, in another task too.
"""

from __future__ import annotations

from itertools import count, islice
from math import isqrt

import numpy as np

_U = np.uint32
COLUMNS = 4096  # messages at a time, so that a step stays in the cache


def _primes():
    return (n for n in count(2) if all(n % d for d in range(2, isqrt(n) + 1)))


def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 2)
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if mid**3 <= n else (low, mid)
    return low


# Fixed values of the standard: the first 32 bits of the fractions of square roots of the
# first 8 primes, and of cube roots of the first 64.
INITIAL = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in islice(_primes(), 8)], _U)
ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in islice(_primes(), 64)], _U)


def _hex_words() -> np.ndarray:
    """The four hexadecimal characters of every 16-bit number, as one big-endian word."""
    digit = np.frombuffer(b"0123456789abcdef", np.uint8).astype(_U)
    v = np.arange(1 << 16)
    return (digit[v >> 12] << 24) | (digit[(v >> 8) & 15] << 16) | (digit[(v >> 4) & 15] << 8) | digit[v & 15]


HEX = _hex_words()


def words_of(digests: list[bytes]) -> np.ndarray:
    """Digests of 32 bytes as an array of eight words each."""
    return np.frombuffer(b"".join(digests), ">u4").astype(_U).reshape(-1, 8)


def bytes_of(words: np.ndarray) -> list[bytes]:
    """The digests as 32 bytes each."""
    raw = words.astype(">u4").tobytes()
    return [raw[i : i + 32] for i in range(0, len(raw), 32)]


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> _U(n)) | (x << _U(32 - n))


def _step(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    w = list(block)
    for i in range(16, 64):
        x, y = w[i - 15], w[i - 2]
        low = _turn(x, 7) ^ _turn(x, 18) ^ (x >> _U(3))
        high = _turn(y, 17) ^ _turn(y, 19) ^ (y >> _U(10))
        w.append(w[i - 16] + low + w[i - 7] + high)
    a, b, c, d, e, f, g, h = state
    for k, x in zip(ROUND, w, strict=True):
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + (x + k)
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def _in_columns(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    out = np.empty_like(state)
    for low in range(0, len(state), COLUMNS):
        part = slice(low, low + COLUMNS)
        out[part] = _step(np.ascontiguousarray(state[part].T), np.ascontiguousarray(block[part].T)).T
    return out


def start(n: int) -> np.ndarray:
    """``n`` states that have read nothing."""
    return np.tile(INITIAL, (n, 1))


def read(state: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """The states after reading one more digest each, as hexadecimal text."""
    block = np.empty((len(digests), 16), _U)
    block[:, 0::2] = HEX[digests >> _U(16)]
    block[:, 1::2] = HEX[digests & _U(0xFFFF)]
    return _in_columns(state, block)


def finish(state: np.ndarray, width: np.ndarray) -> np.ndarray:
    """The digests of states that have read ``width`` digests each."""
    block = np.zeros((len(state), 16), _U)
    block[:, 0] = _U(1 << 31)
    block[:, 15] = (512 * width).astype(_U)
    return _in_columns(state, block)
