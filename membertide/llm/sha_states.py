"""SHA-256 over many messages at once, with states that can be kept between 64-byte blocks.

Numbers are held as rows of 32-bit words: a state has eight rows, a block sixteen, a column per message.
"""

from __future__ import annotations

from math import isqrt

import numpy as np


def _primes(count: int) -> list[int]:
    found: list[int] = []
    n = 2
    while len(found) < count:
        if all(n % p for p in found):
            found.append(n)
        n += 1
    return found


def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle**3 <= n else (low, middle - 1)
    return low


#: The standard's constants: fractions of the roots of the first primes.
_ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)
INITIAL = np.array([[isqrt(p << 64) & 0xFFFFFFFF] for p in _primes(8)], np.uint32)
#: Four hexadecimal digits of a 16-bit number as a word.
_HEX = np.array([int.from_bytes(b"%04x" % i, "big") for i in range(1 << 16)], np.uint32)


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def absorbed(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states after one more block each; one state or block may stand for all columns."""
    words = list(block)
    for t in range(16, 64):
        near, far = words[t - 2], words[t - 15]
        low = _rotated(far, 7) ^ _rotated(far, 18) ^ (far >> np.uint32(3))
        high = _rotated(near, 17) ^ _rotated(near, 19) ^ (near >> np.uint32(10))
        words.append(words[t - 16] + low + words[t - 7] + high)
    a, b, c, d, e, f, g, h = state
    for t in range(64):
        chosen = g ^ (e & (f ^ g))
        first = h + (_rotated(e, 6) ^ _rotated(e, 11) ^ _rotated(e, 25)) + chosen + (words[t] + _ROUND[t])
        second = (_rotated(a, 2) ^ _rotated(a, 13) ^ _rotated(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return np.stack(np.broadcast_arrays(a, b, c, d, e, f, g, h)) + state


def closed(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests of messages that were ``blocks`` whole blocks long."""
    padding = np.zeros((16, len(blocks)), np.uint32)
    padding[0] = 0x80000000
    bits = blocks.astype(np.uint64) * np.uint64(512)
    padding[14], padding[15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return absorbed(state, padding)


def hex_block(digest: np.ndarray) -> np.ndarray:
    """Digests as their hexadecimal text, which is one block each."""
    return np.stack((_HEX[digest >> np.uint32(16)], _HEX[digest & np.uint32(0xFFFF)]), axis=1).reshape(16, -1)


def words(raw: bytes) -> np.ndarray:
    """Rows of words from 32-byte strings one after the other."""
    return np.ascontiguousarray(np.frombuffer(raw, ">u4").reshape(-1, 8).T).astype(np.uint32)


def raw_bytes(digest: np.ndarray) -> bytes:
    return np.ascontiguousarray(digest.T).astype(">u4").tobytes()
