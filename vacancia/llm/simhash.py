"""64-bit SimHash fingerprints of word shingles."""

from __future__ import annotations

import numpy as np
import xxhash


def shingle_hashes(words: list[bytes], width: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of ``width`` words joined by spaces; of the whole sequence if there are fewer; none of no words."""
    if not words:
        return np.zeros(0, np.uint64)
    joined, n = b" ".join(words), max(1, len(words) - width + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    ends = (starts + lengths)[min(width, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends.tolist())], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; 0 without hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192]
        counts += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")
