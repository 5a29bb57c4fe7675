"""64-bit hashes of words and of runs of words, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII capitals to small letters, everything else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (shift, multiply, shift)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int = 1) -> np.ndarray:
    """``n`` odd pseudo-random factors."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, one after the other, and words per text.

    A word's hash is the sum of its bytes times a factor per place, scrambled: equal words have
    equal hashes, different ones collide with a chance of about 2^-57 a pair."""
    texts = [t or b"" for t in texts]
    joined = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    inside = ~SPACE[joined]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends_of_texts = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, ends_of_texts, "left"), prepend=0) if len(texts) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), counts
    lengths = ends - starts
    at = np.flatnonzero(inside)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(at)) - np.repeat(first, lengths)
    parts = constants(int(lengths.max()))[place]
    parts *= joined[at].astype(np.uint64) + np.uint64(1)
    sums = np.add.reduceat(parts, first)
    return mix(sums + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), counts


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words (none when there are fewer)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    factors = constants(width, seed=7)
    out = words[:n] * factors[0]
    for k in range(1, width):
        out += words[k:k + n] * factors[k]
    return mix(out)
