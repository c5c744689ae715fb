"""64-bit hashes of words and of word windows, whole batches at a time in numpy."""

import numpy as np

BLOCK = 1 << 18  # bytes that are hashed at a time; cut between words
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_CHARS = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_block(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of ``data``, A-Z in lower case."""
    space = _SPACE[data]
    edges = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    powers = np.full(len(data), _PRIME)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_CHARS[_LOWER[data]] * np.cumprod(powers), out=sums[1:])
    powers[:] = _INVERSE
    back = np.cumprod(powers)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64)), starts


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's words end among them."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw), dtype=np.uint8)
    lengths = np.array([len(r) for r in raw], dtype=np.int64)
    limits = np.cumsum(lengths + 1)  # with the space between
    hashes, places, at = [], [], 0
    while at < len(data):
        end = at + BLOCK
        if end < len(data):
            window = np.flatnonzero(_SPACE[data[at:end]])
            while not len(window) and end < len(data):  # a word longer than the block
                end += BLOCK
                window = np.flatnonzero(_SPACE[data[at:end]])
            if len(window) and end < len(data):
                end = at + int(window[-1]) + 1
        h, s = _hash_block(data[at:end])
        hashes.append(h)
        places.append(s + at)
        at = end
    if not hashes:
        return np.empty(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), limits, side="left")


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    size = min(size, len(words))
    out = words[: len(words) - size + 1].copy()
    for k in range(1, size):
        out = mix(out * _PRIME + words[k : len(words) - size + 1 + k])
    return mix(out + np.uint64(size))
