"""Word shingles of whole texts as 64-bit hashes, batch by batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 8_000_000  # of text that is worked on at once
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive parts of about ``most`` bytes, at least one text each."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = sizes[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(sizes, done + most, side="right")))
        yield texts.slice(at, stop - at)
        at = stop


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (lower-cased A-Z, split at ASCII white space) and the offsets of the texts in them."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = split.flatten().dictionary_encode()
    words = flat.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))
    codes = flat.indices.to_numpy(zero_copy_only=False)
    offsets = split.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    # Splitting leaves empty strings at the ends of a text; they are no words.
    empty = np.array([w == "" for w in words], dtype=bool)
    if empty.any():
        real = ~empty[codes]
        before = np.concatenate([[0], np.cumsum(real)])
        codes, offsets = codes[real], before[offsets]
    return hashes[codes], offsets


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles.

    A text with fewer words has one shingle, the whole sequence; one without words has none.
    """
    for part in slices(texts):
        yield from _shingle_sets(part, width)


def _shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    hashes, offsets = word_hashes(texts)
    n = len(hashes) - width + 1
    with np.errstate(over="ignore"):
        windows = sum((hashes[i : i + n] * _FACTORS[i] for i in range(width)), np.uint64(0)) if n > 0 else hashes[:0]
        windows = mix(windows)
        for start, stop in zip(offsets[:-1], offsets[1:], strict=True):
            if stop - start >= width:
                yield np.unique(windows[start : stop - width + 1])
            elif stop > start:
                few = (hashes[start:stop] * _FACTORS[: stop - start]).sum(dtype=np.uint64)
                yield mix(np.array([few + np.uint64(stop - start)], dtype=np.uint64))
            else:
                yield hashes[:0]
