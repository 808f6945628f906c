"""Word shingles as 64-bit hashes, and SuperMinHash signatures over them (numpy)."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import U64, mix64

_ODD = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0x27D4EB2F165667C5),
        U64(0x85EBCA77C2B2AE63)]


def word_hashes(text: str | None) -> np.ndarray:
    """One hash per word: A-Z lowered, words are runs without ASCII white space."""
    if not text:
        return np.empty(0, np.uint64)
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's ``width``-word shingles.

    A text with fewer words is one shingle, a text without words has none.
    """
    h = word_hashes(text)
    if not len(h):
        return h
    w = min(width, len(h))
    with np.errstate(over="ignore"):
        acc = np.full(len(h) - w + 1, U64(w))
        for i in range(w):
            acc = mix64(acc * _ODD[0] + h[i : len(h) - w + 1 + i] * _ODD[1 + i % 4])
    return np.unique(acc)


def superminhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures, uint32, one row of ``m`` slots (at most 1024) per set.

    Element x walks its own random permutation of the slots; at step j it offers
    ``j + r`` to the j-th slot, so the ranks of one element are correlated (each
    slot gets a different integer part). A set is finished at step j as soon as
    all its slots hold a value below j: nothing later can be smaller. All
    elements of all sets of the batch take step j together.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full((len(sets), m), np.iinfo(np.uint64).max, np.uint64)
    if not sizes.sum():
        return np.zeros((len(sets), m), np.uint32)
    flat = out.reshape(-1)
    elem = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    for lo in range(0, len(elem), 1 << 18):  # bounded memory for very long texts
        x, doc = elem[lo : lo + (1 << 18)], owner[lo : lo + (1 << 18)]
        perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(x), 1))
        live = np.arange(len(x))
        for j in range(m):
            open_docs = (out.max(axis=1) >> U64(32)) >= j
            keep = open_docs[doc[live]]
            if not keep.all():
                live = live[keep]
            if not len(live):
                break
            with np.errstate(over="ignore"):
                r = mix64(x[live] + _ODD[0] * U64(j + 1))
            k = (j + (((r >> U64(32)) * U64(m - j)) >> U64(32))).astype(np.int64)
            slot = perm[live, k]
            perm[live, k] = perm[live, j]
            np.minimum.at(flat, doc[live] * m + slot, (U64(j) << U64(32)) | (r & U64(0xFFFFFFFF)))
    return ((out >> U64(32)) << U64(22) | (out & U64(0xFFFFFFFF)) >> U64(10)).astype(np.uint32)


def jaccard_counts(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted distinct arrays."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both, len(a) + len(b) - both
