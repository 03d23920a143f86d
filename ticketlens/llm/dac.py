"""Token ids as directly addressable codes.

Format of one segment (all integers little-endian):

    header   8 bytes b"TLDAC\\x00\\x01\\x00", then uint64 n_tokens, uint64 n_docs,
             uint32 chunk_bits (8), uint32 n_levels
    docs     n_docs int64 doc ids, n_docs uint8 "id is not NULL", n_docs + 1 uint64 token offsets
    level l  uint64 n_l, n_l chunk bytes, ceil(n_l / 8) bytes continuation bitmap
             (bit i % 8 of byte i // 8), then the rank directory:
             ceil(n_l / 512) + 1 uint64 counts of set bits before each 512-bit block

Level 0 holds the low 8 bits of every id.  A set continuation bit says that
the id goes on in the next level, at the index that the rank of the bit
gives.  So token i is read with one rank per level and no block is decoded.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"TLDAC\x00\x01\x00"
CHUNK = 8
BLOCK = 512
_HEAD = struct.Struct("<8sQQII")


def encode_segment(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment: ``counts[i]`` ids of document i, documents in the given order."""
    offsets = np.zeros(len(counts) + 1, dtype="<u8")
    np.cumsum(counts, out=offsets[1:])
    if int(offsets[-1]) != len(ids):
        raise ValueError("counts and ids disagree")
    levels = []
    rest = np.asarray(ids, dtype=np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        blocks = -(-len(rest) // BLOCK)
        ones = np.zeros(blocks * BLOCK, dtype=np.uint8)
        ones[: len(rest)] = more
        ranks = np.zeros(blocks + 1, dtype="<u8")
        np.cumsum(ones.reshape(blocks, BLOCK).sum(axis=1, dtype=np.uint64), out=ranks[1:])
        levels.append((len(rest), (rest & np.uint32(0xFF)).astype(np.uint8), bits, ranks))
        rest = rest[more] >> np.uint32(CHUNK)
        if len(rest) == 0:
            break
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    out = [
        _HEAD.pack(MAGIC, len(ids), len(counts), CHUNK, len(levels)),
        np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes(),
        known.tobytes(),
        offsets.tobytes(),
    ]
    for n, chunks, bits, ranks in levels:
        out += [struct.pack("<Q", n), chunks.tobytes(), bits.tobytes(), ranks.tobytes()]
    return b"".join(out)


class Segment:
    """Reads one segment; nothing is decoded before it is asked for."""

    def __init__(self, data: bytes) -> None:
        magic, self.n_tokens, self.n_docs, chunk, n_levels = _HEAD.unpack_from(data, 0)
        if magic != MAGIC or chunk != CHUNK:
            raise ValueError("not a token segment")
        at = _HEAD.size
        ids = np.frombuffer(data, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        known = np.frombuffer(data, np.uint8, self.n_docs, at)
        at += self.n_docs
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known)]
        self.offsets = np.frombuffer(data, "<u8", self.n_docs + 1, at).astype(np.int64)
        at += 8 * (self.n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            at += 8
            chunks = np.frombuffer(data, np.uint8, n, at)
            at += n
            bits = np.frombuffer(data, np.uint8, -(-n // 8), at)
            at += len(bits)
            ranks = np.frombuffer(data, "<u8", -(-n // BLOCK) + 1, at)
            at += 8 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def token(self, i: int) -> int:
        """Id number ``i`` of the segment, by one rank lookup per level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not (int(bits[i >> 3]) >> (i & 7)) & 1:
                break
            block = i // BLOCK
            between = int.from_bytes(bits[block * BLOCK // 8 : (i >> 3) + 1].tobytes(), "little")
            between &= (1 << (i - block * BLOCK)) - 1
            i = int(ranks[block]) + between.bit_count()
            shift += CHUNK
        return value

    def all_ids(self) -> np.ndarray:
        """Every id of the segment in order (the levels are merged from the last one up)."""
        deeper = np.zeros(0, dtype=np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            value = chunks.astype(np.uint32)
            more = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
            value[more] |= deeper << np.uint32(CHUNK)
            deeper = value
        return deeper
