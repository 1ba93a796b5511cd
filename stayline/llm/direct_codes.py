"""Directly addressable codes of token ids.

An id is split into chunks, one per level. A level keeps a chunk of every id that
reaches it and a bitmap that says which of them go on to the next level; the place
there is the number of set bits before, which a rank directory gives in constant
time. So any id, and any range of ids, is read without decoding what stands before
it. Chunk widths are chosen for each array so that it takes the fewest bits.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Bits a block of the rank directory covers, and blocks of a superblock.
BLOCK, SUPER = 64, 64
#: Ids decoded at a time.
STEP = 1 << 20


def best_widths(ids: np.ndarray, most: int = 32) -> list[int]:
    """Chunk widths, lowest bits first, with the least total size."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    top = max(1, top)
    if top > most:
        raise ValueError(f"ids need {top} bits, at most {most} are kept")
    # the exponent of a float is the bit length of the whole number in it
    sizes = np.bincount(np.frexp(ids.astype(np.float64))[1], minlength=top + 1)
    longer = np.append(len(ids), len(ids) - np.cumsum(sizes)[1:])
    cost, after = np.zeros(top + 1), [0] * (top + 1)
    for b in range(top - 1, -1, -1):
        # a level that is not the last also has its bitmap, with a quarter more for the directory
        options = [(longer[b] * (e - b + (1.25 if e < top else 0)) + 128 + cost[e], e) for e in range(b + 1, top + 1)]
        cost[b], after[b] = min(options)
    widths, b = [], 0
    while b < top:
        widths.append(after[b] - b)
        b = after[b]
    return widths


def pack(values: np.ndarray, width: int) -> bytes:
    """Values of ``width`` bits one after another, lowest bit first."""
    out = []
    for lo in range(0, len(values), STEP):
        part = values[lo : lo + STEP].astype("<u4").view(np.uint8).reshape(-1, 4)
        bits = np.unpackbits(part, axis=1, bitorder="little", count=width)
        out.append(np.packbits(bits.ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack(read: Callable[[int, int], bytes], width: int, lo: int, hi: int) -> np.ndarray:
    """Values lo .. hi - 1; ``read`` gives bytes from one place to another."""
    first, groups = lo // 8, -(-hi // 8) - lo // 8  # eight values take ``width`` whole bytes
    data = np.zeros(groups * width, np.uint8)
    got = np.frombuffer(read(first * width, (first + groups) * width), np.uint8)
    data[: len(got)] = got
    grid = data.reshape(groups, width)
    out = np.empty((groups, 8), np.uint32)
    for j in range(8):
        byte, shift = divmod(j * width, 8)
        value = np.zeros(groups, np.uint64)
        for k in range(-(-(shift + width) // 8)):
            value |= grid[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = (value >> np.uint64(shift)) & np.uint64(2**width - 1)
    return out.ravel()[lo - first * 8 : hi - first * 8]


def rank_directory(bits: np.ndarray) -> tuple[bytes, bytes]:
    """Set bits before each superblock (64 bits each) and, within it, before each block (16 bits each)."""
    blocks = -(-len(bits) // BLOCK) + 1
    ones = np.zeros(blocks * BLOCK, np.uint8)
    ones[: len(bits)] = bits
    before = np.concatenate([[0], np.cumsum(ones.reshape(-1, BLOCK).sum(axis=1, dtype=np.int64))[:-1]])
    supers = before[::SUPER]
    return supers.astype("<i8").tobytes(), (before - np.repeat(supers, SUPER)[:blocks]).astype("<u2").tobytes()


def encode(ids: np.ndarray) -> tuple[list[dict], list[bytes]]:
    """Levels (width, number of chunks) and, per level, chunks, bitmap, superblocks and blocks (empty in the last)."""
    ids = np.asarray(ids).astype(np.uint32)
    widths = best_widths(ids)
    levels, sections = [], []
    for i, width in enumerate(widths):
        levels.append({"width": width, "n": len(ids)})
        sections.append(pack(ids & np.uint32(2**width - 1), width))
        if i + 1 == len(widths):
            sections += [b"", b"", b""]
            break
        ids = ids >> np.uint32(width)
        more = ids > 0
        sections += [np.packbits(more, bitorder="little").tobytes(), *rank_directory(more)]
        ids = ids[more]
    return levels, sections


class Codes:
    """Reads ids from encoded sections; ``read(section, lo, hi)`` gives bytes lo .. hi - 1 of a section."""

    def __init__(self, levels: list[dict], read: Callable[[int, int, int], bytes]):
        self.levels, self.read = levels, read

    def __len__(self) -> int:
        return self.levels[0]["n"]

    def rank(self, level: int, at: int) -> int:
        """Set bits before place ``at`` of a level's bitmap: three short reads."""
        block = at // BLOCK
        above = np.frombuffer(self.read(4 * level + 2, block // SUPER * 8, block // SUPER * 8 + 8), "<i8")[0]
        within = np.frombuffer(self.read(4 * level + 3, block * 2, block * 2 + 2), "<u2")[0]
        word = int.from_bytes(self.read(4 * level + 1, block * 8, -(-at // 8)), "little")
        return int(above) + int(within) + (word & ((1 << at % BLOCK) - 1)).bit_count()

    def get(self, at: int) -> int:
        """One id."""
        return int(self.range(at, at + 1)[0])

    def range(self, lo: int, hi: int, level: int = 0) -> np.ndarray:
        """Ids lo .. hi - 1, from a stretch of each level."""
        if not 0 <= lo <= hi <= self.levels[level]["n"]:
            raise IndexError(f"{lo}:{hi} of {self.levels[level]['n']}")
        if lo == hi:
            return np.empty(0, np.uint32)
        width = self.levels[level]["width"]
        ids = unpack(lambda a, b: self.read(4 * level, a, b), width, lo, hi)
        if level + 1 < len(self.levels):
            bits = np.unpackbits(np.frombuffer(self.read(4 * level + 1, lo // 8, -(-hi // 8)), np.uint8), bitorder="little")
            more = bits[lo % 8 : lo % 8 + hi - lo].astype(bool)
            n = int(more.sum())
            if n:
                place = self.rank(level, lo)
                ids[more] |= self.range(place, place + n, level + 1) << np.uint32(width)
        return ids
