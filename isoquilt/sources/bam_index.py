"""The region index that stands beside a sorted BAM file: bins of six widths, and a linear index of 16 kb windows.

Places in the file are virtual offsets: the byte of a compressed block, times 2**16, plus the byte inside it.
"""

import struct
from collections import defaultdict

MAGIC = b"BAI\1"
# Fixed values of the format: width of the bins of each level as a power of two, and the number of its first bin.
LEVELS = ((29, 0), (26, 1), (23, 9), (20, 73), (17, 585), (14, 4681))
WINDOW = 14


def bin_of(begin: int, end: int) -> int:
    """The smallest bin that holds the places begin .. end - 1."""
    for shift, first in reversed(LEVELS):
        if begin >> shift == (end - 1) >> shift:
            return first + (begin >> shift)
    return 0


def bins_over(begin: int, end: int) -> list:
    """All bins that share a place with begin .. end - 1, as ranges."""
    end = min(end, 1 << LEVELS[0][0])
    return [range(first + (begin >> shift), first + (max(begin, end - 1) >> shift) + 1) for shift, first in LEVELS]


class Index:
    """Per reference: the stretches of the file that hold the records of each bin, and the linear index."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a BAM index")
        at = 4

        def number(kind):
            nonlocal at
            at += struct.calcsize(kind)
            return struct.unpack_from("<" + kind, data, at - struct.calcsize(kind))[0]

        self.bins, self.linear = [], []
        for _ in range(number("i")):
            held = {}
            for _ in range(number("i")):
                name, count = number("I"), number("i")
                held[name] = [(number("Q"), number("Q")) for _ in range(count)]
            self.bins.append(held)
            self.linear.append([number("Q") for _ in range(number("i"))])

    def chunks(self, ref: int, begin: int, end: int) -> list:
        """Stretches (from, to) with all records that overlap the places begin .. end - 1, in order and apart."""
        if ref >= len(self.bins) or end <= begin:
            return []
        linear = self.linear[ref]
        least = linear[min(begin >> WINDOW, len(linear) - 1)] if linear else 0
        held = self.bins[ref]
        wanted = bins_over(begin, end)
        names = [b for b in held if any(b in r for r in wanted)]
        return merged((max(low, least), high) for b in names for low, high in held[b] if high > least)

    def pieces(self, ref: int, stretch: tuple, most: int) -> list:
        """A stretch cut into pieces of about ``most`` bytes, at records that start a window."""
        low, high = stretch
        out = []
        for place in sorted({x for x in self.linear[ref] if low < x < high}):
            if (place >> 16) - (low >> 16) >= most:
                out.append((low, place))
                low = place
        return [*out, (low, high)]


def merged(stretches) -> list:
    """Stretches in order, those that touch as one."""
    out: list = []
    for low, high in sorted(stretches):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


class Builder:
    """Collects the records of a file in their order and writes its index."""

    def __init__(self, references: int):
        self.bins = [defaultdict(list) for _ in range(references)]
        self.linear: list[list] = [[] for _ in range(references)]
        self.last = (-1, -1)

    def add(self, ref: int, begin: int, end: int, low: int, high: int) -> None:
        """A record over begin .. end - 1 that lies at the virtual offsets low .. high."""
        if (ref if ref >= 0 else len(self.bins), begin) < self.last:
            raise ValueError("an index needs records sorted by reference and position in every partition")
        self.last = (ref if ref >= 0 else len(self.bins), begin)
        if ref < 0:
            return
        held = self.bins[ref][bin_of(begin, end)]
        if held and held[-1][1] == low:
            held[-1] = (held[-1][0], high)
        else:
            held.append((low, high))
        windows = self.linear[ref]
        windows += [None] * ((end - 1 >> WINDOW) + 1 - len(windows))
        for k in range(begin >> WINDOW, (end - 1 >> WINDOW) + 1):
            windows[k] = low if windows[k] is None else windows[k]

    def data(self) -> bytes:
        out = [MAGIC, struct.pack("<i", len(self.bins))]
        for held, windows in zip(self.bins, self.linear):
            out.append(struct.pack("<i", len(held)))
            for name in sorted(held):
                out.append(struct.pack("<Ii", name, len(held[name])))
                out += [struct.pack("<QQ", *x) for x in held[name]]
            filled, before = [], 0
            for x in windows:
                before = before if x is None else x
                filled.append(before)
            out.append(struct.pack(f"<i{len(filled)}Q", len(filled), *filled))
        return b"".join(out)
