"""Vectorised numpy helpers over packed UTF-8 text, shared by the Arrow-based operators."""

import numpy as np
import pyarrow as pa

#: Odd multiplier of sequence hashes, and the finaliser's two multipliers.
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
#: Prime moduli of the range hash with a base each. Powers of one base modulo a power of two would
#: let two words over two letters collide (one is the complement of the other).
MODULI = ((2147483647, 1000000007), (2147483629, 998244353))
#: Bytes of text handled at once; bounds the memory of a task whatever the batch size.
SLICE_BYTES = 700_000

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_POWERS = [(np.ones(1, np.uint64), np.ones(1, np.uint64)) for _ in MODULI]


def _grown(known, base, prime, size):
    while len(known) < size:
        step = np.uint64(pow(base, len(known), prime))
        known = np.concatenate([known, known * step % np.uint64(prime)])
    return known


def powers(which, size):
    """Powers of a base and of its inverse by its prime, at least ``size`` of each."""
    prime, base = MODULI[which]
    up, down = _POWERS[which]
    if len(up) < size:
        _POWERS[which] = (_grown(up, base, prime, size), _grown(down, pow(base, -1, prime), prime, size))
    return _POWERS[which]


def mixed(h):
    """Spread the bits of 64-bit values (bijective)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(MIX[0])
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(MIX[1])
    return h ^ (h >> np.uint64(31))


def range_hashes(values, starts, ends):
    """64-bit hash of each ``values[start:end]``, equal for equal content.

    Not proof of equal content: compare what is behind equal hashes (``exact_groups``).
    """
    n = len(values)
    parts = []
    for which, (prime, _) in enumerate(MODULI):
        up, down = powers(which, n + 1)
        prime = np.uint64(prime)
        total = np.zeros(n + 1, np.uint64)
        # terms are below 2**31, so their running sum fits for any text
        np.multiply(values, up[:n], out=total[1:], dtype=np.uint64, casting="unsafe")
        total[1:] %= prime
        np.cumsum(total, out=total)
        parts.append((total[ends] - total[starts]) % prime * down[starts] % prime)
    raw = parts[0] << np.uint64(32) | parts[1]
    return mixed(mixed(raw) ^ (ends - starts).astype(np.uint64))


def exact_groups(hashes, same, content):
    """Group number of each item, equal exactly for equal content.

    ``same(i, j)`` compares items with equal hashes pair by pair; only if some differ, items are
    numbered by ``content(i)``.
    """
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    tied = np.flatnonzero(~new)
    group = np.empty(len(h), np.int64)
    group[order] = np.cumsum(new) - 1
    if len(tied) and not same(order[tied], order[tied - 1]).all():
        seen = {}
        for i in range(len(h)):
            group[i] = seen.setdefault(content(i), len(seen))
    return group


def same_ranges(data, starts, ends, a, b):
    """Whether ranges ``a`` and ``b`` hold the same values, pair by pair."""
    length = ends - starts
    out = length[a] == length[b]
    rows = np.flatnonzero(out)
    step = 4096
    for at in range(0, len(rows), step):
        part = rows[at:at + step]
        size = length[a[part]]
        own = np.repeat(part, size)
        differ = data[spread(starts[a[part]], size)] != data[spread(starts[b[part]], size)]
        out[own[differ]] = False
    return out


def sequence_hashes(hashes, length):
    """Hash of each run of ``length`` consecutive values."""
    n = max(0, len(hashes) - length + 1)
    out = np.zeros(n, np.uint64)
    for i in range(length):
        out = out * np.uint64(BASE) + hashes[i:i + n]
    return mixed(out)


def sliding_minimum(values, width):
    """Minimum of every run of ``width`` consecutive values, by doubling."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


class Texts:
    """Texts of an Arrow column as one byte buffer; nulls are empty texts."""

    def __init__(self, data, offsets):
        self.data, self.offsets = data, offsets

    def __len__(self):
        return len(self.offsets) - 1

    def words(self):
        """(starts, ends, first word index of each text and the total).

        Words are maximal runs of bytes outside 0x20 and 0x09-0x0D within a text.
        """
        data, n = self.data, len(self.data)
        inside = ~SPACE[data]
        cut = np.zeros(n + 1, bool)
        cut[self.offsets] = True
        before = np.concatenate([[False], inside[:-1]]) if n else inside
        after = np.concatenate([inside[1:], [False]]) if n else inside
        starts = np.flatnonzero(inside & (~before | cut[:n]))
        ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def lowered(self):
        """The same texts with A-Z in lower case."""
        upper = (self.data >= 65) & (self.data <= 90)
        return Texts(np.where(upper, self.data + 32, self.data).astype(np.uint8), self.offsets)

    def bytes_of(self, i):
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def texts_of(column) -> Texts:
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = offsets[0] if len(offsets) else 0
    return Texts(data[low:offsets[-1]] if len(offsets) else data, offsets - low)


def slices(batches, column="text", most=SLICE_BYTES):
    """Cut record batches so that each piece holds about ``most`` bytes of text, or one row."""
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        offsets = texts_of(batch.column(at)).offsets
        row = 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
            yield batch.slice(row, end - row)
            row = end


def per_text(first, values, how=np.add):
    """Reduce ``values`` (one per word) to one number per text; texts without words give 0."""
    out = np.zeros(len(first) - 1, np.int64)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        out[full] = how.reduceat(values, first[:-1][full])
    return out


def spread(starts, lengths):
    """Indices of the concatenated ranges ``start .. start + length``."""
    total = int(lengths.sum())
    begin = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - begin, lengths)
