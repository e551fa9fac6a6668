"""Words of texts as 64-bit codes, computed on all words of a batch at once.

A code mixes a word's bytes eight at a time, each step a bijection of what came
before, so no algebraic pattern in a word (such as a Thue-Morse sequence, which
defeats polynomial hashes modulo a power of two) makes two words meet.  Words of
up to seven bytes have codes of their own; two longer ones share a code by chance
only, with probability 2**-64 a pair.  Where that is not enough, :func:`equal`
compares the bytes themselves.
"""

from __future__ import annotations

import numpy as np

#: Bytes that are not ASCII white space.
NOT_WHITE = np.ones(256, bool)
NOT_WHITE[[9, 10, 11, 12, 13, 32]] = False
#: Words of more bytes are hashed one by one, by a library.
_LONG = 64
_PAD = bytes(8)
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_STEP, _SEED = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xA0761D6478BD642F)


def mixed(x):
    """A bijection of 64-bit values that spreads every bit over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def edges(data):
    """Where the runs of other than white space begin and end; ``data`` begins and
    ends with white space."""
    word = NOT_WHITE[data]
    return np.flatnonzero(word[1:] & ~word[:-1]) + 1, np.flatnonzero(word[:-1] & ~word[1:]) + 1


def _eights(data):
    """The eight bytes from each place on, as one value; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), "<u8", padded, 0, (1,))


def codes(data, begin, end):
    """64-bit codes of the words ``data[begin:end]``, none of them empty."""
    eights, size = _eights(data), end - begin
    code = eights[begin] & _MASK[np.minimum(size, 8)]
    short = size < 8
    code = mixed(np.where(short, code | (size.astype(np.uint64) << np.uint64(56)), code ^ _SEED))
    rest = np.flatnonzero(size >= 8)
    if not len(rest):
        return code
    code[rest] = mixed(code[rest] + size[rest].astype(np.uint64) * _STEP)
    at = 8
    rest = rest[(size[rest] > at) & (size[rest] <= _LONG)]
    while len(rest):
        left = size[rest] - at
        code[rest] = mixed((code[rest] ^ (eights[begin[rest] + at] & _MASK[np.minimum(left, 8)])) + _STEP)
        at += 8
        rest = rest[left > 8]
    long = np.flatnonzero(size > _LONG)
    if len(long):
        from xxhash import xxh3_64_intdigest

        raw = data.tobytes()
        code[long] = [xxh3_64_intdigest(raw[i:j]) for i, j in zip(begin[long].tolist(), end[long].tolist())]
    return code


def same(data, begin, end, one, other):
    """For each pair of words (their numbers) whether they agree byte by byte."""
    eights, left = _eights(data), (end - begin)[one]
    out = left == (end - begin)[other]
    pair = np.flatnonzero(out)
    mine, its, left = begin[one[pair]], begin[other[pair]], left[pair]
    while len(pair):
        unlike = ((eights[mine] ^ eights[its]) & _MASK[np.minimum(left, 8)]) != 0
        out[pair[unlike]] = False
        more = ~unlike & (left > 8)
        pair, mine, its, left = pair[more], mine[more] + 8, its[more] + 8, left[more] - 8
    return out


def equal(data, begin, end, other) -> bool:
    """Whether every word agrees byte by byte with the one that ``other`` names."""
    every = np.arange(len(begin))
    pair = every[other != every]
    return bool(same(data, begin, end, pair, other[pair]).all())


def tokens(texts: list[str | None], lower: bool = True):
    """Codes of the words of all texts end to end, and where each text's words end.
    ``lower``: A-Z count as a-z."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    if lower:
        data = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)
    begin, end = edges(data)
    return codes(data, begin, end), np.searchsorted(begin, np.cumsum([len(x) + 1 for x in raw]))
