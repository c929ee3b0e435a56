"""Texts of an Arrow batch cut into pieces, each different piece encoded once.

For the pre-token pattern ``PATTERN`` there are places where a pre-token always ends, whatever
surrounds them, and where either side alone is matched as it is within the text:

* before a space, if a character other than white space follows;
* between an ASCII character that shows and ASCII white space after it;
* between an ASCII letter and an ASCII character that shows and is no letter;
* between two ASCII characters that show and one line feed, tab or the like between them,
  after that.

The cuts are found on the bytes of the whole batch; what may start white space beyond ASCII is
never cut off. Equal pieces are found by Arrow's dictionary encoding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The pre-token pattern that the cuts hold for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bytes of text that are cut at a time, or one longer text.
SLICE = 1 << 22

_B = np.arange(256)
_SHOWN = (_B > 0x20) & (_B < 0x7F)
_LETTER = _SHOWN & (((_B | 32) >= 97) & ((_B | 32) <= 122))
_BREAK = (_B >= 9) & (_B <= 13)
_WHITE = _BREAK | (_B == 32)
#: First bytes of characters that are no white space: U+0085, U+00A0, U+1680, U+2000 to U+205F
#: and U+3000 begin with the bytes left out.
_OPENS = (_B > 0x20) & ~np.isin(_B, [0xC2, 0xE1, 0xE2, 0xE3])


def flat(cells: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings or binaries in one array, and where each one begins and ends; null: none."""
    cells = pc.fill_null(cells.cast(pa.large_binary()), b"")
    ends = np.frombuffer(cells.buffers()[1], np.int64)[cells.offset:cells.offset + len(cells) + 1]
    data = cells.buffers()[2]
    if data is None or not len(cells) or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), np.zeros(len(cells) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def binaries(data, ends: np.ndarray) -> pa.Array:
    """Binaries that lie one after the other in ``data``."""
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(ends, np.int64)), pa.py_buffer(data)])


def starts(data: np.ndarray, ends: np.ndarray, cut: bool = True) -> np.ndarray:
    """Where the pieces begin; a text without ``cut`` is one piece."""
    begins = np.zeros(len(data), bool)
    if cut and len(data) > 1:
        shown, letter = _SHOWN[data], _LETTER[data]
        begins[:-1] = (data[:-1] == 32) & _OPENS[data[1:]]
        begins[ends[1:][ends[1:] > 0] - 1] = False  # a text's last space has nothing after it
        begins[1:] |= shown[:-1] & (_WHITE[data[1:]] | letter[:-1] & shown[1:] & ~letter[1:])
        begins[2:] |= shown[:-2] & _BREAK[data[1:-1]] & shown[2:]
    begins[ends[:-1][ends[:-1] < ends[1:]]] = True
    return np.flatnonzero(begins)


def joined(table: pa.Array, which: pa.Array, ends: np.ndarray) -> pa.Array:
    """Per text the entries of ``table`` that ``which`` names, put together; text ``k`` has those
    from ``ends[k]`` on."""
    data, at = flat(table.take(which))
    return binaries(data, at[ends])


def encoded(texts: pa.Array, look_up, cut: bool = True) -> pa.Array:
    """The ids of each text; ``look_up`` packs those of each of a list of pieces (both as bytes)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    out, at = [], 0
    while at < len(texts) or not out:  # a slice at a time, for little memory
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, "right")))
        out.append(_encoded(texts.slice(at, stop - at), look_up, cut))
        at = stop
    return pa.concat_arrays(out)


def _encoded(texts: pa.Array, look_up, cut: bool) -> pa.Array:
    data, ends = flat(texts)
    first = starts(data, ends, cut)
    found = binaries(data, np.append(first, len(data))).dictionary_encode()
    raw, at = flat(found.dictionary)
    raw, at = raw.tobytes(), at.tolist()
    ids = look_up([raw[a:e] for a, e in zip(at[:-1], at[1:], strict=True)])
    table = binaries(b"".join(ids), np.cumsum([0, *map(len, ids)]))
    return joined(table, found.indices, np.searchsorted(first, ends)).cast(pa.binary())
