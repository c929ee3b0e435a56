"""Cuts between pre-tokens, and encoding each different piece once, against the libraries."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from ampere.llm import pieces, repair

PARTS = ["a", "Word", "'s", "'", "12", " ", "  ", "\n", "\t", " ", " ", "\u0085", "　", "\x1c", "\x7f", "é",
         "à", "日本", ".", ",", "<|endoftext|>", " \n ", "don't", "😀", "\r\n", "ü", "́", "٣", "–"]


def texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choices(PARTS, k=r.randrange(25))) for _ in range(n)] + [None, "", " ", "  "]


def test_cuts_keep_every_pre_token():
    assert pieces.PATTERN == public_tokenizers.PATTERN
    rows = texts(8000, 1)
    data, ends = pieces.flat(pa.array(rows))
    first = pieces.starts(data, ends)
    at = np.append(first, len(data))
    raw = data.tobytes()
    for t, a, e in zip(rows, np.searchsorted(first, ends[:-1]), np.searchsorted(first, ends[1:]), strict=True):
        mine = [raw[at[k]:at[k + 1]].decode() for k in range(a, e)]
        assert [x for p in mine for x in regex.findall(pieces.PATTERN, p)] == regex.findall(pieces.PATTERN, t or "")


def test_each_different_piece_is_looked_up_once():
    asked = []

    def look_up(found):
        asked.extend(found)
        return [x.upper() for x in found]

    rows = ["one two, one two\none", None, "", "two one"]
    out = pieces.encoded(pa.array(rows), look_up)
    assert out.to_pylist() == [(t or "").upper().encode() for t in rows]
    assert sorted(asked) == sorted(set(asked))
    assert pieces.encoded(pa.array([], pa.string()), look_up).to_pylist() == []


def test_words_of_one_call_equal_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        found = repair.Pieces(f.read())
    assert found.apart
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    rows = texts(3000, 2) + ["à la", "voilà\nLà voilà là", "à" * 100 + " x", "\nà\n  à"]
    for k in range(0, len(rows), 500):
        part = rows[k:k + 500]
        for t, ids in zip(part, found.encode_all(pa.array(part)).to_pylist(), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(t or "", add_special_tokens=False).ids, repr(t)
