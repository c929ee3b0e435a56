"""Token ids in files compressed by Re-Pair grammars, with random-access decoding.

Texts are encoded, an end id is appended, and the id stream in ascending order of document
ids is cut into shards at document ends. In each shard, frequent pairs of neighbouring ids are
replaced by nonterminals, over and over, until no pair is frequent or a round gains next to
nothing; a round replaces all pairs that occur at least a ``1 / STEP`` part as often as the most
frequent one, where two overlap the more frequent. A shard stores the symbols left, the rules (two symbols each) and
the expansion length of each rule, so that a document is decoded from the symbols that cover
its range alone.

The files are Parquet with one row per shard, binary columns little-endian:

=========  =====================================================================
part       number of the range of document ids the shard lies in
shard      number of the shard in its part
start      ids in earlier shards of the part
n_tokens   ids in the shard
ids, ends  its documents, and where each one's ids end within the shard
base       first nonterminal
symbols    the compressed sequence
rules      pairs of symbols; rule ``r`` is symbol ``base + r``
lengths    ids that each rule stands for, unsigned 32-bit
=========  =====================================================================

Symbols are unsigned integers of 16 bits in a shard with at most 2^16 of them, else of 32.

Encoding calls the tokenizers library on each different piece of text once per worker: texts
are cut where a byte-level pre-tokenizer always starts a new token (``pieces``).

Defined results: null and empty texts have the end id alone; repeated rows are documents of
their own; null ids come first; of equal ids the order is by a hash of the token ids; an
empty table gives no shard and an empty result; other columns are not looked at. A task holds one shard,
that is ``SHARD`` ids or one longer document.
"""

from __future__ import annotations

import os
import re
import struct
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.llm.common import shuffle_files_removed
from ampere.llm.pieces import encoded

END = 2
SHARD = 1 << 19
#: Documents per range, and the largest number of ranges (more: longer ranges).
PART = 20_000
PARTS = 20_000
#: A pair is frequent from so many occurrences; a round goes down to this part of the top.
FREQUENT = 16
STEP = 64
#: A grammar is done when a round would shorten its sequence by less than this part.
GAIN = 0.02
CACHED_PIECES = 800_000
#: Bytes of the longest piece that is kept.
LONGEST_PIECE = 64
#: Words that the library's model merges in one call.
WORDS = 256
ROWS = 1024


# ------------------------------------------------------------------ encoding

_id = attrgetter("id")


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: the byte's own
    Latin-1 character if that shows, else the next one from U+0100 on."""
    shown = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Pieces(dict):
    """Pieces of text to packed ids, by the library; forgets everything when it is full."""

    def __init__(self, vocabulary: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task per core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.library.model
        # Latin letters, with or without a space before them, are one pre-token.
        self.word = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+").fullmatch
        self.byte_letters = _byte_letters()
        space, line = self.byte_letters[32], self.byte_letters[10]
        known = self.library.get_vocab()
        first = np.zeros(max(known.values(), default=0) + 1, bool)
        first[[k for token, k in known.items() if token.startswith(space)]] = True
        #: Tokens that begin with a space, and the one that is a line feed.
        self.first, self.line = first, known.get(line)
        lead, rest = ("".join(map(self.byte_letters.get, x)) for x in (range(0xC3, 0xCA), range(0x80, 0xC0)))
        mixed = re.compile(f"([A-Za-z]|(^|[{lead}])[{rest}])[{space}{line}]|{line}[A-Za-z{lead}]").search
        #: No token reaches over the start of a word, so many words can be merged in one call.
        self.apart = self.line is not None and not any(map(mixed, known))

    def words(self, found: list[bytes], spaced: bool) -> None:
        """Ids of many words, all of them with a space before, or all without: by one call of the
        library's model, as no merge reaches from one into the next."""
        text = (b"" if spaced else b"\n").join(found)
        ids = np.fromiter(map(_id, self.model.tokenize(text.decode("latin-1").translate(self.byte_letters))), "<u4")
        if spaced:
            ends = np.append(np.flatnonzero(self.first[ids]), len(ids))
        else:
            lines = ids == self.line
            ends = np.concatenate([[0], np.flatnonzero(lines) - np.arange(int(lines.sum())), [len(ids) - int(lines.sum())]])
            ids = ids[~lines]
        raw, ends = ids.tobytes(), (ends * 4).tolist()
        self.update((x, raw[a:e]) for x, a, e in zip(found, ends[:-1], ends[1:], strict=True))

    def learn(self, found: list[bytes]) -> None:
        spaced, bare = [], []
        for x in found:
            text = x.decode("utf-8", "surrogatepass")
            if self.apart and len(x) <= LONGEST_PIECE and self.word(text):
                (spaced if x[0] == 32 else bare).append(x)
            else:
                self[x] = np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        for many, has in ((spaced, True), (bare, False)):
            for k in range(0, len(many), WORDS):
                self.words(many[k:k + WORDS], has)

    def look_up(self, found: list[bytes]) -> list[bytes]:
        if len(self) > CACHED_PIECES:
            self.clear()
        new = [x for x in found if x not in self]
        self.learn(new)
        out = list(map(self.__getitem__, found))
        for x in new:
            if len(x) > LONGEST_PIECE:
                del self[x]
        return out

    def encode_all(self, texts: pa.Array) -> pa.Array:
        return encoded(texts, self.look_up)

    def encode(self, text: str | None) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0].as_py()


# ------------------------------------------------------------------ grammars

_MIX, _BITS = np.uint64(0x9E3779B97F4A7C15), 20


def _slots(keys: np.ndarray) -> np.ndarray:
    return (keys * _MIX) >> np.uint64(64 - _BITS)


def _frequent(keys: np.ndarray, frequent: int, step: int) -> np.ndarray:
    """The pairs to replace in this round, most frequent first (ties by the pair)."""
    ordered = np.sort(keys)
    at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    count = np.diff(at, append=len(ordered))
    top = int(count.max())
    if top < frequent:
        return ordered[:0]
    chosen = np.flatnonzero(count >= max(frequent, top // step))
    pairs = ordered[at[chosen]]
    return pairs[np.lexsort((pairs, -count[chosen]))]


def _places(keys: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where one of ``pairs`` is, and which, by a table of hashes. Of pairs that share a slot the
    first is found; the others wait for another round."""
    table = np.full(1 << _BITS, -1, np.int32)
    table[_slots(pairs)[::-1]] = np.arange(len(pairs) - 1, -1, -1)
    which = table[_slots(keys)]
    at = np.flatnonzero(which >= 0)
    rank = which[at]
    hit = pairs[rank] == keys[at]
    return at[hit], rank[hit].astype(np.int64)


def _apart(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which places to take where pairs overlap: the better rank; of equal ones (as in a a a)
    every other."""
    touch = np.diff(at) == 1
    begins = np.ones(len(at), bool)
    begins[1:] = ~(touch & (rank[1:] == rank[:-1]))
    n = np.arange(len(at))
    good = (n - np.maximum.accumulate(np.where(begins, n, 0))) % 2 == 0
    good[:-1] &= ~(touch & (rank[1:] < rank[:-1]))
    good[1:] &= ~(touch & (rank[:-1] < rank[1:]))
    return good


def compress(ids: np.ndarray, frequent: int = FREQUENT, step: int = STEP, gain: float = GAIN):
    """Symbols, rules and rule lengths of a Re-Pair grammar of ``ids``, and its first nonterminal."""
    s = ids.astype(np.uint64)
    base = int(s.max()) + 1 if len(s) else 0
    rules, lengths, made = [], np.zeros(0, np.int64), 0
    while len(s) > 1:
        keys = (s[:-1] << np.uint64(32)) | s[1:]
        pairs = _frequent(keys, frequent, step)
        if not len(pairs):
            break
        at, rank = _places(keys, pairs)
        good = _apart(at, rank)
        at, rank = at[good], rank[good]
        used = np.bincount(rank, minlength=len(pairs)) >= max(2, frequent // 2)
        if not used.any():
            break
        mine = used[rank]
        at, rank = at[mine], rank[mine]
        if len(at) < gain * len(s):
            break
        new = pairs[used]
        left, right = (new >> np.uint64(32)).astype(np.int64), (new & np.uint64(0xFFFFFFFF)).astype(np.int64)
        lengths = np.concatenate([lengths, _sizes(left, base, lengths) + _sizes(right, base, lengths)])
        rules.append(np.stack([left, right], 1))
        s[at] = (np.cumsum(used) - 1 + base + made)[rank].astype(np.uint64)
        made += len(new)
        keep = np.ones(len(s), bool)
        keep[at + 1] = False
        s = s[keep]
    rules = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    kind = symbol_type(base, len(rules))
    return s.astype(kind), rules.astype(kind), lengths.astype("<u4"), base


def symbol_type(base: int, n_rules: int) -> str:
    return "<u2" if base + n_rules <= 1 << 16 else "<u4"


def _sizes(symbols: np.ndarray, base: int, lengths: np.ndarray) -> np.ndarray:
    out = np.ones(len(symbols), np.int64)
    rule = symbols >= base
    out[rule] = lengths[symbols[rule] - base]
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for; rules are expanded level by level, once each."""
    used = np.flatnonzero(np.bincount(symbols[symbols >= base].astype(np.int64) - base, minlength=len(rules)))
    flat, rules = used + base, rules.astype(np.int64)
    while (inner := flat >= base).any():
        n = np.where(inner, 2, 1)
        at = np.cumsum(n) - n
        out = np.empty(int(n.sum()), np.int64)
        out[at] = flat
        pair = rules[flat[inner] - base]
        out[at[inner]], out[at[inner] + 1] = pair[:, 0], pair[:, 1]
        flat = out
    start = np.zeros(len(rules), np.int64)
    start[used] = np.cumsum(lengths[used].astype(np.int64)) - lengths[used]
    table = np.concatenate([flat, np.arange(base)]).astype("<u4")  # each rule used, then each id itself
    symbols = symbols.astype(np.int64)
    size = _sizes(symbols, base, lengths)
    rule = symbols >= base
    begin = symbols + len(flat)
    begin[rule] = start[symbols[rule] - base]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total + len(table) < 1 << 31 else np.int64  # half the memory to move
    return table[np.repeat((begin - ends + size).astype(kind), size) + np.arange(total, dtype=kind)]


def slice_of(symbols, rules, lengths, base, covered: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a shard from the symbols that cover them; ``covered`` holds
    where the expansion of each symbol ends."""
    first = int(np.searchsorted(covered, start, "right"))
    last = int(np.searchsorted(covered, stop, "left")) + 1
    before = int(covered[first - 1]) if first else 0
    return expand(symbols[first:last], rules, lengths, base)[start - before:stop - before]


# --------------------------------------------------------------------- files

def write(docs: DataFrame, path: str, vocabulary: str, id: str = "doc_id", text: str = "text",
          end: int = END, shard: int = SHARD, part: int = PART, frequent: int = FREQUENT) -> None:
    """Write the ids of all documents, in ascending order of their ids, as grammar shards.

    Texts, smaller than their ids, are dealt into ranges of document ids and sorted there; each
    task encodes and compresses its range shard by shard."""
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:  # a fixed file of a few megabytes
        table = spark.sparkContext.broadcast({"vocabulary": f.read()})
    last = np.array([end], "<u4").tobytes()
    parts = max(1, min(PARTS, -(-docs.count() // part)))
    rows = docs.select(docs[f"`{id}`"].alias("id"), docs[f"`{text}`"].alias("text"))
    # Equal ids are told apart by their texts, equal rows by their place: no range is one key.
    order = ["id", "tie", "row"]
    dealt = (rows.select("*", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
             .repartitionByRange(parts, *order).sortWithinPartitions(*order)
             .select("id", "text", F.spark_partition_id().alias("part")))
    key = rows.schema["id"].dataType

    def work(batches):
        names = [f.name for f in schema]
        # A Python worker keeps what it has learnt, up to its bound, for its next tasks.
        kept = table.value
        if "pieces" not in kept:
            kept["pieces"] = Pieces(kept["vocabulary"])
        pieces = kept["pieces"]
        held, size, where, state = [], 0, None, [0, 0]

        def close():
            ids = np.frombuffer(b"".join(x for _, x in held), "<u4")
            symbols, rules, lengths, base = compress(ids, frequent)
            row = [[where], [state[0]], [state[1]], [len(ids)], [[k for k, _ in held]],
                   [np.cumsum([len(x) // 4 for _, x in held]).tolist()], [base],
                   [symbols.tobytes()], [rules.tobytes()], [lengths.tobytes()]]
            state[0] += 1
            state[1] += len(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, [*types[:4], pa.list_(known), *types[4:]], strict=True)], names=names)

        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(),
                 pa.binary(), pa.binary(), pa.binary()]
        known = None
        for whole in batches:
            known = whole.schema.field(0).type
            for off in range(0, whole.num_rows, ROWS):
                b = whole.slice(off, ROWS)
                coded = pieces.encode_all(b.column(1)).to_pylist()
                for k, x, p in zip(b.column(0).to_pylist(), coded, b.column(2).to_pylist(), strict=True):
                    x += last
                    if held and size + len(x) // 4 > shard:
                        yield close()
                        held, size = [], 0
                    held.append((k, x))
                    size, where = size + len(x) // 4, p
        if held:
            yield close()

    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("shard", T.LongType()),
        T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(key)), T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("base", T.LongType()), T.StructField("symbols", T.BinaryType()),
        T.StructField("rules", T.BinaryType()), T.StructField("lengths", T.BinaryType())])
    with shuffle_files_removed(spark):
        dealt.mapInArrow(work, schema).write.option("compression", "zstd").parquet(path)


def _decode(shards: DataFrame, id: str) -> DataFrame:
    """Documents of shards with columns part, start, ids, ends, pick (places in the shard, null:
    all) and the grammar: part, ``id``, start, n_tokens, ids."""
    key = shards.schema["ids"].dataType.elementType

    def work(batches):
        for b in batches:
            for k in range(b.num_rows):
                row = {name: b.column(i)[k] for i, name in enumerate(b.schema.names)}
                lengths, base = np.frombuffer(row["lengths"].as_py(), "<u4"), row["base"].as_py()
                kind = symbol_type(base, len(lengths))
                symbols = np.frombuffer(row["symbols"].as_py(), kind)
                rules = np.frombuffer(row["rules"].as_py(), kind).reshape(-1, 2)
                ends = row["ends"].values.to_numpy(zero_copy_only=False)
                starts, keys = ends - np.diff(ends, prepend=0), row["ids"].as_py()
                pick = row["pick"].as_py()
                if pick is None:
                    whole = expand(symbols, rules, lengths, base)
                    pick = range(len(ends))
                    found = [whole[starts[j]:ends[j]] for j in pick]
                else:
                    covered = np.cumsum(_sizes(symbols.astype(np.int64), base, lengths))
                    found = [slice_of(symbols, rules, lengths, base, covered, starts[j], ends[j]) for j in pick]
                first = row["start"].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"].as_py()] * len(found), pa.int32()),
                     pa.array([keys[j] for j in pick], row["ids"].type.value_type),
                     pa.array([first + int(starts[j]) for j in pick], pa.int64()),
                     pa.array([len(x) for x in found], pa.int64()),
                     pa.array([x.tobytes() for x in found], pa.binary())],
                    names=["part", id, "start", "n_tokens", "ids"])

    return shards.select("part", "start", "ids", "ends", "base", "symbols", "rules", "lengths", "pick").mapInArrow(
        work, T.StructType([T.StructField("part", T.IntegerType()), T.StructField(id, key),
                            T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
                            T.StructField("ids", T.BinaryType())]))


def _placed(files: DataFrame, found: DataFrame, id: str) -> DataFrame:
    """``start`` counted over all parts; there are at most ``PARTS`` of them."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return found.join(F.broadcast(parts), "part").select(
        id, (F.col("start") + F.col("_before")).alias("start"), "n_tokens", "ids")


def read(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """Every document of the files: ``id``, start (ids before it), n_tokens, ids."""
    files = spark.read.parquet(path)
    return _placed(files, _decode(files.withColumn("pick", F.lit(None).cast("array<int>")), id), id)


def lookup(spark: SparkSession, path: str, wanted: DataFrame, id: str = "doc_id") -> DataFrame:
    """The documents named in ``wanted[id]`` alone, decoded without expanding their shards."""
    files = spark.read.parquet(path)
    listed = files.select("part", "shard", F.posexplode("ids").alias("at", "_id"))
    asked = wanted.select(wanted[f"`{id}`"].alias("_id")).distinct()
    picks = listed.join(asked, "_id", "left_semi").groupBy("part", "shard").agg(
        F.sort_array(F.collect_list("at")).alias("pick"))  # at most a shard's documents
    return _placed(files, _decode(files.join(picks, ["part", "shard"]), id), id)
