"""Packing of tokenised documents into sequences, by dominance reduction and best fit.

A piece is as long as a whole number of tokens from 1 to the capacity, so the
instance is a histogram of at most `capacity` counts, however many documents
there are. The plan is made on it: pieces of one length are interchangeable.
It is a table of runs, "the next m pieces of this length go to sequences b to
b+m-1 at this offset", of a size that depends on the capacity only; Spark
deals the pieces out to the runs by their rank within their length.

Dominance (Martello and Toth): for the longest piece left, a set that holds it
and fits is fixed for good if every other set with that piece could be traded
for it: alone, if nothing fits beside it; with the longest piece that fits, if
they fill the sequence or if no two pieces fit beside the first; with a pair
that fills the sequence, if no three pieces could fit. What is left goes by
best fit, longest first.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabmill.llm.shared import for_workers, staged

CAPACITY = 4096
END_ID = 1
CACHED_WORDS = 400_000  # of the newer half of a worker's table of word ids
RANK_ROWS = 50_000  # pieces ranked by one task
TOKENIZER = "word_bpe_49k.json"


# How the vocabulary file normalises and splits texts; the short way below holds for this only.
_NORMAL = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same for texts of ASCII and the letters of Latin-1, which are in normal form and lower-cased one by one.
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
_PLAIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-zß-öø-ÿ0-9]+")


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level vocabularies write for each byte: printable bytes as they are, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


class WordIds:
    """Ids of texts by a tokenizer that never joins characters across white space.

    A plain text is split into parts as the tokenizer would, and each different
    part is given to it once, without the steps that change nothing in it. Any
    other text is cut at ASCII white space, which the tokenizer drops, and each
    different run is given to it once. The tables are of bounded size: when the
    newer half of the parts is full, the older goes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(Path(path).read_text())
        steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        splits = [x.get("pattern", {}).get("Regex") for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.bare = None
        if steps == _NORMAL and splits == [_SPLIT, None]:
            self.bare = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": None}))
        self.special = re.compile("|".join(re.escape(x["content"]) for x in spec["added_tokens"]) or r"(?!)", re.I)
        self.letters = _byte_letters()
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def _add_parts(self, parts: list[str]) -> None:
        written = [p.encode().decode("latin-1").translate(self.letters) for p in parts]
        found = self.bare.encode(written, is_pretokenized=True, add_special_tokens=False)
        ids, of = np.array(found.ids, np.uint32).tobytes(), np.array(found.word_ids, np.int64)
        ends = (4 * np.searchsorted(of, np.arange(len(parts)), side="right")).tolist()
        for part, a, b in zip(parts, [0, *ends], ends):
            self.parts[part] = ids[a:b]

    def _plain(self, texts: list[list[str]]) -> list[bytes]:
        """Ids of texts given as parts."""
        seen: set[str] = set()
        for parts in texts:
            seen.update(parts)
        if len(self.parts) > CACHED_WORDS:
            self.parts, self.older = {}, self.parts
        new = []
        for part in seen.difference(self.parts):
            if (ids := self.older.get(part)) is None:
                new.append(part)
            else:
                self.parts[part] = ids
        for at in range(0, len(new), 20_000):
            self._add_parts(new[at : at + 20_000])
        return [b"".join(map(self.parts.__getitem__, parts)) for parts in texts]

    def _any(self, texts: list[list[bytes]]) -> list[bytes]:
        """Ids of texts given as runs between white space."""
        seen = {word for words in texts for word in words}
        if len(self.words) + len(seen) > CACHED_WORDS:
            self.words = {}
        new = list(seen.difference(self.words))
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            for word, e in zip(part, self.tokenizer.encode_batch([w.decode() for w in part], add_special_tokens=False)):
                self.words[word] = np.array(e.ids, np.uint32).tobytes()
        return [b"".join(map(self.words.__getitem__, words)) for words in texts]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        plain = [bool(self.bare and _PLAIN.fullmatch(t) and not ("<" in t and self.special.search(t))) for t in texts]
        short = iter(self._plain([_PLAIN_SPLIT.findall(t.lower()) for t, p in zip(texts, plain) if p]))
        other = iter(self._any([t.encode().split() for t, p in zip(texts, plain) if not p]))
        return [np.frombuffer(next(short if p else other), np.uint32) for p in plain]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One table for a Python worker, shared by its tasks; a task has one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and the end id, cut at the capacity.

    `row` tells repeated documents apart: it is the place of the row in its
    input partition. `path` is the tokenizer file, the same on all executors.
    """
    name = None if path else TOKENIZER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(path or tokenizer_path(name))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                out = []
                part = [c.to_pylist() for c in batch.slice(at, 500).columns]
                for row, doc, ids in zip(part[0], part[1], ids_of([t or "" for t in part[2]])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for k, start in enumerate(range(0, len(ids), capacity)):
                        cut = ids[start : start + capacity]
                        out.append((row, doc, k, start, len(cut), zlib.crc32(cut.tobytes()), cut if with_ids else None))
                columns = list(zip(*out))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
                yield pa.record_batch(arrays[: 6 + with_ids], names=["row", "doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 + with_ids])

    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return for_workers(source).mapInArrow(run, "row long, doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids)


@dataclass
class Plan:
    """Runs (length, first rank, number, first sequence, offset); sequences used; how many the reduction fixed; a lower bound."""

    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    fixed: int = 0
    bound: int = 0


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's bound L2: no packing uses fewer sequences."""
    n, total = np.zeros(capacity + 1, np.int64), np.arange(capacity + 1)
    for length, k in counts.items():
        n[length] = k
    rows, sums = np.cumsum(n), np.cumsum(n * total)
    best = -(-int(sums[-1]) // capacity)
    for a in range(capacity // 2 + 1):
        large = int(rows[-1] - rows[capacity - a])
        half = int(rows[capacity - a] - rows[capacity // 2])
        room = half * capacity - int(sums[capacity - a] - sums[capacity // 2])
        small = int(sums[capacity // 2] - (sums[a - 1] if a else 0))
        best = max(best, large + half + max(0, -(-(small - room) // capacity)))
    return best


class _Left:
    """Counts of pieces left by length, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {k: v for k, v in counts.items() if v > 0}
        self.lengths = sorted(self.n)
        self.used: dict[int, int] = defaultdict(int)

    def take(self, length: int, k: int) -> int:
        """First rank of the k pieces taken."""
        first = self.used[length]
        self.used[length] += k
        self.n[length] -= k
        if not self.n[length]:
            del self.n[length]
            self.lengths.pop(bisect.bisect_left(self.lengths, length))
        return first

    def longest(self, room: int, without: int = 0) -> int:
        """Longest length of at most `room`, where one piece of length `without` is spoken for; 0 if none."""
        i = bisect.bisect_right(self.lengths, room)
        while i:
            length = self.lengths[i - 1]
            if self.n[length] > (length == without):
                return length
            i -= 1
        return 0

    def least(self, k: int, without: int) -> int | None:
        """Sum of the k shortest pieces beside one of length `without`; None if there are fewer."""
        total, need = 0, k
        for length in self.lengths:
            some = min(need, self.n[length] - (length == without))
            total, need = total + some * length, need - some
            if not need:
                return total
        return None


def _dominating(left: _Left, capacity: int) -> tuple[int, ...] | None:
    """A set with the longest piece that dominates all others with it."""
    first = left.lengths[-1]
    room = capacity - first
    second = left.longest(room, first)
    if not second:
        return (first,)
    if second == room:
        return first, second
    two = left.least(2, first)
    if two is None or two > room:  # at most one fits beside it, and the longest is best
        return first, second
    three = left.least(3, first)
    if three is None or three > room:  # at most two fit: a pair that fills the room can't be beaten
        for a in reversed(left.lengths[: bisect.bisect_right(left.lengths, room)]):
            b = room - a
            if b > a:
                break
            need = {first: 1}
            for x in (a, b):
                need[x] = need.get(x, 0) + 1
            if b in left.n and all(left.n.get(x, 0) >= k for x, k in need.items()):
                return first, a, b
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Runs for a histogram of lengths. The work depends on the number of different lengths, not on the counts."""
    left, out = _Left(counts), Plan(bound=lower_bound(counts, capacity))
    while left.lengths and (chosen := _dominating(left, capacity)):
        uses = {x: chosen.count(x) for x in chosen}
        times = min(left.n[x] // k for x, k in uses.items())
        offset = 0
        for x in chosen:
            out.runs.append((x, left.take(x, times), times, out.sequences, offset))
            offset += x
        out.sequences += times
    out.fixed = out.sequences

    # Open sequences by room left: lists of (first sequence, number).
    rooms: list[int] = []
    open_: dict[int, list[tuple[int, int]]] = {}

    def put(room: int, first: int, number: int) -> None:
        if room:
            if room not in open_:
                bisect.insort(rooms, room)
                open_[room] = []
            open_[room].append((first, number))

    while left.lengths:
        length = left.lengths[-1]
        while length in left.n:
            i = bisect.bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, number = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(i)
                k = min(number, left.n[length])
                if number > k:
                    put(room, first + k, number - k)
                out.runs.append((length, left.take(length, k), k, first, capacity - room))
                put(room - length, first, k)
            else:
                fill = capacity // length
                k = left.n[length] // fill
                if k:  # whole new sequences of this length alone
                    for s in range(fill):
                        out.runs.append((length, left.take(length, k), k, out.sequences, s * length))
                    put(capacity - fill * length, out.sequences, k)
                    out.sequences += k
                else:
                    out.runs.append((length, left.take(length, 1), 1, out.sequences, 0))
                    put(capacity - length, out.sequences, 1)
                    out.sequences += 1
    return out


def _rows(spark: SparkSession, names: list[str], rows: list[tuple[int, ...]]) -> DataFrame:
    values = np.array(rows, np.int64).reshape(-1, len(names))
    return spark.createDataFrame(pa.table({n: values[:, i] for i, n in enumerate(names)}))


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`found` (from pieces(), staged) with sequence_id and offset.

    A length that many pieces have is ranked in parts of RANK_ROWS pieces, by a
    hash of the piece, and the parts are put one behind the other.
    """
    spark = found.sparkSession
    # At most `capacity` rows, whatever the input.
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    made = plan(counts, capacity)
    runs = _rows(spark, ["run_length", "first", "number", "base", "offset"], made.runs)
    parts = _rows(spark, ["length", "parts"], [(length, -(-n // RANK_ROWS)) for length, n in sorted(counts.items())])

    spread: Column = F.pmod(F.xxhash64("row", "piece"), F.col("parts"))
    dealt = found.join(F.broadcast(parts), "length").withColumn("part", spread)
    sizes = dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("length", "part", before.alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("row", "piece")) - 1
    ranked = dealt.withColumn("within", within).join(starts, ["length", "part"]).withColumn("rank", F.col("before") + F.col("within"))
    # Of bounded size: its rows depend on the capacity alone.
    placed = ranked.join(F.broadcast(runs), F.expr("length = run_length and rank >= first and rank < first + number"))
    keep = [c for c in found.columns if c != "row"]
    return placed.select(*keep, (F.col("base") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row for each piece of `docs` (doc_id, text): its place in its document and in its sequence.

    Cases: a null or empty text is the end id alone; repeated rows are packed
    each; a document of more than `capacity` ids is cut, nothing is dropped; an
    empty table gives no rows; a null doc_id stays null; further columns are
    ignored.
    """
    return pack(staged(pieces(docs, path, capacity, end_id, with_ids), "pieces"), capacity)


def sequences(places: DataFrame) -> DataFrame:
    """(sequence_id, ids, starts) from `packed(..., with_ids=True)`: the ids of each sequence and where its pieces start."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return places.groupBy("sequence_id").agg(rows.alias("rows")).select(
        "sequence_id", F.flatten(F.transform("rows", lambda r: r["ids"])).alias("ids"), F.transform("rows", lambda r: r["offset"]).alias("starts"))
