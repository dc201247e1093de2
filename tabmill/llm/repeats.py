"""Passages that an earlier document holds already, found from seeds that are extended to both sides.

Seeds: in every window of 13 words the least hash of its 8-word runs is chosen
(the rightmost of equal ones), so equal windows choose equal anchors at equal
places. An anchor occurrence with the windows that chose it is one seed; its
span reaches from the first word of these windows to the last.

Join: seeds meet by anchor. Occurrences with equal spans are one class, of which
only the smallest doc_id is compared further: all others are covered whole.
An anchor that stands in several spans is extended word by word: the windows
around it, one for each pair of steps to the left and right, are joined with
those of the other spans. Windows that an earlier document holds join up to
the maximal repeats, which are removed.

Documents travel in compressed blocks, some blocks in a group, and seeds as
packed arrays, one row for each group and range of anchors. Within a block
equal seeds are one, so a passage of a third of all documents gives one entry
for each block; an anchor with many spans in one block is not compared by span
at all, its windows are joined at once. No pairs are formed anywhere.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmill.llm.shared import for_workers, staged

WINDOW = 13  # words
ANCHOR = 8  # words of a run that may be an anchor
BLOCK_BYTES = 2 << 20  # texts of a block; a longer text is a block of its own
GROUP_BYTES = 16 << 20  # texts of a group of blocks, which are one row
RANGE_BYTES = 16 << 20  # texts whose seeds one task compares
MANY_SPANS = 8  # of one anchor in one block, beyond which its windows are joined at once
_PIECE = 1 << 20  # bytes that are hashed at once

U = np.uint64
_BASES = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F))
_LETTERS = np.random.default_rng(12).integers(0, 1 << 63, (2, 256), dtype=np.uint64) * U(2) + U(1)


@functools.lru_cache(8)
def _powers(lane: int, inverse: bool, size: int) -> np.ndarray:
    base = int(_BASES[lane])
    out = np.full(size, pow(base, -1, 1 << 64) if inverse else base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _power(lane: int, inverse: bool, n: int) -> np.ndarray:
    """The first n powers of a lane's base, modulo 2^64."""
    return _powers(lane, inverse, 1 << max(12, (n - 1).bit_length()))[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def _sums(values: np.ndarray, lane: int) -> np.ndarray:
    """Prefix sums of the values times powers: what `_runs` takes the hashes of runs from."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(lane, False, len(values)), out=out[1:])
    return out


def _runs(sums: np.ndarray, lane: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run [start, end), the same wherever the run stands."""
    found = (sums[end] - sums[start]) * _power(lane, True, len(sums))[start]
    return _mixed(found + (end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def word_hashes(data: bytes) -> tuple[np.ndarray, list[np.ndarray]]:
    """Start of each word in `data`, and two hashes of each word."""
    letters = np.frombuffer(data, np.uint8)
    space = np.ones(len(letters) + 2, np.int8)
    space[1:-1] = (letters == 32) | ((letters - np.uint8(9)) <= 4)
    edge = np.diff(space)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    lanes = [np.empty(len(starts), np.uint64) for _ in _BASES]
    at = 0
    while at < len(starts):
        last = max(at + 1, int(np.searchsorted(ends, starts[at] + _PIECE, side="right")))
        s, e = starts[at:last] - starts[at], ends[at:last] - starts[at]
        piece = letters[starts[at] : ends[last - 1]]
        for lane, out in enumerate(lanes):
            out[at:last] = _runs(_sums(_LETTERS[lane][piece], lane), lane, s, e)
        at = last
    return starts, lanes


@dataclass
class Seeds:
    """Seeds of a block and the classes of equal seeds, in the order of (anchor, span).

    A seed has its first window (the number of its first word), its number of
    windows, and its class. A class has its anchor, span, least and most
    doc_id, and whether its anchor has many spans here.
    """

    words: np.ndarray  # words of each document
    sums: list[np.ndarray]
    first: np.ndarray
    count: np.ndarray
    of: np.ndarray
    doc: np.ndarray  # doc_id of each seed
    row: np.ndarray  # document of each seed
    anchor: np.ndarray
    span: np.ndarray
    least: np.ndarray
    most: np.ndarray
    many: np.ndarray

    def windows(self, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the seed and first word of each window of the given seeds."""
        count = self.count[seed]
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(seed, count), np.repeat(self.first[seed], count) + step

    def keys(self, window: np.ndarray) -> list[np.ndarray]:
        return [_runs(self.sums[lane], lane, window, window + WINDOW) for lane in range(2)]

    def asked(self, ask: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """Windows that are joined: those of the least document of each class in `ask` or with many spans.

        Returns the seed, key number and first word of each window, and the
        different keys with the least doc_id of each, by key.
        """
        wanted = self.many.copy()
        wanted[ask] = True
        seed, window = self.windows(np.flatnonzero(wanted[self.of] & (self.doc == self.least[self.of])))
        a, b = self.keys(window)
        order = np.lexsort((b, a))
        new = np.ones(len(order), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        key = np.empty(len(order), np.int64)
        key[order] = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        least = np.minimum.reduceat(self.doc[seed][order], heads) if len(heads) else np.empty(0, np.int64)
        return seed, [a[order][heads], b[order][heads], least], key, window


def seeds(texts: list[bytes], ids: list[int | None]) -> Seeds:
    """Seeds of a block of documents; those without a doc_id have none."""
    starts, lanes = word_hashes(b" ".join(texts))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    cuts = np.concatenate([[0], np.cumsum(sizes + 1)])
    words = np.diff(np.searchsorted(starts, cuts))
    row = np.repeat(np.arange(len(texts)), words)
    known = np.array([i is not None for i in ids], bool)
    doc = np.array([i or 0 for i in ids], np.int64)
    sums = [_sums(x, lane) for lane, x in enumerate(lanes)]

    n = max(0, len(starts) - WINDOW + 1)
    at = np.arange(len(starts) - ANCHOR + 1) if n else np.arange(0)
    run = _runs(sums[0], 0, at, at + ANCHOR)
    best, chosen = run[:n].copy(), np.zeros(n, np.int64)
    for step in range(1, WINDOW - ANCHOR + 1):
        there = run[step : step + n]
        less = there <= best
        best[less] = there[less]
        chosen[less] = step
    chosen += np.arange(n)
    window = np.flatnonzero((row[:n] == row[WINDOW - 1 :]) & known[row[:n]]) if n else np.arange(0)
    chosen = chosen[window]
    # Windows of one document that follow each other and chose one place are one seed.
    head = np.ones(len(window), bool)
    head[1:] = (chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1) | (row[window[1:]] != row[window[:-1]])
    heads = np.flatnonzero(head)
    first, count = window[heads], np.diff(np.append(heads, len(window)))
    anchor, span = run[chosen[heads]], _runs(sums[1], 1, first, first + count + WINDOW - 1)

    order = np.lexsort((span, anchor))
    a, s, d = anchor[order], span[order], doc[row[first]][order]
    other = np.ones(len(order), bool)
    other[1:] = a[1:] != a[:-1]
    new = other.copy()
    new[1:] |= s[1:] != s[:-1]
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    least, most = (f.reduceat(d, np.flatnonzero(new)) if len(d) else d for f in (np.minimum, np.maximum))
    # Number of spans of the anchor of each class.
    group = np.cumsum(other[new]) - 1
    many = (np.bincount(group) > MANY_SPANS)[group] if len(group) else np.zeros(0, bool)
    return Seeds(words, sums, first, count, of, doc[row[first]], row[first], a[new], s[new], least, most, many)


# Blocks


_GROUP = "group long, ids array<array<long>>, sizes array<array<int>>, texts array<binary>, bytes long"
_GROUP_TYPES = (pa.int64(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.list_(pa.int32())), pa.list_(pa.binary()), pa.int64())
Block = tuple[list[bytes], list[int | None]]


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[Block]:
    texts, ids, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
            data = text.as_py() or b""
            if ids and size + len(data) > block_bytes:
                yield texts, ids
                texts, ids, size = [], [], 0
            ids.append(doc_id)
            texts.append(data)
            size += len(data) + 1
    if ids:
        yield texts, ids


def _pack(block_bytes: int, group_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[list, list, bytes]] = []

        def flush() -> pa.RecordBatch:
            row = [number], *([list(x)] for x in zip(*held)), [size]
            return pa.record_batch([pa.array(x, k) for x, k in zip(row, _GROUP_TYPES)], names=["group", "ids", "sizes", "texts", "bytes"])

        for texts, ids in _blocks(batches, block_bytes):
            held.append((ids, list(map(len, texts)), zstandard.ZstdCompressor(level=3).compress(b" ".join(texts))))
            size += sum(map(len, texts))
            if size >= group_bytes or len(held) == 1 << 15:
                yield flush()
                held, number, size = [], number + 1, 0
        if held:
            yield flush()

    return run


def groups_of(docs: DataFrame, block_bytes: int = BLOCK_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The documents as rows of compressed blocks of texts, written once."""
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return staged(for_workers(slim).mapInArrow(_pack(block_bytes, group_bytes), _GROUP), "text-blocks")


def _opened(row: dict) -> Iterator[Block]:
    """Blocks of a group, one at a time."""
    for ids, sizes, packed in zip(row["ids"], row["sizes"], row["texts"]):
        data, texts, at = zstandard.ZstdDecompressor().decompress(packed), [], 0
        for size in sizes:
            texts.append(data[at : at + size])
            at += size + 1
        yield texts, ids


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one: a batch may hold many groups or ranges, and each is large once opened."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


# Entries: what a block sends to a range. Columns: two hashes, least doc_id,
# block of the group, number in the block, and flags.
_ENTRY = np.dtype([("a", "<u8"), ("b", "<u8"), ("doc", "<i8"), ("block", "<u2"), ("number", "<u4"), ("flags", "u1")])
_ANSWER = np.dtype([("block", "<u2"), ("number", "<u4"), ("code", "u1")])
_MORE, _MANY = 1, 2  # a class of several doc_ids; an anchor with many spans
_COVER, _ASK = 1, 2  # an earlier document has it; join its windows


def _packed(columns: dict[str, np.ndarray], kinds: np.dtype) -> bytes:
    """Columns by byte planes, compressed: sorted hashes and numbers share their high bytes."""
    planes = [np.ascontiguousarray(columns[n], kinds[n]).view(np.uint8).reshape(-1, kinds[n].itemsize).T.tobytes() for n in kinds.names]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpacked(data: bytes, kinds: np.dtype) -> dict[str, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n, at, out = len(planes) // kinds.itemsize, 0, {}
    for name in kinds.names:
        size = kinds[name].itemsize
        out[name] = np.ascontiguousarray(planes[at : at + n * size].reshape(size, n).T).view(kinds[name]).reshape(-1)
        at += n * size
    return out


def _joined(parts: list[bytes], kinds: np.dtype) -> dict[str, np.ndarray]:
    columns = [_unpacked(p, kinds) for p in parts] or [{n: np.empty(0, kinds[n]) for n in kinds.names}]
    return {n: np.concatenate([c[n] for c in columns]) for n in kinds.names}


def _seed_entries(s: Seeds, ask: np.ndarray) -> tuple[np.ndarray, ...]:
    """Classes; of an anchor with many spans only that it occurs."""
    few, many = np.flatnonzero(~s.many), np.flatnonzero(s.many)
    if len(many):
        many = many[np.flatnonzero(np.concatenate([[True], s.anchor[many][1:] != s.anchor[many][:-1]]))]
    number = np.concatenate([few, many])
    flags = np.where(s.many[number], _MANY, np.where(s.most[number] > s.least[number], _MORE, 0))
    return s.anchor[number], s.span[number], s.least[number], number, flags


def _window_entries(s: Seeds, ask: np.ndarray) -> tuple[np.ndarray, ...]:
    _, (a, b, least), _, _ = s.asked(ask)
    return a, b, least, np.arange(len(a)), np.zeros(len(a), np.uint8)


def _answers_by_block(row: dict, name: str) -> list[dict[str, np.ndarray]]:
    """The answers to each block of a group."""
    found = _joined(row.get(name) or [], _ANSWER)
    order = np.argsort(found["block"], kind="stable")
    cuts = np.searchsorted(found["block"][order], np.arange(len(row["texts"]) + 1))
    return [{n: found[n][order[x:y]] for n in ("number", "code")} for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def _chosen(answer: dict[str, np.ndarray], code: int) -> np.ndarray:
    return answer["number"][answer["code"] == code].astype(np.int64)


def _send(entries, ranges: int):
    """(part, group, entries): what the blocks of each group send to each range of the first hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            held = []
            for k, (block, answer) in enumerate(zip(_opened(row), _answers_by_block(row, "answers"))):
                a, b, doc, number, flags = entries(seeds(*block), _chosen(answer, _ASK))
                held.append((a, b, doc, np.full(len(a), k, np.uint16), number.astype(np.uint32), flags.astype(np.uint8)))
            columns = dict(zip(_ENTRY.names, map(np.concatenate, zip(*held))))
            del held
            order = np.argsort(columns["a"], kind="stable")
            part = ((columns["a"][order] >> U(32)) * U(ranges)) >> U(32)
            cuts = np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64)).tolist()
            rows = [(p, row["group"], _packed({n: c[order[x:y]] for n, c in columns.items()}, _ENTRY)) for p, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary()))], names=["part", "group", "entries"])

    return run


def _runs_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by the keys, the number of each ordered entry's run of equal keys, and the first entry of each run."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    return order, np.cumsum(new) - 1, np.flatnonzero(new)


def _least(doc: np.ndarray, order: np.ndarray, run: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Least doc_id of each entry's run, in the order of the entries."""
    out = np.empty(len(doc), np.int64)
    out[order] = np.minimum.reduceat(doc[order], heads)[run]
    return out


def _seed_codes(x: dict[str, np.ndarray]) -> np.ndarray:
    """Cover: an earlier document has the class. Ask: the anchor stands in several spans and documents, and this one is the first of its class."""
    doc, more, many = x["doc"], x["flags"] & _MORE > 0, x["flags"] & _MANY > 0
    order, run, heads = _runs_of(x["a"], x["b"])
    least = _least(doc, order, run, heads)
    by_anchor, group, firsts = _runs_of(x["a"])
    of = np.empty(len(doc), np.int64)
    of[by_anchor] = group
    several, extended = np.zeros(len(firsts), bool), np.bincount(of[order[heads]], minlength=len(firsts)) > 1
    several[of[(doc != _least(doc, by_anchor, group, firsts)) | more | many]] = True
    extended[of[many]] = True
    return np.where(many, 0, np.where(least < doc, _COVER, np.where((several & extended)[of], _ASK, 0)))


def _window_codes(x: dict[str, np.ndarray]) -> np.ndarray:
    """Cover: an earlier document has the window."""
    return np.where(_least(x["doc"], *_runs_of(x["a"], x["b"])) < x["doc"], _COVER, 0)


def _compare(codes):
    """(group, answers): the entries of a range with a code, back to the groups that sent them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            parts = row["parts"]
            sent = [_unpacked(p["entries"], _ENTRY) for p in parts]
            sizes = [len(x["a"]) for x in sent]
            x = {n: np.concatenate([y[n] for y in sent]) for n in _ENTRY.names}
            del sent
            code, rows, at = codes(x), [], 0
            for p, size in zip(parts, sizes):
                mine = at + np.flatnonzero(code[at : at + size])
                if len(mine):
                    rows.append((p["group"], _packed({"block": x["block"][mine], "number": x["number"][mine], "code": code[mine]}, _ANSWER)))
                at += size
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary()))], names=["group", "answers"])

    return run


_RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("repeats", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))), T.StructField("kept", T.StringType())])
_REPEATS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def covered_words(s: Seeds, cover: np.ndarray, ask: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """Whether each word of the block stands in a window that an earlier document has.

    cover and ask are the answers to the block's classes, earlier the numbers
    of its windows' keys that an earlier document has in another block.
    """
    whole = np.zeros(len(s.anchor), bool)
    whole[cover] = True
    _, full = s.windows(np.flatnonzero(whole[s.of] | (s.doc > s.least[s.of])))
    seed, (_, _, least), key, window = s.asked(ask)
    known = np.zeros(len(least), bool)
    known[earlier] = True
    edge = np.zeros(s.words.sum() + 1, np.int64)
    for found in (full, window[known[key] | (least[key] < s.doc[seed])]):
        np.add.at(edge, found, 1)
        np.add.at(edge, found + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _each(batches):
        for (texts, ids), answer, window in zip(_opened(row), _answers_by_block(row, "answers"), _answers_by_block(row, "windows")):
            s = seeds(texts, ids)
            gone = covered_words(s, _chosen(answer, _COVER), _chosen(answer, _ASK), _chosen(window, _COVER))
            ends = np.cumsum(s.words)
            kept, repeats, removed = [], [], []
            for text, a, b in zip(texts, (ends - s.words).tolist(), ends.tolist()):
                mask = gone[a:b]
                words = text.split()
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))).reshape(-1, 2)
                removed.append(int(mask.sum()))
                repeats.append([{"start": x, "end": y} for x, y in edges.tolist()])
                kept.append(b" ".join(compress(words, (~mask).tolist()) if removed[-1] else words).decode())
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(s.words.tolist(), pa.int64()), pa.array(removed, pa.int64()), pa.array(repeats, _REPEATS), pa.array(kept, pa.string())], names=_RESULT.names)


def without_repeats(docs: DataFrame, range_bytes: int = RANGE_BYTES, block_bytes: int = BLOCK_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row for each row of `docs` (doc_id, text): its words without those that an earlier document's windows cover.

    Columns: doc_id, n_words, n_removed, repeats (maximal runs of removed words,
    start and end by word), kept (the other words, joined by one space). A
    window is 13 consecutive words; earlier means a smaller doc_id.

    Cases: null and empty texts have no words and keep the empty text; texts
    under 13 words keep all; rows of one doc_id don't cover each other, and
    repeats within one document stay; rows without a doc_id keep all and cover
    nothing; an empty table gives no rows; further columns are ignored. Windows
    are compared by two 64-bit hashes over two hashes of each word.
    """
    # A group is large enough by itself: a batch need hold no more than one.
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    groups = groups_of(docs, block_bytes, group_bytes)
    size = groups.agg(F.sum("bytes")).first()[0] or 0
    ranges = max(1, -(-size // range_bytes))

    def compared(rows: DataFrame, entries, codes, name: str) -> DataFrame:
        """Answers to each group as one row; they are small beside the texts."""
        sent = for_workers(rows).mapInArrow(_send(entries, ranges), "part int, group long, entries binary")
        listed = sent.groupBy("part").agg(F.collect_list(F.struct("group", "entries")).alias("parts")).select("parts")
        found = for_workers(listed).mapInArrow(_compare(codes), "group long, answers binary")
        return staged(found.groupBy("group").agg(F.collect_list("answers").alias(name)), f"repeat-{name}")

    answers = compared(groups, _seed_entries, _seed_codes, "answers")
    windows = compared(groups.join(answers, "group", "left"), _window_entries, _window_codes, "windows")
    both = answers.join(windows, "group", "full")
    return for_workers(groups.join(both, "group", "left")).mapInArrow(_remove, _RESULT)


def digests(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


ORACLE_SQL = """WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
    s AS (SELECT r, doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d WHERE doc_id IS NOT NULL AND len(w) >= 13),
    g AS (SELECT r, i, doc_id > min(doc_id) OVER (PARTITION BY list_aggregate(w[i:i + 12], 'string_agg', ' ')) AS gone FROM s),
    c AS MATERIALIZED (SELECT r, list(DISTINCT p) AS gone FROM (SELECT r, unnest(range(i, i + 13)) AS p FROM g WHERE gone) GROUP BY r),
    k AS (SELECT doc_id, w, coalesce(gone, []) AS gone, CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END AS kept
      FROM d LEFT JOIN c USING (r))
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed, sha256(coalesce(list_aggregate(kept, 'string_agg', ' '), '')) AS kept_sha256 FROM k"""
