"""Merkle manifest of a dataset: one root, and a proof for every row.

Leaves stand in the order of (language, doc_id). Their places come from ranks,
not from a sort: tasks turn the ids of each language into compressed bitmaps
of 65,536 ids (a list of low halves, or bits), the bitmaps of one range are
merged, a directory of counts over the four 16-bit digits of an id gives what
lies before a range, and a directory of popcounts over the words of a bitmap
what lies before an id in it. Digests then go to slot arrays keyed by place;
an array reduces ten levels of the tree in one task, and the roots of the
arrays are the nodes of the next round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabmill.llm.shared import for_workers, staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 10  # of the tree that a slot array reduces: it has 2^LEVELS slots
RANGE = 1 << 16  # ids of a bitmap
SPARSE = 4096  # ids below which a bitmap is a list of low halves; a list is shorter than the bits then
FLUSH_IDS = 1 << 20  # ids of a task that are held before their bitmaps are sent on
PART_ROWS = 1 << 16  # equal rows that one task ranks


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(n_chars: Column | None = None) -> Column:
    """Digest of a row's fields, each `-` if null, else its bytes, `:`, and itself."""
    cells = []
    for name in FIELDS:
        value = (F.col(name) if n_chars is None or name != "n_chars" else n_chars).cast("string")
        cells.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.encode(F.concat(*cells), "UTF-8"), 256)


# Bitmaps


def bitmap(low: np.ndarray) -> bytes:
    """Different low halves as sorted 16-bit numbers, or as 65,536 bits where that is shorter."""
    if len(low) < SPARSE:
        return np.sort(low).astype("<u2").tobytes()
    bits = np.zeros(RANGE, np.uint8)
    bits[low] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def members(data: bytes) -> np.ndarray:
    if len(data) != RANGE // 8:
        return np.frombuffer(data, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little"))


def ranks(data: bytes, ids: np.ndarray) -> np.ndarray:
    """How many members lie below each of `ids`, by a directory of popcounts over 64-bit words."""
    if len(data) != RANGE // 8:
        return np.searchsorted(np.frombuffer(data, "<u2"), ids)
    words = np.frombuffer(data, "<u8")
    before = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
    below = (np.uint64(1) << (ids & 63).astype(np.uint64)) - np.uint64(1)
    return before[ids >> 6] + np.bitwise_count(words[ids >> 6] & below)


def _task_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, high, bits, again, times) of a task's ids; `again` lists ids met more than once, by how many times more."""
    held: list[pa.RecordBatch] = []

    def flush() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).group_by(["lang", "id"], use_threads=False).aggregate([([], "count_all")])
        ids, times = table["id"].to_numpy(), table["count_all"].to_numpy()
        lang = table["lang"].combine_chunks().dictionary_encode()
        if isinstance(lang, pa.ChunkedArray):
            lang = lang.combine_chunks()
        codes = lang.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        order = np.lexsort((ids, codes))
        ids, times, codes, high = ids[order], times[order], codes[order], ids[order] >> 16
        starts = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (high[1:] != high[:-1])]))
        names = lang.dictionary.to_pylist()
        rows = []
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
            low, more = ids[s:e] & (RANGE - 1), times[s:e] - 1
            rows.append((None if codes[s] < 0 else names[codes[s]], int(high[s]), bitmap(low), low[more > 0].astype("<u2").tobytes(), more[more > 0].astype("<i8").tobytes()))
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["lang", "high", "bits", "again", "times"])
        held.clear()

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= FLUSH_IDS:
            yield from flush()
    if held:
        yield from flush()


def _counted(parts: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Different low halves of a range's parts, and how often each occurs."""
    lows = [members(p["bits"]) for p in parts] + [np.frombuffer(p["again"], "<u2").astype(np.int64) for p in parts]
    times = [np.ones(len(x), np.int64) for x in lows[: len(parts)]] + [np.frombuffer(p["times"], "<i8") for p in parts]
    low, of = np.unique(np.concatenate(lows), return_inverse=True)
    count = np.zeros(len(low), np.int64)
    np.add.at(count, of, np.concatenate(times))
    return low, count


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bitmap of each (lang, high) from the list of its parts: ids that several parts hold count again."""
    for batch in batches:
        bits, again, times, rows = [], [], [], []
        for parts in batch.column("parts"):
            low, count = _counted(parts.as_py())
            more = count > 1
            bits.append(bitmap(low))
            again.append(low[more].astype("<u2").tobytes())
            times.append((count[more] - 1).astype("<i8").tobytes())
            rows.append(int(count.sum()))
        yield pa.record_batch(
            [batch.column("lang"), batch.column("high"), pa.array(bits, pa.binary()), pa.array(again, pa.binary()), pa.array(times, pa.binary()), pa.array(rows, pa.int64())],
            names=["lang", "high", "bits", "again", "times", "rows"])


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, id, first, times) for each id of a range whose `base` ids lie before it."""
    held: list[tuple[str | None, np.ndarray, np.ndarray, np.ndarray]] = []

    def flush() -> pa.RecordBatch:
        lang = pa.array([x[0] for x in held], pa.string()).take(pa.array(np.repeat(np.arange(len(held)), [len(x[1]) for x in held])))
        numbers = [pa.array(np.concatenate([x[i] for x in held])) for i in (1, 2, 3)]
        held.clear()
        return pa.record_batch([lang, *numbers], names=["lang", "id", "first", "times"])

    waiting = 0
    for batch in batches:
        for row in batch.to_pylist():
            low = members(row["bits"])
            again, more = np.frombuffer(row["again"], "<u2").astype(np.int64), np.frombuffer(row["times"], "<i8")
            upto = np.concatenate([[0], np.cumsum(more)])
            first = row["base"] + ranks(row["bits"], low) + upto[np.searchsorted(again, low)]
            times = np.ones(len(low), np.int64)
            times[np.searchsorted(low, again)] += more
            held.append((row["lang"], (row["high"] << 16) | low, first, times))
            waiting += len(low)
            if waiting >= FLUSH_IDS:
                yield flush()
                waiting = 0
    if held:
        yield flush()


def _before(df: DataFrame, group: list[str], digit: str, rows: str = "rows") -> DataFrame:
    """`rows` of the digits before, in a group of 65,536 digits at most."""
    upto = Window.partitionBy(*group).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce(F.sum(rows).over(upto), F.lit(0)))


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & left[n].eqNullSafe(right[f"r_{n}"])
    return out


def _joined(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join by name in which null equals null."""
    right = right.withColumnsRenamed({n: f"r_{n}" for n in names})
    return left.join(right, _same(left, right, names), how).drop(*[f"r_{n}" for n in names])


def ranked_ids(rows: DataFrame) -> DataFrame:
    """(lang, id, first, times) for each different (lang, id) of `rows`: its first place within the language.

    A null id is before all others and has no bitmap.
    """
    parts = for_workers(rows.where("id is not null").select("lang", "id")).mapInArrow(_task_bitmaps, "lang string, high long, bits binary, again binary, times binary")
    listed = parts.groupBy("lang", "high").agg(F.collect_list(F.struct("bits", "again", "times")).alias("parts"))
    ranges = staged(for_workers(listed).mapInArrow(_merge, "lang string, high long, bits binary, again binary, times binary, rows long"), "id-bitmaps")

    shift = lambda c, by: F.call_function("shiftright", F.col(c), F.lit(by))
    third = ranges.groupBy("lang", "high").agg(F.sum("rows").alias("rows")).withColumns({"second": shift("high", 16), "first": shift("high", 32)})
    second = third.groupBy("lang", "first", "second").agg(F.sum("rows").alias("rows"))
    first = second.groupBy("lang", "first").agg(F.sum("rows").alias("rows"))
    top = _before(first, ["lang"], "first").select("lang", "first", F.col("before").alias("b1"))
    middle = _before(second, ["lang", "first"], "second").select("lang", "first", "second", F.col("before").alias("b2"))
    low = _before(third, ["lang", "second"], "high").select("lang", "second", "high", F.col("before").alias("b3"))
    nulls = rows.where("id is null").groupBy("lang").agg(F.count(F.lit(1)).alias("nulls"))
    bases = _joined(_joined(_joined(low, middle, ["lang", "second"]), top, ["lang", "first"]), nulls, ["lang"], "left")
    bases = bases.select("lang", "high", (F.col("b1") + F.col("b2") + F.col("b3") + F.coalesce("nulls", F.lit(0))).alias("base"))
    found = for_workers(_joined(ranges, bases, ["lang", "high"])).mapInArrow(_rank, "lang string, id long, first long, times long")
    none = nulls.select("lang", F.lit(None).cast("long").alias("id"), F.lit(0).cast("long").alias("first"), F.col("nulls").alias("times"))
    return found.unionByName(none)


def _spread(rows: DataFrame) -> DataFrame:
    """Rows of ids that occur again, each with a slot of its own: by digest, then by row number.

    A group may hold any share of all rows: it is ranked by the first 16 bits
    of the digest, then by digest, then by parts of 65,536 row numbers.
    """
    key = ["lang", "id"]
    cut = rows.withColumns({"digit": F.substring("leaf", 1, 4), "part": F.call_function("shiftright", F.col("row"), F.lit(16))})
    parts = cut.groupBy(*key, "digit", "leaf", "part").agg(F.count(F.lit(1)).alias("rows"))
    leaves = parts.groupBy(*key, "digit", "leaf").agg(F.sum("rows").alias("rows"))
    digits = leaves.groupBy(*key, "digit").agg(F.sum("rows").alias("rows"))
    a = _before(digits, key, "digit").select(*key, "digit", F.col("before").alias("a"))
    b = _before(leaves, [*key, "digit"], "leaf").select(*key, "digit", "leaf", F.col("before").alias("b"))
    c = _before(parts, [*key, "leaf"], "part").select(*key, "digit", "leaf", "part", F.col("before").alias("c"))
    starts = _joined(_joined(c, b, [*key, "digit", "leaf"]), a, [*key, "digit"]).select(*key, "leaf", "part", (F.col("a") + F.col("b") + F.col("c")).alias("start"))
    place = F.row_number().over(Window.partitionBy(*key, "leaf", "part").orderBy("row")) - 1
    return _joined(cut.withColumn("place", place), starts, [*key, "leaf", "part"]).withColumn("slot", F.col("first") + F.col("start") + F.col("place")).drop("digit", "part", "place", "start")


# Slot arrays


def reduce_slots(digests: list[str], first: int, total: int, levels: int = LEVELS) -> tuple[str, list[str]]:
    """Root of the slots from `first` on after `levels` levels of a tree of `total` nodes, and each slot's path.

    A path has for each level `L` or `R` and the digest of the sibling on that
    side, or `-` for a node that is alone. The root of the whole tree has no
    level above it, so a path ends there.
    """
    paths = [""] * len(digests)
    nodes, width = list(digests), 1
    for _ in range(levels):
        if total <= 1:
            break
        above = []
        for i in range(0, len(nodes), 2):
            left, right = nodes[i], nodes[i + 1] if i + 1 < len(nodes) else None
            at = i * width
            if right is None:
                for k in range(at, min(at + width, len(paths))):
                    paths[k] += "-"
                above.append(digest(left))
                continue
            for k in range(at, at + width):
                paths[k] += "R" + right
            for k in range(at + width, min(at + 2 * width, len(paths))):
                paths[k] += "L" + left
            above.append(digest(left, right))
        nodes, width, total = above, 2 * width, -(-total // 2)
    return nodes[0], paths


def siblings(path: str) -> str:
    """The digests of a path, joined."""
    return path.replace("L", "").replace("R", "").replace("-", "")


def fold(node: str, path: str) -> str:
    """Root of a node by its path."""
    at = 0
    while at < len(path):
        side = path[at]
        if side == "-":
            node, at = digest(node), at + 1
        else:
            other = path[at + 1 : at + 65]
            node, at = digest(other, node) if side == "L" else digest(node, other), at + 65
    return node


def _arrays(nodes: DataFrame, payload: list[str], levels: int) -> DataFrame:
    """Slot arrays (group, block, total, slots) of `nodes` (group, slot, total, digest, payload); a slot array is one row."""
    block = F.call_function("shiftright", F.col("slot"), F.lit(levels))
    held = F.array_sort(F.collect_list(F.struct("slot", "digest", *payload)))
    return nodes.withColumn("block", block).groupBy("group", "block").agg(F.max("total").alias("total"), held.alias("slots"))


def _roots(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [reduce_slots([s["digest"] for s in slots], 0, total, levels)[0] for total, slots in zip(batch.column("total").to_pylist(), batch.column("slots").to_pylist())]
            yield pa.record_batch([batch.column("group"), batch.column("block"), batch.column("total"), pa.array(out, pa.string())], names=["group", "slot", "total", "digest"])

    return run


def _paths(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, paths = reduce_slots([s["digest"] for s in row["slots"]], 0, row["total"], levels)
                n = len(paths)
                yield pa.record_batch(
                    [pa.array([row["group"]] * n, pa.string()), pa.array([s["slot"] for s in row["slots"]], pa.int64()), pa.array([p + row["path"] for p in paths], pa.string()), pa.array([row["root"]] * n, pa.string())],
                    names=["group", "slot", "path", "root"])

    return run


def climb(arrays: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(group, block, path, root): for each slot array the path of its root up to its group's root, and that root."""
    up = staged(for_workers(arrays.select("group", "block", "total", "slots")).mapInArrow(_roots(levels), "group string, slot long, total long, digest string"), "tree-nodes")
    if not (up.agg(F.max("slot")).first()[0] or 0):
        return up.select("group", F.col("slot").alias("block"), F.lit("").alias("path"), F.col("digest").alias("root"))
    halved = up.withColumn("total", F.expr(f"(total + {(1 << levels) - 1}) div {1 << levels}"))
    above = staged(_arrays(halved, [], levels), "tree-slots")
    placed = _joined(above, climb(above, levels), ["group", "block"])
    return for_workers(placed).mapInArrow(_paths(levels), "group string, slot long, path string, root string").withColumnRenamed("slot", "block")


def _proofs(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                slots = row["slots"]
                _, paths = reduce_slots([s["digest"] for s in slots], 0, row["total"], levels)
                ends = [p + row["path"] + row["top"] for p in paths]
                folded = [fold(s["changed"], p) for s, p in zip(slots, ends)]
                n = len(slots)
                same = lambda value, kind=pa.string(): pa.array([value] * n, kind)
                yield pa.record_batch(
                    [pa.array([s["id"] for s in slots], pa.int64()), pa.array([s["digest"] for s in slots], pa.string()), same(row["subroot"]), same(row["root"]),
                     pa.array([digest(siblings(p)) for p in ends], pa.string()), pa.array(folded, pa.string()), pa.array([f == row["root"] for f in folded], pa.bool_()),
                     same(row["group"]), pa.array([s["slot"] for s in slots], pa.int64()), pa.array(ends, pa.string())],
                    names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "lang", "slot", "path"])

    return run


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row for each row of `docs` (doc_id, source, lang, n_chars, text): leaf, roots, proof, and the check of a changed copy.

    Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified,
    lang, slot (place in the language), path (what a proof holds, level by
    level). A changed row is one whose n_chars is not null and whose doc_id has
    a CRC-32 that 7 divides: one is added to n_chars before its leaf is folded.

    Cases: a null in any field is `-` in the leaf; a null language is a group
    before all others, a null doc_id stands before all others and isn't changed;
    rows of one doc_id stand in the order of their leaves, and equal rows have
    a slot each; a single language's subroot is the root; an empty table gives
    no rows; further columns are ignored. Languages are few: their subroots are
    ordered in one task.
    """
    columns = {n: F.col(n).cast("long" if n in ("doc_id", "n_chars") else "string") for n in FIELDS}
    plain = docs.select(*[c.alias(n) for n, c in columns.items()])
    hit = F.coalesce((F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0) & F.col("n_chars").isNotNull(), F.lit(False))
    rows = staged(plain.select(
        F.col("doc_id").alias("id"), "lang", leaf().alias("leaf"), F.when(hit, leaf(F.col("n_chars") + 1)).alias("changed"),
        F.monotonically_increasing_id().alias("row")), "leaves")

    met = staged(_joined(rows, ranked_ids(rows), ["lang", "id"]), "leaf-ranks")
    single = met.where("times = 1").withColumn("slot", F.col("first"))
    placed = single.unionByName(_spread(met.where("times > 1"))).select(
        F.col("lang").alias("group"), "slot", F.col("leaf").alias("digest"), "id", F.coalesce("changed", "leaf").alias("changed"))
    totals = rows.groupBy(F.col("lang").alias("group")).agg(F.count(F.lit(1)).alias("total"))
    arrays = staged(_arrays(_joined(placed, totals, ["group"]), ["id", "changed"], levels), "leaf-slots")
    tops = staged(climb(arrays, levels), "leaf-paths")

    # One node for each language from here on; nulls come first, bytes decide.
    order = Window.orderBy(F.col("lang").asc_nulls_first())
    langs = tops.groupBy(F.col("group").alias("lang")).agg(F.first("root").alias("digest"))
    nodes = staged(langs.select(F.lit("").alias("group"), "lang", "digest", (F.row_number().over(order) - 1).cast("long").alias("slot"), F.count(F.lit(1)).over(Window.partitionBy()).alias("total")), "subroots")
    over = staged(_arrays(nodes, ["lang"], levels), "subroot-slots")
    paths = for_workers(_joined(over, climb(over, levels), ["group", "block"])).mapInArrow(_paths(levels), "group string, slot long, path string, root string")
    heads = nodes.join(paths.drop("group"), "slot").select(F.col("lang").alias("group"), F.col("digest").alias("subroot"), F.col("path").alias("top"), F.col("root"))
    # Small tables first: the arrays then join by (language, block), which no language is too large for.
    ends = staged(_joined(tops.drop("root"), heads, ["group"]), "proof-ends")
    return for_workers(_joined(arrays, ends, ["group", "block"])).mapInArrow(
        _proofs(levels), "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, lang string, slot long, path string")


_STEPS = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, 1 + strlen(s)), lambda i: list_concat([CAST(ascii(s[i]) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1])))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END)"""
_CELL = "coalesce(strlen({0}) || ':' || {0}, '-')"
_LEAF = "sha256(" + " || ".join(_CELL.format(x) for x in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST({0} AS VARCHAR)", "text")) + ")"

#: For distinct ids, with the columns of the contract.
ORACLE_SQL = f"""WITH RECURSIVE d AS MATERIALIZED (SELECT *, CAST(doc_id AS VARCHAR) AS s, {_LEAF.format("n_chars")} AS leaf, {_LEAF.format("n_chars + 1")} AS other FROM documents),
    f AS MATERIALIZED (SELECT doc_id, lang, leaf, CASE WHEN xor({_STEPS}, CAST(4294967295 AS BIGINT)) % 7 = 0 AND n_chars IS NOT NULL THEN other ELSE leaf END AS changed,
      row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS slot FROM d),
    t AS (SELECT lang, 0 AS level, list(leaf ORDER BY slot) AS nodes FROM f GROUP BY lang
      UNION ALL SELECT lang, level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], ''))) FROM t WHERE len(nodes) > 1),
    h AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM t WHERE len(nodes) = 1),
    r AS (SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM h
      UNION ALL SELECT level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], ''))) FROM r WHERE len(nodes) > 1),
    p AS MATERIALIZED (SELECT f.doc_id, f.lang, f.slot, list({{'left': (f.slot >> t.level) % 2 = 1, 'node': t.nodes[xor(f.slot >> t.level, 1) + 1]}} ORDER BY t.level) AS path
      FROM f JOIN t ON t.lang IS NOT DISTINCT FROM f.lang WHERE len(t.nodes) > 1 GROUP BY ALL),
    q AS MATERIALIZED (SELECT h.lang, list({{'left': (h.place >> r.level) % 2 = 1, 'node': r.nodes[xor(h.place >> r.level, 1) + 1]}} ORDER BY r.level) AS path
      FROM h, r WHERE len(r.nodes) > 1 GROUP BY ALL),
    a AS (SELECT f.doc_id, f.leaf, h.subroot, (SELECT nodes[1] FROM r WHERE len(nodes) = 1) AS root, f.changed, f.lang, f.slot, list_concat(coalesce(p.path, []), coalesce(q.path, [])) AS path
      FROM f JOIN h ON h.lang IS NOT DISTINCT FROM f.lang LEFT JOIN p ON p.lang IS NOT DISTINCT FROM f.lang AND p.slot = f.slot LEFT JOIN q ON q.lang IS NOT DISTINCT FROM f.lang),
    z AS (SELECT *, sha256(coalesce(list_aggregate(list_transform(path, lambda x: coalesce(x.node, '')), 'string_agg', ''), '')) AS proof_sha256,
      list_reduce(list_prepend({{'left': false, 'node': changed}}, path), lambda c, x: {{'left': false, 'node': CASE WHEN x.left THEN sha256(x.node || c.node) ELSE sha256(c.node || coalesce(x.node, '')) END}}).node AS folded_root FROM a)
    SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM z"""
