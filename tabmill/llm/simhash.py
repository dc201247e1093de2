"""SimHash near-duplicates by exact comparison of fingerprint tiles.

Every pair of different fingerprints is covered: equal fingerprints are one
row before anything is compared, the rest are laid out in tiles of one
population count each, and each pair of tiles whose counts differ by no more
than the radius is compared by exclusive-or and bit counts. Two fingerprints
at `radius` bits cannot differ by more in their population counts, so the
tile pairs that are left out hold no link.

The work is the square of the number of different fingerprints, by the
method; tiles split any population count, so no task has more than two tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmill.llm.components import Forest, connected_components
from tabmill.llm.shared import for_workers, staged, texts_of

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
TILE_ROWS = 8192
# Pairs compared by one numpy call: the block stays in the processor's cache.
BLOCK_PAIRS = 1 << 17

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """64 bits: bit i is one if it is one in over half of the shingles' hashes; no words give zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())), np.dtype(">u8"), n)
    octets = hashes.view(np.uint8).reshape(n, 8)
    if n < 400:
        ones = np.unpackbits(octets, axis=1).sum(0)
    else:
        ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, column: str = "fp", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """`docs` and the fingerprint of its text as a signed long. A-Z are lower-cased; a null text is empty."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in texts_of(batch.column(at))), np.uint64, batch.num_rows)
            yield pa.record_batch([*batch.columns, pa.array(found.view(np.int64))], names=[*batch.schema.names, column])

    return for_workers(docs).mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.LongType())]))


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> Forest:
    """Groups among the fingerprints of two tiles, b's numbered after a's; same: b is a."""
    forest = Forest(len(a) if same else len(a) + len(b))
    step = max(1, BLOCK_PAIRS // max(1, len(b)))
    for at in range(0, len(a), step):
        rest = b[at:] if same else b
        near = np.bitwise_count(a[at : at + step, None] ^ rest[None, :]) <= radius
        if same:
            if np.count_nonzero(near) == min(step, len(a) - at):  # each with itself only
                continue
            x, y = np.nonzero(near)
            forest.add(x + at, y + at)
        elif near.any():
            x, y = np.nonzero(near)
            forest.add(x + at, y + len(a))
    return forest


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, same = (batch.column(i) for i in range(3))
            for k in range(batch.num_rows):
                a = np.asarray(left[k].values).view(np.uint64)
                b = a if same[k].as_py() else np.asarray(right[k].values).view(np.uint64)
                node, first = close_pairs(a, b, radius, same[k].as_py()).links()
                both = (a if same[k].as_py() else np.concatenate([a, b])).view(np.int64)
                if len(node):
                    yield pa.record_batch([pa.array(both[node]), pa.array(both[first])], names=["a", "b"])

    return run


def linked_fingerprints(values: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links (a, b) that join all groups of the different fingerprints in `values` (fp).

    Within a pair of tiles a group is sent on as one link for each member, not
    as its pairs.
    """
    spark = values.sparkSession
    counted = values.select("fp", F.bit_count("fp").alias("ones"))
    # At most 65 rows, whatever the input.
    sizes = {r["ones"]: r["n"] for r in counted.groupBy("ones").agg(F.count(F.lit(1)).alias("n")).collect()}
    tiles = [-(-sizes.get(ones, 0) // tile_rows) for ones in range(65)]
    starts = np.concatenate([[0], np.cumsum(tiles)]).tolist()
    last = [starts[min(ones + radius, 64) + 1] - 1 for ones in range(65)]
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("ones") + 1).cast("long")
    part = F.pmod(F.xxhash64("fp"), F.greatest(pick(tiles), F.lit(1)))
    laid = counted.select("fp", (pick(starts[:65]) + part).alias("tile"), pick(last).alias("last"))
    laid = staged(laid.groupBy("tile", "last").agg(F.collect_list("fp").alias("fps")), "fingerprint-tiles")
    left = laid.select("tile", F.explode(F.sequence("tile", "last")).alias("other"), F.col("fps").alias("a"))
    right = laid.select(F.col("tile").alias("other"), F.col("fps").alias("b"))
    n = max(spark.sparkContext.defaultParallelism * 2, starts[-1])
    pairs = left.join(right, "other").repartition(n, "tile", "other")
    pairs = pairs.select("a", "b", (F.col("tile") == F.col("other")).alias("same"))
    return for_workers(pairs).mapInArrow(_compare(radius), "a long, b long")


def groups(values: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(fp, group) for the different fingerprints in `values` (fp): equal groups are linked."""
    labels = connected_components(linked_fingerprints(values, radius, tile_rows))
    return values.select("fp").join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("group"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row for each row of `docs` (doc_id, text): doc_id, fingerprint, component_id.

    Cases: null and empty texts have fingerprint zero and link like any other;
    fewer words than a shingle are one shingle; repeated rows give repeated
    rows; a null doc_id never names a component unless all its rows are null;
    an empty table gives no rows; further columns of `docs` are ignored.
    """
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    fps = staged(with_fingerprint(slim, "fp", shingle).select("doc_id", "fp"), "fingerprints")
    first = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("doc")), "fingerprint-rows")
    grouped = first.join(groups(first, radius, tile_rows), "fp")
    named = grouped.join(grouped.groupBy("group").agg(F.min("doc").alias("component_id")), "group").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """The row of the smallest doc_id of each group, with its columns as they were; of repeated rows one stays."""
    row, fp = "_row", "_fp"
    while {row, fp} & set(docs.columns):
        row, fp = f"_{row}", f"_{fp}"
    marked = staged(with_fingerprint(docs.withColumn(row, F.monotonically_increasing_id()), fp, shingle), "fingerprinted")
    slim = marked.select(F.col(fp).alias("fp"), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("row")).alias("who"))
    first = staged(slim.groupBy("fp").agg(F.min("who").alias("who")), "fingerprint-rows")
    grouped = first.join(groups(first, radius, tile_rows), "fp")
    named = grouped.join(grouped.groupBy("group").agg(F.min("who").alias("keeper")), "group").select("fp", "keeper")
    gone = slim.join(named, "fp").where("who.row <> keeper.row").select(F.col("who.row").alias(row))
    return marked.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
