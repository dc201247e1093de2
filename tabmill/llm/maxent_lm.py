"""Maximum-entropy language model with hashed n-gram and skip features and a class-factored softmax.

P(word | history) = P(class 1 | history) * P(class 2 | class 1, history) *
P(word | class 2). Whole words are hashed to 4080 buckets. The buckets are
halved again and again along the direction in which the words beside them
differ most, which gives 16 classes of 16 classes, of 16 buckets each; the last
of the 256 is that of the end token. Each of the two choices is a log-linear
model of 16 outcomes: its features are hashes of the word before, the last two
words together, and by skips the second and the third word before, each
together with the class chosen so far; its reference measure is the training
share of the outcomes. Inside its class a word has its smoothed share of the
training tokens, unknown words together that of one token, so all
probabilities of a history add up to one.

Everything that is fitted has a fixed size, whatever the corpus: the bucket
table, the weights, and the list of frequent words whose counts are sent to
tasks. Counts of all other words are met by a join. Training is by rounds of
gradient updates over parts of the training documents, which are dealt and
ordered by hashes of the documents, so that scores don't depend on the
cluster. A part takes the weights, makes one pass of mini-batch updates and
sends its moves and how often it touched each row in blocks, which are averaged
by block in a stream.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmill.llm.shared import for_workers, staged, texts_of

WAYS, LEVELS = 16, 2  # outcomes of a choice; choices that lead to a class
CLASSES = WAYS**LEVELS  # the last one is that of the end token
MEMBERS = 16  # buckets of a class
END = BUCKETS = (CLASSES - 1) * MEMBERS  # of words; the next number is the end token's
DETAIL = 16  # of the words of a bucket, what features tell apart
END_ID, START_ID = BUCKETS * DETAIL, 65_535  # the end token and the place before the first token
ROW_BITS = 16
LEVEL_ROWS = 1 << ROW_BITS  # hashed rows of weights for each of the choices
ROWS = LEVELS * LEVEL_ROWS
FEATURES = 4
CONTEXTS = 64  # hashed neighbours that buckets are clustered by, on each side
ROUNDS = 2  # each over its own half of the training documents: one pass with an exchange midway
RATE = 0.1
BATCH = 4096  # tokens
PART_TOKENS = 2_500_000  # that one part trains on between two exchanges of weights, about
FREQUENT = 1 << 18  # words whose counts go to every task
FREQUENT_BYTES = 48  # longer words don't
FLUSH_WORDS = 300_000  # different words a task holds before it sends their counts on
BLOCK_ROWS = 4096  # of the weights in one message
NEIGHBOUR_BLOCK = 255  # buckets in one message
BATCH_BYTES = 8 << 20  # of an Arrow batch, of which a worker holds a few

END_TOKEN = b""  # no word is empty


def word_id(word: bytes) -> int:
    """Hash of a whole word; its bucket is the id divided by DETAIL."""
    return zlib.crc32(word) % END_ID if word else END_ID


def bucket_column(word: Column) -> Column:
    """Bucket of a binary column; the end token has one of its own."""
    return F.when(F.octet_length(word) == 0, END).otherwise(F.floor(F.crc32(word) % END_ID / DETAIL)).cast("int")


class _Words(dict):
    """Numbers of the different words met since the last flush, and their ids."""

    def __init__(self):
        super().__init__()
        self.ids: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.ids)
        self.ids.append(word_id(word))
        return number


def feature_hashes(ids: np.ndarray) -> np.ndarray:
    """Hashes of what stands before each token of a document: the last word, the second, the third, the last two."""
    before = np.concatenate([np.full(3, START_ID, np.uint64), ids[:-1].astype(np.uint64)])
    n = len(ids)
    one, two, three = before[2 : 2 + n], before[1 : 1 + n], before[:n]
    kinds = np.stack([one, two, three, (one << np.uint64(16)) | two], 1)
    kinds += np.arange(FEATURES, dtype=np.uint64) << np.uint64(40)
    return kinds * np.uint64(0x9E3779B97F4A7C15)


def choices(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, outcome) of each choice on the way to each class: two arrays of tokens by LEVELS."""
    nodes, outcomes, first = [], [], 0
    for level in range(LEVELS):
        nodes.append(first + classes // WAYS ** (LEVELS - level))
        outcomes.append(classes // WAYS ** (LEVELS - 1 - level) % WAYS)
        first += WAYS**level
    return np.stack(nodes, 1), np.stack(outcomes, 1)


def weight_rows(hashes: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Rows of the weights that are on: tokens by LEVELS by FEATURES."""
    mixed = hashes[:, None, :] + nodes.astype(np.uint64)[:, :, None] * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed >>= np.uint64(64 - ROW_BITS)
    return mixed.astype(np.int32) + (np.arange(LEVELS, dtype=np.int32) * LEVEL_ROWS)[None, :, None]


def scores(base: np.ndarray, weights: np.ndarray, nodes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of the WAYS outcomes of choices, given as nodes and rows of weights; held where exp() is finite."""
    out = base.take(nodes, 0)
    for k in range(rows.shape[1]):
        out += weights.take(rows[:, k], 0)
    return np.clip(out, -60, 60, out=out)


def log_probabilities(base: np.ndarray, weights: np.ndarray, nodes: np.ndarray, rows: np.ndarray, outcomes: np.ndarray) -> np.ndarray:
    """Logarithm of the probability of one outcome of each choice."""
    every = scores(base, weights, nodes, rows)
    chosen = every[np.arange(len(outcomes)), outcomes]
    return chosen - np.log(np.exp(every, out=every).sum(1))


@dataclass
class Trainer:
    """Mini-batch updates with one step size for each row, which shrinks with its gradients so far."""

    base: np.ndarray
    weights: np.ndarray
    rate: float = RATE

    def __post_init__(self):
        self.squares = np.full(len(self.weights), 1e-3, np.float32)
        self.touched = np.zeros(len(self.weights), np.float64)

    def update(self, nodes: np.ndarray, rows: np.ndarray, outcomes: np.ndarray) -> None:
        error = scores(self.base, self.weights, nodes, rows)
        np.exp(error, out=error)
        error /= error.sum(1, keepdims=True)
        error[np.arange(len(outcomes)), outcomes] -= 1
        # Rows with their places in the low bits, sorted together.
        key = rows.ravel().astype(np.int64) << 32 | np.arange(rows.size)
        key.sort()
        row, token = key >> 32, (key & 0xFFFFFFFF) // rows.shape[1]
        begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        at, times = row[begin], np.diff(np.append(begin, len(row)))
        # Most rows are met once or a few times; only the others take the slower sum.
        gradient = error.take(token[begin], 0)
        for k in range(1, 4):
            more = np.flatnonzero((times > k) & (times <= 4))
            gradient[more] += error.take(token[begin[more] + k], 0)
        many = np.flatnonzero(times > 4)
        if len(many):
            few = times[many]
            gradient[many] = np.add.reduceat(error.take(token[np.repeat(times > 4, times)], 0), np.cumsum(few) - few, axis=0)
        squares = self.squares[at] + np.einsum("rk,rk->r", gradient, gradient) / WAYS
        self.squares[at] = squares
        gradient *= (self.rate / np.sqrt(squares))[:, None]
        self.weights[at] = self.weights.take(at, 0) - gradient
        self.touched[at] += times

    def learn(self, ids: list[np.ndarray], classes: np.ndarray) -> None:
        """One pass over documents, in mini-batches."""
        hashes = np.concatenate([feature_hashes(x) for x in ids])
        nodes, outcomes = choices(classes[np.concatenate(ids) // DETAIL])
        rows = weight_rows(hashes, nodes)
        for at in range(0, len(hashes), BATCH):
            few = slice(at, at + BATCH)
            self.update(nodes[few].ravel(), rows[few].reshape(-1, FEATURES), outcomes[few].ravel())


def class_tree(neighbours: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Class of each bucket and, last, of the end token.

    A set of buckets is halved by its weighted first principal component, down
    to sets of MEMBERS. Neighbours count as square roots of their shares.
    """
    x = np.sqrt(neighbours / np.maximum(neighbours.sum(1, keepdims=True), 1))
    sets, room = [np.arange(BUCKETS)], CLASSES
    while room > 1:
        room //= 2
        halves = []
        for members in sets:
            if len(members) > room * MEMBERS:
                weight = np.sqrt(counts[members] + 1.0)
                off = x[members] - np.average(x[members], axis=0, weights=weight)
                axis = np.linalg.eigh((off * weight[:, None]).T @ off)[1][:, -1]
                axis = axis * np.sign(axis[np.argmax(abs(axis))])
                members = members[np.argsort(np.round(off @ axis, 9), kind="stable")]
            halves += [members[: room * MEMBERS], members[room * MEMBERS :]]
        sets = halves
    out = np.full(BUCKETS + 1, CLASSES - 1)
    for k, members in enumerate(sets):
        out[members] = k
    return out


def reference(in_class: np.ndarray) -> np.ndarray:
    """Logarithms of the smoothed training shares of the outcomes of each node, from the tokens of each class."""
    levels = [(in_class + 1.0).reshape(-1, WAYS, WAYS ** (LEVELS - 1 - level)).sum(2) for level in range(LEVELS)]
    nodes = np.concatenate(levels)
    return np.log(nodes / nodes.sum(1, keepdims=True)).astype(np.float32)


def _gather(docs: DataFrame) -> DataFrame:
    """All that one pass over the texts gives, as rows of three kinds.

    0: a document's words as ids (row, doc_id, held_out, ids). 1: a word of the
    training documents and how often a part of them has it (word, n). 2: how
    often buckets of a block stand beside each hashed neighbour (n is the block, sums).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = _Words(), np.zeros(0, np.int64)
        beside = np.zeros(BUCKETS * 2 * CONTEXTS, np.int64)

        def batch(kind: int, **columns) -> pa.RecordBatch:
            size = len(next(iter(columns.values())))
            full = {"kind": [kind] * size} | {f.name: columns.get(f.name, [None] * size) for f in schema if f.name != "kind"}
            return pa.record_batch([pa.array(full[f.name], f.type) for f in schema], schema=schema)

        def counted() -> pa.RecordBatch:
            some = np.flatnonzero(counts)
            every = list(words)
            out = batch(1, word=[every[k] for k in some], n=counts[some].tolist())
            words.clear()
            words.ids.clear()
            return out

        for part in batches:
            if not part.num_rows:
                continue
            rows, docs_, held, texts = (part.column(i) for i in range(4))
            numbers, sizes = [], []
            for text in texts_of(texts):
                tokens = text.lower().split()
                tokens.append(END_TOKEN)
                numbers.append(np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens)))
                sizes.append(len(tokens))
            every, learned = np.concatenate(numbers), np.repeat(~np.array(held.to_pylist(), bool), sizes)
            ids = np.array(words.ids, np.int32)[every]
            # Held-out words have numbers too, but no counts.
            found = np.bincount(every[learned], minlength=len(words.ids))
            found[: len(counts)] += counts
            counts = found
            b = ids // DETAIL
            pair = np.flatnonzero(learned[:-1] & (b[:-1] < END) & (b[1:] < END))
            before, after = b[pair].astype(np.int64), b[pair + 1].astype(np.int64)
            for place in (after * (2 * CONTEXTS) + before % CONTEXTS, before * (2 * CONTEXTS) + CONTEXTS + after % CONTEXTS):
                beside += np.bincount(place, minlength=len(beside))
            cuts = np.cumsum(sizes)
            yield batch(0, row=rows.to_pylist(), doc_id=docs_.to_pylist(), held_out=held.to_pylist(), ids=[x.tobytes() for x in np.split(ids.astype("<u2"), cuts[:-1])])
            if len(words) > FLUSH_WORDS:
                yield counted()
                counts = np.zeros(0, np.int64)
        if len(words):
            yield counted()
        blocks = beside.reshape(-1, NEIGHBOUR_BLOCK * 2 * CONTEXTS)
        some = np.flatnonzero(blocks.any(1))
        if len(some):
            yield batch(2, n=some.tolist(), sums=[blocks[k].astype("<i4").tobytes() for k in some])

    schema = pa.schema([("kind", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("ids", pa.binary()), ("word", pa.binary()), ("n", pa.int64()), ("sums", pa.binary())])
    return for_workers(docs).mapInArrow(run, "kind int, row long, doc_id long, held_out boolean, ids binary, word binary, n long, sums binary")


def _summed_blocks(blocks: DataFrame, number: int) -> dict[int, np.ndarray]:
    """Sums of int32 messages (block, sums) by block, in a stream: a task holds the sums of its blocks only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(sums.as_py(), "<i4").astype(np.int64)
                total[block] = total[block] + values if block in total else values
        for block, values in total.items():
            yield pa.record_batch([pa.array([block], pa.int64()), pa.array([values.tobytes()], pa.binary())], names=["block", "sums"])

    found = blocks.repartition(number, "block").mapInArrow(run, "block long, sums binary").collect()
    return {r["block"]: np.frombuffer(r["sums"], np.int64) for r in found}


def _train_round(parts: DataFrame, weights: np.ndarray, base: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Weights after one exchange: averages of the parts' moves, row by row, by how often each part touched the row.

    `parts` (part, ids) has the rows of a part together and in order.
    """
    context = parts.sparkSession.sparkContext
    sent, number = context.broadcast((weights, base, classes)), -(-ROWS // BLOCK_ROWS)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, base, class_of = sent.value
        trainer, part, held, size = None, None, [], 0

        def moves() -> Iterator[pa.RecordBatch]:
            if held:
                trainer.learn(held, class_of)
                held.clear()
            moved = trainer.weights - start
            for block in range(number):
                at = np.flatnonzero(trainer.touched[block * BLOCK_ROWS : (block + 1) * BLOCK_ROWS])
                if len(at):
                    k = at + block * BLOCK_ROWS
                    # Moves travel in half precision.
                    columns = [[block], [part], [at.astype("<u2").tobytes()], [trainer.touched[k].astype("<f4").tobytes()], [moved[k].astype("<f2").tobytes()]]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (*[pa.int64()] * 2, *[pa.binary()] * 3))], names=["block", "part", "at", "touched", "moved"])

        for batch in batches:
            for number_, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                if number_ != part:
                    if trainer is not None:
                        yield from moves()
                    trainer, part, size = Trainer(base, start.copy()), number_, 0
                held.append(np.frombuffer(value.as_py(), "<u2").astype(np.int64))
                size += len(held[-1])
                if size >= 8 * BATCH:
                    trainer.learn(held, class_of)
                    held.clear()
                    size = 0
        if trainer is not None:
            yield from moves()

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for block, at, touched, moved in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                total, count = sums.setdefault(block, (np.zeros((BLOCK_ROWS, WAYS)), np.zeros(BLOCK_ROWS)))
                at, touched = np.frombuffer(at, "<u2"), np.frombuffer(touched, "<f4").astype(np.float64)
                total[at] += np.frombuffer(moved, "<f2").reshape(-1, WAYS) * touched[:, None]
                count[at] += touched
        for block, (total, count) in sums.items():
            mean = (total / np.maximum(count, 1)[:, None]).astype("<f4")
            yield pa.record_batch([pa.array([block], pa.int64()), pa.array([mean.tobytes()], pa.binary())], names=["block", "mean"])

    messages = parts.select("part", "ids").mapInArrow(train, "block long, part long, at binary, touched binary, moved binary")
    out = np.zeros((number * BLOCK_ROWS, WAYS), np.float32)
    for r in messages.repartition(number, "block").sortWithinPartitions("block", "part").mapInArrow(average, "block long, mean binary").collect():
        out[r["block"] * BLOCK_ROWS : (r["block"] + 1) * BLOCK_ROWS] = np.frombuffer(r["mean"], "<f4").reshape(-1, WAYS)
    sent.destroy()
    return weights + out[:ROWS]


@dataclass
class Model:
    """classes: of each bucket. base and weights: of the choices. share: log10 of the tokens of each class, smoothed."""

    classes: np.ndarray
    base: np.ndarray
    weights: np.ndarray
    share: np.ndarray

    def log10_classes(self, documents: list[np.ndarray]) -> np.ndarray:
        """For each document (ids), the sum over its tokens of log10(P(class | history) / smoothed tokens of the class)."""
        classes = self.classes[np.concatenate(documents) // DETAIL]
        hashes = np.concatenate([feature_hashes(x) for x in documents])
        logs = np.empty(len(classes))
        for at in range(0, len(classes), BATCH):
            few = slice(at, at + BATCH)
            nodes, outcomes = choices(classes[few])
            rows = weight_rows(hashes[few], nodes).reshape(-1, FEATURES)
            found = log_probabilities(self.base, self.weights, nodes.ravel(), rows, outcomes.ravel())
            logs[few] = found.reshape(-1, LEVELS).sum(1, dtype=np.float64) / np.log(10) - self.share[classes[few]]
        starts = np.cumsum([0, *map(len, documents)])[:-1]
        return np.add.reduceat(logs, starts)


@dataclass
class Fitted:
    """A model, the counts (word, n) that it rests on, their sum and number, and the documents' words as ids."""

    model: Model
    counts: DataFrame
    tokens: int
    types: int
    documents: DataFrame


def source_rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, held_out, text). `docs` must be a table at rest: it is read twice, and `row` is a place in it."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), held.alias("held_out"), F.col("text").cast("string"))


def fit(docs: DataFrame) -> Fitted:
    """Counts over all training documents, classes, and weights by distributed gradient updates."""
    gathered = staged(_gather(source_rows(docs)), "lm-gathered")
    counts = staged(gathered.where("kind = 1").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    per_bucket = counts.groupBy(bucket_column(F.col("word")).alias("bucket")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect()
    tokens, types = sum(r["n"] for r in per_bucket), sum(r["types"] for r in per_bucket)
    count_of, types_of = np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS + 1, np.int64)
    for r in per_bucket:
        count_of[r["bucket"]], types_of[r["bucket"]] = r["n"], r["types"]

    beside = np.zeros((BUCKETS, 2 * CONTEXTS), np.int64)
    blocks = gathered.where("kind = 2").select(F.col("n").alias("block"), "sums")
    for block, sums in _summed_blocks(blocks, BUCKETS // NEIGHBOUR_BLOCK).items():
        beside[block * NEIGHBOUR_BLOCK : (block + 1) * NEIGHBOUR_BLOCK] = sums.reshape(-1, 2 * CONTEXTS)
    classes = class_tree(beside, count_of[:BUCKETS])
    in_class = np.bincount(classes, count_of, CLASSES)
    share = np.log10(in_class + np.bincount(classes, types_of, CLASSES) + 1)
    base, weights = reference(in_class), np.zeros((ROWS, WAYS), np.float32)
    documents = gathered.where("kind = 0").select("row", "doc_id", "held_out", "ids")
    parts = -(-tokens // (ROUNDS * PART_TOKENS))
    mixed = F.xxhash64("doc_id", "ids")
    dealt = documents.where(~F.col("held_out")).select("doc_id", "ids", mixed.alias("order"), F.pmod(mixed, F.lit(ROUNDS)).alias("round"), F.pmod(F.xxhash64(mixed), F.lit(max(parts, 1))).alias("part"))
    for k in range(ROUNDS if tokens else 0):
        # More tasks than parts, so that few of them get two.
        mine = dealt.where(F.col("round") == k).repartition(4 * parts, "part").sortWithinPartitions("part", "order", "doc_id")
        weights = _train_round(mine, weights, base, classes)
    return Fitted(Model(classes, base, weights, share), counts, tokens, types, documents)


def _frequent(counts: DataFrame) -> dict[bytes, int]:
    """Counts of all words from some count on: at most FREQUENT words of FREQUENT_BYTES bytes, found without a sort."""
    short = counts.where(F.octet_length("word") <= FREQUENT_BYTES).withColumn("size", F.floor(64 * F.log2("n")))
    # At most 64 sizes for each doubling of a count.
    words, least = 0, None
    for r in sorted(short.groupBy("size").agg(F.count(F.lit(1)).alias("words")).collect(), key=lambda r: -r["size"]):
        words += r["words"]
        if words > FREQUENT:
            break
        least = r["size"]
    if least is None:
        return {}
    found = short.where(F.col("size") >= least).select("word", "n").toArrow()
    return dict(zip(found.column("word").to_pylist(), found.column("n").to_pylist()))


def score(docs: DataFrame, fitted: Fitted) -> DataFrame:
    """One row for each row of `docs`, which must be what the model's documents were read from."""
    context = docs.sparkSession.sparkContext
    model = context.broadcast(fitted.model)
    frequent = context.broadcast(_frequent(fitted.counts))

    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, logs, held, size = [], [], [], 0
            for k, ids in enumerate(batch.column(3), 1):
                held.append(np.frombuffer(ids.as_py(), "<u2").astype(np.int64))
                size += len(held[-1])
                if size >= 8 * BATCH or k == batch.num_rows:
                    sizes += map(len, held)
                    logs.append(model.value.log10_classes(held))
                    held, size = [], 0
            yield pa.record_batch(
                [*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(np.concatenate(logs or [np.zeros(0)]), pa.float64())],
                names=["row", "doc_id", "held_out", "n_tokens", "by_class"])

    def by_count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = frequent.value
        logs = {w: np.log10(n + 1) for w, n in counted.items()}
        names = ["row", "word", "times", "known", "logs"]
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.float64())
        for batch in batches:
            out = []
            for row, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                found = Counter(text.lower().split())
                found[END_TOKEN] += 1
                known, total = 0, 0.0
                for word, times in found.items():
                    if word in logs:
                        known += times
                        total += times * logs[word]
                    else:
                        out.append((row, word, times, 0, 0.0))
                out.append((row, None, 0, known, total))
                if len(out) > 50_000:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
                    out = []
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    classed = for_workers(fitted.documents).mapInArrow(by_class, "row long, doc_id long, held_out boolean, n_tokens long, by_class double")
    counted = staged(source_rows(docs).select("row", "text").mapInArrow(by_count, "row long, word binary, times long, known long, logs double"), "lm-words")
    rare = counted.where("word is not null").join(fitted.counts, "word").select("row", F.col("times").alias("known"), (F.col("times") * F.log10(F.col("n") + 1)).alias("logs"))
    frequent_part = counted.where("word is null").select("row", "known", "logs")
    summed = frequent_part.unionByName(rare).groupBy("row").agg(F.sum("known").alias("n_known"), F.sum("logs").alias("logs"))
    base = F.lit(float(np.log10(fitted.tokens + fitted.types + 1)))
    return classed.join(summed, "row").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(fitted.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * base).alias("base_score"), (F.col("logs") + F.col("by_class")).alias("score"))


def scored(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs` (doc_id, text): doc_id, held_out, counts of tokens, base_score, score.

    Cases: a null or empty text is the end token alone; a null doc_id is in the
    training part; repeated rows are counted and scored each; without training
    tokens base_score is 0 and every class is as likely; an empty table gives
    no rows; further columns are ignored.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return score(docs, fit(docs))
