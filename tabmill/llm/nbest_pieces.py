"""The N best segmentations of texts into the pieces of a SentencePiece vocabulary, and back.

A text is a lattice of pieces. A forward pass gives the best score from the
start to each place; a search from the end takes it as the exact value of what
is left (A*), so that segmentations come out best first and no more of the
lattice is visited than the N best need.

In this vocabulary a space mark only begins a piece, so no piece crosses the
start of a word: the lattice is a chain of word lattices. One pass forward over
the pieces of each different word, many words at a time, gives its two best
scores and so what its second choice costs; the N best of the text lie in the
N-1 words where that is least, and A* lists the N best of those. A vocabulary
with other pieces is searched as one lattice a text.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmill.llm.shared import for_workers

N_BEST = 4
SPACE = "▁"
VOCABULARY = "piece_bpe_32k.model"
PENALTY = 10.0  # of a character that has no piece, below the least score of one
TOGETHER = 48  # characters of a word that is searched along with others
AT_ONCE = 16_384  # words searched along with one another
CACHED_WORDS = 300_000  # of the newer half of a worker's table
DECODED = 65_536  # pieces decoded at once
ROWS, BYTES = 1000, 4_000_000  # of texts cut at once; one text may have more


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _step(key: np.ndarray, points: np.ndarray) -> np.ndarray:
    key = (key ^ (points + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
    return key ^ (key >> np.uint64(29))


class Vocabulary:
    """Pieces with ids and scores. A character without a piece becomes the pieces of its bytes."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: list[int] | None, unknown: int = 0, skip: frozenset[int] = frozenset()):
        self.text = [p for p, _ in pieces]
        special = skip | set(byte_ids or ()) | {unknown}
        self.known = {p: (i, s) for i, (p, s) in enumerate(pieces) if i not in special and p}
        # All beginnings of pieces; those that aren't pieces have None.
        self.starts = {p[:k]: None for p in self.known for k in range(1, len(p) + 1)} | self.known
        self.byte_ids, self.unknown = byte_ids, unknown
        self.byte_of = {i: b for b, i in enumerate(byte_ids or ())}
        # What each id decodes to, as one run of bytes.
        plain = [bytes([self.byte_of[i]]) if i in self.byte_of else p.replace(SPACE, " ").encode() for i, p in enumerate(self.text)]
        self.plain, self.plain_size = np.frombuffer(b"".join(plain), np.uint8), np.fromiter(map(len, plain), np.int64, len(plain))
        self.plain_start = np.cumsum(self.plain_size) - self.plain_size
        # Scores far below all others mark pieces that are there for the user's sake only.
        self.fallback = min((s for _, s in self.known.values() if s > -1e8), default=0.0) - PENALTY
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.known)
        # Nor does a piece hold a line break, as a rule.
        self.by_line = not any("\n" in p for p in self.known)
        self._make_index()
        self._choices = lru_cache(20_000)(lambda word, n: [(score, np.array(ids, np.uint32)) for score, ids in self.n_best(word, n)])
        self._start_table()

    def _start_table(self) -> None:
        self.words: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.size, self.score, self.loss, self.count, self.ids = 0, np.zeros(1024), np.zeros(1024), np.zeros(1024, np.int64), []

    def _make_index(self) -> None:
        """Pieces by hash, with a first filter that most other strings fail: bit 1 for what longer pieces begin with, bit 2 for pieces."""
        by_size: dict[int, list[str]] = {}
        for piece in self.known:
            by_size.setdefault(len(piece), []).append(piece)
        self.longest = max(by_size, default=0)
        self.filter = np.zeros(1 << 21, np.uint8)
        keys, numbers, scores = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for size, pieces in by_size.items():
            key = np.zeros(len(pieces), np.uint64)
            for k, column in enumerate(_points("".join(pieces)).reshape(len(pieces), size).T, 1):
                key = _step(key, column)
                self.filter[key >> np.uint64(43)] |= 1 if k < size else 2
            keys.append(key)
            numbers.append(np.array([self.known[p][0] for p in pieces]))
            scores.append(np.array([self.known[p][1] for p in pieces]))
        keys, numbers, scores = (np.concatenate(x) for x in (keys, numbers, scores))
        order = np.argsort(keys)
        self.keys, self.numbers, self.scores = keys[order], numbers[order].astype(np.uint32), scores[order]
        # The first key of each slot of the filter; the others of the slot follow it.
        slots, first, most = np.unique(self.keys >> np.uint64(43), return_index=True, return_counts=True)
        self.first, self.most = np.zeros(1 << 21, np.int32), int(most.max(initial=0))
        self.first[slots] = first

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        size = range(sp.get_piece_size())
        byte_ids = [i for i in size if sp.is_byte(i)]
        skip = frozenset(i for i in size if sp.is_control(i) or sp.is_unused(i))
        return cls([(sp.id_to_piece(i), sp.get_score(i)) for i in size], byte_ids if len(byte_ids) == 256 else None, sp.unk_id(), skip)

    def normal(self, text: str) -> str:
        """Spaces as marks, with one before the first word."""
        return SPACE + text.replace(" ", SPACE) if text else ""

    def _lattice(self, text: str) -> tuple[list[list[tuple[int, float, tuple[int, ...]]]], list[float]]:
        """For each place, the pieces that end there (where they begin, their score and ids), and the best score up to it."""
        size, starts, missing = len(text), self.starts, ()
        ends: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
        best = [0.0] + [float("-inf")] * size
        for i in range(size):
            here, single = best[i], False
            for j in range(i + 1, size + 1):
                found = starts.get(text[i:j], missing)
                if found is missing:
                    break
                if found is not None:
                    number, score = found
                    ends[j].append((i, score, (number,)))
                    if here + score > best[j]:
                        best[j] = here + score
                    single |= j == i + 1
            if not single:
                ids = tuple(self.byte_ids[b] for b in text[i].encode("utf-8", "surrogatepass")) if self.byte_ids else (self.unknown,)
                ends[i + 1].append((i, self.fallback, ids))
                best[i + 1] = max(best[i + 1], here + self.fallback)
        return ends, best

    def n_best(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """Up to n segmentations of a normal text, best first: scores and ids."""
        if not text:
            return [(0.0, ())]
        ends, best = self._lattice(text)
        out: list[tuple[float, tuple[int, ...]]] = []
        # Of equal values the one nearer to the start goes first; the count keeps the order the same in each run.
        count, heap = 0, [(-best[-1], len(text), 0, 0.0, None)]
        while heap and len(out) < n:
            _, j, _, after, path = heapq.heappop(heap)
            if not j:
                ids: list[int] = []
                while path:
                    piece, path = path
                    ids += piece
                out.append((after, tuple(ids)))
                continue
            for i, score, ids in ends[j]:
                count += 1
                total = after + score
                heapq.heappush(heap, (-(best[i] + total), i, count, total, (ids, path)))
        return out

    def _pieces_in(self, points: np.ndarray, left: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1, 2, ... characters: the characters that pieces of this length begin at, and the numbers of these among the keys.

        `left` has the characters from each one to the end of its word. Only
        beginnings of longer pieces are followed further.
        """
        at, key, size = np.arange(len(points)), np.zeros(len(points), np.uint64), 0
        while len(at) and size < self.longest:
            key = _step(key, points[at + size])
            size += 1
            kind = self.filter[key >> np.uint64(43)]
            maybe = np.flatnonzero(kind & 2)
            wanted = key[maybe]
            found = self.first[wanted >> np.uint64(43)]
            sure = self.keys[found] == wanted
            for k in range(1, self.most):
                other = np.flatnonzero(~sure)
                number = np.minimum(self.first[wanted[other] >> np.uint64(43)] + k, len(self.keys) - 1)
                hit = self.keys[number] == wanted[other]
                found[other[hit]], sure[other[hit]] = number[hit], True
            yield at[maybe[sure]], found[sure]
            more = np.flatnonzero((kind & 1).astype(bool) & (left[at] > size))
            at, key = at[more], key[more]

    def _search_together(self, words: list[str]) -> None:
        """Best segmentations and the cost of the second for words of at most TOGETHER characters, in one pass over all of them.

        A second segmentation is the best or the second up to where its last
        piece begins, so two scores a place are enough. Places are those before,
        between and behind the characters of a word.
        """
        points, sizes = _points("".join(words)), np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), sizes)
        ends = np.cumsum(sizes)
        left = ends[word] - np.arange(len(points))
        inside = sizes[word] - left
        starts, ends = ends - sizes + np.arange(len(words)), ends + np.arange(len(words))
        begins, found, order, whole = [], [], [], np.zeros(len(words), bool)
        for size, (at, number) in enumerate(self._pieces_in(points, left), 1):
            if size == 1:
                single = np.zeros(len(points), bool)
                single[at] = True
                whole[:] = True
                whole[word[~single]] = False
            begins.append(at + word[at])
            found.append(number)
            # By the end within the word, then the longest first, which wins among equals.
            order.append(((inside[at] + size) * (TOGETHER + 1) + TOGETHER - size).astype(np.uint16))
        if whole.any():
            begins, found, order = (np.concatenate(x) for x in (begins, found, order))
            sort = np.argsort(order, kind="stable")
            begins, found, order = begins[sort], found[sort], order[sort]
            scores = self.scores[found]
            best, second = np.full((2, len(points) + len(words)), -np.inf)
            best[starts], came = 0, np.zeros(len(best), np.int64)
            edges = [0, *(np.flatnonzero(np.diff(order)) + 1).tolist(), len(order)]
            for a, b in zip(edges, edges[1:]):
                begin, score = begins[a:b], scores[a:b]
                end = begin + (TOGETHER - int(order[a]) % (TOGETHER + 1))
                total, old = best[begin] + score, best[end]
                second[end] = np.maximum(np.maximum(np.minimum(total, old), second[begin] + score), second[end])
                better = np.flatnonzero(total > old)
                here = end[better]
                best[here], came[here] = total[better], better + a
            # Words with a character that has no piece are left to the search alone.
            good = np.flatnonzero(whole)
            taken, ids, home = np.zeros(len(best), bool), np.zeros(len(best), np.uint32), np.zeros(len(best), bool)
            home[starts] = True
            here = ends[good]
            while len(here):
                taken[here], piece = True, came[here]
                ids[here] = self.numbers[found[piece]]
                here = begins[piece]
                here = here[~home[here]]
            counts = np.add.reduceat(taken, starts, dtype=np.int64)[good]
            score, other = best[ends[good]], second[ends[good]]
            self._store([words[k] for k in good.tolist()], score, score - other, counts, ids[taken].tobytes())
        for k in np.flatnonzero(~whole).tolist():
            self._search(words[k])

    def _search(self, word: str) -> None:
        """The same for one word of any length and characters."""
        found = self.n_best(word, 2)
        loss = found[0][0] - found[1][0] if len(found) > 1 else float("inf")
        self._store([word], np.array([found[0][0]]), np.array([loss]), np.array([len(found[0][1])]), np.array(found[0][1], np.uint32).tobytes())

    def _store(self, words: list[str], score: np.ndarray, loss: np.ndarray, count: np.ndarray, ids: bytes) -> None:
        """Put words into the table; the ids of all of them follow one another."""
        size = self.size + len(words)
        if size > len(self.score):
            self.score, self.loss, self.count = (np.concatenate([x, np.zeros(size, x.dtype)]) for x in (self.score, self.loss, self.count))
        self.score[self.size : size], self.loss[self.size : size], self.count[self.size : size] = score, loss, count
        ends = (4 * np.cumsum(count)).tolist()
        self.ids += [ids[a:b] for a, b in zip([0, *ends], ends)]
        self.words.update(zip(words, range(self.size, size)))
        self.size = size

    def _make_room(self) -> None:
        """When the newer half is full, the older goes."""
        if len(self.words) < CACHED_WORDS:
            return
        newer = self.words
        old, old_ids = (self.score, self.loss, self.count), self.ids
        self._start_table()
        numbers = np.fromiter(newer.values(), np.int64, len(newer))
        self.size, self.ids = len(newer), [old_ids[k] for k in numbers.tolist()]
        room = max(1024, len(newer))
        self.score, self.loss, self.count = (np.concatenate([x[numbers], np.zeros(room, x.dtype)]) for x in old)
        self.older = dict(zip(newer, range(len(newer))))

    def _cut(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The different words of texts, the word at each place, and the places up to the end of each text.

        The lattices of a text's words make up its own. A word is marks and
        what follows them in the line, or line breaks; the whole text where
        pieces may cross words.
        """
        if not self.by_word:
            words = {normal: k for k, normal in enumerate(dict.fromkeys(self.normal(t) for t in texts if t))}
            which = np.array([words[self.normal(t)] for t in texts if t], np.int64)
            return list(words), which, np.cumsum([bool(t) for t in texts], dtype=np.int64)
        # A space in place of each mark, so that marks are one byte.
        data = [(" " + t.replace(SPACE, " ")).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        every = b"".join(data)
        if not every:
            return [], np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        chars = np.frombuffer(every, np.uint8)
        kind = (chars == 32) + np.uint8(2) * ((chars == 10) & self.by_line)
        begins = np.ones(len(chars), bool)
        begins[1:] = (kind[1:] != kind[:-1]) & ~((kind[1:] == 0) & (kind[:-1] == 1))
        begins[(ends - np.diff(ends, prepend=0))[np.diff(ends, prepend=0) > 0]] = True
        begins = np.flatnonzero(begins)
        offsets = np.append(begins, len(chars))
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(every)]).dictionary_encode()
        # All words are decoded as one; where each ends follows from the bytes that begin a character.
        found = coded.dictionary
        stops = np.frombuffer(found.buffers()[1], np.int64)[1 : len(found) + 1]
        joined = found.buffers()[2].to_pybytes()[: stops[-1]]
        heads = np.cumsum((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80)
        text = joined.decode("utf-8", "surrogatepass").replace(" ", SPACE)
        return [text[a:b] for a, b in pairwise([0, *heads[stops - 1].tolist()])], coded.indices.to_numpy(), np.searchsorted(begins, ends)

    def learn(self, texts: list[list[str]]) -> None:
        """Put the words of some texts into the table, many at a time."""
        self._make_room()
        seen: set[str] = set()
        for words in texts:
            seen.update(words)
        fresh: list[str] = []
        for word in seen.difference(self.words):
            if (number := self.older.get(word)) is not None:
                self.words[word] = number
            elif len(word) <= TOGETHER:
                fresh.append(word)
            else:
                self._search(word)
        for at in range(0, len(fresh), AT_ONCE):
            self._search_together(fresh[at : at + AT_ONCE])

    def segmentations(self, text: str, n: int = N_BEST) -> list[tuple[float, np.ndarray]]:
        """Up to n segmentations of a text, best first."""
        return next(self.segmented([text], n))

    def segmented(self, texts: list[str], n: int = N_BEST) -> Iterator[list[tuple[float, np.ndarray]]]:
        """Up to n segmentations of each text, best first. Each different word is looked up once."""
        words, which, ends = self._cut(texts)
        self.learn([words])
        numbers = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        pool = np.frombuffer(b"".join(map(self.ids.__getitem__, numbers.tolist())), np.uint32)
        score, loss, count = (x[numbers][which] for x in (self.score, self.loss, self.count))
        first = (np.cumsum(self.count[numbers]) - self.count[numbers])[which]
        to = np.cumsum(count)
        best = pool[np.repeat(first + count - to, count) + np.arange(count.sum())]
        for a, b in pairwise([0, *ends.tolist()]):
            # A word beyond the n-1 cheapest to change is not changed in any of the n best.
            size = b - a
            places = np.sort(np.argpartition(loss[a:b], n - 2)[: n - 1]) if 1 < n <= size else np.arange(size if n > 1 else 0)
            top = float(score[a:b].sum())
            choices: list[tuple[float, tuple[tuple[int, np.ndarray], ...]]] = [(0.0, ())]
            for place in (places + a).tolist():
                others = self._choices(words[which[place]], n)
                made = [(lost + others[0][0] - s, (*changed, (place, ids))) for lost, changed in choices for s, ids in others]
                choices = sorted(made, key=lambda x: x[0])[:n]
            begin, end = (int(to[x - 1]) if x else 0 for x in (a, b))
            out = []
            for lost, changed in choices:
                whole, done = [], begin
                for place, ids in changed:
                    whole += best[done : to[place] - count[place]], ids
                    done = to[place]
                out.append((top - lost, np.concatenate([*whole, best[done:end]])))
            yield out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that aren't UTF-8 become replacement marks."""
        out = []
        for at in range(0, len(ids), DECODED):
            some = np.asarray(ids[at : at + DECODED], np.int64)
            size = self.plain_size[some]
            ends = np.cumsum(size)
            out.append(self.plain[np.repeat(self.plain_start[some] + size - ends, size) + np.arange(ends[-1])].tobytes())
        return b"".join(out).decode("utf-8", "replace").replace(SPACE, " ").removeprefix(" ")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One for a Python worker, shared by its tasks."""
    return Vocabulary.load(path)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch (doc_id, text) of bounded rows and bytes of text, a row at least."""
    begin, held = 0, 0
    for at, size in enumerate(pc.binary_length(batch.column(1)).fill_null(0).to_pylist()):
        if at > begin and (at - begin == ROWS or held + size > BYTES):
            yield batch.slice(begin, at - begin)
            begin, held = at, 0
        held += size
    if batch.num_rows:
        yield batch.slice(begin)


def encoded(docs: DataFrame, n: int = N_BEST, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row for each row of `docs` (doc_id, text): doc_id, n_pieces, score, scores, crcs, decoded_crc32, same[, ids].

    n_pieces and score are those of the best segmentation, scores and crcs (of
    the ids as little-endian 32-bit numbers) of all n, best first, and ids the
    segmentations. decoded_crc32 is that of the text which the best one decodes
    to, same whether that is the text; only a text with the space mark itself
    differs. `path` is the vocabulary file, the same on all executors.

    Cases: a null or empty text has one segmentation, of no pieces; texts with
    fewer than n segmentations give fewer; equal scores go in an order that is
    the same in each run; repeated rows give repeated rows; an empty table gives
    no rows; further columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(path or vocabulary_path())
        names = ["doc_id", "n_pieces", "score", "scores", "crcs", "decoded_crc32", "same", "ids"][: 7 + with_ids]
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.int64(), pa.bool_(), pa.list_(pa.list_(pa.int32()))]
        for batch in batches:
            for part in _parts(batch):
                rows = []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, text, found in zip(part.column(0).to_pylist(), texts, pieces.segmented(texts, n)):
                    back = pieces.decode(found[0][1])
                    crcs = [zlib.crc32(ids.astype("<u4", copy=False)) for _, ids in found]
                    rows.append((doc, len(found[0][1]), found[0][0], [s for s, _ in found], crcs, zlib.crc32(back.encode()), back == text, [ids.tolist() for _, ids in found] if with_ids else None))
                yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds[: len(names)])], names=names)

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return for_workers(slim).mapInArrow(
        run, "doc_id long, n_pieces long, score double, scores array<double>, crcs array<long>, decoded_crc32 long, same boolean" + ", ids array<array<int>>" * with_ids)


def decoded(rows: DataFrame, column: str = "ids", path: str | None = None) -> DataFrame:
    """`rows` with the text of an array of ids instead of the ids, under the name `text`; null for null."""
    names = [c for c in rows.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(path or vocabulary_path())
        for batch in batches:
            texts = [None if v is None else pieces.decode(np.array(v, np.uint32)) for v in batch.column(len(names)).to_pylist()]
            yield pa.record_batch([*batch.columns[: len(names)], pa.array(texts, pa.string())], names=[*names, "text"])

    kept = rows.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{column}`"))
    schema = T.StructType([*kept.drop(column).schema.fields, T.StructField("text", T.StringType())])
    return for_workers(kept).mapInArrow(run, schema)
