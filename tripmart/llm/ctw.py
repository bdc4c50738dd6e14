"""Language-model scoring by context-tree weighting over bytes.

A text is scored as its token sequence: words with A-Z lowered, joined by one
space, then a line feed as the end (which no word holds).  Each byte is eight
binary decisions, each with a context tree of its own over the ``DEPTH`` bytes
before it.

Learning counts, over all training texts, each context of ``DEPTH`` bytes with
the byte that follows.  The tree branches at every context that stands before
at least ``LEAST`` bytes, so it grows with the corpus; the rarer continuations
of a context share one leaf, so every count is used.  A node keeps how often
its decision was 0 and 1; its Krichevsky-Trofimov block probability is weighed
against the product of its children's, bottom up.  The probability of a
decision mixes the KT estimates of all depths with the resulting weights; the
logarithms sum to the text's code length.

Nothing that grows with the corpus is broadcast or collected.  The texts are
dealt into slices of about ``SLICE`` characters, kept as compressed chunks; each
slice gives its distinct (context, byte) pairs, packed into one sorted,
delta-coded list per hash bucket.  A bucket's lists add up to its counts, which
meet by the last ``TOP`` + 1 bytes of the context: below those a task builds the
tree and mixes the estimates of the pairs.  The contexts of ``TOP`` bytes and
less (their number is bounded by the alphabet, not by the corpus) are joined on
the driver.  The probabilities then meet the lists by bucket, and each slice is
scored with those that come back to it.

The unigram baseline takes the same way: each slice's distinct words in packed
lists by hash bucket, whose counts add up and come back to the slices.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import documents, held_out, stored

DEPTH = 5
#: A context branches if it stands before at least so many bytes.
LEAST = 2
#: Contexts up to this length are joined on the driver, longer ones in tasks.
TOP = 2
#: Characters of a slice of the texts.
SLICE = 1 << 25
#: Slices whose pairs fill a bucket.
PER_BUCKET = 4
#: Distinct words a task holds before it hands them on.
WORDS = 1_000_000
#: Contexts with a byte that a training task holds.
GRAMS = 1 << 21
#: Bytes handled at a time.
CHUNK = 1 << 20
END = b"\n"
START = END * DEPTH
LOG2 = float(np.log(2.0))
_ZSTD = zstandard.ZstdCompressor(level=1)


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def stream(words: list[bytes]) -> bytes:
    """What is scored of a text, after the fixed context that precedes it."""
    return START + b" ".join(words) + END


def slices(column: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, tokens of each text) of rows with about CHUNK characters."""
    at, some, size = 0, [], 0
    for i, t in enumerate(column):
        text = t.as_py()
        some.append(tokens(text))
        size += len(text or "")
        if size >= CHUNK:
            yield at, some
            at, some, size = i + 1, [], 0
    if some:
        yield at, some


def positions(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all bytes, places of the scored ones, scored bytes of each stream)."""
    a = np.frombuffer(b"".join(streams), np.uint8)
    size = np.fromiter(map(len, streams), np.int64, len(streams))
    begin = np.cumsum(size) - size
    scored = np.ones(len(a), bool)
    for i in range(DEPTH):
        scored[begin + i] = False
    return a, np.flatnonzero(scored), size - DEPTH


def grams(streams: list[bytes]) -> np.ndarray:
    """Of every scored byte: its context, the last byte lowest, then the byte, in one number."""
    a, at, _ = positions(streams)
    key = np.zeros(len(a), np.uint64)
    for i in range(DEPTH, 0, -1):  # byte i places before stands above those nearer
        key[DEPTH:] |= a[DEPTH - i:len(a) - i].astype(np.uint64) << np.uint64(8 * i)
    return key[at] | a[at]


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(back, np.concatenate(counts), len(key)).astype(np.int64)


def _closed(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def _open(chunk: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(chunk).read_next_batch()


def _packed(values: np.ndarray) -> bytes:
    """Unsigned numbers, their bytes of equal rank side by side, compressed."""
    planes = values.view(np.uint8).reshape(len(values), -1).T
    return _ZSTD.compress(values.dtype.str.encode() + planes.tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    raw = zstandard.decompress(packed)
    kind = np.dtype(raw[:3].decode())
    return np.frombuffer(raw, np.uint8, offset=3).reshape(kind.itemsize, -1).T.copy().view(kind)[:, 0]


def _gaps(key: np.ndarray) -> bytes:
    """Sorted numbers as the gaps between them."""
    return _packed(np.diff(key.astype("<u8"), prepend=np.uint64(0)))


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _deal(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """(slice, chunk): rows numbered, in chunks of about CHUNK characters and
    slices of about ``most``; a longer text is a chunk and a slice of its own."""
    row = slice_ = TaskContext.get().partitionId() << 40
    size = 0
    for batch in batches:
        length = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy()
        part = np.cumsum(length) // min(CHUNK, most)
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            if size >= most:
                slice_, size = slice_ + 1, 0
            columns = [pa.array(np.arange(row, row + b - a), pa.int64()), *(c.slice(a, b - a) for c in batch.columns)]
            chunk = _closed(pa.RecordBatch.from_arrays(columns, ["row", "id", "text", "train"]))
            yield pa.RecordBatch.from_arrays([pa.array([slice_], pa.int64()), pa.array([chunk], pa.binary())], ["slice", "chunk"])
            row, size = row + b - a, size + int(length[a:b].sum())


def _words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(slice, bucket, words, counts) of each slice, the end among them; 0 for
    words of texts that are not learnt from.  A slice may come in several parts."""
    words: Counter = Counter()
    now = None

    def counted() -> pa.RecordBatch:
        lists: dict[int, list[bytes]] = defaultdict(list)
        for w in sorted(words):
            lists[zlib.crc32(w) % buckets].append(w)
        out = pa.RecordBatch.from_arrays([
            pa.array([now] * len(lists), pa.int64()), pa.array(list(lists), pa.int64()),
            pa.array([_ZSTD.compress(b" ".join(x)) for x in lists.values()], pa.binary()),
            pa.array([_packed(np.array([words[w] for w in x], "<u4")) for x in lists.values()], pa.binary())], ["slice", "bucket", "words", "counts"])
        words.clear()
        return out

    for batch in batches:
        for number, chunk in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if number != now and words:
                yield counted()
            now = number
            rows = _open(chunk.as_py())
            train = rows.column(3).to_pylist()
            for at, split in slices(rows.column(2)):
                for s, learnt in zip(split, train[at:], strict=False):
                    if learnt:
                        words.update(s)
                        words[END] += 1
                    else:
                        words.update(dict.fromkeys([*s, END], 0))
                if len(words) > WORDS:
                    yield counted()
    if words:
        yield counted()


def _listed(words: bytes, counts: bytes) -> Iterator[tuple[bytes, int]]:
    return zip(zstandard.decompress(words).split(b" "), _unpacked(counts).tolist(), strict=True)


def _vocabulary(lists: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, words, counts, n_words, n_tokens): the words of one bucket that were learnt."""
    known: Counter = Counter()
    bucket = 0
    for batch in lists:
        for row in batch.select(["bucket", "words", "counts"]).to_pylist():
            bucket = row["bucket"]
            for w, n in _listed(row["words"], row["counts"]):
                if n:
                    known[w] += n
    if known:
        counts = np.array(list(known.values()), "<i8")
        yield pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int64()), pa.array([_ZSTD.compress(b" ".join(known))], pa.binary()), pa.array([_packed(counts)], pa.binary()),
             pa.array([len(known)], pa.int64()), pa.array([int(counts.sum())], pa.int64())], ["bucket", "words", "counts", "n_words", "n_tokens"])


def _counted_words(key, lists: pa.Table, vocabulary: pa.Table) -> pa.Table:
    """(slice, words, counts): each list of a bucket with the counts over all texts learnt from."""
    known = {w: n for row in vocabulary.select(["words", "counts"]).to_pylist() for w, n in _listed(row["words"], row["counts"])}
    counts = [_packed(np.array([known.get(w, 0) for w in zstandard.decompress(x.as_py()).split(b" ")], "<i8")) for x in lists["words"]]
    return pa.table({"slice": lists["slice"], "words": lists["words"], "counts": pa.array(counts, pa.binary())})


def _pairs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(slice, bucket, grams, counts) of each slice, 0 for grams of texts that
    are not learnt from.  A slice may come in several parts."""
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    now = None

    def counted() -> pa.RecordBatch:
        key, n = _merge(keys, counts)
        of = _bucket(key, buckets)
        order = np.argsort(of, kind="stable")  # grams stay sorted in a bucket
        key, n, of = key[order], n[order].astype("<u4"), of[order]
        cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
        parts = [(int(of[a]), _gaps(key[a:b]), _packed(n[a:b])) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]
        bucket, grams_, ns = zip(*parts, strict=True)
        return pa.RecordBatch.from_arrays([pa.array([now] * len(parts), pa.int64()), pa.array(bucket, pa.int64()), pa.array(grams_, pa.binary()),
                                           pa.array(ns, pa.binary())], ["slice", "bucket", "grams", "counts"])

    for batch in batches:
        for number, chunk in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if number != now:
                if keys:
                    yield counted()
                keys, counts, now = [], [], number
            rows = _open(chunk.as_py())
            train = np.array(rows.column(3).to_pylist(), bool)
            for at, split in slices(rows.column(2)):
                for learnt in (False, True):
                    streams = [stream(s) for s, t in zip(split, train[at:], strict=False) if t == learnt]
                    if streams:
                        key, n = np.unique(grams(streams), return_counts=True)
                        keys.append(key)
                        counts.append(n if learnt else np.zeros(len(n), np.int64))
                if sum(map(len, keys)) > GRAMS:
                    keys, counts = ([x] for x in _merge(keys, counts))
                    if len(keys[0]) > GRAMS // 2:
                        yield counted()
                        keys, counts = [], []
    if keys:
        yield counted()


def _added(lists: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, n): the counts of one bucket."""
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    for batch in lists:
        for g, c in zip(batch.column("grams"), batch.column("counts"), strict=True):
            keys.append(np.cumsum(_unpacked(g.as_py())))
            counts.append(_unpacked(c.as_py()))
            if sum(map(len, keys)) > GRAMS:
                keys, counts = ([x] for x in _merge(keys, counts))
    gram, n = _merge(keys, counts)
    yield pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int64)), pa.array(n, pa.int64())], ["gram", "n"])


def _answered(key, lists: pa.Table, known: pa.Table) -> pa.Table:
    """(slice, grams, logs): each list of a bucket with its log10 probabilities."""
    gram, log10 = known["gram"].to_numpy(), known["log10"].to_numpy()
    order = np.argsort(gram)
    gram, log10 = gram[order], log10[order]
    logs = [_packed(log10[np.searchsorted(gram, np.cumsum(_unpacked(g.as_py())).astype(np.int64))].astype("<f4")) for g in lists["grams"]]
    return pa.table({"slice": lists["slice"], "grams": lists["grams"], "logs": pa.array(logs, pa.binary())})


def _lgamma(x, ln=F.ln):
    """ln Gamma for x > 0: Stirling's series eight places on, stepped back."""
    y = x + 8
    series = ((y - 0.5) * ln(y) - y + float(0.5 * np.log(2 * np.pi)) + 1 / (12 * y) - 1 / (360 * y * y * y)
              + 1 / (1260 * y * y * y * y * y))
    steps = x
    for i in range(1, 8):
        steps = steps * (x + i)
    return series - ln(steps)


def _kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the KT block probability of the counts."""
    def log_gamma(x):
        return _lgamma(x, np.log)

    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - float(np.log(np.pi))


def _one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """KT probability of a 1."""
    return (ones + 0.5) / (zeros + ones + 1)


def _weigh(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ln of the weighted block probability, weight of the own estimate)."""
    gap = own - below
    return np.maximum(own, below) + np.log1p(np.exp(-np.abs(gap))) - LOG2, 1 / (1 + np.exp(np.minimum(-gap, 700.0)))


def branching(counts: DataFrame, branch: int | None = None) -> int:
    """Bytes a context must stand before to branch: ``LEAST``, or one in ``branch`` of all."""
    if branch is None:
        return LEAST
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return max(1, -(-total // branch))


@lru_cache(1)
def _paths() -> tuple[np.ndarray, np.ndarray]:
    """For each byte and place: the node decided there, and the bit.

    Nodes number the decisions of a byte: 1 for the first, then the bits so
    far with a leading 1.
    """
    byte, k = np.arange(256)[:, None], np.arange(8)[None, :]
    return (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1


class Nodes:
    """Counts of the nodes that some grams pass at one depth."""

    def __init__(self, context: np.ndarray, byte: np.ndarray, n: np.ndarray):
        node, bit = _paths()
        # the context stands above the node; 8 * DEPTH + 8 bits are below 63
        self.key, self.at = np.unique((context[:, None] << 8 | node[byte]).reshape(-1), return_inverse=True)
        self.at = self.at.reshape(-1)
        each, ones = np.repeat(n, 8), bit[byte].reshape(-1)
        self.n1 = np.bincount(self.at, each * ones, len(self.key))
        self.n0 = np.bincount(self.at, each * (1 - ones), len(self.key))
        self.one = _one(self.n0, self.n1)
        self.at = self.at.reshape(-1, 8)


def _mask(depth: int) -> int:
    return (1 << 8 * depth) - 1


def _subtrees(gram: np.ndarray, n: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, pa.RecordBatch]:
    """Of whole subtrees below contexts of TOP + 1 bytes.

    (which grams have such a context in the tree, their estimates mixed down
    from the deepest to that context, what the contexts above take from here).
    """
    context, byte = gram >> 8, gram & 255
    deep = np.full(len(gram), TOP)
    for d in range(TOP + 1, DEPTH + 1):
        _, at = np.unique(context & _mask(d), return_inverse=True)
        deep += np.bincount(at, n)[at] >= max(least, 1)  # a longer context is never more frequent
    p = np.zeros((len(gram), 8))
    below: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0))  # nodes one byte longer, their block probability
    up = Nodes(context[:0], byte[:0], n[:0])
    for d in range(DEPTH, TOP, -1):
        some, last = np.flatnonzero(deep >= d), np.flatnonzero(deep == d)
        up, rest = (Nodes(context[i] & _mask(d), byte[i], n[i]) for i in (some, last))
        if d == DEPTH:
            p[some], blocks = up.one[up.at], _kt(up.n0, up.n1)
        else:
            p[last] = rest.one[rest.at]
            shorter = (below[0] >> 8 & _mask(d)) << 8 | below[0] & 255
            deeper = np.bincount(np.searchsorted(up.key, shorter), below[1], len(up.key))
            deeper += np.bincount(np.searchsorted(up.key, rest.key), _kt(rest.n0, rest.n1), len(up.key))
            blocks, own = _weigh(_kt(up.n0, up.n1), deeper)
            p[some] = own[up.at] * up.one[up.at] + (1 - own[up.at]) * p[some]
        below = up.key, blocks
    short = deep == TOP
    leaf = Nodes(context[short] & _mask(TOP), byte[short], n[short])
    to, at = np.unique((up.key >> 8 & _mask(TOP)) << 8 | up.key & 255, return_inverse=True)
    sums = [np.bincount(at, x, len(to)) for x in (up.n0, up.n1, below[1])]
    more = pa.RecordBatch.from_arrays(
        [pa.nulls(len(to) + len(leaf.key), pa.int64()), pa.nulls(len(to) + len(leaf.key), pa.list_(pa.float32())),
         pa.array(np.concatenate([to, leaf.key])), pa.array(np.repeat([False, True], [len(to), len(leaf.key)])),
         *[pa.array(np.concatenate([x, y])) for x, y in zip(sums, (leaf.n0, leaf.n1, np.zeros(len(leaf.key))), strict=True)]],
        ["gram", "p", "key", "leaf", "n0", "n1", "block"])
    return deep > TOP, p, more


def _mix(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Subtrees of the grams, which come sorted by the last TOP + 1 bytes of their contexts."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def done(gram: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        has, p, more = _subtrees(gram, n, least)
        size = len(gram)
        ends = np.concatenate([[0], np.cumsum(np.where(has, 8, 0))])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(p[has].reshape(-1).astype(np.float32)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram), lists, pa.nulls(size, pa.int64()), pa.nulls(size, pa.bool_()), *[pa.nulls(size, pa.float64())] * 3],
            ["gram", "p", "key", "leaf", "n0", "n1", "block"])
        yield more

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        if sum(len(g) for g, _ in held) < GRAMS // 16:
            continue
        gram, n = (np.concatenate(x) for x in zip(*held, strict=True))
        top = gram >> 8 & _mask(TOP + 1)
        cut = int((top == top[-1]).argmax())  # the last subtree may go on
        if cut:
            yield from done(gram[:cut], n[:cut])
        held = [(gram[cut:], n[cut:])]
    if held and sum(len(g) for g, _ in held):
        yield from done(*(np.concatenate(x) for x in zip(*held, strict=True)))


class Top:
    """The contexts of TOP bytes and less, from what the subtrees hand up.

    The longest are worked through ``BLOCK`` at a time and kept in single
    precision, so that even all 65,536 contexts of two bytes take 200 MB.
    """

    BLOCK = 2048

    def __init__(self, key: np.ndarray, leaf: np.ndarray, n0: np.ndarray, n1: np.ndarray, block: np.ndarray, least: int):
        order = np.argsort(key, kind="stable")
        key, leaf, n0, n1, block = (x[order] for x in (key, leaf, n0, n1, block))
        longest, first = np.unique(key >> 8, return_index=True)
        first = np.append(first, len(key))
        self.context, self.has, self.rest, self.one, self.own = {}, {}, {}, {}, {}
        context = np.unique(longest & _mask(TOP - 1))
        rest, full, deeper = [np.zeros((len(context), 256)) for _ in "01"], [np.zeros((len(context), 256)) for _ in "01"], np.zeros((len(context), 256))
        parts = []
        for a in range(0, len(longest), self.BLOCK):
            some = longest[a:a + self.BLOCK]
            rows = slice(first[a], first[a + len(some)])
            under, of = ~leaf[rows], (np.searchsorted(some, key[rows] >> 8), key[rows] & 255)

            def dense(value, which, of=of, shape=(len(some), 256), rows=rows):
                out = np.zeros(shape)
                out[of[0][which], of[1][which]] = value[rows][which]
                return out

            own_rest = [dense(x, ~under) for x in (n0, n1)]
            own_full = [r + dense(x, under) for r, x in zip(own_rest, (n0, n1), strict=True)]
            has, blocks, kept = self._level(own_full, own_rest, dense(block, under), least)
            parts.append((has, *(x.astype(np.float32) for x in kept)))
            self._up(np.searchsorted(context, some & _mask(TOP - 1)), has, blocks, own_full, rest, full, deeper)
        self.context[TOP] = longest
        if parts:
            self.has[TOP], self.rest[TOP], self.one[TOP], self.own[TOP] = (np.concatenate(x) for x in zip(*parts, strict=True))
        for d in range(TOP - 1, -1, -1):
            has, blocks, kept = self._level(full, rest, deeper, least if d else 0)
            self.context[d], self.has[d] = context, has
            self.rest[d], self.one[d], self.own[d] = kept
            if not d:
                break
            shorter = np.unique(context & _mask(d - 1))
            shape = len(shorter), 256
            above = [np.zeros(shape) for _ in "01"], [np.zeros(shape) for _ in "01"], np.zeros(shape)
            self._up(np.searchsorted(shorter, context & _mask(d - 1)), has, blocks, full, *above)
            context, (rest, full, deeper) = shorter, above

    @staticmethod
    def _level(full: list, rest: list, deeper: np.ndarray, least: int) -> tuple:
        """(which contexts branch, block probabilities, (estimates of the rest, own estimates, their weights))."""
        has = full[0][:, 1] + full[1][:, 1] >= max(least, 1) if least else np.ones(len(deeper), bool)
        blocks, own = _weigh(_kt(*full), deeper + _kt(*rest))
        return has, blocks, (_one(*rest), _one(*full), own)

    @staticmethod
    def _up(at: np.ndarray, has: np.ndarray, blocks: np.ndarray, full: list, above_rest: list, above_full: list, above_deeper: np.ndarray) -> None:
        """Adds a level's contexts to those one byte shorter."""
        for x, r, f in zip(full, above_rest, above_full, strict=True):
            np.add.at(f, at, x)
            np.add.at(r, at[~has], x[~has])
        np.add.at(above_deeper, at[has], blocks[has])

    def log10(self, gram: np.ndarray, has: np.ndarray, p: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's byte; ``p`` as :func:`_subtrees` mixed it where ``has``."""
        context, byte = gram >> 8, gram & 255
        node, bit = (x[byte] for x in _paths())
        p, known = p.copy(), has.copy()
        for d in range(TOP, -1, -1):
            if not len(self.context[d]):
                continue
            some = context & _mask(d)
            i = np.minimum(np.searchsorted(self.context[d], some), len(self.context[d]) - 1)
            here = (self.context[d][i] == some) & self.has[d][i]
            i = i[:, None]
            p = np.where((here & ~known)[:, None], self.rest[d][i, node], p)
            own = self.own[d][i, node]
            p = np.where(here[:, None], own * self.one[d][i, node] + (1 - own) * p, p)
            known |= here
        p[~known] = 0.5
        p = np.clip(p, 1e-12, 1 - 1e-12)
        return np.log10(np.where(bit == 1, p, 1 - p)).sum(axis=1)


def _finished(batches: Iterator[pa.RecordBatch], top, buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gram, lists = batch.column(0).to_numpy(), batch.column(1)
        has = pc.list_value_length(lists).to_numpy(zero_copy_only=False) == 8
        p = np.zeros((len(gram), 8))
        p[has] = lists.flatten().to_numpy().reshape(-1, 8)
        yield pa.RecordBatch.from_arrays([pa.array(_bucket(gram, buckets)), batch.column(0), pa.array(top.value.log10(gram, has, p))],
                                         ["bucket", "gram", "log10"])


def probabilities(counts: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, gram, log10)``: log10 probability of the byte of every gram after its context."""
    spark = counts.sparkSession
    counts = stored(counts, "ctw-counts", "zstd")
    least = branching(counts)
    above = F.shiftright("gram", 8).bitwiseAND(F.lit(_mask(TOP + 1)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.select("gram", "n", above.alias("top")).repartition(parts, "top").sortWithinPartitions("top", "gram").select("gram", "n")
    mixed = stored(dealt.mapInArrow(partial(_mix, least=least), "gram long, p array<float>, key long, leaf boolean, n0 double, n1 double, block double"),
                   "ctw-mixed", "zstd")
    got = (mixed.where("gram IS NULL").groupBy("key", "leaf").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "block")])).toArrow()
    columns = [got[c].to_numpy() for c in ("key", "leaf", "n0", "n1", "block")]
    columns[1] = columns[1].astype(bool)
    top = spark.sparkContext.broadcast(Top(*columns, least))
    return mixed.where("gram IS NOT NULL").select("gram", "p").mapInArrow(partial(_finished, top=top, buckets=buckets), "bucket long, gram long, log10 double")


def _score(key, texts: pa.Table, answers: pa.Table) -> pa.Table:
    """Per row of a slice: the model's score and the baseline's sum over its words."""
    pairs = answers.filter(pc.is_valid(answers["grams"]))
    gram = np.concatenate([np.cumsum(_unpacked(g.as_py())) for g in pairs["grams"]])
    gram, first = np.unique(gram, return_index=True)
    log10 = np.concatenate([_unpacked(x.as_py()) for x in pairs["logs"]])[first].astype(np.float64)
    logs: dict[bytes, float] = {}
    for row in answers.filter(pc.is_valid(answers["words"])).select(["words", "counts"]).to_batches():
        for words, counts in zip(row.column(0), row.column(1), strict=True):
            n = _unpacked(counts.as_py())
            some = zip(zstandard.decompress(words.as_py()).split(b" "), np.log10(n + 1.0).tolist(), strict=True)
            logs.update((w, x) for w, x in some if x)  # a word that was learnt has a log above 0
    out = []
    for chunk in texts["chunk"]:
        batch = _open(chunk.as_py())
        for at, split in slices(batch.column("text")):
            found = [[x for x in map(logs.get, [*words, END]) if x is not None] for words in split]
            streams = [stream(words) for words in split]
            size = np.fromiter(map(len, streams), np.int64, len(streams)) - DEPTH
            own, back = np.unique(grams(streams), return_inverse=True)
            scores = np.add.reduceat(log10[np.searchsorted(gram, own)][back], np.cumsum(size) - size)
            out.append(pa.RecordBatch.from_arrays(
                [batch.column("id").slice(at, len(split)), pa.array(list(map(sum, found)), pa.float64()), pa.array(list(map(len, found)), pa.int64()),
                 pa.array([len(words) + 1 for words in split], pa.int64()), pa.array(size), pa.array(scores)],
                ["id", "sums", "n_known", "n_tokens", "n_bytes", "score"]))
    return pa.Table.from_batches(out)


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", slice_chars: int = SLICE) -> DataFrame:
    """One row per input row: ``(id, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte)``.

    Rows where ``train`` holds are learnt from; all are scored.  ``score`` is
    the model's log10 probability of the token sequence; ``bits_per_byte`` its
    code length over ``n_bytes`` scored bytes.  A null, empty or blank text is
    its end alone.  Repeated rows and null ids give their rows, an empty table
    an empty result; without training rows every estimate is one half.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    kind = dict(rows.dtypes)["id"]
    rows = stored(rows.mapInArrow(partial(_deal, most=slice_chars), "slice long, chunk binary"), "ctw-texts", "uncompressed")
    made = rows.agg(F.count_distinct("slice")).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-made // PER_BUCKET))

    lists = stored(rows.mapInArrow(partial(_words, buckets=buckets), "slice long, bucket long, words binary, counts binary"), "ctw-lists", "uncompressed")
    vocabulary = stored(lists.select("bucket", "words", "counts").groupBy("bucket")
                        .applyInArrow(_vocabulary, "bucket long, words binary, counts binary, n_words long, n_tokens long"), "ctw-words", "uncompressed")
    tokens_in, distinct = vocabulary.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    counted = (lists.select("bucket", "slice", "words").groupBy("bucket").cogroup(vocabulary.select("bucket", "words", "counts").groupBy("bucket"))
               .applyInArrow(_counted_words, "slice long, words binary, counts binary"))

    pairs = stored(rows.mapInArrow(partial(_pairs, buckets=buckets), "slice long, bucket long, grams binary, counts binary"), "ctw-pairs", "uncompressed")
    log10 = probabilities(pairs.select("bucket", "grams", "counts").groupBy("bucket").applyInArrow(_added, "gram long, n long"), buckets)
    known = (pairs.select("bucket", "slice", "grams").groupBy("bucket").cogroup(log10.groupBy("bucket"))
             .applyInArrow(_answered, "slice long, grams binary, logs binary"))

    answers = known.unionByName(counted.where("words IS NOT NULL"), allowMissingColumns=True)
    fields = f"id {kind}, sums double, n_known long, n_tokens long, n_bytes long, score double"
    scored = rows.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_score, fields)
    each = float(np.log10(tokens_in + distinct + 1.0))
    return scored.select(
        "id", "n_tokens", "n_known", F.lit(tokens_in).cast("long").alias("train_tokens"),
        (F.col("sums") - F.col("n_tokens") * each).alias("base_score"), "score", "n_bytes",
        (-F.col("score") * float(np.log2(10.0)) / F.col("n_bytes")).alias("bits_per_byte"))


def query(spark, sf_dir):
    """op2: every document scored, learning from six of seven folds."""
    docs = documents(spark, sf_dir)
    return score(docs, ~held_out(F.col("doc_id"), 7)).select(
        F.col("id").alias("doc_id"), held_out(F.col("id"), 7).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score", "n_bytes", "bits_per_byte")
