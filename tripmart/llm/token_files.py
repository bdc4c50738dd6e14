"""Token-id files: frequency ranks in byte-aligned codes with separate control bytes.

Writing: texts become ids once (stored), ids are counted over all documents
and numbered by falling frequency, documents are dealt to tasks by ranges of
their id, and each task writes blocks of whole documents.  A rank takes 1 to 4
bytes; its length less one is two bits in a control byte that serves four
ranks; the control bytes of a block stand before its data bytes, so a reader
finds all lengths by table look-up, all starts by a running sum, and gathers
whole columns of bytes with numpy.

Files: a folder ``data`` of block files in ascending document order and a
folder ``ranks`` with one table block.  They are written by Spark's text
writer, one block per record (its record end is the block's last byte), so
they lie on any file system Spark can write, are committed as any Spark
output, and a lost executor's task simply writes its file anew.

Block, little endian::

    8 bytes  magic      4 part   4 number in the part   4 documents   4 bytes a control section has
    8        ids        8 bytes of data
    documents x (8 document id, 1 has an id, 8 ids)
    control bytes, data bytes, line feed
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import documents, scratch_dir, stored
from tripmart.llm.pieces import Pieces

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
MAGIC = b"TRIPTOK1"
HEAD = struct.Struct("<8sIIIIQQ")
#: Ids after which a block ends (a longer document is a block of its own).
BLOCK = 1 << 19
#: Blocks in one file, which a reader takes as one value.
BLOCKS_PER_FILE = 16
#: Distinct pre-tokens that a worker remembers (some 200 MB).
REMEMBERED = 1_000_000
#: Characters tokenized at a time.
CHUNK = 1 << 22

# for a control byte: the four lengths it holds
LENGTHS = np.stack([(np.arange(256) >> (2 * i) & 3) + 1 for i in range(4)], axis=1).astype(np.uint8)
# the bits that belong to a value of so many bytes
OF_SIZE = np.array([(1 << 8 * i) - 1 for i in range(5)], np.uint32)


# a blank before more white space or at the end: pre-tokens then span blanks
_AWKWARD = re.compile(r" (?:\s|\Z)").search


class Encoder(dict):
    """Number of each pre-token met, with the ids of all in one array.

    A pre-token is merged once while it is remembered.
    """

    def __init__(self, path: str):
        super().__init__()
        self.pieces = Pieces(path)
        self.begin()

    def begin(self) -> None:
        self.clear()
        self.flat, self.ends = array("I"), array("I", [0])

    def add(self, ids: list[int]) -> int:
        self.flat.extend(ids)
        self.ends.append(len(self.flat))
        return len(self.ends) - 2

    def __missing__(self, piece: str) -> int:
        n = self[piece] = self.add(self.pieces.merged(piece))
        return n

    def fixed(self, key: tuple, ids: list[int]) -> int:
        """Of an id sequence that is no text."""
        if key not in self:
            self[key] = self.add(ids)
        return self[key]

    def numbers(self, text: str) -> list[int]:
        """Numbers of a text's pre-tokens and special strings."""
        out: list[int] = []
        for found, special in self.pieces.parts(text):
            out.extend(map(self.__getitem__, found))
            if special is not None:
                out.append(self.fixed(("special", special), [self.pieces.special[special]]))
        return out

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids of each text): whole texts, each followed by ``end_id``.

        Where single blanks stand between words, no pre-token spans one: the
        words after blanks are split together, each distinct one once, and the
        texts are put together from them by number.  A text's first word, and
        a text with other white space after a blank or with a special string,
        is an entry of its own.
        """
        if len(self) > REMEMBERED:
            self.begin()
        own: list[str] = []   # first words and odd texts
        rest: list[str | None] = []
        for t in texts:
            odd = _AWKWARD(t) or any(name in t for name in self.pieces.special)
            first, _, more = (t, "", "") if odd else t.partition(" ")
            own.append(first)
            rest.append(more or None)
        split = pc.split_pattern(pa.array(rest, pa.string()), " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        words = split.values.dictionary_encode()
        distinct = len(words.dictionary)
        # distinct words in one text: the pre-tokens that begin with a blank begin a word
        joined = pc.binary_join(pa.ListArray.from_arrays([0, distinct], words.dictionary), " ")[0].as_py()
        found = self.pieces.find(" " + joined) if distinct else []
        number = list(map(self.__getitem__, found))
        pieces = np.diff(np.flatnonzero([*(p[0] == " " for p in found), True]))
        if len(pieces) != distinct:
            raise ValueError("a blank did not begin a pre-token")
        wholes = list(map(self.numbers, own))
        number += [n for whole in wholes for n in whole] + [self.fixed(("end", end_id), [end_id])]
        n, end = len(texts), len(pieces) + len(texts)
        around = np.stack([np.arange(len(pieces), end), np.full(n, end)], axis=1).reshape(-1)
        entry = np.insert(words.indices.to_numpy().astype(np.int64), np.stack([offsets[:-1], offsets[1:]], axis=1).reshape(-1), around)
        # ids of each entry, then of all entries, one after the other
        edge = np.r_[0, np.cumsum(np.r_[pieces, np.fromiter(map(len, wholes), np.int64, n), 1])]
        ids, ends = gather(np.array(self.flat, np.uint32), np.array(self.ends, np.int64), np.array(number, np.int64))
        ids, ends = gather(ids, ends[edge], entry)
        return ids, np.diff(ends[offsets + 2 * np.arange(n + 1)])


def gather(values: np.ndarray, ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``which`` of ``values``, one after the other, and their ends; stretch i goes from ends[i] to ends[i + 1]."""
    begin = ends[which]
    size = ends[which + 1] - begin
    out = np.r_[0, np.cumsum(size)]
    return values[np.arange(out[-1]) + np.repeat(begin - out[:-1], size)], out


_KEPT: dict[str, Encoder] = {}


def _tokenize(batches: Iterator[pa.RecordBatch], path: str, end_id: int, size: int, width: int) -> Iterator[pa.RecordBatch]:
    """A row per text with its ids, and one at the end with the task's count of every id."""
    if path not in _KEPT:
        _KEPT[path] = Encoder(path)
    names, tally = ["id", "ids", "tally"], np.zeros(size, np.int64)
    for batch in batches:
        column, at = batch.column(1), 0
        while at < len(column):
            to, held = at, 0
            texts = []
            while to < len(column) and (held < CHUNK or to == at):
                texts.append(column[to].as_py() or "")
                held += len(texts[-1])
                to += 1
            ids, n = _KEPT[path].encode(texts, end_id)
            tally += np.bincount(ids, minlength=size)
            offsets = np.r_[0, np.cumsum(n * width)].astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), len(n), [
                None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.astype(f"<u{width}").tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), data, pa.nulls(to - at, pa.binary())], names)
            at = to
    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([tally.tobytes()])], names)


def _ids(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, ids of each row) of a binary column."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), f"<u{width}"), np.fromiter(map(len, rows), np.int64, len(rows)) // width


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for tally in batch.column(0):
            counts = np.frombuffer(tally.as_py(), np.int64)
            token = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(token, pa.int32()), pa.array(counts[token])], ["token", "n"])


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = values.astype("<u4")
    extra = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    padded = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    padded[:len(v)] = extra
    quad = padded.reshape(-1, 4)
    control = quad[:, 0] | quad[:, 1] << 2 | quad[:, 2] << 4 | quad[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of :func:`pack`: lengths by table look-up, starts by a
    running sum, then one gather of four bytes at every start."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    start = np.cumsum(size, dtype=np.int64) - size
    raw = np.ndarray(len(data), "<u4", data + bytes(3), strides=(1,))
    return raw[start] & OF_SIZE[size]


def block(part: int, number: int, keys: list[int | None], sizes: np.ndarray, values: np.ndarray) -> bytes:
    """One block without its closing line feed, which the text writer adds."""
    control, data = pack(values)
    table = np.zeros(len(keys), "<i8,u1,<i8")
    table["f0"] = [k or 0 for k in keys]
    table["f1"] = [k is not None for k in keys]
    table["f2"] = sizes
    return HEAD.pack(MAGIC, part, number, len(keys), len(control), len(values), len(data)) + table.tobytes() + control + data


def blocks(content: bytes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(part, number, document table, values) of each block of a file."""
    at = 0
    while at < len(content):
        magic, part, number, docs, n_control, n, n_data = HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at += HEAD.size
        table = np.frombuffer(content, "<i8,u1,<i8", docs, at)
        at += docs * 17
        yield part, number, table, unpack(content[at:at + n_control], content[at + n_control:at + n_control + n_data], n)
        at += n_control + n_data + 1


def _write(batches: Iterator[pa.RecordBatch], ranks, width: int) -> Iterator[pa.RecordBatch]:
    rank = np.zeros(int(ranks.value.max(initial=0)) + 1, np.uint32)
    rank[ranks.value] = np.arange(len(ranks.value), dtype=np.uint32)
    part, number = TaskContext.get().partitionId(), 0
    keys: list[int | None] = []
    sizes: list[np.ndarray] = []
    values: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        body = block(part, number, keys, np.concatenate(sizes), rank[np.concatenate(values)])
        return pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["block"])

    for batch in batches:
        ids, n = _ids(batch.column(1), width)
        of = batch.column(0).to_pylist()
        edge = np.r_[0, np.cumsum(n)]
        at = 0
        while at < len(of):
            held = sum(map(len, values))
            to = max(at + 1, int(np.searchsorted(edge, edge[at] + BLOCK - held, "right")) - 1)
            keys += of[at:to]
            sizes.append(n[at:to])
            values.append(ids[edge[at]:edge[to]])
            at = to
            if held + len(values[-1]) >= BLOCK or at < len(of):
                yield flush()
                keys, sizes, values, number = [], [], [], number + 1
    if keys:
        yield flush()


def _save(rows: DataFrame, path: str) -> None:
    """Each binary row as its bytes and a line feed."""
    rows.select(F.col("block").cast("string").alias("value")).write.option("maxRecordsPerFile", BLOCKS_PER_FILE).text(path)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id",
                      text_col: str = "text") -> str:
    """Write the ids of all texts below ``path`` in ascending id order; returns ``path``.

    A null or empty text is its end id alone.  Rows without an id come first;
    rows equal in id stand in the order of their ids' hash.  An empty table
    gives an empty ``data`` folder.
    """
    spark = docs.sparkSession
    vocabulary = Pieces(tokenizer).tok.get_vocab_size(with_added_tokens=True)
    width = 2 if vocabulary <= 1 << 16 else 4
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    encoded = rows.mapInArrow(partial(_tokenize, path=tokenizer, end_id=end_id, size=vocabulary, width=width), "id long, ids binary, tally binary")
    encoded = stored(encoded, "token-ids", "zstd")
    rows = encoded.where("ids IS NOT NULL").select("id", "ids")
    counts = (encoded.where("tally IS NOT NULL").select("tally").mapInArrow(_frequencies, "token int, n long")
              .groupBy("token").agg(F.sum("n").alias("n")))
    order = np.array([r[0] for r in counts.orderBy(F.desc("n"), "token").select("token").collect()], np.int64)
    _save(spark.createDataFrame([(bytearray(block(0, 0, [None], np.array([len(order)]), order)),)], "block binary"), f"{path}/ranks")
    tie = F.xxhash64("ids")
    dealt = rows.withColumn("tie", tie).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "ids").select("id", "ids")
    shared = spark.sparkContext.broadcast(order)
    _save(dealt.mapInArrow(partial(_write, ranks=shared, width=width), "block binary"), f"{path}/data")
    return path


def _read(batches: Iterator[pa.RecordBatch], ranks, with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(len(batch)):
            for part, number, table, values in blocks(batch.column(0)[row].as_py()):
                ids = ranks.value[values].astype("<u4")
                edge = np.r_[0, np.cumsum(table["f2"])]
                each = [ids[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
                n = len(each)
                out = [pa.array(np.full(n, part), pa.int64()), pa.array(number * (1 << 32) + np.arange(n), pa.int64()),
                       pa.array(table["f0"], pa.int64(), mask=table["f1"] == 0), pa.array(table["f2"], pa.int64()),
                       pa.array([zlib.crc32(x) for x in each], pa.int64())]
                names = ["part", "place", "id", "n_tokens", "ids_crc32"]
                if with_ids:
                    out.append(pa.array([x.tolist() for x in each], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``(part, place, id, n_tokens, ids_crc32[, ids])`` of every document in the files."""
    table = spark.read.format("binaryFile").load(f"{path}/ranks").where("length > 0").select("content").collect()
    ranks = next(iter(blocks(bytes(table[0][0]))))[3].astype(np.int64)
    files = spark.read.format("binaryFile").load(f"{path}/data").select("content")
    schema = "part long, place long, id long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return files.mapInArrow(partial(_read, ranks=spark.sparkContext.broadcast(ranks), with_ids=with_ids), schema)


def with_starts(read: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before: a running sum inside
    each part, on top of the totals of the parts before (one row per part)."""
    parts = read.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (read.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(parts, "part").withColumn("start", F.col("base") + F.col("before")).drop("base", "before"))


def query(spark, sf_dir):
    """op6: every document written to token files and read back from them."""
    import public_tokenizers
    path = write_token_files(documents(spark, sf_dir), scratch_dir(spark, "token-files"), public_tokenizers.path(TOKENIZER))
    read = stored(read_token_files(spark, path), "token-read")
    return with_starts(read).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")
