"""Exact token counts with a whole-token shortcut.

Before the job the driver proves, by encoding every vocabulary string alone,
which of them come out as one token (:func:`whole_tokens`); the table has at
most as many entries as the vocabulary and is broadcast.  A pre-token found
there counts one without any merging; only the rest is merged, each distinct
one once while a worker remembers it (``REMEMBERED`` at most, then the memory
starts anew, which changes no result).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import documents
from tripmart.llm.pieces import Pieces

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
#: Merged pre-tokens that a worker remembers.
REMEMBERED = 400_000


def whole_tokens(path: str) -> list[str]:
    """Pre-tokens that the tokenizer encodes alone as exactly one token.

    Candidates are the vocabulary's strings, read back from byte letters and
    without the end-of-word mark; each is kept only if it is one pre-token,
    unchanged by the normalizer, and its encoding has one id.
    """
    pieces = Pieces(path)
    suffix = getattr(pieces.tok.model, "end_of_word_suffix", None) or ""
    byte = {c: b for b, c in pieces.letters.items()}
    found = []
    for name in pieces.tok.get_vocab(with_added_tokens=False):
        body = name[:len(name) - len(suffix)] if suffix and name.endswith(suffix) else name
        if name in pieces.special or (suffix and body == name) or not all(c in byte for c in body):
            continue
        try:
            found.append(bytes(byte[c] for c in body).decode("utf-8"))
        except UnicodeDecodeError:
            continue
    encoded = pieces.tok.encode_batch(found, add_special_tokens=False)
    return [text for text, e in zip(found, encoded, strict=True)
            if len(e.ids) == 1 and pieces.normalize(text) == text and pieces.find(text) == [text]]


class Lengths(dict):
    """Tokens of each pre-token: whole tokens from the start, the rest when first met."""

    def __init__(self, pieces: Pieces, whole: list[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.pieces, self.whole, self.most = pieces, whole, len(whole) + REMEMBERED

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.most:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        n = self[piece] = len(self.pieces.merged(piece))
        return n

    def of_text(self, text: str) -> int:
        n = 0
        for found, special in self.pieces.parts(text):
            n += sum(map(self.__getitem__, found)) + (special is not None)
        return n


_KEPT: dict[str, Lengths] = {}


def _count(batches: Iterator[pa.RecordBatch], path: str, whole) -> Iterator[pa.RecordBatch]:
    if path not in _KEPT:
        _KEPT[path] = Lengths(Pieces(path), whole.value)
    lengths = _KEPT[path]
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "")
        n = [lengths.of_text(t.as_py()) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens)`` per row for the tokenizer file at ``path``.

    No begin, end or added tokens; a special token's string inside a text is
    one token, as the library has it by default.  A null or empty text has
    zero bytes and tokens.  Repeated rows and null ids each give their row; an
    empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(partial(_count, path=path, whole=shared), f"id {kind}, n_bytes long, n_tokens long")


def query(spark, sf_dir):
    """op5: token counts of every document."""
    import public_tokenizers
    return count_tokens(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER)).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
