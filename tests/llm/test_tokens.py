import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripmart.llm import token_counts as C
from tripmart.llm import token_files as T
from tripmart.llm.pieces import Pieces

from conftest import SF_SMALL

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def odd_texts():
    r = random.Random(4)
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(r.sample(chars, 300)) for _ in range(60)]
    texts += ["".join(r.choice("aZ 1'.\n\t ̀É<|endoftext|>") for _ in range(200)) for _ in range(60)]
    texts += ["".join(map(chr, range(0x250))), "I'm you'LL 's'S don't ''t", "x<|endoftext|>y <|startoftext|><|endoftext|", "<|endoftext|>" * 3,
              "  lead\r\n\r\n  trail  \n", "ÀÉ İİ ẞ Σς", "a" * 3000, "\x00\x01 \x7f", " ", "", "İstanbul ﬁ ½ Ⅷ ٣ 漢字かな"]
    return texts


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_give_the_librarys_ids(path):
    tok, pieces = Tokenizer.from_file(path), Pieces(path)
    for text in odd_texts():
        ids = []
        for found, special in pieces.parts(text):
            for p in found:
                ids += pieces.merged(p)
            if special is not None:
                ids.append(pieces.special[special])
        assert ids == tok.encode(text, add_special_tokens=False).ids, repr(text[:80])


def test_every_code_point_splits_as_in_the_library():
    for path in (WORD, BYTE):
        tok, lengths = Tokenizer.from_file(path), C.Lengths(Pieces(path), [])
        texts = [" ".join(f"a{chr(c)}1{chr(c)}" for c in range(a, a + 512) if not 0xD800 <= c < 0xE000) for a in range(0, 0x20000, 512)]
        for text, e in zip(texts, tok.encode_batch(texts, add_special_tokens=False)):
            assert lengths.of_text(text) == len(e.ids), repr(text[:40])


def test_whole_tokens_are_one_token_alone():
    whole = C.whole_tokens(WORD)
    tok = Tokenizer.from_file(WORD)
    assert len(whole) > 30_000 and len(set(whole)) == len(whole)
    assert all(len(e.ids) == 1 for e in tok.encode_batch(whole[::37], add_special_tokens=False))


def test_counts_equal_library(spark, monkeypatch):
    monkeypatch.setattr(C, "REMEMBERED", 50)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(odd_texts())] + [(None, "no id"), (20_000, None), (20_000, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_tokens int")
    tok = Tokenizer.from_file(WORD)
    want = sorted((i is None, i or 0, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    got = sorted((r.id is None, r.id or 0, r.n_bytes, r.n_tokens) for r in C.count_tokens(df, WORD).collect())
    assert got == want
    assert C.count_tokens(df.limit(0), WORD).count() == 0
    few = C.Lengths(Pieces(WORD), ["the"])
    assert [few.of_text(t or "") for _, t in rows[:40]] == [n for t in rows[:40] for n in [len(tok.encode(t[1] or "", add_special_tokens=False).ids)]]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=50))
def test_pack_round_trip(values):
    v = np.array(values, np.uint32)
    control, data = T.pack(v)
    assert len(control) == -(-len(v) // 4)
    assert T.unpack(control, data, len(v)).tolist() == values


def test_blocks_round_trip():
    body = T.block(3, 1, [5, None, -7], np.array([2, 0, 3]), np.array([1, 70000, 3, 10, 2**31]))
    (part, number, table, values), = T.blocks(body + b"\n")
    assert (part, number, values.tolist()) == (3, 1, [1, 70000, 3, 10, 2**31])
    assert table["f0"].tolist() == [5, 0, -7] and table["f1"].tolist() == [1, 0, 1] and table["f2"].tolist() == [2, 0, 3]
    with pytest.raises(ValueError):
        list(T.blocks(b"x" * 64))


def expected(rows):
    tok, start, out = Tokenizer.from_file(BYTE), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_hold_all_documents_in_order(spark, tmp_dir, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(odd_texts())] + [(None, "no id"), (20_000, None), (-5, "word " * 30000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, ids int").repartition(5)
    path = T.write_token_files(df, f"{tmp_dir}/files", BYTE)
    back = T.with_starts(T.read_token_files(spark, path)).select("id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted((tuple(r) for r in back), key=lambda r: r[1]) == expected(rows)
    one = T.read_token_files(spark, path, with_ids=True).where("id = 10010").first()
    assert one["ids"] == Tokenizer.from_file(BYTE).encode(dict(rows)[10010], add_special_tokens=False).ids + [2]
    assert T.read_token_files(spark, T.write_token_files(df.limit(0), f"{tmp_dir}/none", BYTE)).count() == 0


def test_small_blocks_and_memory_change_nothing(spark, tmp_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    encoder = T.Encoder(BYTE)
    ids, n = encoder.encode([t for _, t in rows], 2)
    encoder.begin()
    again = [encoder.encode([t], 2)[0] for _, t in rows]
    assert np.concatenate(again).tolist() == ids.tolist() and n.tolist() == [len(x) for x in again]
    assert encoder.encode([], 2)[0].tolist() == []


def test_query_equals_library(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in T.query(spark, SF_SMALL).collect()), key=lambda r: r[1]) == expected(rows)


def test_quick_split_equals_the_pattern():
    import random

    import regex

    from tripmart.llm import pieces
    whole = regex.compile(pieces.BYTE_LEVEL).findall
    letters = [c for c in map(chr, range(0x250)) if not pieces._OTHER(c)]
    rng = random.Random(2)
    texts = ["".join(letters), *letters, *(a + b for a in letters for b in " \n'9,sé" if a in " \n\t\r'09._aß")]
    texts += ["".join(rng.choice([rng.choice(letters), *" \n''19,.st"]) for _ in range(rng.randrange(40))) for _ in range(4000)]
    for t in texts:
        assert pieces._QUICK(t) == whole(t), repr(t)
    assert all(pieces._OTHER(c) for c in "\x0b\x0c\x1c\x85\xa0×÷ªµ²½日̀")
