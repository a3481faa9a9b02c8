"""Token files: an exact round trip, independent frames and checksums."""

import struct
import zlib

import pytest
import zstandard
from tokenizers import Tokenizer

from tidemart.llm import token_files
from tidemart.llm.queries import END_ID, TOKENIZER, token_files_of
from tidemart.session import fresh_path

TEXTS = [
    "Hello, world's \"end\". it's  <|endoftext|> x.<|endoftext|>! a'. b''s Ünïcode é . ... #$% A<b. a|b, <|ENDOFTEXT|>",
    "", None, "a\x1eb c", " x y.", "Don't!!' 'll x'll. I'M we'RE THE3. 3a, 33.. DON'T'S' ", " ", "日本語 テスト。", "word " * 5000,
]


def expected(text):
    return [*Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids, END_ID]


def frame(spark, extra=()):
    data = [(3 * k, t, "x") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame([*data, *extra], "doc_id long, text string, blob string").repartition(3)


def test_described_as_written(spark):
    got = token_files_of(frame(spark)).orderBy("doc_id").collect()
    start = 0
    for row, text in zip(got, TEXTS, strict=True):
        ids = expected(text)
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)


def test_many_files_order_and_requested_documents(spark):
    path = fresh_path(spark, "tokens")
    token_files.write_token_files(frame(spark, [(None, "n", ""), (0, "again", ""), (0, "again", "")]), path, TOKENIZER, END_ID, file_bytes=40)
    every = token_files.with_starts(token_files.read_token_files(spark, path, with_ids=True)).orderBy("start").collect()
    assert [r.doc_id for r in every] == [None, 0, 0, 0, *range(3, 27, 3)]
    assert len({(r.file_part, r.file_number) for r in every}) > 3
    assert [r.ids for r in every if r.doc_id == 21] == [expected(TEXTS[7])]
    some = token_files.read_token_files(spark, path, [6, 21], with_ids=True).collect()
    assert sorted((r.doc_id, r.ids) for r in some) == [(6, [END_ID]), (21, expected(TEXTS[7]))]


def test_files_are_plain_zstandard_with_a_seek_table(spark):
    path = fresh_path(spark, "tokens")
    token_files.write_token_files(frame(spark), path, TOKENIZER, END_ID)
    contents = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    every = b""
    for content in contents:
        assert content.endswith(struct.pack("<I", token_files.SEEK_TABLE_MAGIC))
        reader = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True)
        every += reader.read()
    assert len(every) == 4 * sum(len(expected(t)) for t in TEXTS)
    file = token_files.TokenFile(contents[0])
    spoilt = bytearray(contents[0])
    spoilt[int(file.starts[0]) + int(file.entries[0][0]) - 1] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.TokenFile(bytes(spoilt)).raw(0)


def test_empty_table(spark):
    assert token_files_of(frame(spark).limit(0)).count() == 0
