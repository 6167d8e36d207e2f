import io
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from tablespoon.llm import tokens

from .conftest import prose

VOCABULARY = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, tokens.END_ID]


TEXTS = [
    "Hello, World! it's 42nd\tstreet x y",
    "é ́a Straße İstanbul ΟΣ Σ",
    "<|startoftext|> a<|endoftext|>b <|endof text|>",
    "你好 \U0001f600\U0001f468‍\U0001f469 \x1c a\x1fb \x85 z",
    "don't we'll I'M 'S' 's",
    "",
    None,
    " \n ",
]


def test_words_give_the_ids_of_the_text(whole):
    draw = random.Random(1)
    noise = ["".join(chr(draw.choice([draw.randrange(32, 0x250), draw.randrange(0x300, 0x370), draw.randrange(9, 33), draw.randrange(0x2000, 0x2100)])) for _ in range(80)) for _ in range(60)]
    texts = [*TEXTS, *noise, prose(1, 300)]
    for text, packed in zip(texts, tokens.Encoder(VOCABULARY).encode(texts)):
        assert np.frombuffer(packed, "<u4").tolist() == whole(text), text


def test_file_format():
    rows = [(7, struct.pack("<3I", 1, 2, 3)), (None, b""), (9, struct.pack("<I", 5) * 1000)]
    out = io.BytesIO()
    assert tokens.write_file(out, iter(rows)) == (3, 1003)
    raw = out.getvalue()
    # any zstandard reader sees the documents one after another and skips the rest
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read() == b"".join(p for _, p in rows)
    file = tokens.SeekableFile(io.BytesIO(raw))
    assert file.doc_ids == [7, None, 9] and [file.document(i) for i in (2, 0, 1)] == [rows[2][1], rows[0][1], b""]
    table = struct.unpack_from("<II", raw, len(raw) - 8 - 9 - 12 * 4)
    assert table == (tokens.TABLE_MAGIC, 9 + 12 * 4)
    broken = bytearray(raw)
    broken[9 + 2] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        tokens.SeekableFile(io.BytesIO(bytes(broken))).document(0)


def test_round_trip(spark, make, whole, tmp_path):
    draw = random.Random(2)
    rows = [(i * 3, prose(i, draw.randint(0, 200))) for i in range(200)] + [(1000 + i, t) for i, t in enumerate(TEXTS)]
    draw.shuffle(rows)
    files = tokens.write_tokens(make(rows), f"file://{tmp_path}/out", VOCABULARY, file_chars=20_000)
    assert files.where("n_docs > 0").count() > 2 and not list((tmp_path / "out").glob(".draft*"))
    got = {r.doc_id: r for r in tokens.read_tokens(files).collect()}
    start = 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        packed = np.array(whole(text), "<u4").tobytes()
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(packed) // 4, zlib.crc32(packed))
        start += r.n_tokens


def test_odd_rows(spark, messy, empty, tmp_path):
    got = tokens.read_tokens(tokens.write_tokens(messy, f"file://{tmp_path}/a", VOCABULARY)).collect()
    assert len(got) == messy.count() and all(r.n_tokens == 1 for r in got if r.doc_id in (3, 4, 5))
    assert max(r.start for r in got if r.doc_id is not None) < min(r.start for r in got if r.doc_id is None)
    assert tokens.read_tokens(tokens.write_tokens(empty, f"file://{tmp_path}/b", VOCABULARY)).count() == 0
