import random
import zlib

import numpy as np
import pyarrow.fs as pafs
import pytest
from tokenizers import Tokenizer

from threadloom.llm import token_pack as tp
from threadloom.llm.common import new_folder
from threadloom.llm.queries import tokenizer_path

ODD = ["", "  ", "A", "<|endoftext|> x<|ENDOFTEXT|>y", "don't won'T it's. I'LL", "İstanbul Σας ΟΔΟΣ.",
       "H̱abc T̈.", "á, é.", "x y z\x1cq\x85r", "日本語。漢字",
       "ab12.5,3%%% ##$$", "a.b,c!!! ?!x", "\x00\x07 tab\tnew\r\nline\x0b\x0c", "😀😀 x😀.",
       "≮ a≮ ,", "אְב."]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("bits", [1, 5, 13, 16, 17, 31])
def test_packing_round_trip_and_random_access(tmp_path, bits):
    rng = np.random.default_rng(bits)
    docs = [rng.integers(0, 1 << bits, n).astype(np.uint32) for n in (0, 1, 7, 100, 33, 0, 64)]
    disk = pafs.LocalFileSystem()
    path = str(tmp_path / "ids.bin")
    writer = tp.PackedWriter(disk.open_output_stream(path), bits, block_ids=32)
    for ids in docs:
        writer.add(ids)
    writer.close()
    reader = tp.PackedReader(disk.open_input_file(path))
    assert (reader.total, reader.documents) == (205, len(docs))
    whole = np.concatenate(docs)
    for start, ids in zip(reader.starts, docs):
        assert reader.read(start, len(ids)).tolist() == ids.tolist()
    for first, n in ((0, 205), (31, 2), (64, 32), (204, 1)):
        assert reader.read(first, n).tolist() == whole[first:first + n].tolist()


def test_encoder_equals_encoding_whole_texts(plain, monkeypatch):
    monkeypatch.setattr(tp, "REMEMBERED", 50)
    rng = random.Random(1)
    letters = "aA.,<|é́'ßs \tIİ12%日̸"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30)))
                   for _ in range(1500)]
    encoder = tp.Encoder(tokenizer_path())
    for at in range(0, len(texts), 100):
        some = texts[at:at + 100]
        assert [x.tolist() for x in encoder.encode(some)] == [plain(t) for t in some]


def check(docs, rows, plain):
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted(tp.op8(docs, tokenizer_path()).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [r[0] for r in want]
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens

    def digest(ids):
        return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())

    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (str(r[0]), *digest(plain(r[1]))) for r in rows)


def test_documents_come_back_in_order(test_documents, plain):
    check(test_documents, [(r.doc_id, r.text) for r in test_documents.collect()], plain)


def test_odd_rows(documents, odd_rows, plain):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(ODD)]
    check(documents(*rows), rows, plain)


def test_several_files_of_a_range(test_documents, spark, plain, monkeypatch):
    folder = new_folder(spark, "tokens")
    manifest = tp.write_tokens(test_documents, folder, tokenizer_path(), files=3)
    assert manifest.select("path").distinct().count() == 3
    assert tp.read_tokens(manifest, folder).count() == test_documents.count()


def test_empty_table(documents):
    assert tp.op8(documents().filter("false"), tokenizer_path()).collect() == []
