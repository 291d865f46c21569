"""Round trips through the files, random access, and the encoder against the tokenizer alone."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from jobtide.llm import token_files as t
from jobtide.llm.byte_text import buffers

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def ids_of(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids


def odd_texts():
    rng = random.Random(1)
    parts = [" ", "  ", "a", "b's", "\n", "\t", " \n", "é.", "...", "　", "\xa0", "<|endoftext|>",
             "Word,", "don't", "12", "\x1f", "漢字", "|", "%%%", "(x)", " ", "😀"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3_000)]
    return ["", "\n", " ", *made, made[5], "word " * 50_000]


def test_encoder(plain):
    encoder = t.Encoder(PATH)
    for _ in range(2):  # the second time from memory
        memory, bounds = buffers(pa.array(odd_texts()))
        ids, ends = encoder.encode(memory[bounds[0] : bounds[-1]], bounds - bounds[0])
        for k, text in enumerate(odd_texts()):
            assert ids[ends[k] : ends[k + 1]].tolist() == ids_of(plain, text), repr(text)[:80]


def test_encoder_starts_afresh(plain, monkeypatch):
    monkeypatch.setattr(t, "REMEMBERED", 20)
    encoder = t.Encoder(PATH)
    for text in odd_texts()[:200]:
        memory, bounds = buffers(pa.array([text]))
        assert encoder.encode(memory, bounds)[0].tolist() == ids_of(plain, text)


def test_round_trip(plain, table, tmp_path):
    texts = [None, "", *odd_texts()[:60], "long word " * 3_000]
    rows = [(100 - i, x, "y") for i, x in enumerate(texts)] + [(None, "no id", "z"), (7, "twice", "z")]
    docs = table(rows, "doc_id long, text string, start string")
    files = t.write_token_files(docs, str(tmp_path / "out"), PATH, sequence=64)
    found = t.read_token_files(files).collect()
    assert len(found) == len(rows)
    expected = sorted((i is not None, i or 0, ids_of(plain, x) + [0]) for i, x, _ in rows)
    start, line = 0, sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in line] == [i if known else None for known, i, _ in expected]
    by_crc = {}
    for known, i, ids in expected:
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        by_crc.setdefault(i if known else None, set()).add((len(ids), crc))
    for r in line:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in by_crc[r.doc_id]
        start += r.n_tokens


def test_random_access(plain, table, tmp_path):
    text = "some words in a row, " * 500
    files = t.write_token_files(table([(1, text)], "doc_id long, text string"), str(tmp_path / "o"), PATH, sequence=32)
    sequences = t.Sequences(files.first().file)
    ids = ids_of(plain, text) + [0]
    assert len(sequences) == -(-len(ids) // 32)
    for i in (0, 3, len(sequences) - 1):
        own, mask = sequences[i]
        part = ids[i * 32 : i * 32 + 32]
        assert own[: len(part)].tolist() == part and mask.true_count == len(part)
        assert not own.flags.owndata and len(own) == len(mask) == 32


def test_empty_table(table, tmp_path):
    docs = table([], "doc_id long, text string")
    files = t.write_token_files(docs, str(tmp_path / "o"), PATH)
    assert files.collect() == [] and t.read_token_files(files).collect() == []


def test_files_of_failed_tasks_are_removed(table, tmp_path):
    folder = tmp_path / "o"
    files = t.write_token_files(table([(i, f"text {i}") for i in range(20)], "doc_id long, text string"), str(folder), PATH)
    before = sorted(p.name for p in folder.iterdir())
    half = "part-000000-" + "0" * 32 + ".arrow"
    for name in (half, f"{half}.docs", "notes.txt"):
        (folder / name).write_bytes(b"half")
    assert t.remove_unlisted(files, str(folder)) == [half, f"{half}.docs"]
    assert sorted(p.name for p in folder.iterdir() if not p.name.startswith(".")) == sorted([*[b for b in before if not b.startswith(".")], "notes.txt"])
    assert t.read_token_files(files).count() == 20
