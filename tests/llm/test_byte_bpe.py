"""Byte-level BPE against the tokenizer's own library, and back to the bytes."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from monthclose.llm import byte_bpe
from monthclose.llm.common import ship_package
from monthclose.llm.registry import QUERIES

PARTS = list("ab'strevlmd  \n\t\r12!.,é— 　中文ñ́🙂½Ⅷ٣_\x00") + ["'s", "'re", "'ll", " '", "''", "  ", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    lines = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.Coder(byte_bpe.Ranks.from_file())


def joined(texts):
    parts = [t.encode() for t in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]).astype(np.int64)


def odd_texts(seed, n):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(PARTS, k=rnd.choice([0, 1, 2, 3, 8, 40, 200]))) for _ in range(n)]


@pytest.mark.parametrize("stretch", [2, 3, 7, 64, 1 << 19])
def test_pre_tokens_do_not_depend_on_stretches(coder, stretch):
    data, offsets = joined(odd_texts(stretch, 300))
    got = byte_bpe.pre_token_starts(data, offsets, coder.classes, stretch)
    assert got.tolist() == byte_bpe.pre_token_starts(data, offsets, coder.classes).tolist()


def test_ids_and_offsets_equal_the_library(coder, library):
    for seed in range(20):
        texts = odd_texts(seed, 200)
        data, offsets = joined(texts)
        ids, at, first = coder.encode(data, offsets)
        for i, want in enumerate(library.encode_ordinary_batch(texts)):
            mine = ids[first[i] : first[i + 1]].tolist()
            assert mine == want, texts[i]
            lengths = [len(library.decode_single_token_bytes(t)) for t in want]
            assert at[first[i] : first[i + 1]].tolist() == [sum(lengths[:j]) for j in range(len(want))]


def test_every_code_point_beside_letters_and_spaces(coder, library):
    points = [chr(c) for c in [*range(0x3000), *range(0xFE00, 0x11000), *range(0x1E000, 0x1F000)] if not 0xD800 <= c < 0xE000]
    texts = [f"a{c} {c}'s{c}\n{c}1" for c in points]
    data, offsets = joined(texts)
    ids, _, first = coder.encode(data, offsets)
    for i, want in enumerate(library.encode_ordinary_batch(texts)):
        assert ids[first[i] : first[i + 1]].tolist() == want, hex(ord(points[i]))


@pytest.mark.parametrize("text", ["a" * 200_000, " " * 100_001, "ab" * 60_000 + "'s", "x'll" * 30_000, "é" * 50_001, "\n " * 40_000])
def test_very_long_texts(coder, library, text):
    data, offsets = joined(["", text, ""])
    ids, at, first = coder.encode(data, offsets)
    assert ids.tolist() == library.encode_ordinary(text) and first.tolist() == [0, 0, len(ids), len(ids)]
    assert coder.decode(ids.astype(np.int64), at)[0].tobytes() == text.encode()


def test_both_ways_of_merging_agree(coder):
    rnd = random.Random(9)
    for _ in range(2000):
        piece = "".join(rnd.choices("abcdefé中 the ing", k=rnd.randint(1, 30))).encode()
        assert coder.merge.short(piece) == coder.merge.long(piece)


def test_composition_is_that_of_the_functions():
    machine = byte_bpe.automaton()
    for f in range(len(machine.apply)):
        for g in range(len(machine.apply)):
            assert (machine.apply[machine.compose[f, g]] == machine.apply[g][machine.apply[f]]).all()


def test_rows_equal_the_library(docs, library):
    found = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    assert found[0].asDict().keys() == {"doc_id", "ids", "offsets", "decoded"}
    texts = docs.select("doc_id", "text").collect()
    got = sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in found), key=repr)
    assert got == sorted(((r.doc_id, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in texts), key=repr)


def test_empty_table(nothing):
    assert byte_bpe.decode(byte_bpe.encode(nothing)).count() == 0


def test_query_digests(docs, library, tmp_path):
    ship_package(docs.sparkSession)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op13_byte_bpe"](docs.sparkSession, str(tmp_path)).collect()]
    want = []
    for row in docs.collect():
        ids = library.encode_ordinary(row.text or "")
        listed, text = ",".join(map(str, ids)), row.text or ""
        want.append((row.doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, text))))
    assert sorted(got, key=repr) == sorted(want, key=repr)
