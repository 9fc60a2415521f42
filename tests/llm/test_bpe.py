"""BPE against the tokenizers library, code point by code point and over whole texts."""

import hashlib
import random

import public_tokenizers
import pytest
from fixtures import EDGES, documents, sample
from flowsight.llm.bpe import ByteBpe, decode_documents, encode_documents, round_trip_report
from flowsight.llm.common import text_blocks
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "aeththnreing .,'\n\t 0189éßЖ語😀  \x1c\x85"


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_code_point(bpe, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF][::7]
    texts = [f"a{c}1 {c}{c}b" for c in points]
    assert list(bpe.encode(texts)) == ids(library, texts)


def test_odd_texts(bpe, library):
    pick = random.Random(3)
    texts = ["", "a" * 500, "  x  \n\n y", "<|endoftext|>a<|endoftext|> b <|endoftext", "'s 't''ll"]
    texts += ["".join(pick.choice(ALPHABET) for _ in range(pick.randint(0, 90))) for _ in range(3000)]
    got = list(bpe.encode(texts))
    assert got == ids(library, texts)
    assert [bpe.decode(i) for i in got] == [
        library.decode(i, skip_special_tokens=False) for i in got
    ]
    assert 0 < bpe.failed < bpe.proposed


def test_compatible_pairs_are_those_that_stay(bpe):
    import numpy as np

    pick = np.random.default_rng(5)
    a, b = pick.integers(0, 50_000, 4000), pick.integers(0, 3000, 4000)
    want = [bpe.merged(bpe.bytes_of[x] + bpe.bytes_of[y]) == [x, y] for x, y in zip(a, b)]
    assert bpe.compatible(a, b).tolist() == want


def test_small_cache_and_blocks(bpe, library):
    text = " ".join(pick for pick in random.Random(1).choices(["the", "ernd", "größe", "x\n"], k=9000))
    assert "".join(text_blocks(text, 1000)) == text
    small = ByteBpe(PATH, cache_words=3)
    assert list(small.encode([text, "", text])) == ids(library, [text, "", text])
    parts = [small.encode_group([p])[0] for p in text_blocks(text, 1000)]
    assert sum(parts, []) == ids(library, [text])[0]


def test_report_and_columns(spark, library):
    rows = EDGES + [(r.doc_id + 100, r.text) for r in sample(spark).collect()]
    docs = documents(spark, rows, True)
    want = []
    for (i, text), tokens in zip(rows, ids(library, [t or "" for _, t in rows])):
        joined = ",".join(map(str, tokens)).encode()
        back = library.decode(tokens, skip_special_tokens=False).encode()
        want.append((i, len(tokens), hashlib.sha256(joined).hexdigest(), hashlib.sha256(back).hexdigest()))
    assert sorted(map(str, map(tuple, round_trip_report(docs, PATH).collect()))) == sorted(map(str, want))
    back = decode_documents(encode_documents(docs, PATH), PATH)
    assert sorted(map(str, map(tuple, back.collect()))) == sorted(str((i, t or "")) for i, t in rows)
    assert round_trip_report(documents(spark, []), PATH).count() == 0
