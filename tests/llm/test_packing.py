"""Packing: ids by the tokenizers library, places without gaps, few sequences."""

import random
import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from fixtures import EDGES, documents, sample
from flowsight.llm.packing import WordIds, fit_counts, pack, pack_documents, patterns, plan, slots
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library(library):
    pick = random.Random(2)
    alphabet = "aeththnrei .,'\n\t 0189éßЖ語😀\x1c\x85́ İΣ"
    texts = ["".join(pick.choice(alphabet) for _ in range(60)) for _ in range(3000)]
    texts += [f"Ab{chr(c)}1 {chr(c)}{chr(c)}b 'S{chr(c)}" for c in range(1, 0xD800, 3)]
    texts += [f"{chr(c)}a'Ll{chr(c)}{chr(c)}9 {chr(c)}" for c in range(33, 0x180)]
    texts += ["".join(pick.choice("aB'sStrRevEmMlLdD09.,!-ßÉ ÿ÷×²ª") for _ in range(40)) for _ in range(3000)]
    texts += ["<|endoftext|>x <|startoftext|>", "", " ", "a'll b'S"]
    want = [array("I", e.ids).tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert list(WordIds(PATH, cache_words=100).encode(texts)) == want


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    pick, capacity = random.Random(seed), 128
    shapes = [lambda: pick.randint(1, 128), lambda: 90, lambda: pick.choice([1, 2, 127]), lambda: pick.randint(1, 20)]
    counts = Counter(pick.choice(shapes)() for _ in range(pick.choice([1, 7, 300, 6000])))
    made = plan(counts, capacity)
    used = Counter()
    for parts, times in made:
        assert 0 < sum(parts) <= capacity and times > 0
        for length in parts:
            used[length] += times
    assert used == counts
    sequences = sum(times for _, times in made)
    large = sum(n for length, n in counts.items() if 2 * length > capacity)
    bound = max(-(-sum(k * n for k, n in counts.items()) // capacity), large)
    assert sequences <= 1.05 * bound + 1
    table = slots(made)
    assert all(table["offset"] + table["length"] <= capacity)


def test_fit_reaches_a_histogram_made_of_patterns():
    import numpy as np

    columns = patterns(np.array([10, 20, 30, 40, 50]), 60)
    assert all(columns.sum(axis=1) == 60) and [0, 10, 50] in columns.tolist()
    histogram = np.zeros(61)
    histogram[[10, 20, 30, 50]] = [7, 9, 4, 7]
    x = fit_counts(histogram, columns)
    fitted = np.zeros(61)
    for parts, times in zip(columns, x):
        for p in parts[parts > 0]:
            fitted[p] += times
    assert x.min() >= 0 and np.abs(fitted - histogram).max() < 0.2


def test_documents(spark, library):
    rows = EDGES + [(r.doc_id + 100, r.text) for r in sample(spark, 200).collect()]
    got = pack_documents(documents(spark, rows, True), PATH).collect()
    want = []
    for i, text in rows:
        ids = ids_of(library, text)
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((i, piece, at, len(part), zlib.crc32(array("I", part).tobytes())))
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, want))
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= 1.02 * sum(r.length for r in got) / 2048 + 1


def test_one_length_and_no_rows(spark):
    pieces = spark.range(1000).selectExpr(
        "id AS doc_id", "0 AS piece", "0L AS start", "700L AS length", "7L AS ids_crc32"
    )
    got = pack(pieces, 2048).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 1000
    assert len({r.sequence_id for r in got}) == 500
    assert pack_documents(documents(spark, []), PATH).count() == 0
