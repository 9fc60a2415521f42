"""Collocations against plain counting, and the parsing."""

import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from fixtures import EDGES, documents, sample
from flowsight.llm import collocations as c
from flowsight.llm.collocations import chunk_ends, chunks_of, collocations, frequent_filter, parse, phrase_counts
from hypothesis import given, settings
from hypothesis import strategies as st


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\n-\r]", low)]


def plain_counts(rows):
    f = Counter()
    for lang, text in rows:
        for words in pieces(text):
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f["und" if lang is None else lang, tuple(words[i : i + k])] += 1
    return f


def plain(rows, least=100, top=2000):
    f = plain_counts(rows)
    n = Counter()
    for (lang, words), count in f.items():
        if len(words) == 1:
            n[lang] += count
    out = []
    for lang in n:
        found = {w: a for (of, w), a in f.items() if of == lang and a >= least}
        kept = []
        for w, a in found.items():
            if len(w) == 1:
                continue
            cuts = []
            for k in range(1, len(w)):
                l, r = found[w[:k]], found[w[k:]]
                cuts.append((int(Fraction(1000 * a * n[lang], l * r)), k, l, r))
            longer = [
                b for v, b in found.items() if len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))
            ]
            if not any(100 * b >= 100 * a for b in longer):
                score, _, l, r = min(cuts)
                kept.append((-score, -a, " ".join(w).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def chunks_in(text, divisor=48, longest=8192):
    words, tokens = c.Words(), c.tokens_of(text)
    return list(chunks_of(tokens, words.numbers(tokens), words, 4, divisor, longest))


def got(df):
    return sorted(tuple(r) for r in df.collect())


def with_langs(spark, rows):
    schema = "doc_id long, text string, lang string, size string, phrase string, f string, n string, chunk string"
    return spark.createDataFrame([(i, t, lang, "1", "2", "3", "4", "5") for i, (lang, t) in enumerate(rows)], schema)


def planted():
    random = np.random.default_rng(5)
    words = ["the", "of", "New", "york", "city", "aé", "語", "x y", "B", "b", "c\x00d"]
    rows = []
    for i in range(260):
        text = " ".join(random.choice(words, 60))
        text += f". In new\tyork  City, by and large; BY AND LARGE {i} one two three four five six!"
        rows.append((["en", "fr", None, "und"][i % 4], text if i % 9 else text + "\n" + text))
    return rows + [("en", "de facto " * 400), ("de", "ja " * 300), ("de", "a b c d e " * 150)]


def test_planted_phrases(spark):
    rows = planted() + [("en", None), (None, None), ("xx", ""), ("en", " ,.\n\t "), ("yy", "rare words")]
    want = plain(rows)
    assert len(want) > 30 and {r[0] for r in want} == {"en", "fr", "und", "de"}
    assert got(collocations(with_langs(spark, rows))) == want


def test_edges_repeats_no_rows(spark):
    docs = documents(spark, EDGES, extra=True)
    assert got(collocations(docs)) == plain([(None, t) for _, t in EDGES])
    assert got(collocations(documents(spark, []))) == []
    assert got(collocations(documents(spark, [(1, None), (2, "  ")]))) == []


def test_sample_by_a_lower_count(spark):
    docs = sample(spark, 120)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    want = plain(rows, 20, 40)
    assert len(want) >= 40
    assert got(collocations(docs, min_count=20, top=40)) == want


def test_bounded_tables_give_the_same(spark, monkeypatch):
    rows = planted()
    docs = with_langs(spark, rows)
    found = got(phrase_counts(parse(docs), (2,)))
    f = plain_counts(rows)
    assert {(lang, p): n for lang, p, n in found} == {
        (lang, " ".join(w)): n for (lang, w), n in f.items() if len(w) == 2
    }


def test_counter_gives_out_when_full(monkeypatch):
    monkeypatch.setattr(c, "MAX_PHRASES", 50)
    monkeypatch.setattr(c, "MAX_WORDS", 40)
    seen, want = Counter(), Counter()
    counter = c.Counter("en", (2, 3))
    random = np.random.default_rng(2)
    for _ in range(30):
        words = [f"w{i}" for i in random.integers(0, 60, 80)]
        for k in (2, 3):
            want.update(" ".join(words[i : i + k]) for i in range(81 - k))
        counter.add([" ".join(words) + " \r"], np.array([1]), 4, None)
        if counter.full():
            for part in counter.out():
                for p, n in zip(part["phrase"], part["f"].tolist()):
                    seen[p] += n
            counter = c.Counter("en", (2, 3))
    for part in counter.out():
        for p, n in zip(part["phrase"], part["f"].tolist()):
            seen[p] += n
    assert seen == want


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 7, 200, 5000])
@pytest.mark.parametrize("longest", [1, 3, 50, 8192])
def test_chunks_overlap_by_a_window_and_cover_all(n, longest):
    hashes = np.random.default_rng(n).integers(0, 50, n).astype(np.uint64)
    ends = chunk_ends(hashes, 4, 8, longest)
    if not n:
        assert ends == []
        return
    assert ends[0][0] == 0 and ends[-1][1] == n
    for (a, b), (x, _) in zip(ends, ends[1:]):
        assert a < x == b - 4 and b < n
        assert b - a <= longest + 4
    assert ends[-1][1] - ends[-1][0] <= longest + 4


@given(st.text(alphabet="ab .\n\tCé", max_size=300), st.integers(1, 6), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_every_phrase_is_counted_once(text, divisor, longest):
    chunks = chunks_in(text, divisor, longest)
    counter = c.Counter("x", (1, 2, 3, 4, 5))
    if chunks:
        counter.add(chunks, np.ones(len(chunks), np.int64), 4, None)
    seen = {p: n for part in counter.out() for p, n in zip(part["phrase"], part["f"].tolist())}
    assert seen == {" ".join(w): n for (_, w), n in plain_counts([("x", text)]).items()}


def test_equal_content_is_cut_alike():
    random = np.random.default_rng(7)
    shared = " ".join(f"w{i}" for i in random.integers(0, 900, 2000))
    a = chunks_in("one two three " + shared)
    b = chunks_in("something else before it " * 9 + shared)
    assert len(set(a) & set(b)) >= len(a) - 2 > 20


def test_filter_knows_all_it_was_made_of(spark):
    rows = [("en", f"w{i} x{i % 7}") for i in range(3000)] + [("fr", "w1 x1")]
    made = frequent_filter(spark.createDataFrame(rows, "lang string, phrase string"))

    def hashes(lang, phrases):
        seed = c.lang_seed(lang)
        words = list(zip(*[[c.word_hash(w, seed) for w in p.split(" ")] for p in phrases]))
        return c.mixed([np.array(w, np.uint64) for w in words])

    assert made.holds(hashes("en", [p for lang, p in rows if lang == "en"])).all()
    assert made.holds(hashes("en", [f"y{i} z" for i in range(3000)])).mean() < 0.05
    assert made.holds(hashes("fr", ["w1 x1"])).all() and not made.holds(hashes("fr", ["w2 x2"])).all()
