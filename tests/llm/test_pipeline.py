"""The pipeline against plain Python, stage by stage, on a small corpus with planted cases."""

import random
import re
from collections import defaultdict

import corpus_pipeline
import public_tokenizers
from fixtures import DOCS_SCHEMA
from test_line_dedup import plain as plain_lines
from test_simhash import plain_fingerprint, reach
from tokenizers import Tokenizer

VOCABULARY = {
    "en": "the and of thing with water under stone house light river garden winter summer bread".split(),
    "fr": "le une été dans où maison rivière jardin hiver lumière pierre pain avec sous eau".split(),
}


def corpus():
    pick = random.Random(9)
    rows, doc = [], 0

    def add(text, lang):
        nonlocal doc
        rows.append((doc, text, lang, f"src{doc % 3}", None if text is None else len(text)))
        doc += 1

    def prose(lang, n):
        return " ".join(pick.choice(VOCABULARY[lang]) + str(pick.choice("abcdef")) * pick.randint(0, 3) for _ in range(n))

    passage = prose("en", 60)
    original = prose("fr", 120)
    for k in range(90):
        lang = ("en", "fr")[k % 2]
        add("\n".join(prose(lang, pick.randint(8, 40)) for _ in range(4)), lang)
    for _ in range(3):
        add(prose("en", 30) + " " + passage + " " + prose("en", 25), "en")
    for _ in range(4):
        add(original, "fr")
    for _ in range(5):
        add(prose("en", 70) + "\nA line that many of these documents share\n" + prose("en", 40), "en")
    for text in ("12 34 !!", "", None, "***"):
        add(text, "en")
    return rows


def cut(rows, n=50):
    """Words of passages of n words that a smaller id holds, verbatim, are cut."""
    first, out = {}, {}
    for i, text in sorted(rows.items()):
        words = text.lower().split()
        places = [m.start() for m in re.finditer(r"[^ \t\n\x0b\x0c\r]+", text)] + [len(text)]
        gone = set()
        for k in range(len(words) - n + 1):
            if first.setdefault(tuple(words[k : k + n]), i) != i:
                gone.update(range(k, k + n))
        spans = [text[places[k] : places[k + 1]] for k in range(len(words)) if k not in gone]
        out[i] = text[: places[0]] + "".join(spans) if words else text
    return out


def test_stages(spark, folder):
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS_SCHEMA)
    docs.write.parquet(f"{folder}/documents.parquet")
    texts = {i: t for i, t, *_ in rows}
    out = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, folder)
        out.write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        if name != "packing":
            assert out.columns == docs.columns
            kept[name] = {r.doc_id: r.text for r in out.collect()}
            assert all(r.n_chars == len(r.text or "") for r in out.collect())
    want = {i: t for i, t in texts.items() if t and re.search("[a-z]", t)}
    assert kept["language"] == want
    want = {i: "\n".join(lines) for i, lines in plain_lines(list(want.items()))}
    assert kept["lines"] == want and sum(t != texts[i] for i, t in want.items()) == 7
    stays = set(reach({i: plain_fingerprint(t) for i, t in want.items()}).values())
    want = {i: t for i, t in want.items() if i in stays}
    assert kept["near_copies"] == want
    assert kept["passages"] == cut(want) != want
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes, places = defaultdict(int), defaultdict(list)
    for r in out.collect():
        sizes[r.doc_id] += r.length
        places[r.sequence_id].append((r.offset, r.length))
    assert sizes == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in cut(want).items()}
    for parts in places.values():
        ends = [0] + [a + n for a, n in sorted(parts)]
        assert [a for a, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() > 100
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
