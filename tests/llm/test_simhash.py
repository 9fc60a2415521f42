"""SimHash near-dedup against all pairs."""

import random

import numpy as np
import xxhash
from fixtures import EDGES, documents, sample
from flowsight.llm.components import connected_components
from flowsight.llm.simhash import classes, fingerprint, keep_one_of_each, simhash_report


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def reach(prints, radius=2):
    """Smallest id reachable, by all pairs and repeated minima."""
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            best = min(label[j] for j in prints if bin(prints[i] ^ prints[j]).count("1") <= radius)
            if best < label[i]:
                label[i], changed = best, True
    return label


def test_fingerprint_is_the_majority_of_shingle_bits():
    for _, text in EDGES:
        assert fingerprint(text or "") & (2**64 - 1) == plain_fingerprint(text)
    long = " ".join(random.Random(1).choice("abcdefg") for _ in range(70_000))
    assert fingerprint(long) & (2**64 - 1) == plain_fingerprint(long)


def test_report_equals_all_pairs(spark):
    rows = sample(spark, 150).collect()
    docs = documents(spark, [(r.doc_id, r.text) for r in rows] + [(i + 1000, t) for i, t in EDGES if i], True)
    want = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    want |= {i + 1000: plain_fingerprint(t) for i, t in EDGES if i}
    got = simhash_report(docs).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == want
    assert {r.doc_id: r.component_id for r in got} == reach(want)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(reach(want).values())


def test_classes_of_chains_and_balls(spark):
    rng = np.random.default_rng(7)
    prints, doc = {}, 0
    for _ in range(12):
        at = int(rng.integers(0, 2**63))
        for _ in range(20):
            prints[doc] = at
            doc += 1
            for _ in range(int(rng.integers(0, 4))):
                at ^= 1 << int(rng.integers(0, 64))
    signed = [(d, f - 2**64 if f >> 63 else f) for d, f in prints.items()]
    for radius in (2, 4):
        got = classes(spark.createDataFrame(signed, "doc_id long, fp long"), radius).collect()
        of = {r.fp & (2**64 - 1): r.component_id for r in got}
        assert {d: of[f] for d, f in prints.items()} == reach(prints, radius)


def test_missing_ids_and_empty_table(spark):
    got = simhash_report(documents(spark, EDGES)).collect()
    assert len(got) == len(EDGES)
    assert [r.component_id for r in got if r.doc_id is None] == [12]
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert simhash_report(documents(spark, [])).count() == 0
    assert keep_one_of_each(documents(spark, [])).count() == 0


def test_components_of_a_long_path(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 102), (102, 101), (5, 5), (None, 3)]
    got = connected_components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()
    assert {r.node: r.component for r in got} == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100}
