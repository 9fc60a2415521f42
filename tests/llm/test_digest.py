"""Quartile digests against a plain loop over all documents in order."""

import hashlib

import numpy as np
from fixtures import EDGES, documents, sample
from flowsight.llm import digest
from flowsight.llm.digest import digest_report, edited, fingerprint, fingerprints, likeness


def plain(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    out = []
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        changed = edited(text, following)
        fp, changed_fp = fingerprint(text), fingerprint(changed)
        sha = hashlib.sha256(changed.encode()).hexdigest()
        out.append((i, len(text), sha, fp, changed_fp, likeness(fp, changed_fp), likeness(fp, fingerprint(following))))
    return out


def test_report_equals_the_plain_loop(spark):
    rows = EDGES + [(r.doc_id * 3 + 100, r.text) for r in sample(spark, 150).collect()]
    got = digest_report(documents(spark, rows, True)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain(rows)))


def test_one_row_equal_ids_and_no_rows(spark):
    for rows in ([(7, "one text alone")], [(5, f"text {i % 4} of five") for i in range(40)], [(None, "x"), (None, None)]):
        got = digest_report(documents(spark, rows)).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain(rows)))
    assert digest_report(documents(spark, [])).count() == 0


def test_counts_do_not_depend_on_steps(monkeypatch):
    raw = np.random.default_rng(0).integers(97, 110, (1 << 20) + 50).astype(np.uint8).tobytes()
    want = np.zeros(256, np.int64)
    for a in range(0, len(raw), 4099):
        part = digest.bucket_counts(raw[a : a + 4099])
        want += part
    whole = digest.bucket_counts(raw)
    assert whole.sum() == 3 * len(raw) - 2 - 3 - 4
    assert abs(whole - want).sum() < 256 * 3 * 4


def test_edit_and_likeness():
    assert edited("abcdefgh", "XYZ") == "abcdefXY" and edited("abcdefgh", "X") == "abcdefX"
    assert edited("abc", "XYZ") == "abc" and edited("", "X") == ""
    a = fingerprint("the quick brown fox jumps over the lazy dog " * 5)
    b = fingerprint("the quick brown fox jumps over the lazy cat " * 5)
    c = fingerprint("completely other words stand in this sentence, 0123456789 " * 5)
    assert likeness(a, a) == 1 and 0 <= likeness(a, c) < likeness(a, b) < 1
    assert likeness(a, b) == likeness(b, a) and fingerprint("") == "0" * 132


def test_fingerprints_of_a_table(spark):
    got = {r.doc_id: r.fingerprint for r in fingerprints(documents(spark, EDGES)).collect()}
    assert got[7] == got[8] and got[1] == got[2] == fingerprint("")
