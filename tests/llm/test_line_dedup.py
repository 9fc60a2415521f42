"""Line dedup against a plain dictionary, and the bitmaps."""

import hashlib
import re

from fixtures import EDGES, documents, sample
from flowsight.llm.line_dedup import dedup_lines, keep_bitmaps, line_dedup_report


def lines_of(text):
    return (text or "").split("\n")


def key(line):
    cut = line.strip(" \t\n\x0b\x0c\r")
    return re.sub("[A-Z]", lambda m: m[0].lower(), cut)


def plain(rows):
    first = {}
    for i, text in rows:
        for line in lines_of(text):
            if i is not None and len(key(line)) >= 10:
                first[key(line)] = min(i, first.get(key(line), i))
    return [
        (i, [x for x in lines_of(text) if i is None or first.get(key(x), i) == i]) for i, text in rows
    ]


ROWS = [r for r in EDGES] + [
    (20, "A common line here\nshort\n  a COMMON line here \nown line of twenty"),
    (21, "a common line here\nshort\nother line of 21\nother line of 21"),
    (22, "\n\nÀ common line here\nother line of 21\n"),
    (23, "\n".join(f"line number {i % 400}" for i in range(2000))),
    (24, "\n".join(f"line number {i}" for i in range(300, 900))),
    (24, "another text of 24\na common line here"),
]


def test_report_equals_the_plain_rule(spark):
    rows = ROWS + [(r.doc_id + 100, r.text) for r in sample(spark).collect()]
    got = line_dedup_report(documents(spark, rows, True)).collect()
    want = [
        (i, len(lines_of(t)), len(lines_of(t)) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
        for (i, t), (_, kept) in zip(rows, plain(rows))
    ]
    order = lambda r: (r[0] is None, r[0], r[3])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_texts_and_columns(spark):
    docs = documents(spark, ROWS, True)
    got = dedup_lines(docs)
    assert got.columns == docs.columns
    texts = sorted((r.doc_id or 0, r.text or "") for r in got.collect())
    assert texts == sorted((i or 0, "\n".join(kept)) for i, kept in plain(ROWS))
    assert all(r.n_chars == len(r.text) for r in got.collect() if r.text is not None)


def test_bitmaps_hold_a_bit_for_each_line(spark):
    maps = keep_bitmaps(documents(spark, ROWS)).collect()
    assert not {20, 23} & {r.doc_id for r in maps}
    keep = max((r.keep for r in maps if r.doc_id == 24), key=len)
    bits = [keep[i // 64] >> (i % 64) & 1 if i // 64 < len(keep) else 1 for i in range(600)]
    assert bits == [0] * 100 + [1] * 500


def test_empty_table(spark):
    assert line_dedup_report(documents(spark, [])).count() == 0
