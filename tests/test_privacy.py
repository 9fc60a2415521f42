"""Sealed tokens and findings against plain Python."""

import random
import re

from pyspark.sql import functions as F

from flowsight.functions import privacy

KEY = b"a key of any length, also a longer one than a block of the digest has: 64 bytes"


def test_seal(spark):
    rows = [("310150123456789", "a"), ("310150123456789", "b"), ("", "a"), ("é語😀", "a"), (None, "a"), ("x", None)]
    df = spark.createDataFrame(rows, "v string, c string")
    token = privacy.seal(F.col("v"), KEY, F.col("c"))
    got = df.select("*", token.alias("t"), privacy.unseal(token, KEY, F.col("c")).alias("back")).collect()
    assert [r["back"] for r in got] == ["310150123456789", "310150123456789", "", "é語😀", None, None]
    assert got[0]["t"] != got[1]["t"] and got[4]["t"] is None and got[5]["t"] is None
    assert "310150123456789" not in got[0]["t"]
    again = df.select(token.alias("t")).collect()
    assert [r["t"] for r in again] == [r["t"] for r in got]
    bound = df.select(privacy.seal(F.lit("bc"), KEY, F.lit("a")).alias("x"), privacy.seal(F.lit("c"), KEY, F.lit("ab")).alias("y"))
    assert bound.first()["x"] != bound.first()["y"]


def test_forged_tokens_are_refused(spark):
    token = spark.range(1).select(privacy.seal(F.lit("310150123456789"), KEY, "id").alias("t")).first()["t"]
    head, body = token.split(":")
    forged = [f"{head}:{body[:i]}{'A' if body[i] != 'A' else 'B'}{body[i + 1:]}" for i in range(0, len(body) - 2)]
    forged += ["", "no token", f"{head}:", f"{head}:****", f"{head}:{body[:20]}", body]
    df = spark.createDataFrame([(t,) for t in [token, *forged]], "t string")
    got = df.select(privacy.unseal(F.col("t"), KEY, "id").alias("v")).collect()
    assert [r["v"] for r in got] == ["310150123456789"] + [None] * len(forged)
    assert df.select(privacy.unseal(F.col("t"), KEY, "other").alias("v")).where("v IS NOT NULL").count() == 0
    assert df.select(privacy.unseal(F.col("t"), KEY[1:], "id").alias("v")).where("v IS NOT NULL").count() == 0


def plain(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
        "imsi": r"(?<![0-9A-Za-z_])[0-9]{14,15}(?![0-9A-Za-z_])",
        "ipv4": r"(?<![0-9A-Za-z_])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9A-Za-z_])",
    }
    all_ = [(m.start() - m.end(), m.start(), k, m.end(), m[0]) for k, p in patterns.items() for m in re.finditer(p, text or "")]
    out = []
    for x in all_:
        if not any(y[1] < x[3] and x[1] < y[3] and y[:3] < x[:3] for y in all_):
            check = None
            if re.fullmatch("[0-9]{15}", x[4]):
                digits = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(x[4]))]
                check = sum(d - 9 if d > 9 else d for d in digits) % 10 == 0
            out.append((x[1], x[3], x[2], x[4], check))
    return sorted(out, key=lambda r: r[:3])


def test_findings(spark):
    pick = random.Random(3)
    parts = ["490154203237518", "490154203237519", "12345678901234", "1.2.3.4", "a.b@c.de", "😀", " ", "x", ".", "123456789012345@x.org", "10.0.0.1@h.com", "é"]
    texts = ["".join(pick.choice(parts) + pick.choice(["", " ", ","]) for _ in range(pick.randint(0, 25))) for _ in range(300)]
    texts += [None, "", "490154203237518", "490154203237518 1.2.3.4", "1.2.3.4.5.6.7.8 a@b.cc@d.ee", "1.2.3.4 " * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    got = {i: [] for i in range(len(texts))}
    for r in privacy.find_sensitive(df, "text").collect():
        got[r["n"]].append((r["start"], r["end"], r["kind"], r["value"], r["check_digit"]))
    for i, text in enumerate(texts):
        assert got[i] == plain(text), text
