"""Line dedup: the first document that holds a line keeps it, the others lose it.

Lines become 96-bit hashes, the hashes are range-partitioned and sorted by document and
position, and the sorted runs are streamed for their first document. The answer is a bitmap of
the lines to keep for each document, not text. Built-in functions only.

A line that a third of all documents hold would fill one range. So the ranges are first cut by
(hash, salt of the document): what is not first there is dropped for good, and only the first
document of each salt goes on to the ranges of the hash alone. Nothing is joined back.

Defined results: null and empty text are one empty line; a document without `doc_id` can't be
ordered among the others, so it loses nothing and takes nothing from others; rows that repeat a
`doc_id` are one document (equal rows get equal results, different texts each get a bitmap of
their own); other columns are carried along untouched, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, shuffle_partitions, whole_text, written

MIN_LENGTH = 10
WORD = 64


def line_key(line: Column) -> Column:
    """White space cut at both ends, A-Z lower-cased and nothing else."""
    cut = F.trim(line, F.lit(WHITE))
    ascii_only = F.octet_length(cut) == F.length(cut)
    return F.when(ascii_only, F.lower(cut)).otherwise(
        F.translate(cut, string.ascii_uppercase, string.ascii_lowercase)
    )


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, row, pos, h, g): a hash pair for each line whose key is long enough."""
    text = whole_text(docs)
    exploded = docs.filter(docs["doc_id"].isNotNull()).select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(text).alias("row"),
        F.posexplode(_lines(text)).alias("pos", "line"),
    )
    keyed = exploded.select("doc_id", "row", "pos", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.length("key") >= min_length).select(
        "doc_id", "row", "pos", F.xxhash64("key").alias("h"), F.hash("key").alias("g")
    )


def _first_document(lines: DataFrame, *key: str) -> DataFrame:
    ordered = Window.partitionBy(*key).orderBy("doc_id", "pos")
    return lines.withColumn("first_doc", F.first("doc_id").over(ordered))


def dropped_lines(lines: DataFrame) -> DataFrame:
    """(doc_id, row, pos) of lines that a document with a smaller id holds too."""
    n = shuffle_partitions(lines.sparkSession)
    salted = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int"))
    dealt = salted.repartitionByRange(n, "h", "g", "salt")
    in_salt = written(_first_document(dealt, "h", "g", "salt"), "line-firsts")
    later = F.col("doc_id") > F.col("first_doc")
    rest = in_salt.filter(~later).drop("first_doc", "salt").repartitionByRange(n, "h", "g")
    across = _first_document(rest, "h", "g")
    columns = ["doc_id", "row", "pos"]
    return in_salt.filter(later).select(columns).union(across.filter(later).select(columns))


def keep_bitmaps(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, row, keep): bit i of word j of `keep` is 1 if line 64 j + i stays.

    `row` is the XXH64 of the text. Words after the last dropped line are left out, and
    so are documents that lose no line.
    """
    lines = written(line_hashes(docs, min_length), "line-hashes")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("pos") % WORD).cast("int"))
    words = (
        dropped_lines(lines)
        .groupBy("doc_id", "row", F.floor(F.col("pos") / WORD).cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
    )
    per_doc = words.groupBy("doc_id", "row").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words")
    )
    w = F.col("words")

    def with_gap(x: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(w, i - 1)["word"])
        gap = F.array_repeat(F.lit(-1).cast("long"), x["word"] - before - 1)
        return F.concat(gap, F.array(F.bitwise_not(x["bits"])))

    return per_doc.select("doc_id", "row", F.flatten(F.transform(w, with_gap)).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """`docs` with `_line_total` and the array `_line_kept` of the lines that stay."""
    marked = docs.withColumn("_line_row", F.xxhash64(whole_text(docs)))
    maps = bitmaps.select(
        F.col("doc_id").alias("_line_doc"), F.col("row").alias("_line_map"), F.col("keep").alias("_line_keep")
    ).hint("shuffle_hash")
    joined = marked.join(
        maps,
        (marked["doc_id"].cast("long") == maps["_line_doc"])
        & (marked["_line_row"] == maps["_line_map"]),
        "left",
    )
    lines, keep = _lines(whole_text(joined)), F.col("_line_keep")

    def stays(_: Column, i: Column) -> Column:
        word = F.get(keep, F.floor(i / WORD).cast("int"))
        return F.coalesce(F.getbit(word, (i % WORD).cast("int")) == 1, F.lit(True))

    kept = F.when(keep.isNull(), lines).otherwise(F.filter(lines, stays))
    return (
        joined.withColumn("_line_total", F.size(lines).cast("long"))
        .withColumn("_line_kept", kept)
        .drop("_line_doc", "_line_map", "_line_row", "_line_keep")
    )


def dedup_lines(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """The same columns, `text` without dropped lines and `n_chars`, if there, brought up to date."""
    applied = apply_bitmaps(docs, keep_bitmaps(docs, min_length))
    text = F.array_join("_line_kept", "\n")
    changed = F.size("_line_kept") < F.col("_line_total")
    out = {"text": F.when(changed, text).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return applied.withColumns(out).select(*docs.columns)


def line_dedup_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256."""
    narrow = docs.select("doc_id", "text")
    applied = apply_bitmaps(narrow, keep_bitmaps(narrow))
    return applied.select(
        "doc_id",
        F.col("_line_total").alias("n_lines"),
        (F.col("_line_total") - F.size("_line_kept")).cast("long").alias("n_dropped"),
        F.sha2(F.array_join("_line_kept", "\n").cast("binary"), 256).alias("kept_sha256"),
    )
