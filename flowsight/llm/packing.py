"""Best-fit packing: patterns of few documents by non-negative least squares, the rest by best fit.

Documents become pieces of at most `capacity` tokens. Their lengths make a histogram of at most
`capacity` rows, the only thing the driver sees. Patterns of two or three lengths that fill a
sequence exactly are enumerated, their repeat counts are fitted to the histogram, rounded down,
and what is left is packed by best fit, longest first, on the histogram too. The plan is a list of
slots (length, first rank, count → sequence, offset); a piece finds its slot by its rank
among the pieces of its length. Ranks are counted per (length, salt), so that a length which a third
of all pieces share fills no task. The plan's size depends on `capacity`, not on the documents.

Defined results: null text counts as empty, and an empty document is its closing id alone; rows
that repeat a `doc_id` are packed one by one; a null `doc_id` is carried along; other columns play
no part; no documents, no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, per_process, shuffle_partitions, text_blocks, text_groups, whole_text, written

CAPACITY = 2048
END_ID = 0
CACHE_WORDS = 1 << 19
ROUNDS = 400
ASCII_WHITE = re.compile("[ \t\n\x0b\x0c\r]+")
SEPARATORS = re.compile("[\x1c-\x1f]")  # white space for str.split, not for the tokenizer


# Texts of these letters, whose class no version of Unicode changes, are cut here as the tokenizer cuts them.
PLAIN = re.compile("[ \t\n\x0b\x0c\r!-~À-ÖØ-öø-ÿ]*")
RUNS = re.compile("[a-zß-öø-ÿ]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^ \t\n\x0b\x0c\ra-zß-öø-ÿ0-9]+")
JOINED = 256
WORD_END = "</w>"


class Recent(dict):
    """A bounded cache: when it is half full its entries grow old, and those not used again by the next time go."""

    def __init__(self, most: int):
        super().__init__()
        self.old: dict[str, bytes] = {}
        self.most = most

    def missing(self, keys: set[str]) -> list[str]:
        """Those of `keys` to be made and put in; all others are in the cache from now on."""
        new = keys.difference(self)
        if len(self) + len(new) > self.most // 2:
            self.old = dict(self)
            self.clear()
            new = keys
        old, made = self.old, []
        for key in new:
            value = old.get(key)
            if value is None:
                made.append(key)
            else:
                self[key] = value
        return made


class WordIds:
    """Ids of texts by the tokenizers library, through bounded caches.

    Right for tokenizers that drop white space and treat what lies between alone, and that end every run of
    `RUNS` with a token in `</w>`: plain texts are cut into their lower-case runs, of which many go to a call, and
    whose ids are told apart by these tokens. Other texts are encoded by words of white space.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words, self.runs = Recent(cache_words), Recent(cache_words)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _add_runs(self, new: list[str]) -> None:
        """The ids of new runs; each ends with the only token of its kind."""
        joined = ["\n".join(new[at : at + JOINED]) for at in range(0, len(new), JOINED)]
        for k, ids in enumerate(self._encode(joined)):
            ids = np.array(ids, "<u4")
            data, start = ids.tobytes(), 0
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            for run, end in zip(new[k * JOINED : (k + 1) * JOINED], ends, strict=True):
                self.runs[run] = data[start:end]
                start = end

    def _group(self, texts: list[str]) -> list[bytes]:
        plain = [bool(PLAIN.fullmatch(t)) and not any(s in t for s in self.special) for t in texts]
        cut = [
            RUNS.findall(t.lower()) if p else ASCII_WHITE.split(t) if SEPARATORS.search(t) else t.split()
            for t, p in zip(texts, plain)
        ]
        self._add_runs(self.runs.missing(set(chain.from_iterable(c for c, p in zip(cut, plain) if p))))
        new = self.words.missing(set(chain.from_iterable(c for c, p in zip(cut, plain) if not p)))
        for word, ids in zip(new, self._encode(new)):
            self.words[word] = array("I", ids).tobytes()
        of_run, of_word = self.runs.__getitem__, self.words.__getitem__
        return [b"".join(map(of_run if p else of_word, c)) for c, p in zip(cut, plain)]

    def encode(self, texts: list[str]):
        """The little-endian unsigned 32-bit ids of each text."""
        for group in text_groups(texts):
            if len(group) > 1:
                yield from self._group(group)
            else:
                yield b"".join(self._group([part])[0] for part in text_blocks(group[0]))


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids, an end id, cut at `capacity`."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))

    key = f"words {path}"

    def work(batch: pa.RecordBatch):
        encoder = per_process(key, lambda: WordIds(path))
        end = array("I", [END_ID]).tobytes()
        doc, piece, start, length, crc = [], [], [], [], []
        for i, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist())):
            ids += end
            for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                doc.append(i)
                piece.append(k)
                start.append(at // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
        yield {"doc_id": doc, "piece": piece, "start": start, "length": length, "ids_crc32": crc}

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return arrow_map(rows, work, schema, keeps=key)


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All (a <= b <= c) of present lengths, a possibly 0 (none), that sum to `capacity`."""
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    found = []
    for a in [0, *sorted(x for x in lengths.tolist() if 3 * x <= capacity)]:
        b = np.arange(max(a, 1), (capacity - a) // 2 + 1)
        b = b[there[b] & there[capacity - a - b]]
        found.append(np.stack([np.full(len(b), a), b, capacity - a - b], axis=1))
    return np.concatenate(found).astype(np.int64)


def fit_counts(histogram: np.ndarray, columns: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative repeat counts of the patterns whose sum comes nearest to the histogram.

    Least squares by greedy coordinate descent: each round takes the steepest patterns that
    share no length and moves each to its best value, never below 0.
    """
    if not len(columns):
        return np.zeros(0)
    rest = histogram.astype(np.float64).copy()
    rest[0] = 0
    a, b, c = columns.T
    used = (a > 0).astype(np.float64)
    same_ab, same_bc = (a == b) & (a > 0), b == c
    norm = used + 2 + 2 * same_ab + 2 * same_bc + 2 * (same_ab & same_bc)
    x = np.zeros(len(columns))
    start = float(rest @ rest)
    last = start
    for turn in range(rounds):
        step = (rest[a] + rest[b] + rest[c]) / norm
        step = np.maximum(step, -x)
        gain = step * step * norm
        top = np.argpartition(-gain, min(2048, len(gain) - 1))[:2048]
        top = top[np.argsort(-gain[top], kind="stable")]
        taken: set[int] = {-1}
        for k, (i, j, m) in zip(top.tolist(), columns[top].tolist()):
            if gain[k] <= 0:
                break
            if (i and i in taken) or j in taken or m in taken:
                continue
            taken.update((i, j, m) if i else (j, m))
            x[k] += step[k]
            for length in (i, j, m):
                rest[length] -= step[k]
            rest[0] = 0
        if turn % 20 == 19:
            now = float(rest @ rest)
            if last - now < 1e-4 * start:
                break
            last = now
    return x


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, repeats) that together use every piece of the histogram once."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[list[int], int]] = []
    if left[capacity]:
        out.append(([capacity], int(left[capacity])))
        left[capacity] = 0
    lengths = np.flatnonzero(left)
    if not len(lengths):
        return out
    columns = patterns(lengths, capacity)
    fitted = np.floor(fit_counts(left, columns) + 1e-9).astype(np.int64)
    for k in sorted(np.flatnonzero(fitted).tolist(), key=lambda k: -fitted[k]):
        parts = [p for p in columns[k].tolist() if p]
        times = min([int(fitted[k]), *(int(left[p]) // parts.count(p) for p in parts)])
        if times > 0:
            out.append((parts, times))
            for p in parts:
                left[p] -= times
    return out + _best_fit(left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Best fit, longest first, on counts: whole runs of equal pieces and equal gaps at a time."""
    gaps: dict[int, list[tuple[list[int], int]]] = {}
    closed: list[tuple[list[int], int]] = []

    def put(parts: list[int], gap: int, times: int) -> None:
        if gap:
            gaps.setdefault(gap, []).append((parts, times))
        else:
            closed.append((parts, times))

    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            gap = min((g for g in gaps if g >= length), default=None)
            if gap is None:
                many = capacity // length
                times = n // many
                if times:
                    put([length] * many, capacity - many * length, times)
                if n % many:
                    put([length] * (n % many), capacity - n % many * length, 1)
                n = 0
                continue
            parts, times = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
            many = min(gap // length, -(-n // times))
            fill = min(times, n // many)
            put(parts + [length] * many, gap - many * length, fill)
            if times > fill:
                gaps.setdefault(gap, []).append((parts, times - fill))
            n -= fill * many
    return closed + [group for groups in gaps.values() for group in groups]


def slots(strategies: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """Where the pieces of a length go by rank: sorted by (length, first rank)."""
    rows, rank, sequence = [], {}, 0
    for parts, times in strategies:
        offset = 0
        for length in parts:
            first = rank.get(length, 0)
            rows.append((length, first, sequence, offset))
            rank[length] = first + times
            offset += length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {n: table[:, i] for i, n in enumerate(("length", "first", "sequence", "offset"))}


def ranked(pieces: DataFrame) -> DataFrame:
    """`pieces` with `rank` from 0 among those of equal length."""
    n = shuffle_partitions(pieces.sparkSession)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n)))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("here"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "salt", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    return (
        salted.join(base, ["length", "salt"])
        .withColumn("rank", F.col("base") + F.row_number().over(inside) - 1)
        .drop("salt", "base")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (written: they are read twice) with `sequence_id` and `offset`."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    place = slots(plan(counts, capacity))
    key = place["length"] * (1 << 44) + place["first"]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = ranked(pieces).select(*columns, "rank")

    def work(batch: pa.RecordBatch):
        out = {name: batch.column(i) for i, name in enumerate(columns)}
        length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
        at = np.searchsorted(key, length * (1 << 44) + rank, side="right") - 1
        out["sequence_id"] = place["sequence"][at] + rank - place["first"][at]
        out["offset"] = place["offset"][at]
        yield out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return arrow_map(rows, work, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its place."""
    return pack(written(token_pieces(docs, path, capacity), "pieces"), capacity)
