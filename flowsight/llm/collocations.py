"""Phrase collocations by prefix-free parsing: count phrases in distinct chunks, weighted by their number.

Parsing: a text is a row of words with breaks between pieces. Wherever the hash of a window of `WINDOW`
words is divisible by `DIVISOR`, a chunk ends behind the window and the next begins with it, so chunks of
equal content are cut alike wherever they stand, and overlap by a window. The distinct chunks with
their frequencies are the dictionary; copies, repeated lines and passages shrink to one entry
each. A phrase occurrence belongs to the chunk in which it begins before the closing window (in a
text's last chunk: anywhere), so each is counted once; a phrase is at most a word longer than the window.

Words are counted by the parsing pass, as the alphabet; then two passes over the dictionary count pairs and longer phrases. As no phrase is
more frequent than its parts, a pass leaves out phrases with an infrequent part, known by a Bloom filter of
what the pass before has found. The filter has at most 2^`FILTER_BITS` bits whatever the input; where it lets an infrequent part
pass, a phrase more is counted and dropped by its exact count. Tasks identify phrases by their words,
never by hashes, sum up what they meet in bounded tables, and Spark sums these.

Scores are compared as decimals of 38 digits: exact while 1000 * a * n stays below 10^38.

Defined results: null texts count as empty; a null `lang` is `und`; texts without words give nothing; repeated
rows and doc_ids count as often as they occur (doc_id plays no part); a text is parsed as a whole, a long
one into chunks of at most `LONGEST_CHUNK` words and a window; ties go by a, then by the phrase's bytes; no documents, no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_fold, arrow_map, release_process, whole_text, written

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
ABSORB_PERCENT = 100
WINDOW = LONGEST - 1
DIVISOR = 48
LONGEST_CHUNK = 1 << 13
FILTER_BITS = 27
MAX_WORDS = 1 << 20
MAX_TOKENS = 1 << 22
MAX_PHRASES = 1 << 21
BREAK, END = "\n", "\r"
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
NORMAL = bytes.maketrans(
    (UPPER := b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") + b"\t" + PIECE_ENDS.encode(),
    UPPER.lower() + b" " + BREAK.encode() * len(PIECE_ENDS),
)
MIX = np.uint64(0x9E3779B97F4A7C15)
TEXT_BLOCK = 1 << 20


def word_hash(word: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), seed)


def mixed(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of several, in their order."""
    out = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        out = (out ^ part) * MIX
        out ^= out >> np.uint64(29)
    return out


def tokens_of(text: str) -> list[str]:
    """Words and breaks; a break may stand anywhere, also several times."""
    plain = text.encode("utf-8").translate(NORMAL).decode("utf-8")
    return list(filter(None, plain.replace(BREAK, f" {BREAK} ").split(" ")))


class Words(dict):
    """Numbers of words in the order of their first use, and their hashes by number."""

    def __init__(self, seed: int = 0):
        super().__init__({BREAK: 0, END: 1})
        self.seed, self.hashes = seed, np.zeros(1 << 16, np.uint64)

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        if number == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
        self.hashes[number] = word_hash(word, self.seed)
        return number

    def numbers(self, tokens: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))


def chunk_ends(hashes: np.ndarray, window: int, divisor: int, longest: int) -> list[tuple[int, int]]:
    """(first, end) of a text's chunks, in words; neighbours overlap by a window."""
    n = len(hashes)
    if n <= window:
        return [(0, n)] if n else []
    seen = mixed([hashes[i : n - window + i] for i in range(window)])  # a window at the end cuts nothing
    starts = np.flatnonzero((seen >> np.uint64(20)) % np.uint64(divisor) == 0)
    out, first = [], 0
    for at in [*starts[starts > 0].tolist(), n]:
        while at - first > longest + window * (at == n):
            out.append((first, first + longest + window))
            first += longest
        if at < n:
            out.append((first, at + window))
            first = at
    out.append((first, n))
    return out


def chunks_of(
    tokens: list[str], ids: np.ndarray, words: Words, window: int, divisor: int, longest: int
) -> Iterator[str]:
    """The chunks of a text given as tokens and their numbers; the last one closes with the end mark."""
    at = np.flatnonzero(ids > 1)
    for first, end in chunk_ends(words.hashes[ids[at]], window, divisor, longest):
        chunk = " ".join(tokens[at[first] : at[end - 1] + 1])
        yield f"{chunk} {END}" if end == len(at) else chunk


def parse(
    docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR, longest: int = LONGEST_CHUNK
) -> DataFrame:
    """The dictionary and its alphabet: (lang, word, entry, n).

    Every distinct chunk of a language with its number (`word` false), and every distinct word.
    """
    rows = docs.select(
        F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), whole_text(docs).alias("text")
    ).filter("text <> ''")

    def work(batch: pa.RecordBatch):
        words, seen, held = Words(), {}, 0
        langs, found, size = [], [], 0

        def alphabet():
            names = list(words)
            for lang, parts in seen.items():
                number, n = np.unique(np.concatenate(parts), return_counts=True)
                n, number = n[number > 1], number[number > 1].tolist()
                yield {
                    "lang": [lang] * len(n),
                    "word": np.ones(len(n), bool),
                    "entry": [names[i] for i in number],
                    "n": n,
                }

        def chunks():
            yield {
                "lang": langs,
                "word": np.zeros(len(found), bool),
                "entry": found,
                "n": np.ones(len(found), np.int64),
            }

        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            tokens = tokens_of(text)
            ids = words.numbers(tokens)
            seen.setdefault(lang, []).append(ids)
            held += len(ids)
            for chunk in chunks_of(tokens, ids, words, window, divisor, longest):
                langs.append(lang)
                found.append(chunk)
            size += len(text)
            if size > TEXT_BLOCK:
                yield from chunks()
                langs, found, size = [], [], 0
            if held > MAX_TOKENS or len(words) > MAX_WORDS:
                yield from alphabet()
                words, seen, held = Words(), {}, 0
        yield from chunks()
        yield from alphabet()

    parsed = arrow_map(rows, work, "lang string, word boolean, entry string, n long")
    return parsed.groupBy("lang", "word", "entry").agg(F.sum("n").alias("n"))


class Filter:
    """A Bloom filter over phrase hashes with two places a phrase."""

    def __init__(self, bits: int, words: np.ndarray):
        self.shift, self.words = np.uint64(64 - bits), words

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> np.ndarray:
        shift = np.uint64(64 - bits)
        return np.concatenate([hashes * MIX >> shift, (hashes ^ (hashes >> np.uint64(32))) * MIX >> shift])

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        first, second = np.split(self.places(hashes, 64 - int(self.shift)), 2)
        return self._bit(first) & self._bit(second)

    def _bit(self, place: np.ndarray) -> np.ndarray:
        return (self.words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def lang_seed(lang: str) -> int:
    return word_hash(lang, 1)


def frequent_filter(frequent: DataFrame) -> Filter:
    """The filter of the phrases in `frequent` (lang, phrase, ...; written)."""
    bits = min(max(16, (16 * max(frequent.count(), 1)).bit_length()), FILTER_BITS)

    def add(blocks: dict, batch: pa.RecordBatch) -> None:
        hashes = np.zeros(len(batch), np.uint64)
        for i, (lang, phrase) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            seed = lang_seed(lang)
            parts = [np.array([word_hash(w, seed)], np.uint64) for w in phrase.split(" ")]
            hashes[i] = mixed(parts)[0]
        for place in Filter.places(hashes, bits).tolist():
            blocks[place >> 6] = blocks.get(place >> 6, 0) | 1 << (place & 63)

    def finish(blocks: dict):
        yield {
            "block": list(blocks),
            "set": np.array(list(blocks.values()), np.uint64).view(np.int64),
        }

    parts = arrow_fold(frequent.select("lang", "phrase"), dict, add, finish, "block long, set long")
    parts = parts.groupBy("block").agg(F.bit_or("set").alias("set"))
    got = parts.toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[got["block"].to_numpy()] = got["set"].to_numpy().view(np.uint64)
    return Filter(bits, words)


def distinct(columns: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of a matrix of word numbers, with the sum of their weights."""
    if not columns.shape[1]:
        return columns, weights
    width = int(columns.max()) + 1
    code = columns[0].astype(np.int64)
    for row in columns[1:-1]:
        code = np.unique(code * width + row, return_inverse=True)[1]
    if len(columns) > 1:
        code = code * width + columns[-1]
    _, first, inverse = np.unique(code, return_index=True, return_inverse=True)
    return columns[:, first], np.bincount(inverse, weights).astype(np.int64)


class Counter:
    """Phrase counts of one language in one task, by word numbers; what is full is given out."""

    def __init__(self, lang: str, sizes: tuple[int, ...]):
        self.lang, self.sizes = lang, sizes
        self.words = Words(lang_seed(lang))
        self.held = {k: [] for k in sizes}

    def add(self, chunks: list[str], numbers: np.ndarray, window: int, parts: Filter | None) -> None:
        """`parts` knows the frequent phrases a word shorter than the shortest counted here."""
        tokens = f" {END} {END} ".join(chunks).split(" ") + [END, END]
        ids = self.words.numbers(tokens)
        # a chunk closes with two end marks, a text's last one with three
        end = ids == 1
        close = np.flatnonzero(end & np.append(~end[1:], True))
        last = end[close - 2]
        chunk = np.zeros(len(ids), np.int64)
        chunk[close[:-1] + 1] = 1
        chunk = chunk.cumsum()
        word = ids > 1
        upto = word.cumsum()
        behind = upto[close][chunk] - upto  # words of the chunk that follow
        owned = word & (last[chunk] | (behind >= window))
        weight = numbers[chunk]
        if parts is None:
            alive = word
            least = 1
        else:
            least = min(self.sizes) - 1
            alive = word.copy()
            for k in range(1, least):
                alive[:-k] &= word[k:]
                alive[len(alive) - k :] = False
            at = np.flatnonzero(alive)
            hashes = self.words.hashes
            alive[at] = parts.holds(mixed([hashes[ids[at + i]] for i in range(least)]))
        for k in range(least, max(self.sizes) + 1):
            if k > least:  # both parts that are a word shorter
                alive = alive & np.append(alive[1:], False)
            if k in self.sizes:
                at = np.flatnonzero(alive & owned)
                # sequences of k words: every part is alive, so no break lies inside
                columns = np.stack([ids[at + i] for i in range(k)]).astype(np.int32)
                self.held[k].append(distinct(columns, weight[at]))

    def full(self) -> bool:
        if sum(w.size for held in self.held.values() for _, w in held) <= MAX_PHRASES:
            return len(self.words) > MAX_WORDS
        for k in self.sizes:
            self._merge(k)
        return 2 * sum(w.size for held in self.held.values() for _, w in held) > MAX_PHRASES

    def _merge(self, k: int) -> None:
        if len(self.held[k]) > 1:
            columns, weights = zip(*self.held[k])
            self.held[k] = [distinct(np.concatenate(columns, axis=1), np.concatenate(weights))]

    def out(self) -> Iterator[dict]:
        names = list(self.words)
        for k in self.sizes:
            self._merge(k)
            for columns, weights in self.held[k]:
                for at in range(0, len(weights), 1 << 16):
                    rows = zip(*([names[i] for i in c] for c in columns[:, at : at + (1 << 16)].tolist()))
                    phrases = [" ".join(r) for r in rows]
                    yield {
                        "lang": [self.lang] * len(phrases),
                        "phrase": phrases,
                        "f": weights[at : at + (1 << 16)],
                    }


def phrase_counts(
    chunks: DataFrame, sizes: tuple[int, ...], parts: Filter | None = None, window: int = WINDOW
) -> DataFrame:
    """(lang, phrase, f) of the phrases of `sizes` words in the dictionary's chunks.

    With `parts`, phrases that hold a part it does not know may be left out.
    """
    kind = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_process()
        counters: dict[str, Counter] = {}

        def given(counter: Counter) -> Iterator[pa.RecordBatch]:
            for columns in counter.out():
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in kind], schema=kind)

        for batch in batches:
            by_lang: dict[str, tuple[list, list]] = {}
            for lang, chunk, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = by_lang.setdefault(lang, ([], []))
                found[0].append(chunk)
                found[1].append(n)
            for lang, (texts, numbers) in by_lang.items():
                if lang not in counters:
                    counters[lang] = Counter(lang, sizes)
                counters[lang].add(texts, np.array(numbers, np.int64), window, parts)
                if counters[lang].full():
                    yield from given(counters.pop(lang))
        for counter in counters.values():
            yield from given(counter)

    counts = chunks.filter("NOT word").select("lang", "entry", "n").mapInArrow(run, "lang string, phrase string, f long")
    return counts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def frequent_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST
) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of all phrases of 1 to `longest` words found at least `min_count` times,
    and (lang, n) of all words."""
    window = max(longest - 1, 1)
    chunks = written(parse(docs, window), "chunks")
    words = chunks.filter("word").select("lang", F.col("entry").alias("phrase"), F.col("n").alias("f"))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    enough = F.col("f") >= min_count
    found = below = words.filter(enough)
    for sizes in (range(2, min(longest, 2) + 1), range(3, longest + 1)):
        if sizes:
            counts = phrase_counts(chunks, tuple(sizes), frequent_filter(below), window)
            below = written(counts.filter(enough), "phrases")
            found = found.unionByName(below)
    return found.withColumn("size", F.size(F.split("phrase", " "))), totals


def _part(first: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, length), " ")


def scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, size, phrase, a, l, r, n, score): every phrase with its lowest-scoring cut."""
    candidates = found.filter("size > 1").withColumnRenamed("f", "a")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns(
        {
            "first": _part(F.lit(1), F.col("cut")),
            "rest": _part(F.col("cut") + 1, F.col("size") - F.col("cut")),
        }
    )
    left = found.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    wide = {c: F.col(c).cast("decimal(18,0)") for c in "alrn"}
    exact = F.expr("(CAST(1000 AS decimal(4,0)) * wide.a * wide.n) div (wide.l * wide.r)")
    cuts = cuts.withColumn("wide", F.struct(*[c.alias(k) for k, c in wide.items()])).withColumn("score", exact)
    best = F.min(F.struct("score", "cut", "l", "r")).alias("best")
    return cuts.groupBy("lang", "size", "phrase", "a", "n").agg(best).select(
        "lang", "size", "phrase", "a", "best.l", "best.r", "n", "best.score"
    )


def unabsorbed(candidates: DataFrame, percent: int = ABSORB_PERCENT) -> DataFrame:
    """`candidates` without those inside a longer one that is at least `percent` % as frequent."""
    longer = candidates.filter("size > 2")
    longer = longer.withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    longer = longer.withColumn("first", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    inside = longer.select("lang", _part(F.col("first"), F.col("length")).alias("phrase"), "a")
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(inside, ["lang", "phrase"], "left")
    return kept.filter(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))).drop("longer")


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    top: int = TOP,
    absorb_percent: int = ABSORB_PERCENT,
) -> DataFrame:
    """The first `top` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    found, totals = frequent_phrases(docs, min_count, longest)
    kept = unabsorbed(scored(found, totals), absorb_percent)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
