"""BPE encoding and decoding by speculating and verifying.

Greedy longest match proposes the tokens of all new words of a block at once. A proposal is the
right encoding exactly if every pair of neighbouring tokens is compatible: no merge across their
border would ever come before the merges that built the two. That is checked for all distinct
pairs together in numpy; only words with a failing pair go through exact merging. Words are kept
in a bounded cache of the Python worker. Decoding joins the bytes of the ids.

Defined results: null text counts as empty (no ids, empty text); every other column is untouched by
the column-wise operators; repeated rows give repeated results; a special token's string in a text
becomes its id, as the vocabulary file asks.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, per_process, text_blocks, text_groups, whole_text

# Fixed value: the split of byte-level BPE, from the vocabulary's public description.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_WORDS = 1 << 19
END = 1 << 40
NEVER = np.int64(END)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, other = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(other)
            other += 1
    return [letters[b] for b in range(256)]


class ByteBpe:
    """A byte-level BPE vocabulary in the JSON format of the tokenizers library."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocab, merges = data["model"]["vocab"], data["model"]["merges"]
        letters = byte_letters()
        as_byte = {c: b for b, c in enumerate(letters)}
        size = max(vocab.values()) + 1
        self.bytes_of = [b""] * size
        for word, i in vocab.items():
            self.bytes_of[i] = bytes(as_byte[c] for c in word)
        self.byte_id = [vocab[c] for c in letters]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.size = size
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        self.rank = np.full(size, -1, np.int64)
        self.rank_of = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.whole = [vocab[a + b] for a, b in pairs]
        for (x, y), rank in self.rank_of.items():
            whole = self.whole[rank]
            if self.rank[whole] < 0:
                self.left[whole], self.right[whole], self.rank[whole] = x, y, rank
        keys = np.array([x * size + y for x, y in self.rank_of], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array(list(self.rank_of.values()), np.int64)[order]
        made = np.flatnonzero(self.rank >= 0)
        sound = np.zeros(size, bool)
        sound[self.byte_id] = True
        sound[made] = self.compatible(self.left[made], self.right[made], self.rank[made])
        for i in made[np.argsort(self.rank[made])]:
            sound[i] &= sound[self.left[i]] and sound[self.right[i]]
        self.automaton = ahocorasick.Automaton()
        for i in np.flatnonzero(sound).tolist():
            self.automaton.add_word(self.bytes_of[i].decode("latin-1"), i)
        self.automaton.make_automaton()
        self.split = regex.compile(SPLIT)
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        for text, i in self.special.items():
            self.bytes_of += [b""] * (i + 1 - len(self.bytes_of))
            self.bytes_of[i] = text.encode("utf-8")
        self.special_split = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special
            else None
        )
        self.decimal = [b"%d" % i for i in range(len(self.bytes_of))]
        self.cache: dict[str, tuple[int, ...]] = {}
        self.cache_words = cache_words
        self.proposed = self.failed = 0

    def _pair_rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        key = x * self.size + y
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, whole: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens a, b side by side stay so; `whole`: rank of the merge of a and b, to ignore.

        Goes back in time: the border lies between x and y, which last until the merges of rank
        x_end and y_end. A merge across it comes first if its rank is below x_end (that pair
        stands further left, so it wins a tie) and not above y_end.
        """
        good = np.ones(len(a), bool)
        at = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        x_end = np.full(len(a), NEVER) if whole is None else whole.astype(np.int64)
        y_end = np.full(len(a), NEVER) if whole is None else whole.astype(np.int64) - 1
        while len(at):
            across = self._pair_rank(x, y)
            bad = (across < x_end) & (across <= y_end)
            good[at[bad]] = False
            undo_y = self.rank[y] >= self.rank[x]
            go = ~bad & ((self.rank[x] >= 0) | (self.rank[y] >= 0))
            at, x, y, x_end, y_end, undo_y = (v[go] for v in (at, x, y, x_end, y_end, undo_y))
            y_end = np.where(undo_y, self.rank[y], y_end)
            x_end = np.where(undo_y, x_end, self.rank[x])
            x, y = np.where(undo_y, x, self.right[x]), np.where(undo_y, self.left[y], y)
        return good

    def merged(self, word: bytes) -> list[int]:
        """Exact merging: always the lowest rank, the leftmost of equal ones."""
        ids = [self.byte_id[b] for b in word]
        if len(ids) > 40:
            return self._merged_long(ids)
        rank, whole = self.rank_of.get, self.whole
        ranks = [rank(pair, END) for pair in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == END:
                break
            i = ranks.index(least)
            ids[i : i + 2] = [whole[least]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), END)
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), END)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        n, rank_of, whole = len(ids), self.rank_of, self.whole
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (rank := rank_of.get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(n):
            offer(i)
        while heap:
            rank, i, x, y = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j < 0 or ids[j] != y:
                continue
            ids[i], ids[j], after[i] = whole[rank], -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]

    def learn(self, words: set[str]) -> None:
        """Puts the encodings of new words into the cache."""
        if not words:
            return
        order = list(words)
        raw = [w.encode("utf-8") for w in order]
        found = list(self.automaton.iter_long("Ā".join(w.decode("latin-1") for w in raw)))
        ends = np.fromiter((e for e, _ in found), np.int64, len(found))
        ids = np.fromiter((i for _, i in found), np.int64, len(found))
        limits = np.cumsum([len(w) + 1 for w in raw])
        word = np.searchsorted(limits, ends, side="right")
        inner = np.flatnonzero(word[1:] == word[:-1])
        pair, back = np.unique(ids[inner] * self.size + ids[inner + 1], return_inverse=True)
        good = self.compatible(pair // self.size, pair % self.size)[back]
        wrong = np.zeros(len(order), bool)
        wrong[word[inner[~good]]] = True
        starts = np.searchsorted(word, np.arange(len(order) + 1))
        self.proposed += len(order)
        self.failed += int(wrong.sum())
        tokens, cuts = ids.tolist(), starts.tolist()
        for i, (w, bad) in enumerate(zip(order, wrong.tolist())):
            self.cache[w] = tuple(self.merged(raw[i]) if bad else tokens[cuts[i] : cuts[i + 1]])

    def _words(self, text: str) -> list[str]:
        if self.special_split is None or not any(s in text for s in self.special):
            return self.split.findall(text)
        words: list[str] = []
        for part in self.special_split.split(text):
            words += [part] if part in self.special else self.split.findall(part)
        return words

    def encode_group(self, texts: list[str]) -> list[list[int]]:
        words = [self._words(t) for t in texts]
        new = set(chain.from_iterable(words)).difference(self.cache)
        if len(self.cache) + len(new) > self.cache_words:
            self.cache.clear()
            new = set(chain.from_iterable(words))
        self.learn(new.difference(self.special))
        for s in self.special:
            self.cache[s] = (self.special[s],)
        of = self.cache.__getitem__
        return [list(chain.from_iterable(map(of, w))) for w in words]

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text, in order; long texts are split at inner blanks on the way."""
        for group in text_groups(texts):
            if len(group) > 1:
                yield from self.encode_group(group)
            else:
                ids: list[int] = []
                for part in text_blocks(group[0], keep=self.special):
                    ids += self.encode_group([part])[0]
                yield ids

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")

    def decimals(self, ids: list[int]) -> bytes:
        return b",".join([self.decimal[i] for i in ids])


def _key(path: str) -> str:
    return f"bpe {path}"


def vocabulary(path: str) -> ByteBpe:
    return per_process(_key(path), lambda: ByteBpe(path))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids array<int>."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))

    def work(batch: pa.RecordBatch):
        bpe = vocabulary(path)
        yield {"doc_id": batch.column(0), "ids": list(bpe.encode(batch.column(1).to_pylist()))}

    return arrow_map(rows, work, "doc_id long, ids array<int>", keeps=_key(path))


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of rows of (doc_id, ids)."""
    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))

    def work(batch: pa.RecordBatch):
        bpe = vocabulary(path)
        yield {
            "doc_id": batch.column(0),
            "text": [bpe.decode(ids) for ids in batch.column(1).to_pylist()],
        }

    return arrow_map(rows, work, "doc_id long, text string", keeps=_key(path))


def round_trip_report(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: both directions in one pass."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))

    def work(batch: pa.RecordBatch):
        bpe = vocabulary(path)
        counts, ids_sha, text_sha = [], [], []
        for ids in bpe.encode(batch.column(1).to_pylist()):
            counts.append(len(ids))
            ids_sha.append(hashlib.sha256(bpe.decimals(ids)).hexdigest())
            text_sha.append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
        yield {
            "doc_id": batch.column(0),
            "n_tokens": counts,
            "ids_sha256": ids_sha,
            "decoded_sha256": text_sha,
        }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_map(rows, work, schema, keeps=_key(path))
