"""Language ID: scripts narrow the candidates, Viterbi over words labels spans.

A word's score for a language sums, over the word and the letter triples in it, the log of how much
more often the language has them than the corpus. Counts come from all learnable documents in one
pass with partial aggregation, hashed into a table of fixed size, which is all the driver
sees. A word's script leaves only the languages that are written in it. Over the words of a text the
best path pays `penalty` for each change of language; its runs are the spans.

Defined results: null text and text without a letter is `und` with score 0; a null language or null
doc_id is never learned from (a null doc_id counts as held out); with nothing to learn from every
row is `und`; repeated rows get equal results; other columns play no part. Of languages that tie the
first in alphabetical order wins.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_fold, arrow_map, held_out, text_blocks, text_groups

BUCKETS = 1 << 17
PENALTY = 8.0
SMOOTHING = 50.0
GROUP_CHARS = 1 << 22  # texts that are scored side by side
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")  # a letter, then letters and their marks
SCRIPT_SHARE = 0.01
UNDETERMINED = "und"

# First code point of Unicode ranges and the script written there.
SCRIPTS = [
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0700, "other"),
    (0x0750, "arabic"),
    (0x0780, "other"),
    (0x0900, "devanagari"),
    (0x0980, "bengali"),
    (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"),
    (0x0B00, "other"),
    (0x0B80, "tamil"),
    (0x0C00, "telugu"),
    (0x0C80, "kannada"),
    (0x0D00, "malayalam"),
    (0x0D80, "sinhala"),
    (0x0E00, "thai"),
    (0x0E80, "lao"),
    (0x0F00, "tibetan"),
    (0x1000, "myanmar"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "ethiopic"),
    (0x1380, "other"),
    (0x1780, "khmer"),
    (0x1800, "mongolian"),
    (0x18B0, "other"),
    (0x1C80, "cyrillic"),
    (0x1CD0, "other"),
    (0x1D00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "latin"),
    (0x2C60, "latin"),
    (0x2C80, "other"),
    (0x3040, "kana"),
    (0x3100, "han"),
    (0x3130, "hangul"),
    (0x3190, "han"),
    (0xA000, "other"),
    (0xA640, "cyrillic"),
    (0xA6A0, "other"),
    (0xA720, "latin"),
    (0xA800, "other"),
    (0xAC00, "hangul"),
    (0xD800, "other"),
    (0xF900, "han"),
    (0xFB00, "latin"),
    (0xFB1D, "hebrew"),
    (0xFB50, "arabic"),
    (0xFE70, "arabic"),
    (0xFF00, "latin"),
    (0xFF66, "kana"),
    (0xFFA0, "hangul"),
    (0x10000, "other"),
    (0x20000, "han"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
SCRIPT_STARTS = np.array([start for start, _ in SCRIPTS])
SCRIPT_INDEX = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


def word_ids(texts: list[str], index: dict[str, int]) -> list[np.ndarray]:
    """For each text the numbers of its lower-cased words; `index` gets the new ones."""
    out = []
    for text in texts:
        parts = [
            np.array([index.setdefault(w, len(index)) for w in LETTERS.findall(block.lower())], np.int32)
            for block in text_blocks(text)
        ]
        out.append(parts[0] if len(parts) == 1 else np.concatenate(parts))
    return out


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, bucket) of every feature of the words, and the script of each word."""
    points = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le", "surrogatepass"), "<u4")
    inner = np.flatnonzero(points[1:-1]) + 1
    owner = np.cumsum(points[:-1] == 0)[inner] - 1
    mixed = (
        points[inner - 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        + points[inner].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        + points[inner + 1].astype(np.uint64) * np.uint64(0x165667B19E3779F9)
    )
    triples = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)
    whole = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.int64, len(words))
    first = np.searchsorted(owner, np.arange(len(words)))
    scripts = SCRIPT_INDEX[np.searchsorted(SCRIPT_STARTS, points[inner[first]], side="right") - 1]
    return (
        np.concatenate([owner, np.arange(len(words))]),
        np.concatenate([triples.astype(np.int64) % BUCKETS, whole % BUCKETS]),
        scripts,
    )


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages
    scripts: np.ndarray  # scripts x languages, whether the language is written so

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(words x languages) scores, and whether any language has the word's script."""
        owner, bucket, scripts = word_features(words)
        scores = np.zeros((len(words), len(self.languages)))
        for k in range(len(self.languages)):
            scores[:, k] = np.bincount(owner, self.weights[bucket, k], len(words))
        fits = self.scripts[scripts]
        known = fits.any(axis=1)
        scores[known[:, None] & ~fits] = -1e6
        scores[~known] = 0.0
        return scores, known


def viterbi(scores: np.ndarray, ids: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """The best language of every word of every text, all texts side by side.

    `scores` are those of the distinct words, `ids` the words of each text.
    """
    lengths = np.array([len(i) for i in ids])
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    order, lengths = order[lengths > 0], lengths[lengths > 0]
    out = [np.zeros(0, np.int16) for _ in ids]
    if not len(order):
        return out
    flat = np.concatenate([ids[i] for i in order])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    best_before = np.zeros(len(flat), np.int16)
    switched = np.zeros((len(flat), scores.shape[1]), bool)
    state = scores[flat[starts]]
    for t in range(1, lengths[0]):
        n = active[t]
        at, s = starts[:n] + t, state[:n]
        top = s.max(axis=1) - penalty
        best_before[at] = s.argmax(axis=1)
        jump = s < top[:, None]
        switched[at] = jump
        state[:n] = np.where(jump, top[:, None], s) + scores[flat[at]]
    labels = np.zeros(len(flat), np.int16)
    labels[starts + lengths - 1] = state.argmax(axis=1)
    for t in range(lengths[0] - 1, 0, -1):
        at = starts[: active[t]] + t
        here = labels[at]
        labels[at - 1] = np.where(switched[at, here], best_before[at], here)
    for i, a, n in zip(order.tolist(), starts.tolist(), lengths.tolist()):
        out[i] = labels[a : a + n]
    return out


def learn(docs: DataFrame, smoothing: float = SMOOTHING) -> Model:
    """Counts over all learnable documents; collects at most BUCKETS rows a language."""
    rows = docs.filter(~held_out(docs, 4, 2) & docs["lang"].isNotNull() & docs["text"].isNotNull())
    rows = rows.select(docs["lang"].cast("string").alias("lang"), docs["text"].cast("string").alias("text"))
    size = BUCKETS + len(SCRIPT_NAMES)

    def add(state: dict[str, np.ndarray], batch: pa.RecordBatch) -> None:
        langs, done = batch.column(0).to_pylist(), 0
        for group in text_groups(batch.column(1).to_pylist(), GROUP_CHARS):
            add_group(state, langs[done : done + len(group)], group)
            done += len(group)

    def add_group(state: dict[str, np.ndarray], langs: list[str], texts: list[str]) -> None:
        index: dict[str, int] = {}
        ids = word_ids(texts, index)
        if not index:
            return
        owner, bucket, scripts = word_features(list(index))
        for lang in set(langs):
            own = [i for i, x in zip(ids, langs) if x == lang]
            times = np.bincount(np.concatenate(own), minlength=len(index)).astype(np.float64)
            counts = state.setdefault(lang, np.zeros(size))
            counts[:BUCKETS] += np.bincount(bucket, times[owner], BUCKETS)
            counts[BUCKETS:] += np.bincount(scripts, times, len(SCRIPT_NAMES))

    def finish(state: dict[str, np.ndarray]):
        for lang, counts in state.items():
            at = np.flatnonzero(counts)
            yield {"lang": [lang] * len(at), "bucket": at, "n": counts[at].astype(np.int64)}

    counted = arrow_fold(rows, dict, add, finish, "lang string, bucket int, n long")
    total = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(total.column("lang").to_pylist()))
    counts = np.zeros((size, len(languages)))
    number = {lang: k for k, lang in enumerate(languages)}
    which = np.array([number[x] for x in total.column("lang").to_pylist()], np.int64)
    counts[total.column("bucket").to_numpy(), which] = total.column("n").to_numpy()
    features, scripts = counts[:BUCKETS], counts[BUCKETS:]
    share = features.sum(axis=1, keepdims=True) / max(features.sum(), 1.0)
    seen = np.maximum(share, 1e-300)
    weights = np.log((features + smoothing * share) / (features.sum(axis=0) + smoothing) / seen + 1e-300)
    weights[share[:, 0] == 0] = 0.0
    written_in = scripts > SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1.0)
    return Model(languages, np.maximum(weights, -12.0).astype(np.float32), written_in)


def predict(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): the language of most letters and its share of all letters.

    Words in a script of no learned language count for none; of a text of such words alone the score is 0.
    """
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        held_out(docs, 4, 2).alias("held_out"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )

    def predicted(texts: list[str]) -> tuple[list[str], list[float]]:
        index: dict[str, int] = {}
        ids = word_ids(texts, index)
        names, scores = [UNDETERMINED] * len(ids), [0.0] * len(ids)
        if index and model.languages:
            words = list(index)
            letters = np.fromiter(map(len, words), np.float64, len(words))
            by_word, known = model.word_scores(words)
            own = np.where(known, letters, 0.0)
            for i, labels in enumerate(viterbi(by_word, ids, penalty)):
                if len(labels):
                    mass = np.bincount(labels, own[ids[i]], len(model.languages))
                    names[i] = model.languages[int(mass.argmax())]
                    scores[i] = float(mass.max() / letters[ids[i]].sum())
        return names, scores

    def work(batch: pa.RecordBatch):
        names: list[str] = []
        scores: list[float] = []
        for group in text_groups(batch.column(2).to_pylist(), GROUP_CHARS):
            for all_, part in zip((names, scores), predicted(group)):
                all_ += part
        yield {
            "doc_id": batch.column(0),
            "held_out": batch.column(1),
            "lang_pred": names,
            "score": scores,
        }

    return arrow_map(rows, work, "doc_id long, held_out boolean, lang_pred string, score double")


def label_spans(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """(doc_id, spans): runs of one language as (start, end, lang) in code points of the text.

    Words in a script of no learned language are `und`.
    """
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )

    def work(batch: pa.RecordBatch):
        index: dict[str, int] = {}
        places, ids = [], []
        for text in batch.column(1).to_pylist():
            found = [(m.start(), m.end(), m[0].lower()) for m in LETTERS.finditer(text)]
            places.append([(a, b) for a, b, _ in found])
            ids.append(np.array([index.setdefault(w, len(index)) for _, _, w in found], np.int32))
        out: list[list[dict]] = [[] for _ in ids]
        if index and model.languages:
            by_word, known = model.word_scores(list(index))
            for k, labels in enumerate(viterbi(by_word, ids, penalty)):
                for (a, b), word, label in zip(places[k], ids[k].tolist(), labels.tolist()):
                    lang = model.languages[label] if known[word] else UNDETERMINED
                    if out[k] and out[k][-1]["lang"] == lang:
                        out[k][-1]["end"] = b
                    else:
                        out[k].append({"start": a, "end": b, "lang": lang})
        yield {"doc_id": batch.column(0), "spans": out}

    return arrow_map(
        rows, work, "doc_id long, spans array<struct<start: int, end: int, lang: string>>"
    )


def language_report(docs: DataFrame) -> DataFrame:
    return predict(docs, learn(docs))


def keep_known_language(docs: DataFrame, min_score: float = 0.3) -> DataFrame:
    """`docs` without texts of no language or of none that fills `min_score` of the letters.

    Rows without a doc_id stay if their text has a letter.
    """
    report = predict(docs, learn(docs)).filter(
        (F.col("lang_pred") == UNDETERMINED) | (F.col("score") < min_score)
    )
    gone = report.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_lang_gone")).distinct()
    kept = docs.join(gone, docs["doc_id"].cast("long") == gone["_lang_gone"], "left_anti")
    return kept.filter(docs["doc_id"].isNotNull() | F.coalesce(docs["text"].rlike(r"\p{L}"), F.lit(False)))
