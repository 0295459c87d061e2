"""Languages of mixed texts: scripts narrow candidates, Viterbi over word scores labels spans.

The model counts hashed character n-grams (1 to 4 letters, and whole words) and the scripts of
letters by language. It has one number per language and bucket, whatever the corpus. A word's
score is the log probability of its n-grams; languages never seen with its script are out. The
best path through a text pays a penalty per change of language. The label with most letters is
the text's language, and its score is the share of letters with that label.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, words_of

UNKNOWN = "und"
BUCKETS = 1 << 16
SWITCH_PENALTY = 8.0
#: A language has a script if so large a share of its letters is in it.
SCRIPT_SHARE = 0.01
#: Distinct words that a task remembers before it starts anew.
WORDS_KEPT = 200_000
#: Unicode ranges of scripts; letters elsewhere are in a script of their own.
SCRIPTS = {
    "latin": (0x0041, 0x024F), "greek": (0x0370, 0x03FF), "cyrillic": (0x0400, 0x052F), "armenian": (0x0530, 0x058F),
    "hebrew": (0x0590, 0x05FF), "arabic": (0x0600, 0x077F), "devanagari": (0x0900, 0x097F), "bengali": (0x0980, 0x09FF),
    "tamil": (0x0B80, 0x0BFF), "telugu": (0x0C00, 0x0C7F), "thai": (0x0E00, 0x0E7F), "georgian": (0x10A0, 0x10FF),
    "ethiopic": (0x1200, 0x137F), "latin_more": (0x1E00, 0x1EFF), "kana": (0x3040, 0x30FF), "han": (0x4E00, 0x9FFF),
    "hangul": (0xAC00, 0xD7AF),
}
OTHER = len(SCRIPTS)
STARTS = np.array([a for a, _ in SCRIPTS.values()])
ENDS = np.array([b for _, b in SCRIPTS.values()])
FACTOR, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
SPAN = "struct<lang:string,start_word:int,words:int>"


class Letters:
    """The letters of distinct words, in lower case, as one array of code points with marks around each word."""

    def __init__(self, words: list[bytes], buckets: int):
        text = "\n".join(w.decode("utf-8", "replace").replace("\n", " ") for w in words).lower()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        kinds, at = np.unique(points, return_inverse=True)
        end = points == 10
        letter = np.array([chr(p).isalpha() for p in kinds])[at] & ~end
        word = np.cumsum(end) - end
        self.sizes = np.bincount(word[letter], minlength=len(words))
        self.points, self.words = points[letter], word[letter]
        self.buckets = buckets

    def scripts(self) -> np.ndarray:
        """Script of most letters of each word."""
        place = np.searchsorted(STARTS, self.points, side="right") - 1
        script = np.where((place >= 0) & (self.points <= ENDS[place]), place, OTHER)
        return np.bincount(self.words * (OTHER + 1) + script, minlength=len(self.sizes) * (OTHER + 1)).reshape(-1, OTHER + 1).argmax(axis=1)

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words and buckets of their n-grams, length by length, then of the words as a whole."""
        sizes = self.sizes + 2 * (self.sizes > 0)
        word, start = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes) - sizes
        inside = np.ones(len(word), bool)
        full = self.sizes > 0
        inside[start[full]], inside[(start + sizes - 1)[full]] = False, False
        marked = np.where(np.arange(len(word)) == start[word], 1, 2).astype(np.uint64)
        marked[inside] = self.points.astype(np.uint64)
        yield word[inside], self.bucket(marked[inside], 1)
        value = marked
        for n in (2, 3, 4):
            if len(marked) < n:
                return
            value = value[:-1] * FACTOR + marked[n - 1:]
            same = word[n - 1:] == word[:len(word) - n + 1]
            yield word[n - 1:][same], self.bucket(value[same], n)
        powers = np.full(int(sizes.max(initial=1)), FACTOR)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        whole = np.add.reduceat(marked * powers[np.arange(len(word)) - start[word]], start[full])
        yield np.flatnonzero(full), self.bucket(whole, 5)

    def bucket(self, value: np.ndarray, order: int) -> np.ndarray:
        value = (value + np.uint64(order)) * MIX
        return ((value ^ (value >> np.uint64(31))) * FACTOR >> np.uint64(20)).astype(np.int64) % self.buckets


class Model:
    """Log probabilities by bucket and language, and the scripts of each language."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray, penalty: float):
        self.langs, self.buckets, self.penalty = langs, counts.shape[1], penalty
        totals = counts.sum(axis=1, keepdims=True).clip(1)
        floor = 1e-7
        self.logs = np.ascontiguousarray(np.log((counts / totals + floor) / (1 + floor * self.buckets)).T.astype(np.float32))
        shares = scripts / scripts.sum(axis=1, keepdims=True).clip(1)
        self.written = shares >= SCRIPT_SHARE

    def score(self, letters: Letters) -> np.ndarray:
        """Scores per word and language, the best 0; all 0 for words without letters."""
        scores = np.zeros((len(letters.sizes), len(self.langs)))
        if not self.langs:
            return scores.astype(np.float32)
        for word, bucket in letters.grams():
            for i in range(len(self.langs)):
                scores[:, i] += np.bincount(word, self.logs[bucket, i], len(scores))
        scores /= 3
        fits = self.written[:, letters.scripts()].T
        scores = np.where(fits | ~fits.any(axis=1, keepdims=True), scores, scores.min(axis=1, keepdims=True) - 50)
        scores -= scores.max(axis=1, keepdims=True)
        return np.where(letters.sizes[:, None] > 0, scores.clip(-100), 0).astype(np.float32)


class Words(dict):
    """Row of each word in a table of scores; words that turn up are scored together."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.fresh = model, []
        self.scores, self.letters = np.zeros((0, len(model.langs)), np.float32), np.zeros(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        row = self[word] = len(self)
        self.fresh.append(word)
        return row

    def settle(self) -> None:
        """Score the words that have turned up since."""
        if self.fresh:
            letters = Letters(self.fresh, self.model.buckets)
            self.scores = np.concatenate([self.scores, self.model.score(letters)])
            self.letters = np.concatenate([self.letters, letters.sizes])
            self.fresh = []


def best_paths(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Label of each word on its text's best path; texts are ``lengths`` rows from ``starts`` on.

    All texts advance together, word by word, longest first, so that each step is one array
    operation over the texts that still have words. Ties go to the label that comes first.
    """
    labels, stays = np.zeros(len(scores), np.int16), np.zeros(scores.shape, bool)
    if not len(scores):
        return labels
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    value = scores[starts[:alive[0]]]
    best = np.zeros(len(scores), np.int16)
    for t in range(1, len(alive)):
        n = alive[t]
        top, before, at = value[:n].argmax(axis=1), value[:n], starts[:n] + t
        jump = before[np.arange(n), top] - penalty
        stay = before >= jump[:, None]
        stays[at], best[at] = stay, top
        value[:n] = np.where(stay, before, jump[:, None]) + scores[at]
    label = value.argmax(axis=1)
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        at = starts[:n] + t
        labels[at] = label[:n]
        if t:
            label[:n] = np.where(stays[at, label[:n]], label[:n], best[at])
    return labels


def train(df: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS,
          penalty: float = SWITCH_PENALTY) -> Model:
    """Count n-grams and scripts over every row with a text and a language.

    Tasks count words first and split distinct ones only. What reaches the driver has one row
    per language and bucket or script. An empty table gives a model without languages.
    """
    rows = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")

    width = buckets + OTHER + 1

    def add(words: Counter, total: np.ndarray) -> None:
        letters = Letters(list(words), buckets)
        times = np.fromiter(words.values(), np.int64, len(words))
        for word, bucket in letters.grams():
            total[:buckets] += np.bincount(bucket, times[word], buckets)
        total[buckets:] += np.bincount(letters.scripts(), times * letters.sizes, OTHER + 1)
        words.clear()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, totals = {}, {}
        for part in slices(batches):
            langs = part.column("lang")
            for name in pc.unique(langs).to_pylist():
                counter, total = words.setdefault(name, Counter()), totals.setdefault(name, np.zeros(width))
                for found in words_of(part.filter(pc.equal(langs, name))):
                    counter.update(found)
                if len(counter) > WORDS_KEPT:
                    add(counter, total)
        for name, total in totals.items():
            if words[name]:
                add(words[name], total)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at].astype(np.int64))],
                                             names=["lang", "bucket", "n"])

    table = (rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket")
             .agg(F.sum("n").alias("n")).toArrow())
    names = table.column("lang").to_pylist()
    langs = sorted(set(names))
    place = {name: i for i, name in enumerate(langs)}
    at, bucket, n = np.array([place[x] for x in names], int), table.column("bucket").to_numpy().astype(int), table.column("n").to_numpy()
    full = np.zeros((len(langs), width))
    full[at, bucket] = n
    counts, scripts = full[:, :buckets], full[:, buckets:]
    return Model(langs, counts, scripts, penalty)


def identify(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: key, ``lang_pred``, ``score`` and ``spans`` of words with one language.

    ``und`` with score 0 and no span for null texts, texts without letters and empty models.
    """
    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)
    span_type = pa.list_(pa.struct([("lang", pa.string()), ("start_word", pa.int32()), ("words", pa.int32())]))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, Words(shared.value)
        langs = model.langs
        for part in slices(batches, limit=8 << 20):
            if len(known) > WORDS_KEPT:
                known = Words(model)
            words = words_of(part)
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            starts = np.cumsum(lengths) - lengths
            rows = np.fromiter((known[w] for doc in words for w in doc), np.int64, int(lengths.sum()))
            known.settle()
            pred, share, spans = [UNKNOWN] * len(words), np.zeros(len(words)), [[] for _ in words]
            if langs and len(rows):
                full = np.flatnonzero(lengths)
                labels = best_paths(known.scores[rows], starts[full], lengths[full], model.penalty).astype(np.int64)
                letters = known.letters[rows].astype(np.float64)
                doc = np.repeat(np.arange(len(words)), lengths)
                sums = np.bincount(doc * len(langs) + labels, letters, len(words) * len(langs)).reshape(-1, len(langs))
                total, top = sums.sum(axis=1), sums.argmax(axis=1)
                changed = np.flatnonzero(np.r_[True, (labels[1:] != labels[:-1]) | (doc[1:] != doc[:-1])])
                for a, b in zip(changed, np.r_[changed[1:], len(labels)]):
                    if total[doc[a]]:
                        spans[doc[a]].append({"lang": langs[labels[a]], "start_word": int(a - starts[doc[a]]), "words": int(b - a)})
                for i in np.flatnonzero(total):
                    pred[i], share[i] = langs[top[i]], sums[i, top[i]] / total[i]
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(pred, pa.string()), pa.array(share), pa.array(spans, span_type)],
                                             names=["key", "lang_pred", "score", "spans"])

    kind = narrow.schema["key"].dataType.simpleString()
    return narrow.mapInArrow(label, f"key {kind}, lang_pred string, score double, spans array<{SPAN}>").withColumnRenamed("key", key)
