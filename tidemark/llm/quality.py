"""Quality by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Every rule looks at counts of one text and votes good (1), bad (-1) or abstains (0). Texts with
equal votes are alike to the model, so EM runs on the counts of vote patterns: 3 ** rules at
most, whatever the number of texts. It estimates how often each rule that votes is right about
good and about bad texts, and the share of good ones. A text is kept if its posterior
probability of being good is at least one half.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import durable, slices

#: Symbols, and limits of the base rule.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEATED = 10, 20
GRAM = 5
#: An ASCII letter, or a byte of any other character.
LETTER = re.compile(rb"[A-Za-z\x80-\xff]")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_letter_words", "n_distinct", "n_ended_lines")
#: Accuracies stay on the right side of chance, so that the two classes can't change names.
LEAST, MOST = 0.55, 0.99


def repeated_words(words: list[bytes], size: int = GRAM) -> int:
    """Words that lie in a window of ``size`` words found twice or more in the text."""
    grams = list(zip(*(words[i:] for i in range(size))))
    distinct = set(grams)
    if len(distinct) == len(grams):
        return 0
    often = {g for g, n in Counter(grams).items() if n > 1}
    covered, end = 0, 0
    for i, gram in enumerate(grams):
        if gram in often:
            covered += i + size - max(i, end)
            end = i + size
    return covered


def count_text(text: bytes | None) -> tuple[int, ...]:
    """The values named in COUNTS, of a text in UTF-8; zeros for a null."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.split()
    seen, lines, copies, ended = set(), 0, 0, 0
    for line in text.split(b"\n"):
        end = line.rstrip()
        if end:
            lines += 1
            ended += end[-1:] in b".!?:;\"'"
            copies += line in seen
            seen.add(line)
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))
    distinct = set(words)
    bare = {w for w in distinct if not LETTER.search(w)}
    plain = len(words) - (sum(w in bare for w in words) if bare else 0)
    return (len(words), chars, sum(text.count(bytes([c])) for c in SYMBOLS), copies,
            repeated_words(words), lines, plain, len(distinct), ended)


def count_texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of counts per row of ``df``; repeated rows repeat, null texts count as empty."""
    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = [count_text(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
            table = np.array(rows, np.int64).reshape(len(rows), len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), *(pa.array(np.ascontiguousarray(table[:, i])) for i in range(len(COUNTS)))],
                names=["key", *COUNTS])

    kind = narrow.schema["key"].dataType.simpleString()
    columns = ", ".join(f"{c} long" for c in COUNTS)
    return narrow.mapInArrow(scan, f"key {kind}, {columns}").withColumnRenamed("key", key)


def vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("byte")


def rules() -> dict[str, Column]:
    """Votes on the columns of COUNTS; ratios of nothing abstain.

    Most rules notice faults only: where a fault is rare, its absence says little.
    """
    words, lines = F.col("n_words"), F.col("n_lines")

    def share(part: str, whole: Column) -> Column:
        return F.coalesce(F.col(part) / F.when(whole > 0, whole), F.lit(-1.0))

    never = F.lit(False)
    length, letters = share("word_chars", words), share("n_letter_words", words)
    symbols, marked = share("n_symbols", words), share("n_symbols", F.col("word_chars"))
    copied, repeated = share("n_dup_lines", lines), share("n_repeat_words", words)
    ended, variety = share("n_ended_lines", lines), share("n_distinct", F.sqrt(words))
    return {
        "length": vote(never, words < 20),
        "word_length": vote(never, length.between(0.0, 2.0) | (length > 20.0)),
        "symbols": vote(symbols.between(0.0, 0.02), symbols > 0.1),
        "marked_words": vote(marked.between(0.0, 0.005), marked > 0.03),
        "letters": vote(letters >= 0.9, letters.between(0.0, 0.7)),
        "copied_lines": vote(never, (lines >= 4) & (copied > 0.3)),
        "repeated_words": vote(never, repeated > 0.15),
        "ended_lines": vote(ended >= 0.6, (lines >= 3) & ended.between(0.0, 0.1)),
        "variety": vote(never, (words >= 30) & variety.between(0.0, 2.0)),
    }


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of good texts, and each rule's accuracy on good and on bad ones, by EM.

    ``patterns`` holds votes, one row per pattern; ``counts`` how many texts have it. Accuracies
    start at 0.8 and carry a prior worth a hundredth of the texts.
    """
    good, bad = patterns > 0, patterns < 0
    total, n = float(counts.sum()), patterns.shape[1]
    prior, right_good, right_bad = 0.8, np.full(n, 0.8), np.full(n, 0.8)
    weight = 0.01 * total + 1.0
    for _ in range(rounds):
        p = posterior(patterns, prior, right_good, right_bad) * counts
        q = counts - p
        share = min(max(p.sum() / total, 0.05), 0.99) if total else 0.8
        new_good = np.clip((p @ good + 0.8 * weight) / (p @ (good | bad) + weight), LEAST, MOST)
        new_bad = np.clip((q @ bad + 0.8 * weight) / (q @ (good | bad) + weight), LEAST, MOST)
        moved = max(abs(share - prior), np.abs(new_good - right_good).max(initial=0), np.abs(new_bad - right_bad).max(initial=0))
        prior, right_good, right_bad = share, new_good, new_bad
        if moved < 1e-9:
            break
    return prior, right_good, right_bad


def posterior(patterns: np.ndarray, prior: float, right_good: np.ndarray, right_bad: np.ndarray) -> np.ndarray:
    """Probability of good for each row of votes."""
    for_good, for_bad = evidence(right_good, right_bad)
    odds = math.log(prior / (1 - prior)) + (patterns > 0) @ for_good + (patterns < 0) @ for_bad
    return 1 / (1 + np.exp(-odds))


def evidence(right_good: np.ndarray, right_bad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of good that a vote for good and a vote for bad add."""
    return np.log(right_good / (1 - right_bad)), np.log((1 - right_good) / right_bad)


def judge_quality(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, the base verdict, ``quality`` (posterior) and ``kept`` for each row of ``df``.

    The counts are written to the shared folder once, since both the fit and the verdict read
    them. An empty table gives no rows. A base failure is never kept.
    """
    counted = durable(count_texts(df, key, text))
    votes = rules()
    rows = counted.select(*[c.alias(n) for n, c in votes.items()]).groupBy(*votes).count().orderBy(*votes).collect()
    table = np.array([tuple(r) for r in rows], float).reshape(len(rows), len(votes) + 1)
    prior, right_good, right_bad = fit(table[:, :-1], table[:, -1])
    for_good, for_bad = evidence(right_good, right_bad)
    odds = F.lit(math.log(prior / (1 - prior)))
    for (name, ballot), g, b in zip(votes.items(), for_good, for_bad):
        odds = odds + F.when(ballot > 0, float(g)).when(ballot < 0, float(b)).otherwise(0.0)
    words = F.col("n_words")
    failed = (words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * words)
    return (counted.withColumn("base_failed", failed).withColumn("quality", 1 / (1 + F.exp(-odds)))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)))
