"""Secrets in texts: fixed patterns, and windows of high entropy in candidate strings.

A candidate is a run of key characters. A window slides along it while the counts of its
characters, and with them the sum of c*log2(c), are updated by one character in and one out.
Each character class has its own threshold. Windows above it are joined into spans. What an
allow-list pattern matches as a whole is left alone; spans of the fixed patterns always stay.

Null and empty texts have no spans; a very long text is scanned whole, a slice of its own. Repeated
rows give repeated results, columns other than the key and the text are not read, and an empty table
gives none. Where spans of two kinds start together, they keep the order of the kinds. Offsets are
code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, texts_of

#: Kinds in the order that breaks ties of position.
KINDS = ("assign", "access", "hex", "entropy")
BASE_KINDS = KINDS[:3]
#: The patterns of the contract. Runs are matched as a whole from their start.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

WINDOW = 20
#: Bits per character that a window must reach, by class.
THRESHOLDS = {"hex": 3.0, "mixed": 3.8, "lower": 3.6, "letters": 3.8}
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
#: Strings that look random and are no secrets: UUIDs, dates, paths of plain words, repeats.
ALLOW = (
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    r"\d{4}-\d\d-\d\d[T_-]?[\d_-]*Z?",
    r"/?(?:[A-Z]?[a-z]+|[A-Z]+|\d+)(?:[/_=-]+(?:[A-Z]?[a-z]+|[A-Z]+|\d+))*[/=]*",
)
#: Words as identifiers join them. Runs of both cases whose words have so many letters on average are names.
NAME_WORD = re.compile("[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
NAME_LETTERS = 3.75

SPAN = "struct<kind:string,start:int,end:int,secret_start:int>"
SPANS_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                 ("secret_start", pa.int32())]))


def character_class(run: str) -> str | None:
    """Class whose threshold holds; None for digits alone, letters of one case alone, and names such as ``someValueOfThat``."""
    digits, small, capital = (re.search(c, run) for c in (r"\d", "[a-z]", "[A-Z]"))
    if small and capital:
        words = NAME_WORD.findall(run)
        if words and sum(map(len, words)) >= NAME_LETTERS * len(words):
            return None
        return "mixed" if digits else "letters"
    if not (digits and (small or capital)):
        return None
    return "hex" if re.fullmatch("[0-9a-f]+|[0-9A-F]+", run) else "lower"


def entropy_spans(run: str, window: int = WINDOW, threshold: float = 3.8) -> list[tuple[int, int]]:
    """Joined windows of ``run`` whose Shannon entropy reaches ``threshold`` bits."""
    if len(run) < window:
        return []
    term = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, found, enough = 0.0, [], window * (math.log2(window) - threshold) + 1e-9
    for i, char in enumerate(run):
        c = counts.get(char, 0)
        total += term[c + 1] - term[c]
        counts[char] = c + 1
        if i >= window:
            old = run[i - window]
            c = counts[old]
            total += term[c - 1] - term[c]
            counts[old] = c - 1
        if i >= window - 1 and total <= enough:
            start = i - window + 1
            if found and start <= found[-1][1]:
                found[-1][1] = i + 1
            else:
                found.append([start, i + 1])
    return [tuple(x) for x in found]


def find_spans(text: str, allow: re.Pattern, window: int, thresholds: dict[str, float]) -> list[tuple]:
    spans = []
    lower = text.lower()
    if any(hint in lower for hint in ASSIGN_HINTS):
        spans += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    for m in CANDIDATE.finditer(text):
        kind = character_class(m[0])
        if kind and not allow.fullmatch(m[0]):
            spans += [("entropy", m.start() + a, m.start() + b, m.start() + a)
                      for a, b in entropy_spans(m[0], window, thresholds[kind])]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def find_secrets(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                 thresholds: dict[str, float] | None = None, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """One row per row of ``df``: its key and ``spans`` of kind, start, end and start of the secret part.

    Repeated rows give repeated results; other columns are not read.
    """
    limits = THRESHOLDS | (thresholds or {})
    listed = re.compile("|".join(f"(?:{a})" for a in allow) or r"(?!)")
    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = pa.schema([("spans", SPANS_TYPE)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            spans = [[dict(zip(("kind", "start", "end", "secret_start"), s)) for s in
                      find_spans(t, listed, window, limits)] for t in texts_of(part)]
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(spans, schema.field(0).type)],
                                             names=["key", "spans"])

    kind = narrow.schema["key"].dataType.simpleString()
    return narrow.mapInArrow(scan, f"key {kind}, spans array<{SPAN}>").withColumnRenamed("key", key)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the fixed kinds, a digest of their spans, and all spans as text."""
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(key, *[count(k) for k in BASE_KINDS],
                        F.sha2(written(base), 256).alias("base_sha256"), written("spans").alias("spans"))


def redact(df: DataFrame, text: str = "text", mark: str = "<SECRET>", **options) -> DataFrame:
    """``df`` with the secret parts of ``text`` replaced by ``mark``; every row and column stays.

    A text without secrets, and a null, stay as they are. ``n_chars`` follows where it exists.
    """
    limits = THRESHOLDS | (options.get("thresholds") or {})
    window = options.get("window", WINDOW)
    listed = re.compile("|".join(f"(?:{a})" for a in options.get("allow", ALLOW)) or r"(?!)")

    def clean(value: str) -> str:
        pieces, at = [], 0
        cuts = sorted((s[3], s[2]) for s in find_spans(value, listed, window, limits))
        for start, end in cuts:
            if end <= at:
                continue
            if start >= at and not (at and start == at):
                pieces += [value[at:start], mark]
            at = end
        return "".join([*pieces, value[at:]]) if cuts else value

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            at = part.schema.get_field_index(text)
            new = [None if t is None else clean(t) for t in part.column(at).to_pylist()]
            yield part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type))

    cleaned = df.mapInArrow(scan, df.schema)
    if "n_chars" in df.columns:
        cleaned = cleaned.withColumn("n_chars", F.length(text).cast(df.schema["n_chars"].dataType))
    return cleaned.select(df.columns)
