"""Scalar and aggregate column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the form of the ids.
UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_millis(ts: str | Column) -> Column:
    return F.unix_millis(col(ts).cast("timestamp"))


def epoch_micros(ts: str | Column) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def from_epoch_millis(ms: str | Column) -> Column:
    return F.timestamp_millis(col(ms).cast("long"))


def seconds(n: float | int | Column) -> Column:
    """Day-time interval of ``n`` seconds; keeps a zone-less timestamp zone-less.

    A number becomes a literal, which stream joins need to derive their watermark.
    """
    if isinstance(n, Column):
        return F.make_dt_interval(secs=n.cast("decimal(18,6)"))
    return F.expr(f"INTERVAL '{n}' SECOND")


def parse_iso(text: str | Column) -> Column:
    """ISO local date-time text to a zone-less timestamp; null when malformed."""
    return col(text).try_cast("timestamp_ntz")


def iso_text(ts: str | Column) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def short_id(prefix: str, source: str | Column | None = None) -> Column:
    """``ORD-1A2B3C4D``: prefix and eight upper-cased hex digits.

    Without ``source`` the digits are random; with it they are a digest of the
    source, so a re-run task produces the same id.
    """
    digits = F.uuid() if source is None else F.md5(col(source).cast("string"))
    return F.concat(F.lit(prefix + "-"), F.upper(F.substring(digits, 1, 8)))


def is_uuid(text: str | Column) -> Column:
    """Whether the text is a UUID in lower case."""
    return col(text).rlike(UUID_PATTERN)


def item_list(items: str | Column) -> Column:
    """Comma-separated text to an array of trimmed names."""
    return F.transform(F.split(col(items), ","), lambda s: F.trim(s))


def content_hash(body: str | Column) -> Column:
    return F.sha2(col(body), 256)


def dedup_id(explicit: str | Column | None, body: str | Column) -> Column:
    """An explicit deduplication id wins over the hash of the body."""
    hashed = content_hash(body)
    return hashed if explicit is None else F.coalesce(col(explicit), hashed)


def topic_regex(pattern: str | Column) -> Column:
    """Anchored regex for a wildcard binding key.

    Every word of the subject is expected to be followed by a dot (see
    ``topic_subject``), so ``*`` is one word and ``#`` any number of them.
    """
    def word(w: Column) -> Column:
        return (F.when(w == "*", r"[^.]*\.")
                .when(w == "#", r"([^.]*\.)*")
                .otherwise(F.concat(F.lit(r"\Q"), w, F.lit(r"\E\."))))

    words = F.transform(F.split(col(pattern), r"\."), word)
    return F.concat(F.lit("^"), F.array_join(words, ""), F.lit("$"))


def topic_subject(routing_key: str | Column) -> Column:
    key = col(routing_key)
    return F.when(key == "", "").otherwise(F.concat(key, F.lit(".")))


# --- framed records: one zero byte, a four-byte schema id, then the body ---------------

def frame_schema_id(value: str | Column) -> Column:
    """Schema id of a framed record; null when the lead byte or length is wrong."""
    v = col(value)
    ok = (F.length(v) >= 5) & (F.hex(F.substring(v, 1, 1)) == "00")
    return F.when(ok, F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("long"))


def frame_body(value: str | Column) -> Column:
    v = col(value)
    return F.when(F.length(v) >= 5, v.substr(F.lit(6), F.length(v) - 5))


def frame(body: str | Column, schema_id: int | Column) -> Column:
    sid = schema_id if isinstance(schema_id, Column) else F.lit(schema_id)
    head = F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(sid.cast("long")), 8, "0")))
    return F.concat(head, col(body).cast("binary"))
