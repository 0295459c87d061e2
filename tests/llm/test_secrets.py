"""Planted secrets and names that look like them; long texts and odd tables."""

import hashlib
import random
import re
import string

from tidemark.llm import common, secrets

ALLOWED = re.compile("|".join(f"(?:{a})" for a in secrets.ALLOW))
WORDS = "get user account by identifier value order total of payment last index table list make current from with status time".split()
ROWS = "doc_id long, text string, spans string, key string"


def spans(text):
    return secrets.find_spans(text, ALLOWED, secrets.WINDOW, secrets.THRESHOLDS)


def names(rng, n):
    for _ in range(n):
        w = [rng.choice(WORDS) for _ in range(rng.randrange(5, 9))]
        yield rng.choice([w[0] + "".join(x.capitalize() for x in w[1:]) + str(rng.randrange(3000)), "_".join(w), "-".join(w).upper(),
                          "/" + "/".join(w) + "/" + str(rng.randrange(99)), "".join(x.capitalize() for x in w)])


def test_planted_secrets_and_names():
    rng = random.Random(11)
    planted = {"base62": string.ascii_letters + string.digits, "letters": string.ascii_letters, "hex": "0123456789abcdef",
               "base36": string.ascii_lowercase + string.digits}
    for kind, alphabet in planted.items():
        size = 31 if kind == "hex" else 32
        hits = [bool(spans("take " + "".join(rng.choice(alphabet) for _ in range(size)) + " home")) for _ in range(400)]
        assert sum(hits) >= 0.95 * len(hits), kind
    wrong = [n for n in names(rng, 1000) if spans(f"see {n} there")]
    assert len(wrong) <= 10


def test_letters_and_joined_parts():
    assert [s[0] for s in spans("x QwErTyUiOpAsDfGhJkLzXcVbNm y")] == ["entropy"]
    assert [s[0] for s in spans("x AbXqZrTv-48213907-KwMnPyLc y")] == ["entropy"]
    for name in ("getUserAccountByIdentifier2024Value", "a/path/to/some/file/name/only", "SOME_CONSTANT_OF_THE_LIBRARY", "2024-01-02T10-20-30Z"):
        assert not spans(f"x {name} y")


def test_the_entropy_windows_decide(spark):
    """Without its windows the operator finds nothing here."""
    text = "key k9Xq2Lm8Zr4Tn6Vb1Wc3Yp5 end"
    df = spark.createDataFrame([(1, text, "s", "k")], ROWS)
    assert secrets.find_secrets(df).first()["spans"]
    assert not secrets.find_secrets(df, thresholds={k: 9.0 for k in secrets.THRESHOLDS}).first()["spans"]


def test_long_texts_repeats_and_odd_tables(spark):
    """A text longer than a slice is scanned to its end; spans are compared with patterns written here."""
    tail = " api_key='Zm9vYmFyLXNlY3JldA==' AKIA0123456789ABCD " + "0123456789abcdef" * 2
    long = "lorem ipsum é " * (common.SLICE_BYTES // 14) + tail
    rows = [(1, long, "x", "k"), (2, None, "x", "k"), (3, "", "x", "k"), (3, "", "x", "k"), (None, "passwd:abcdefgh", None, None)]
    df = spark.createDataFrame(rows, ROWS)
    got = sorted((tuple(r) for r in secrets.digest(secrets.find_secrets(df)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256").collect()), key=repr)
    start = len(long) - len(tail)
    base = []
    for kind, found in (("assign", re.search("api_key='([A-Za-z0-9=]+)", tail)), ("access", re.search("AKIA[A-Z0-9]+", tail)), ("hex", re.search("(0123456789abcdef){2}", tail))):
        base.append(f"{kind}:{start + found.start()}:{start + found.end()}")
    none = hashlib.sha256(b"").hexdigest()
    want = [(1, 1, 1, 1, hashlib.sha256(",".join(base).encode()).hexdigest()), (2, 0, 0, 0, none), (3, 0, 0, 0, none), (3, 0, 0, 0, none),
            (None, 1, 0, 0, hashlib.sha256(b"assign:0:15").hexdigest())]
    assert got == sorted(want, key=repr)
    masked = secrets.redact(df)
    assert masked.columns == df.columns and masked.count() == 5 and not masked.where("text LIKE '%AKIA0%'").count()
    assert secrets.find_secrets(df.limit(0)).count() == 0
