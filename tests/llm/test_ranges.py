"""Neighbours of vectors of any length, and token totals against the tokenizers themselves."""

from __future__ import annotations

import base64
import collections

import numpy as np
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import ann, queries, token_rollup

SF = "/root/testdata/sf0.001"


def wide_best(ids, vectors, q, k=20):
    """By products in extended precision, rounded to doubles: what double precision can hold of them."""
    with np.errstate(over="ignore", under="ignore"):
        score = (vectors.astype(np.longdouble) @ vectors[q].astype(np.longdouble)).astype(float)
    score[q] = -np.inf
    return set(ids[np.lexsort((ids, -score))[:k]].tolist())


@pytest.mark.parametrize("sizes", [(1e-200,), (1e-160,), (1e-20,), (1e25,), (1e150,), (1e200,), (1e300,), (1e-200, 1.0, 1e140), (5e-324, 1e308)])
def test_recall_at_any_length(spark, sizes):
    rng = np.random.default_rng(21)
    vectors = rng.normal(size=(1500, 24))
    vectors = np.clip(vectors / np.abs(vectors).max(), -1, 1) * rng.choice(sizes, 1500)[:, None]
    vectors[np.abs(vectors).sum(axis=1) == 0, 0] = 5e-324
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = collections.defaultdict(set)
    for r in ann.search(df).collect():
        found[r["query_id"]].add(r["vec_id"])
    assert all(len(found[q]) == 20 for q in range(0, 1500, 20))
    hits = sum(len(found[q] & wide_best(np.arange(1500), vectors, q)) for q in range(0, 1500, 20))
    assert hits >= 0.99 * 75 * 20


def test_rollup_equals_tokenizers(spark):
    paths = token_rollup.default_vocabularies()
    slow = Tokenizer.from_file(paths["byte_bpe_50k"])
    slow.encode_special_tokens = True
    import public_tokenizers

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(paths["byte_bpe_multi_50k"], "rb"))}
    multi = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = collections.Counter(), collections.Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for name, n in (("byte_bpe_50k", len(slow.encode(r.text or "", add_special_tokens=False).ids)),
                        ("byte_bpe_multi_50k", len(multi.encode_ordinary(r.text or "")))):
            want[0][r.source, r.lang, name] += 1
            want[1][r.source, r.lang, name] += n
    found = {tuple(r[:3]): (r.docs, r.tokens) for r in queries.op2_token_counts(spark, SF).collect()}
    assert found == {g: (want[0][g], want[1][g]) for g in want[0]}


def test_documents_without_tokens_source_or_language_count(spark):
    rows = [("s", "en", "a b"), ("s", "en", "a b"), (None, None, None), ("empty", "en", ""), ("empty", None, None)]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "source string, lang string, text string, before int, tokenizer string")
    counts = token_rollup.count_tokens(df, token_rollup.default_vocabularies())
    rollup = token_rollup.Rollup(spark, f"{token_rollup_folder(spark)}")
    rollup.commit("one", token_rollup.inserted(counts))
    rollup.commit("two", token_rollup.deleted(counts.where("tokens = 0")))
    assert {r.source for r in rollup.totals().collect()} == {"s"}
    rollup.commit("three", token_rollup.inserted(counts.where("tokens = 0")))
    totals = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.totals().collect()}
    assert len(totals) == 8 and totals["s", "en", "byte_bpe_50k"] == (2, 4) and totals[None, None, "byte_bpe_multi_50k"] == (1, 0)
    assert token_rollup.count_tokens(df.limit(0), token_rollup.default_vocabularies()).count() == 0


def token_rollup_folder(spark):
    from tidemark.session import scratch

    return scratch(spark)
