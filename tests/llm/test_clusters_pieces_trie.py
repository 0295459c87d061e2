"""Clusters by the threshold algorithm, pieces by merge rounds and the prefix trie, against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import sentencepiece

from oracle_check import compare, connect
from tidemark.llm import centroids, pieces, queries, trie

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    rows, difference = compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE[name])
    assert difference is None and rows > 0


# --- clusters -------------------------------------------------------------------------------

def plain_clusters(rows, k, rounds, scale):
    """Integers of any size, every distance, floor means; rows of (id, vector) that take part."""
    whole = [(i, [math.floor(int(x) * scale if abs(x) > 2**52 else x * scale) for x in v], v) for i, v in rows]
    first = sorted((r for r in whole if r[0] is not None),
                   key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[2]))[:k]
    cents = [r[1] for r in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        mine = defaultdict(list)
        for _, v, _ in whole:
            mine[nearest(v)[1]].append(v)
        cents = [[sum(col) // len(mine[n]) for col in zip(*mine[n])] if mine[n] else c for n, c in enumerate(cents)]
    found = [(i, *nearest(v)[::-1]) for i, v, _ in whole]
    inertia = defaultdict(int)
    for _, n, s in found:
        inertia[n] += s

    def held(x):
        return x if x < 2**63 else None

    over = {n for _, n, s in found if s >= 2**63}
    return sorted(((i, n, held(s), None if n in over else held(inertia[n]), None if over else held(sum(inertia.values())),
                    hashlib.sha256(",".join(map(str, cents[n])).encode()).hexdigest()) for i, n, s in found), key=repr)


def test_threshold_walk_finds_what_all_distances_give():
    rng = np.random.default_rng(3)
    for k, dims, top in ((1, 3, 5), (5, 2, 3), (40, 3, 50), (40, 9, 2), (7, 64, 4000)):
        cents = rng.integers(-top, top, (k, dims))
        block = rng.integers(-top, top, (300, dims))
        every = ((block[:, None, :] - cents) ** 2).sum(axis=2)
        for kind in (np.int64, object):
            who, away = centroids.nearest(block.astype(kind), cents.astype(kind))
            assert who.tolist() == every.argmin(axis=1).tolist() and away.tolist() == every.min(axis=1).tolist()


def test_walk_leaves_far_centroids_unread(monkeypatch):
    """Well separated centroids end the walk after the first entry of each list."""
    reads = []
    put = np.put_along_axis
    monkeypatch.setattr(np, "put_along_axis", lambda met, read, *a, **b: (reads.append(read.shape), put(met, read, *a, **b)))
    cents = np.arange(100)[:, None] * np.full(4, 1000)
    who, _ = centroids.nearest(cents + 7, cents)
    assert who.tolist() == list(range(100)) and len(reads) == 2


SCHEMA = "label int, vec_id long, embedding array<double>, cluster string"


@pytest.mark.parametrize("big", [False, True])
def test_awkward_vectors(spark, big):
    rng = random.Random(5)
    good = [(i, [rng.choice([-1.5, 0.0, 0.25, 1 / 3, 2.0]) for _ in range(3)]) for i in range(40)]
    good += [good[4]] * 30 + [(4, [9.0, 9.0, 9.0]), (None, [1.0, 1.0, 1.0]), (41, good[3][1])]
    if big:
        good += [(50, [1e300, -1e300, 0.0]), (51, [3e7, 2.5, 1.0]), (52, [-3e7, 1e18, 5.0])]
    bad = [(60, None), (61, [1.0, 2.0]), (62, [1.0, None, 2.0]), (63, [1.0, float("nan"), 2.0]),
           (64, [float("inf"), 1.0, 1.0]), (65, [])]
    df = spark.createDataFrame([(1, i, v, "x") for i, v in good + bad], SCHEMA).repartition(5)
    found = centroids.cluster(df, k=6, rounds=3, dims=3)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_clusters(good, 6, 3, 1024)


def test_few_or_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert centroids.cluster(empty, dims=3).collect() == []
    nameless = spark.createDataFrame([(1, None, [1.0, 2.0, 3.0], "x")], SCHEMA)
    assert [tuple(r) for r in centroids.cluster(nameless, dims=3).collect()] == [(None,) * 6]
    two = spark.createDataFrame([(1, 1, [1.0, 2.0, 3.0], "x"), (1, 2, [1.0, 2.0, 3.0], "x")], SCHEMA)
    assert sorted(r.cluster for r in centroids.cluster(two, dims=3).collect()) == [0, 0]


# --- pieces ---------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


def ids_of(texts):
    model = pieces.load(pieces.default_model())
    return [x.tolist() for x in pieces.with_ends(model, *model.encode(texts))]


def awkward_texts():
    rng = random.Random(7)
    letters = "abcdehilnorstéü ▁.,'<>0123ABC中🎉\n\t\x00"
    texts = ["", " ", "   ", "a", "  a  b ", "▁", "▁▁ a▁b", "<s> </s> <unk> <0x0A>", "日本語🎉🎉", "é" * 50, "a" * 333,
             " " * 300 + "x" + " " * 50, "hahaha abababab", "\U0001F468‍", "\r\n", "a" * 20_000 + " b" * 20_000]
    texts += ["".join(rng.choice(letters[:rng.randint(2, len(letters))]) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    model = pieces.load(pieces.default_model())
    texts += ["".join(model.surface[rng.randint(259, 31999)].decode() for _ in range(rng.randint(1, 12))) for _ in range(2000)]
    return texts + ["".join(rng.choice("etaoinshrdlu") for _ in range(30_000))]


def test_ids_and_texts_are_the_library_s(library):
    texts = awkward_texts()
    expected = library.encode(texts, add_bos=True, add_eos=True)
    assert ids_of(texts) == expected
    model = pieces.load(pieces.default_model())
    assert [model.decode(x) for x in expected] == library.decode(expected)


def test_any_ids_decode_as_in_the_library(library):
    rng = random.Random(11)
    model = pieces.load(pieces.default_model())
    for top in (300, 700, 32_000):
        ids = [[rng.randrange(top) for _ in range(rng.randint(0, 12))] for _ in range(2000)]
        assert [model.decode(x) for x in ids] == [library.decode(x) if x else "" for x in ids]


class _Small(pieces.Model):
    """A vocabulary of a few pieces, in which later merges may beat the one that made them possible."""

    def __init__(self, words):
        self.order = {w: n for n, w in enumerate(words)}
        pairs = [(self.order[w[:k]], self.order[w[k:]], n, n) for w, n in self.order.items()
                 for k in range(1, len(w)) if w[:k] in self.order and w[k:] in self.order]
        self.pairs = pieces.Pairs(*np.array(pairs, np.int32).reshape(-1, 4).T, len(words))


def one_at_a_time(model, word):
    parts = list(word)
    while True:
        best = min(((model.order[a + b], n) for n, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in model.order), default=None)
        if best is None:
            return [model.order[p] for p in parts]
        parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


def test_simultaneous_merges_equal_one_at_a_time():
    rng = random.Random(13)
    for _ in range(300):
        longer = {"".join(rng.choice("ab") for _ in range(rng.randint(2, 5))) for _ in range(6)}
        words = sorted(longer) + ["a", "b"]
        rng.shuffle(words)
        model = _Small(words)
        tests = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 25))) for _ in range(20)]
        out = np.array([model.order[c] for w in tests for c in w], np.int32)
        alive = np.ones(len(out), bool)
        word = np.repeat(np.arange(len(tests), dtype=np.int32), [len(w) for w in tests])
        model._rounds(out, alive, word)
        got = [out[alive & (word == n)].tolist() for n in range(len(tests))]
        assert got == [one_at_a_time(model, w) for w in tests]


def test_awkward_documents(spark, library):
    long = "wörter und mehr " * 400_000
    rows = [(1, "a b", "x", 9), (1, "a b", "x", 9), (2, None, None, None), (None, "", "y", 1), (3, long, "z", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, n_tokens int")
    found = pieces.round_trip(docs, pieces.default_model()).collect()
    assert len(found) == 5
    for r in found:
        text = {1: "a b", 3: long}.get(r.doc_id, "")
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert pieces.round_trip(docs.limit(0), pieces.default_model()).collect() == []
    back = pieces.decode_ids(pieces.encode_texts(docs.where("doc_id < 3"), pieces.default_model()), pieces.default_model())
    assert back.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    assert sorted((r.text or "", r.decoded) for r in back.collect()) == [("", ""), ("a b", "a b"), ("a b", "a b")]


def test_query_equals_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.op12_pieces(spark, SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest())


# --- trie -----------------------------------------------------------------------------------

def plain_trie(rows):
    """The trie from its definition, with sets of members and sums over all pairs of prefix and node."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in sorted(built.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1]) if node else 0
    return sorted((m[0], len(node), members[node[:-1]][0] if node else None, len(m), kids.get(node, 0), leaves[node], saved[node],
                   hashlib.sha256(",".join(str(c) for c in m if len(built[c]) == len(node)).encode()).hexdigest())
                  for node, m in members.items())


TURNS = "conv_id long, turn long, role string, text string, depth int, key binary"


def nodes_of(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, 1, b"x") for r in rows], TURNS).repartition(4)
    out = trie.prefix_trie(df, **sizes).drop("key", "parent")
    return sorted(tuple(r) for r in out.collect())


def talks(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(-3, 130), 1000, 1001, 1007, 2055]:
        if rng.random() < 0.2:
            continue
        for turn in range(rng.choice([1, 2, 3, 7, 12])):
            rows.append((conv, turn, rng.choice(["user", "assistant"]) if turn > 2 else "user", rng.choice("ab") if turn % 3 else "hé🎉"))
    rows += [(7, None, None, None), (7, 3, "user", "tie"), (7, 3, "user", "tie"), (7, 3, None, "tie"), (None, 1, "user", "x"),
             (2055, 5, "user", ""), (500, 0, "user", "x" * 300_000)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 4, "chunk": 2, "queue_items": 3, "block_ids": 2},
                                   {"shard_rows": 30, "chunk": 3, "queue_items": 1, "block_ids": 1}])
def test_trie_equals_definition(spark, sizes):
    rows = talks(1)
    assert nodes_of(spark, rows, **sizes) == plain_trie(rows)


def test_hot_first_turn_conversation_and_key(spark):
    """A first turn that all share, one conversation that most are copies of, and one very long one."""
    rows = [(c, t, "user", "same") for c in range(0, 260) for t in range(3 + (c % 7 == 0))]
    rows += [(999, t, "user", f"t{t}") for t in range(400)] + [(1000, t, "user", "same") for t in range(200)]
    assert nodes_of(spark, rows, shard_rows=50, chunk=8, queue_items=5, block_ids=16) == plain_trie(rows)


def test_empty_and_turnless(spark):
    assert nodes_of(spark, []) == []
    assert nodes_of(spark, [(None, 1, "a", "b")]) == []
    rows = [(c, 0, "user", "x") for c in range(1, 40)]
    assert nodes_of(spark, rows) == plain_trie(rows)


def test_queue_gives_items_in_order():
    rng = random.Random(2)
    items = [(rng.randrange(50), bytes([rng.randrange(4)]), n, n) for n in range(500)]
    queue, out = trie.SpillingQueue(7), []
    for n, item in enumerate(items):
        queue.push(item)
        if n % 3 == 0:
            out.append(queue.pop())
    while queue.peek():
        out.append(queue.pop())
    assert sorted(out) == sorted(items) and out[167:] == sorted(out[167:]) and queue.files
