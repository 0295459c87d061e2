"""The training-data operators against brute force, on small fixtures with awkward rows."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, language, mixing, neardup, packing, quality, secrets, token_rollup, toxicity, warc
from tidemark.session import scratch

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long,"
          " size string, score string, key string, row string, place string")


def fruit(n: int, seed: int = 0) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(["apple", "pear", "plum", "fig", "kiwi", "lime", "nut", "date", "corn", "rye"], n) + rng.integers(0, 99, n).astype(str))


def table(spark, texts, sources=None):
    rows = [(i if t != "no id" else None, t, "en", (sources or ["a"])[i % len(sources or ["a"])], len(t or ""), "s", "c", "k", "r", "p")
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


AWKWARD = [None, "", " ", "\n\t", "one", "one", "no id", "no id", "déjà vu x", "<|endoftext|> text", "é" * 5000, "\U0001f600 word " * 300]


@pytest.fixture(scope="module")
def awkward(spark):
    return table(spark, AWKWARD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def near_classes(texts, least=0.8):
    sets = {}
    for i, t in enumerate(texts):
        w = (t or "").encode().split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= least:
            low, high = sorted((label[a], label[b]))
            label = {i: low if x == high else x for i, x in label.items()}
    return label


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    texts = [fruit(120, i) for i in range(20)]
    for i in range(160):
        words = texts[i % 20].split()
        for at in rng.integers(0, len(words), rng.integers(0, 6)):
            words[at] = f"new{rng.integers(1e9)}"
        texts.append(" ".join(words))
    texts += [None, "", "tiny text", "tiny text", texts[0], texts[0] + "\n"]
    for i in range(40):  # a passage that many share, and little else
        texts.append(fruit(60, 999) + " " + fruit(20, 2000 + i))
    found = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(table(spark, texts)).collect()}
    assert found == near_classes(texts)


def test_large_bands_meet_in_blocks(spark):
    base = fruit(100, 5).split()
    texts = []
    for i in range(300):
        words = list(base)
        for at in np.random.default_rng(i).choice(100, 3, replace=False):
            words[at] = f"w{i}x{at}"
        texts.append(" ".join(words))
    found = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(table(spark, texts)).collect()}
    assert found == near_classes(texts)


def test_signatures_estimate_weighted_similarity():
    a, b = np.arange(300, dtype=np.uint64), np.arange(100, 400, dtype=np.uint64)
    wa, wb = np.where(a < 200, 1.0, 2.5), np.where(b < 200, 1.0, 2.5)
    signs = neardup.signatures(neardup.mixed(np.r_[a, b] + neardup.GOLD), np.r_[wa, wb], np.r_[np.zeros(300, int), np.ones(300, int)], 2, 2000)
    shared = wa[100:].sum()
    true = shared / (wa.sum() + wb.sum() - shared)
    assert abs((signs[0] == signs[1]).mean() - true) < 0.05


def test_near_duplicates_of_bags_and_awkward_rows(spark, awkward, empty):
    rows = neardup.near_duplicates(awkward, weights="count").collect()
    assert len(rows) == len(AWKWARD)
    classes = {r["doc_id"]: r["class_id"] for r in rows if r["doc_id"] is not None}
    assert classes[4] == classes[5] == 4 and classes[0] == 0 and classes[1] == 1 and classes[2] == 2
    kept = neardup.keep_one(awkward)
    assert kept.columns == awkward.columns and kept.count() == len(AWKWARD) - 2
    assert neardup.near_duplicates(empty).count() == 0 == neardup.keep_one(empty).count()


def test_packing_round_trip(spark, awkward, empty):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(packing.default_vocabulary())
    df = awkward.where("doc_id IS NOT NULL").unionByName(table(spark, [fruit(700, i) for i in range(12)]).withColumn("doc_id", F.col("doc_id") + 100))
    want = {r["doc_id"]: slow.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in df.collect()}
    pieces = packing.pack(df, with_ids=True).collect()
    docs, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        docs[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append(p)
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes()) and p["length"] == len(p["ids"])
    assert {k: [i for p in sorted(v, key=lambda p: p["start"]) for i in p["ids"]] for k, v in docs.items()} == want
    for found in sequences.values():
        at = 0
        for p in sorted(found, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == 1024 or at & (at - 1) == 0
    assert packing.pack(empty).count() == 0


def test_hilbert_neighbours_touch():
    side = 8
    points = np.array(list(itertools.product(range(side), repeat=2)))
    keys = packing.hilbert_keys(points, bits=3)
    assert sorted(keys) == list(range(side * side))
    path = points[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_fill_is_exact_where_it_can_be():
    rng = np.random.default_rng(3)
    for _ in range(200):
        lengths = [(int(s), int(n)) for s, n in zip(rng.choice(np.arange(1, 40), 5, replace=False), rng.integers(1, 5, 5))]
        budget = int(rng.integers(0, sum(s * n for s, n in lengths) + 1))
        taken = mixing.fill(lengths, budget)
        assert all(0 <= taken.get(s, 0) <= n for s, n in lengths)
        sums = {sum(s * k for (s, _), k in zip(lengths, ks)) for ks in itertools.product(*(range(n + 1) for _, n in lengths))}
        best = min(budget - x for x in sums if x <= budget)
        assert abs(sum(s * k for s, k in taken.items()) - budget) <= best


def test_mixing(spark, awkward, empty):
    texts = [fruit(1 + i % 50, i) for i in range(400)]
    df = table(spark, texts, ["b", "a", None, "c", "a", "a"]).unionByName(awkward)
    rows = mixing.mix(df).collect()
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        name = None if r["no_source"] else r["source"]
        sizes[name] += r["size"]
        taken[name] += r["size"] * r["passes"]
        target[name] = r["target"]
        assert r["passes"] in (0, 1, 2) and (r["size"] or not r["passes"])
    order = sorted(k for k in sizes if k is not None) + [None]
    weight, full, left = dict(zip(order, itertools.cycle((3, 1, 2)))), {}, 1.5 * sum(sizes.values())
    while True:
        open_ = [k for k in order if k not in full]
        level = (left - sum(full.values())) / sum(weight[k] for k in open_)
        over = {k: 2.0 * sizes[k] for k in open_ if weight[k] * level > 2 * sizes[k]}
        if not over:
            break
        full |= over
    want = {k: full.get(k, weight[k] * level) for k in order}
    assert all(math.isclose(target[k], want[k]) and abs(taken[k] - want[k]) <= 2 for k in order)
    key = lambda rs: sorted((str(r["doc_id"]), r["size"], r["passes"]) for r in rs)
    assert key(rows) == key(mixing.mix(df.repartition(7)).collect())
    again = mixing.repeat(df)
    assert again.columns == df.columns and again.count() == sum(r["passes"] for r in rows)
    assert mixing.mix(empty).count() == 0 == mixing.repeat(empty).count()


def test_secrets_match_plain_patterns(spark, awkward, empty):
    texts = ["password = hunter2hunter2 and AKIA" + "A1B2C3D4E5F6G7H8", 'API-key api_key:"abcd/efgh+12=" x', "f" * 40 + " " + "0a" * 15, "Token= short ToKeN : 'longenough1'",
             "k9Xq2Lm8Zr4Tn6Vb1Wc3Yp5 plain", "123e4567-e89b-12d3-a456-426614174000", "a/path/to/some/file/name/only"]
    df = table(spark, texts).unionByName(awkward)
    found = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(df.where("doc_id < 7 AND size(split(text, ' ')) > 0").limit(7)).collect()}
    for i, t in enumerate(texts):
        base = [("assign", m.start(), m.end()) for m in re.finditer(secrets.ASSIGN.pattern, t, re.I | re.A) if len(m[2]) >= 8]
        base += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        base += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        assert sorted((s["kind"], s["start"], s["end"]) for s in found[i] if s["kind"] != "entropy") == sorted(base)
    assert [s["kind"] for s in found[4]] == ["entropy"] and not found[5] and not found[6]
    digest = {r["doc_id"]: r for r in secrets.digest(secrets.find_secrets(table(spark, texts))).collect()}
    assert digest[6]["base_sha256"] == hashlib.sha256(b"").hexdigest() and digest[0]["n_access"] == 1
    clean = secrets.redact(df)
    assert clean.columns == df.columns and clean.count() == df.count()
    assert not [r for r in clean.collect() if r["text"] and "hunter2" in r["text"]]
    assert secrets.find_secrets(empty).count() == 0 == secrets.redact(empty).count()


def test_sliding_entropy_equals_recount():
    rng = np.random.default_rng(4)
    for _ in range(50):
        run = "".join(rng.choice(list("abcdef0123456789"), 60))
        inside = set()
        for i in range(len(run) - 19):
            counts = collections.Counter(run[i:i + 20]).values()
            if -sum(c / 20 * math.log2(c / 20) for c in counts) >= 3.3 - 1e-12:
                inside |= set(range(i, i + 20))
        assert {i for a, b in secrets.entropy_spans(run, 20, 3.3) for i in range(a, b)} == inside


def test_quality_counts_and_verdicts(spark, awkward, empty):
    rng = np.random.default_rng(6)
    good = [". ".join(fruit(12, 50 * i + j) for j in range(6)) + "." for i in range(60)]
    junk = [" ".join(w + "%%%" for w in t.split()) for t in good[:10]]
    twice = ["\n".join([fruit(8, 1)] * 5), " ".join(rng.choice(["x", "y"], 60))]
    rows = {r["doc_id"]: r for r in quality.judge_quality(table(spark, good + junk + twice)).collect()}
    for i, t in enumerate(good + junk + twice):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = [tuple(w[j:j + 5]) for j in range(len(w) - 4)]
        often = collections.Counter(grams)
        covered = {j + k for j, g in enumerate(grams) if often[g] > 1 for k in range(5)}
        lines = t.split("\n")
        assert (rows[i]["n_words"], rows[i]["word_chars"], rows[i]["n_symbols"], rows[i]["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(covered))
        assert rows[i]["n_dup_lines"] == sum(x in lines[:j] for j, x in enumerate(lines) if x.split())
    assert all(rows[i]["kept"] for i in range(60)) and not any(rows[i]["kept"] for i in range(60, 72))
    assert quality.judge_quality(awkward).count() == len(AWKWARD) and quality.judge_quality(empty).count() == 0


def test_viterbi_equals_plain_recursion():
    rng = np.random.default_rng(2)
    lengths = np.array([7, 1, 12, 5])
    scores = rng.normal(size=(25, 3))
    starts = np.cumsum(lengths) - lengths
    labels = language.best_paths(scores, starts, lengths, 1.0)
    for s, n in zip(starts, lengths):
        worth = lambda p: sum(scores[s + i, x] for i, x in enumerate(p)) - sum(a != b for a, b in zip(p, p[1:]))  # noqa: E731, B023
        if n <= 7:
            best = max(map(worth, itertools.product(range(3), repeat=int(n))))
            assert math.isclose(worth(labels[s:s + n]), best)


def test_language(spark, awkward, empty):
    en, de = "the cat sat on the mat with another thing", "der hund und die katze sind nicht schön"
    rows = [(i, f"{t} {i}", g) for i, (t, g) in enumerate([(en, "en"), (de, "de"), ("привет мир как дела", "ru")] * 10)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([(0, "the hund"), (1, "katze und hund"), (2, "мир"), (3, "12 34"), (4, None), (5, f"{en} {de} {de}")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in language.identify(asked, model).collect()}
    assert [found[i]["lang_pred"] for i in (1, 2, 3, 4, 5)] == ["de", "ru", "und", "und", "de"]
    assert [s["lang"] for s in found[5]["spans"]] == ["en", "de"] and found[5]["spans"][1]["start_word"] == 9
    assert language.identify(awkward, model).count() == len(AWKWARD) and language.identify(empty, model).count() == 0
    nothing = language.train(empty)
    assert {r["lang_pred"] for r in language.identify(awkward, nothing).collect()} == {"und"}


def test_toxicity(spark, awkward, empty):
    texts = [fruit(20, i) + (" you idiot" if i % 3 == 0 else "") + (" women" if i % 6 == 0 else "") for i in range(150)]
    docs = table(spark, texts)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(150)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    asked = {r["doc_id"]: r["score"] for r in toxicity.score_texts(table(spark, ["what an idiot here", "hello women here", "hello men here", None, ""]), model).collect()}
    assert asked[0] >= 0.3 > max(asked[1], asked[2], asked[3]) and asked[3] == asked[4]
    assert abs(asked[1] - asked[2]) < 0.05
    plain = toxicity.train(docs, labels, fairness=0.0)
    gap = lambda m: abs(m.weights.get("women", 0) - m.weights.get("men", 0))
    assert gap(model) < gap(plain)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] % 3 for r in kept.collect()} == {1, 2} and kept.count() == 100
    assert toxicity.score_texts(awkward, model).count() == len(AWKWARD)
    assert toxicity.train(empty, labels).weights == {} and toxicity.score_texts(empty, model).count() == 0


def test_toxicity_of_repeated_ids(spark, monkeypatch):
    texts = [fruit(20, i) + (" you idiot" if i % 3 == 0 else "") for i in range(90)]
    docs, seen, fit = table(spark, texts), [], toxicity.fit
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(toxicity, "fit", lambda own, y, *rest: seen.append(y) or fit(own, y, *rest))
    model = toxicity.train(docs, labels)
    copies = docs.unionByName(docs.where("doc_id = 1").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("copy")).repartition(5)
    again = toxicity.train(copies, labels)
    assert again == model and [len(y) for y in seen] == [90, 90]
    more = docs.unionByName(docs.where("doc_id = 1").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(300)))).withColumn("text", F.concat("text", F.lit(" "), "n")).drop("n"))
    toxicity.train(more, labels, max_rows=100)
    rows = toxicity.labelled_texts(more, labels, "toxic", "doc_id", "text", 100).collect()
    assert len(seen[2]) == len(rows) == 100 and {r["key"] for r in rows} == set(range(90)) and len({r["text"] for r in rows}) == 100
    toxicity.train(more, labels, max_rows=30)
    assert len(seen[3]) == 30


def test_warc_round_trip_and_pushdown(spark):
    long = "<p>é</p>" * 300
    pages = spark.createDataFrame([(1, "http://a/\n", long, "x"), (2, None, long, "x"), (3, "u", "short", "x"), (4, "u", "short", "x"), (5, "u", None, "x"),
                                   (7, "u", long, "x"), (None, "u", long, "x"), (8, "u", "z" * 200_000, "x")], "page_id long, url string, html string, payload string")
    path = scratch(spark)
    warc.write_archives(warc.archive(pages), path)
    rows = {r["page_id"]: r for r in warc.read_archives(spark, path).collect()}
    assert {k: (r["record_type"], r["refers_to"]) for k, r in rows.items()} == {
        1: ("revisit", 7), 2: ("revisit", 7), 7: ("response", None), None: ("revisit", 7), 3: ("response", None), 4: ("response", None), 5: ("response", None), 8: ("response", None)}
    assert bytes(rows[7]["payload"]).decode() == long and rows[1]["payload"] is None and rows[1]["target_uri"] == "http://a/\n"
    assert all(r["payload_bytes"] == 2700 and r["payload_digest"] == hashlib.sha1(long.encode()).hexdigest() for k, r in rows.items() if k in (1, 2, 7))
    again = warc.read_archives(spark, path, payload=False).where("record_type = 'revisit' AND page_id IN (1, 2)")
    assert sorted(r["page_id"] for r in again.collect()) == [1, 2]
    reader = warc.Reader({"path": path})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload_bytes",), 3)]))
    assert len(left) == 1 and [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()].__len__() == 3
    none = warc.round_trip(pages.where("page_id = 99"))
    assert none.count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(900, 24)).astype(np.float32)
    vectors[100:160] = vectors[100]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)] + [(1000, None, 0), (1020, [0.0] * 24, 0), (1040, [float("nan")] * 24, 0), (1060, [None] * 24, 0), (None, [1.0] * 24, 0), (1080, [1.0, 2.0], 0), (1081, [1.0, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    found = collections.defaultdict(list)
    for r in ann.search(df).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(found) == {*range(0, 900, 20), 1080} and found[1080] == [(1081, 3.0)]
    hits = 0
    for q in range(0, 900, 20):
        score = (vectors.astype(float) * vectors[q].astype(float)).sum(axis=1)
        score[q] = -np.inf
        best = np.lexsort((np.arange(900), -score))[:20]
        hits += len(set(best) & {v for v, _ in found[q]})
        assert all(math.isclose(s, score[v], rel_tol=1e-12) for v, s in found[q])
    assert hits >= 0.99 * 45 * 20
    assert ann.search(df.where("vec_id < 0")).count() == 0


def nearest(rows, every=20, k=20):
    """Ids and scores of each query's best by comparing all rows: a repeated id counts once, with its best score."""
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    want = {}
    for q in sorted({int(i) for i in ids if i % every == 0}):
        scores = {}
        for i, s in zip(ids.tolist(), (vectors @ vectors[ids == q].T).max(axis=1).tolist()):
            scores[i] = max(scores.get(i, -np.inf), s)
        want[q] = sorted(((i, s) for i, s in scores.items() if i != q), key=lambda x: (-x[1], x[0]))[:k]
    return want


def test_neighbours_of_repeated_ids(spark):
    rng = np.random.default_rng(9)
    plain = rng.normal(size=(240, 24))
    plain[:60] = plain[rng.integers(0, 6, 60) * 10] + rng.normal(size=(60, 24)) * 0.2
    exact = [(i, v) for i, v in enumerate(plain) for _ in range(2 + i % 29)]
    moved = [(i, v + rng.normal(size=24) * 0.01) for i, v in exact]
    hot = [(i, v) for i, v in enumerate(plain)] + [(7, plain[7] + rng.normal(size=24) * 0.01) for _ in range(400)]
    for rows in (exact, moved, hot):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
        found = collections.defaultdict(list)
        for r in ann.search(df).orderBy("query_id", "rank").collect():
            found[r["query_id"]].append((r["vec_id"], r["score"]))
        want = nearest(rows)
        assert set(found) == set(want) and all(len({v for v, _ in found[q]}) == 20 for q in want)
        assert sum(len({v for v, _ in found[q]} & {v for v, _ in want[q]}) for q in want) >= 0.99 * 20 * len(want)
        score = {q: dict(x) for q, x in want.items()}
        assert all(math.isclose(s, score[q][v], rel_tol=1e-9) for q in want for v, s in found[q] if v in score[q])


def test_copies_of_a_vector_are_dropped_before_shards(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 64)
    monkeypatch.setattr(ann, "QUERY_ROWS", 8)
    plain = np.random.default_rng(3).normal(size=(300, 24))
    rows = [(i, v) for i, v in enumerate(plain)] + [(20, plain[20])] * 300 + [(7, plain[7])] * 300
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>").repartition(5)
    assert ann.build_index(df)[0].count() == 300
    found = collections.defaultdict(list)
    for r in ann.search(df).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    assert found == {q: [v for v, _ in x] for q, x in nearest(rows).items()}


def test_token_rollup(spark, awkward):
    counts = token_rollup.count_tokens(awkward.select("source", "lang", "text", F.lit(7).alias("before")), {"v1": packing.default_vocabulary()}).cache()
    rollup = token_rollup.Rollup(spark, scratch(spark))
    assert rollup.totals().count() == 0
    assert rollup.commit("one", token_rollup.inserted(counts.withColumn("tokens", F.col("before"))))
    assert rollup.commit("two", token_rollup.revised(counts), token_rollup.deleted(counts.where("tokens = 0")))
    assert not rollup.commit("two", token_rollup.revised(counts))
    want = [(r["docs"], r["tokens"]) for r in counts.where("tokens > 0").groupBy("source", "lang").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens")).collect()]
    assert [(r["docs"], r["tokens"]) for r in rollup.totals().collect()] == want
    rollup.compact()
    assert not rollup.commit("one", token_rollup.inserted(counts))
    assert rollup.commit("three", token_rollup.deleted(counts.where("tokens > 0")))
    assert rollup.totals().count() == 0


def test_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    pieces = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert pieces.count() > 0 and pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
