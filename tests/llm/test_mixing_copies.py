"""The mix where one row, one id or very many sources make up the table."""

import collections

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing

DOCS = "doc_id long, text string, source string, lang string"


def counted(df):
    return collections.Counter(map(tuple, df.collect()))


def table(spark):
    same = [(7, "a b c", "x", "en")] * 3000
    one_id = [(7, f"w{i} b c", "x", "en") for i in range(500)] + [(None, "n n", None, None)] * 20
    return spark.createDataFrame(same + one_id + [(i, "one two three four " * (1 + i % 9), "y", None) for i in range(100, 300)], DOCS).repartition(5)


def test_copies_share_their_passes(spark):
    df = table(spark)
    rows = mixing.mix(df).collect()
    assert len(rows) == df.count()
    assert collections.Counter((r.doc_id, r.size) for r in rows) == collections.Counter((r[0], len(r[1].split())) for r in df.collect())
    taken = collections.Counter()
    for r in rows:
        assert 0 <= r.passes <= 2
        taken[r.no_source, r.source] += r.size * r.passes
    target = {(r.no_source, r.source): r.target for r in rows}
    assert all(abs(taken[s] - target[s]) <= 3 for s in target)
    out, given = counted(mixing.repeat(df)), counted(df)
    assert sum(out.values()) == sum(r.passes for r in rows)
    assert all(out[row] <= 2 * n for row, n in given.items()) and set(out) <= set(given)
    words = collections.Counter()
    for (_, text, source, _), n in out.items():
        words[source is None, source or ""] += n * len(text.split())
    assert words == taken
    assert out == counted(mixing.repeat(df.repartition(3)))


def test_ids_are_drawn_apart_by_content(spark):
    grouped = mixing.entries(table(spark)).where("key = 7").collect()
    assert len(grouped) == 501 and len({r.draw for r in grouped}) == 501
    assert max(r.copies for r in grouped) == 3000


def test_columns_of_any_name_and_type(spark):
    df = table(spark).withColumn("draw", F.create_map(F.lit("k"), F.col("doc_id") % 2)).withColumn("times", F.lit(None).cast("int"))
    out = mixing.repeat(df)
    assert out.schema.simpleString() == df.schema.simpleString()
    assert out.count() == mixing.mix(df).agg(F.sum("passes")).first()[0] > 0


def test_long_runs_come_in_blocks(spark):
    df = spark.createDataFrame([(1, 5 * mixing.BLOCK + 3), (2, 1), (3, 0), (4, mixing.BLOCK)], "id int, times long")
    out = mixing.unfolded(df, "times", "id").groupBy("id").agg(F.count("*").alias("n"), F.min("nth").alias("lo"), F.max("nth").alias("hi"),
                                                                 F.countDistinct("nth").alias("different"))
    assert {tuple(r) for r in out.collect()} == {(i, n, 0, n - 1, n) for i, n in ((1, 5 * mixing.BLOCK + 3), (2, 1), (4, mixing.BLOCK))}


@pytest.mark.parametrize("sizes", [[10, 1000, 1, 0, 5, 70], [0, 0], [3] * 200 + [100000]])
def test_levels_need_no_job_per_source(spark, sizes):
    table_ = spark.createDataFrame([(False, f"s{i:04}", n) for i, n in enumerate(sizes)], "no_source boolean, source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(table_).collect()}
    weight = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    full = {i for i, n in enumerate(sizes) if n == 0}
    while len(full) < len(sizes):
        level = (1.5 * sum(sizes) - sum(2 * sizes[i] for i in full)) / sum(w for i, w in enumerate(weight) if i not in full)
        more = {i for i, n in enumerate(sizes) if i not in full and 2 * n <= weight[i] * level}
        if not more:
            break
        full |= more
    assert all(found[f"s{i:04}"] == pytest.approx(2 * n if i in full else weight[i] * level) for i, n in enumerate(sizes))
