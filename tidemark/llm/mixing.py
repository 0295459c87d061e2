"""Mix sources to target weights, with exact budgets by subset sums over document lengths.

Sources share a multiple of all words by weight; a target stops at so many times its source's
words, and the excess goes to the others. A source takes whole passes over its documents, and
of one more pass a subset whose lengths add up to what is left. The subset is described by
how many documents of each exact length it has: an even share of each length, then the longest
that still fit, and at the end bounded-knapsack dynamic programming over the remaining budget.
Which documents of a length are taken is settled by a seeded hash, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, durable

WEIGHTS = (3.0, 1.0, 2.0)
SHARE, MOST_PASSES, SEED = 1.5, 2.0, 20
#: Words that the dynamic programme covers; the greedy step gets the budget below this.
KNAPSACK_WORDS = 1 << 16
#: Copies of one row that a task writes at once.
BLOCK = 1 << 10


def word_count(text: str = "text") -> Column:
    """Words between ASCII white space; 0 for a null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def before(df: DataFrame, *order: str, **amounts: Column) -> DataFrame:
    """``df`` with, per name, the sum of its amount over earlier rows, without sorting all rows in one task."""
    parts = durable(df.withColumns(amounts).repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0)
    starts = parts.groupBy("part").agg(*[F.sum(n).alias(n) for n in amounts]).select(
        "part", *[F.coalesce(F.sum(n).over(earlier), none).alias(f"{n}_start") for n in amounts])
    return (parts.withColumns({n: F.coalesce(F.sum(n).over(within), none) for n in amounts}).join(starts, "part")
            .withColumns({n: F.col(n) + F.col(f"{n}_start") for n in amounts}).drop("part", *[f"{n}_start" for n in amounts]))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            most: float = MOST_PASSES) -> DataFrame:
    """``no_source, source, source_size, target`` from rows of ``no_source, source, source_size``.

    Weights repeat along the sources in code point order, null last. Sources that are not full share
    by weight what the full ones leave. In the order of limit by weight the full ones come first, so
    running sums give the level to which the others are filled, in a fixed number of jobs.
    """
    placed = before(sizes, "no_source", "source", place=F.lit(1))
    turn = F.pmod(F.col("place"), F.lit(len(weights)))
    listed = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    placed = placed.withColumn("weight", listed).withColumn("limit", most * F.col("source_size"))
    ranked = durable(before(placed.withColumn("ratio", F.col("limit") / F.col("weight")), "ratio", "place",
                            used=F.col("limit"), passed=F.col("weight")))
    total, heavy = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (share * F.lit(total or 0) - F.col("used")) / (F.lit(heavy or 0.0) - F.col("passed"))
    open_ = ranked.withColumn("level", level).where(F.col("limit") > F.col("weight") * F.col("level"))
    found = open_.agg(F.min_by("level", F.struct("ratio", "place"))).first()[0]
    filled = F.col("limit") if found is None else F.least("limit", F.col("weight") * found)
    return ranked.select("no_source", "source", "source_size", filled.alias("target"))


def fill(lengths: list[tuple[int, int]], budget: int, knapsack: int = KNAPSACK_WORDS) -> dict[int, int]:
    """How many documents of each length to take, so that their words come near ``budget``.

    ``lengths`` holds length and number of documents. The result never exceeds the budget,
    except that the shortest document fills it if that is nearer than taking none of it.
    """
    lengths = sorted((s, n) for s, n in lengths if s > 0 and n > 0)
    total = sum(s * n for s, n in lengths)
    if budget >= total:
        return dict(lengths)
    share = {s: n * budget // total for s, n in lengths}
    left = budget - sum(s * k for s, k in share.items())
    for s, n in reversed(lengths):
        if left > knapsack:
            more = min(n - share[s], -(-(left - knapsack) // s), left // s)
            share[s] += more
            left -= more * s
    # Without an exact fit, ever more documents of each length are given back, while sums stay small.
    release, found = 0, {}
    while True:
        base = {s: max(0, k - release) for s, k in share.items()}
        open_ = budget - sum(s * k for s, k in base.items())
        if release and open_ > knapsack:
            break
        tried = base | {s: base[s] + k for s, k in subset([(s, n - base[s]) for s, n in lengths], open_).items()}
        miss = budget - sum(s * k for s, k in tried.items())
        if not release or miss < budget - sum(s * k for s, k in found.items()):
            found = tried
        if not miss or not any(base.values()):
            break
        release = 2 * release or 1
    rest = budget - sum(s * k for s, k in found.items())
    spare = [s for s, n in lengths if found[s] < n and s < 2 * rest]
    if spare:
        found[spare[0]] += 1
    return found


def subset(lengths: list[tuple[int, int]], budget: int) -> dict[int, int]:
    """Documents of each length whose words come nearest to ``budget`` from below.

    Bounded knapsack over word counts: bit w of a state says that w words can be reached.
    """
    states, steps, mask = [1], [], (1 << (budget + 1)) - 1
    for s, n in reversed(lengths):
        free, piece = min(n, budget // s), 1
        while free > 0 and not states[-1] >> budget & 1:
            piece = min(piece, free)
            steps.append((s, piece))
            states.append((states[-1] | states[-1] << s * piece) & mask)
            free -= piece
            piece *= 2
    at, taken = states[-1].bit_length() - 1, {}
    for (s, piece), before in zip(reversed(steps), reversed(states[:-1])):
        if not before >> at & 1:
            taken[s] = taken.get(s, 0) + piece
            at -= s * piece
    return taken


def row_hashes(df: DataFrame, seed: int) -> list[Column]:
    """``draw`` and ``check``: two hashes of a whole row. Columns that Spark cannot hash, such as maps, enter as JSON."""
    values = [F.to_json(F.struct(F.col(c))) if "map<" in kind or "variant" in kind else F.col(c) for c, kind in df.dtypes]
    return [F.xxhash64(F.lit(s), *values).alias(n) for s, n in ((seed, "draw"), (~seed, "check"))]


def entries(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
            weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_PASSES,
            seed: int = SEED) -> DataFrame:
    """The mix, one row per group of equal rows of ``df``.

    ``draw`` and ``check`` are hashes of the whole row, ``copies`` says how many rows share them, ``whole``
    how often the mix takes each, and ``extra`` how many of them it takes once more. Rows of one key with
    different contents are drawn apart, so neither they nor equal rows meet in one task.
    """
    docs = durable(df.select(
        F.col(key).alias("key"), F.col(source).isNull().alias("no_source"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), word_count(text).alias("size"),
        *row_hashes(df, seed))
        .groupBy("key", "no_source", "source", "size", "draw", "check").agg(F.count("*").alias("copies")))
    group = ["no_source", "source", "size"]
    lengths = durable(docs.groupBy(*group).agg(F.sum("copies").alias("docs"), F.count("*").alias("groups")))
    sizes = lengths.groupBy("no_source", "source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    goal = durable(targets(sizes, weights, share, most))

    def choose(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        size, target = rows[0]["source_size"], rows[0]["target"]
        whole = int(target // size) if size else 0
        taken = fill([(r["size"], r["docs"]) for r in rows], round(target - whole * size)) if size else {}
        columns = {c: table.column(c) for c in ("no_source", "source", "size")}
        return pa.table({**columns, "whole": pa.array([whole if r["size"] else 0 for r in rows], pa.int64()),
                         "chosen": pa.array([taken.get(r["size"], 0) for r in rows], pa.int64())})

    # A source's lengths fit a task: there are no more than words in its longest text.
    plan = lengths.drop("groups").join(goal, ["no_source", "source"]).groupBy("no_source", "source").applyInArrow(
        choose, "no_source boolean, source string, size long, whole long, chosen long")
    plan = durable(plan.join(goal, ["no_source", "source"]))
    # Many groups of one length are split along the hash, so that ranks need no large task.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share_of_task = F.lit(max(1, docs.count() // (4 * parts)))
    split = (F.col("groups") / share_of_task).cast("int") + 1
    cell = F.floor((F.col("draw") / 2.0 ** 64 + 0.5) * F.col("split")).cast("int")
    celled = docs.join(lengths.select(*group, split.alias("split")), group).withColumn("cell", cell).drop("split")
    none, up_to_here = F.lit(0), (Window.unboundedPreceding, -1)
    inner = Window.partitionBy(*group, "cell").orderBy("draw", "check", "key").rowsBetween(*up_to_here)
    earlier = Window.partitionBy(*group).orderBy("cell").rowsBetween(*up_to_here)
    cells = celled.groupBy(*group, "cell").agg(F.sum("copies").alias("held"))
    cells = cells.withColumn("before", F.coalesce(F.sum("held").over(earlier), none)).drop("held").join(plan, group)
    ranked = celled.join(cells, [*group, "cell"]).withColumn("place", F.col("before") + F.coalesce(F.sum("copies").over(inner), none))
    extra = F.greatest(F.least("copies", F.col("chosen") - F.col("place")), none)
    return ranked.select("key", *group, "draw", "check", "copies", "whole", extra.alias("extra"), "source_size", "target")


def unfolded(df: DataFrame, times: str, *spread: str) -> DataFrame:
    """Rows as often as ``times`` says, ``nth`` from 0, a block of them at a time.

    Rows of more than one block are dealt to tasks by ``spread`` and block. ``df`` is read twice.
    """
    last = F.col(times) - 1
    few = df.where(F.col(times).between(1, BLOCK)).withColumn("block", F.lit(0).cast("long"))
    many = df.where(F.col(times) > BLOCK).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / BLOCK))))
    start = F.col("block") * BLOCK
    return few.unionAll(many.repartition(*spread, "block")).withColumn(
        "nth", F.explode(F.sequence(start, F.least(last, start + BLOCK - 1)))).drop("block")


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """Per row of ``df``: key, ``no_source``, ``source``, ``size``, ``source_size``, ``target``, ``passes``.

    ``passes`` says how often the mix takes the document. Documents without words are never
    taken; an empty table gives no rows; rows that are equal share their passes in any order.
    Words are counted over whole texts of any length. Options are those of ``entries``.
    """
    rows = unfolded(durable(entries(df, key, source, text, **options)), "copies", "draw")
    passes = F.col("whole") + (F.col("nth") < F.col("extra")).cast("long")
    return rows.select(F.col("key").alias(key), "no_source", "source", "size", "source_size", "target", passes.alias("passes"))


def repeat(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED, **options) -> DataFrame:
    """Rows of ``df`` as often as the mix takes them, with all columns.

    Equal rows are collapsed before they are shuffled and come out as often as the mix takes all of them.
    """
    times = F.col("whole") * F.col("copies") + F.col("extra")
    plan = durable(entries(df, key, source, text, seed=seed, **options).select(
        F.col("draw").alias("its_draw"), F.col("check").alias("its_check"), times.alias("times")).where("times > 0"))
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), *row_hashes(df, seed))
    one = F.row_number().over(Window.partitionBy("draw", "check").orderBy("draw"))
    rows = rows.withColumn("place", one).where("place = 1").drop("place")
    joined = rows.join(plan, F.expr("draw = its_draw AND check = its_check"))
    return unfolded(joined, "times", "draw").select("row.*")
