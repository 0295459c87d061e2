"""Token counts by source, language and tokenizer version, maintained by signed deltas.

A batch of changes is reduced to one row per group and committed as a folder of its own, named
by the batch. Totals are the sums over all folders. A batch that is delivered again finds its
folder and changes nothing; one that broke off has left no finished folder and is written anew.
``compact`` folds the batches so far into a base, so that totals don't read ever more folders.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import slices, texts_of
from tidemark.llm.packing import Encoder

GROUP = ("source", "lang", "tokenizer")
SUMS = "source string, lang string, tokenizer string, docs long, tokens long"


def default_vocabularies() -> dict[str, str]:
    import public_tokenizers

    return {n: public_tokenizers.path(f) for n, f in (("byte_bpe_50k", "byte_bpe_50k.json"), ("byte_bpe_multi_50k", "byte_bpe_multi_50k.tiktoken"))}


def encoder_of(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Encoder of a vocabulary file of ``tokenizers``, or of ranks for ``tiktoken``."""
    if not path.endswith(".tiktoken"):
        return Encoder(path)
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [fast.encode_ordinary(t) for t in texts]


def count_tokens(df: DataFrame, vocabularies: dict[str, str], text: str = "text") -> DataFrame:
    """Rows of ``df`` (``source``, ``lang`` and what else it has but the text) once per tokenizer version, with ``tokens``.

    Null and empty texts have no tokens.
    """
    rest = [c for c in df.columns if c not in (text, "tokenizer", "tokens")]
    rows = df.select(*rest, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = {name: encoder_of(path) for name, path in vocabularies.items()}
        for part in slices(batches, text):
            texts, kept = texts_of(part, text), [part.column(c) for c in rest]
            for name, encoder in encoders.items():
                counts = pa.array([len(ids) for ids in encoder(texts)], pa.int64())
                yield pa.RecordBatch.from_arrays([*kept, pa.array([name] * part.num_rows), counts], names=[*rest, "tokenizer", "tokens"])

    schema = rows.drop(text).schema.add("tokenizer", "string").add("tokens", "long")
    return rows.mapInArrow(run, schema)


def inserted(counts: DataFrame) -> DataFrame:
    return counts.select(*GROUP, F.lit(1).alias("docs"), "tokens")


def deleted(counts: DataFrame) -> DataFrame:
    return counts.select(*GROUP, F.lit(-1).alias("docs"), (-F.col("tokens")).alias("tokens"))


def revised(counts: DataFrame, before: str = "before", after: str = "tokens") -> DataFrame:
    """Changes of counts of documents that stay."""
    return counts.select(*GROUP, F.lit(0).alias("docs"), (F.col(after) - F.col(before)).alias("tokens"))


class Rollup:
    """Totals in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        hadoop = spark._jvm.org.apache.hadoop.fs
        self.at = hadoop.Path
        self.files = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def finished(self, kind: str) -> list[str]:
        """Names of the finished folders of batches or bases."""
        top = self.at(f"{self.path}/{kind}")
        names = [s.getPath().getName() for s in self.files.listStatus(top)] if self.files.exists(top) else []
        return sorted(n for n in names if self.files.exists(self.at(f"{self.path}/{kind}/{n}/_SUCCESS")))

    def commit(self, batch: str, *changes: DataFrame) -> bool:
        """Add the changes under the batch's name; False if that batch has been committed before."""
        if not re.fullmatch(r"[\w-]+", batch):
            raise ValueError(f"not a name of a batch: {batch!r}")
        if batch in self.finished("batches") or batch in self.covered():
            return False
        rows = changes[0]
        for more in changes[1:]:
            rows = rows.unionByName(more)
        self.sums(rows).withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{self.path}/batches/{batch}")
        return True

    def sums(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*GROUP).agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens"))

    def covered(self) -> set[str]:
        """Batches that the newest base holds."""
        bases = self.finished("bases")
        if not bases:
            return set()
        names = self.spark.read.schema("batch string").parquet(f"{self.path}/bases/{bases[-1]}/batches")
        return {r["batch"] for r in names.collect()}

    def changes(self) -> DataFrame:
        bases, covered = self.finished("bases"), self.covered()
        paths = [f"{self.path}/bases/{b}/totals" for b in bases[-1:]] + [f"{self.path}/batches/{b}" for b in self.finished("batches") if b not in covered]
        return self.spark.read.schema(SUMS).parquet(*paths) if paths else self.spark.createDataFrame([], SUMS)

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, docs, tokens`` of groups that still have documents."""
        return self.sums(self.changes()).where("docs <> 0 OR tokens <> 0")

    def compact(self) -> None:
        """Write a base from the newest one and all batches since. Readers use it once it is finished."""
        names = sorted(self.covered() | set(self.finished("batches")))
        base = f"{self.path}/bases/{len(self.finished('bases')):06d}"
        self.sums(self.changes()).write.mode("overwrite").parquet(f"{base}/totals")
        self.spark.createDataFrame([(n,) for n in names], "batch string").write.mode("overwrite").parquet(f"{base}/batches")
        self.files.create(self.at(f"{base}/_SUCCESS")).close()
