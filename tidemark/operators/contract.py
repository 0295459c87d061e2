"""Schema contract: enum checks, version changes, renames, widening and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import ORDER_STATUSES, ORDER_V1, V2_DEFAULTS


def reject_reason(symbols: tuple[str, ...] = ORDER_STATUSES, field: str = "status") -> Column:
    """Why a row breaks the enum contract; null when it does not."""
    return (F.when(F.col(field).isNull(), f"{field} is missing")
            .when(~F.col(field).isin(*symbols), F.concat(F.lit(f"{field} is not one of the "
                                                               "symbols: "), F.col(field))))


def split_by_contract(df: DataFrame, symbols: tuple[str, ...] = ORDER_STATUSES,
                      field: str = "status") -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with a ``reject_reason``."""
    why = reject_reason(symbols, field)
    return df.where(why.isNull()), df.where(why.isNotNull()).withColumn("reject_reason", why)


def upgrade(df: DataFrame, defaults: dict = V2_DEFAULTS) -> DataFrame:
    """Add the fields of the next version.

    A default fills a field only where it was absent from the record; a null in a field
    that is present stays null.  A field has its default's type, and is text without one.
    """
    def filled(value) -> Column:
        return F.lit(None).cast("string") if value is None else F.lit(value)

    return df.withColumns({name: filled(value) for name, value in defaults.items()
                           if name not in df.columns})


def downgrade(df: DataFrame, schema: T.StructType = ORDER_V1) -> DataFrame:
    """What a reader of the older version sees."""
    return df.select(*schema.fieldNames())


def merge_versions(v1: DataFrame, v2: DataFrame, defaults: dict = V2_DEFAULTS) -> DataFrame:
    """One table of both versions, with ``schema_version``."""
    return (upgrade(v1, defaults).withColumn("schema_version", F.lit(1))
            .unionByName(v2.withColumn("schema_version", F.lit(2)), allowMissingColumns=True))


def audit(raw: DataFrame, value: str, schema: T.StructType,
          symbols: tuple[str, ...] = ORDER_STATUSES, enum_field: str = "status") -> DataFrame:
    """Silent corruption in JSON text records.

    Per expected field the records in which it is missing or null, for the enum field
    those with an unknown symbol, and every field that should not be there.  Records are
    read once: a record counts in the group of what is expected and in that of each
    unexpected field.  A table without records has findings of 0.
    """
    names = schema.fieldNames()
    checks = [(n, "null", F.col(f"_r.{n}").isNull()) for n in names]
    if enum_field in names:
        checks.append((enum_field, "bad_symbol", ~F.col(f"_r.{enum_field}").isin(*symbols)))
    extra = F.coalesce(F.array_except(F.json_object_keys("_value"), F.array(*[F.lit(n) for n in names])), F.array().cast("array<string>"))
    groups = F.concat(F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(True).alias("known"))),
                      F.transform(extra, lambda f: F.struct(f.alias("field"), F.lit(False).alias("known"))))
    # A row that counts nothing keeps the expected fields in the result.
    nothing = raw.sparkSession.range(1).select(F.lit(None).cast("string").alias("_value"), F.lit(False).alias("_real"))
    records = raw.select(F.col(value).alias("_value"), F.lit(True).alias("_real")).unionByName(nothing)
    flags = records.select("_real", F.from_json("_value", schema).alias("_r"), groups.alias("_g")) \
        .select("_real", "_g", *[F.coalesce(bad, F.lit(False)).alias(f"_b{i}") for i, (_, _, bad) in enumerate(checks)])
    counts = flags.select("*", F.explode("_g").alias("_at")).groupBy("_at.field", "_at.known").agg(
        F.count_if("_real").alias("_n"), *[F.count_if(F.col("_real") & F.col(f"_b{i}")).alias(f"_b{i}") for i in range(len(checks))])

    def finding(field: Column, issue: str, bad: Column, share: Column) -> Column:
        return F.struct(field.alias("field"), F.lit(issue).alias("issue"), F.col("_n").alias("records"),
                        bad.alias("bad_records"), share.alias("share"))

    expected = [finding(F.lit(field), issue, F.col(f"_b{i}"), F.try_divide(F.col(f"_b{i}"), F.col("_n"))) for i, (field, issue, _) in enumerate(checks)]
    unexpected = finding(F.col("field"), "unexpected", F.col("_n"), F.lit(None).cast("double"))
    return counts.select(F.inline(F.when(F.col("known"), F.array(*expected)).otherwise(F.array(unexpected))))


def decode_json(raw: DataFrame, value: str, schema: T.StructType,
                corrupt: str = "_corrupt") -> DataFrame:
    """Parse JSON text; unreadable text is kept beside null fields."""
    wide = T.StructType(list(schema.fields)).add(corrupt, T.StringType())
    parsed = F.from_json(F.col(value), wide, {"mode": "PERMISSIVE",
                                              "columnNameOfCorruptRecord": corrupt})
    rest = [c for c in raw.columns if c != value]
    return raw.select(*rest, parsed.alias("_r")).select(*rest, "_r.*")


def merge_renamed(df: DataFrame, old: str, new: str) -> DataFrame:
    """One column from a field known under two names; ``rename_conflict`` where they differ."""
    differ = F.col(old).isNotNull() & F.col(new).isNotNull() & (F.col(old) != F.col(new))
    return (df.withColumn("rename_conflict", F.coalesce(differ, F.lit(False)))
            .withColumn(new, F.coalesce(F.col(new), F.col(old))).drop(old))


def widen(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns to wider types; ``incompatible`` names the values that do not fit."""
    lost = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c))
        for c, t in types.items()]))
    return df.withColumn("incompatible", lost) \
        .withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def split_by_width(df: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Widened rows, and the untouched rows that would lose a value."""
    bad = F.lit(False)
    for c, t in types.items():
        bad = bad | (F.col(c).isNotNull() & F.col(c).try_cast(t).isNull())
    good = df.where(~bad).withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})
    return good, df.where(bad)
