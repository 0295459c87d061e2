"""Exact sums of doubles, whatever their sizes and the order of rows.

A double is split into integer parts, one per 24 bits of the exponent range. Parts are added as
longs, which no group of fewer than 2^39 rows overflows, and put together once at the end:
carries are passed upward, and the leading 96 bits with a mark for anything below them round to
the nearest double, ties to even. Infinities and NaN are counted beside the parts.

Batch tables carry only the parts that are not zero, as rows that collapse map-side. Running sums
have a column for every part in use, streams one for every part there is.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, BINS, LOWEST = 24, 88, -1080
#: Bins of values that are no finite number.
NAN, PLUS, MINUS = -1, -2, -3
#: Bins from 2^-96 to 2^72: sums that touch no other are put together by plain arithmetic.
USUAL = range(41, 48)
ALL = range(MINUS, BINS)
_STEP, _MASK = float(1 << BITS), (1 << BITS) - 1


def _scaled(value: str, exponent: str) -> str:
    """Value times a power of two, in two steps so that neither power overflows."""
    return f"{value} * pow(2D, shiftright({exponent}, 1)) * pow(2D, ({exponent}) - shiftright({exponent}, 1))"


def _with_parts(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Add per name ``_b``, the leading bin, ``_0`` to ``_3``, its and the next bins' parts, and ``_x``, the value.

    The leading bin may be one off; four parts of 24 bits hold the 53 bits all the same.
    ``_o`` is 1 where a part lies outside the usual bins. Without a value parts are null.
    """
    out = df.select("*", *[v.cast("double").alias(f"{n}_x") for n, v in values.items()])
    out = out.selectExpr("*", *[f"""CASE WHEN isnan({n}_x) THEN {NAN} WHEN {n}_x = double('infinity') THEN {PLUS}
        WHEN {n}_x = double('-infinity') THEN {MINUS} WHEN {n}_x = 0 THEN {USUAL[0]} WHEN {n}_x IS NOT NULL THEN
        CAST(least({BINS - 1}, greatest(0, floor((log2(abs({n}_x)) - {LOWEST}) / {BITS}))) AS INT) END AS {n}_b""" for n in values])
    shift = f"-({{n}}_b * {BITS} + {LOWEST})"
    out = out.selectExpr("*", *[f"CASE WHEN {n}_b < 0 THEN 0D ELSE {_scaled(f'{n}_x', shift.format(n=n))} END AS {n}_q" for n in values])
    columns = []
    for n in values:
        rest = f"{n}_q"
        for i in range(4):
            first = f"CASE WHEN {n}_b < 0 THEN 1L ELSE CAST({rest} AS BIGINT) END" if i == 0 else f"CAST({rest} AS BIGINT)"
            columns.append(f"{first} AS {n}_{i}")
            rest = f"(({rest} - CAST({rest} AS BIGINT)) * {_STEP}D)"
    out = out.selectExpr("*", *columns)
    low = " OR ".join(f"({{n}}_b < {USUAL[0] + i} AND {{n}}_{i} <> 0)" for i in range(4))
    return out.selectExpr("*", *[f"CAST({n}_b > {USUAL[-1]} OR {low.format(n=n)} AS BIGINT) AS {n}_o" for n in values]) \
        .drop(*[f"{n}_q" for n in values])


def _column(name: str, bin_: int) -> str:
    return f"{name}_{bin_ - MINUS}"


def _wide(name: str, bins: Sequence[int]) -> list[str]:
    """The part that each bin gets from a row."""
    def part(bin_: int) -> str:
        cases = [f"WHEN {name}_b = {bin_ + j} THEN {name}_{j}" for j in range(4 if bin_ >= 0 else 1)]
        return f"CASE {' '.join(cases)} END"

    return [part(b) for b in bins]


def _put_together(df: DataFrame, names: Mapping[str, str], rare: Callable[[str], str] | None,
                  usual: Sequence[int] = USUAL) -> DataFrame:
    """Add sums by name from the parts whose columns begin with the key.

    ``{key}_n`` is the number of values, ``{key}_o`` that of unusual parts, and ``rare`` gives the
    array of entries outside the usual bins, which only groups with such parts look at.
    """
    def here(key: str, bin_: int) -> str:
        return f"coalesce({_column(key, bin_)}, 0L)" if bin_ in usual else "0L"

    def carried(key: str, times: str) -> tuple[list[str], str]:
        digits, carry = [], "0L"
        for b in USUAL:
            total = f"({here(key, b)}{times} + {carry})"
            digits.append(f"({total} & {_MASK}L)")
            carry = f"shiftright({total}, {BITS})"
        return digits, carry

    out = df.selectExpr("*", *[f"CASE WHEN {carried(k, '')[1]} < 0 THEN -1L ELSE 1L END AS {k}_s" for k in names])
    columns, sums = [], []
    for key, name in names.items():
        digits, carry = carried(key, f" * {key}_s")
        # Three more digits take all that longs can carry.
        digits += [f"(shiftright({carry}, {BITS * i}) & {_MASK}L)" for i in range(3)]
        columns += [f"{d} AS {key}_d{i}" for i, d in enumerate(digits)]
        sums.append(f"CASE WHEN coalesce({key}_n, 0L) = 0 THEN CAST(NULL AS DOUBLE) WHEN {key}_o = 0 THEN {_plain(key, len(digits))} * {key}_s"
                    + (f" ELSE {key}_rare END AS {name}" if rare else f" END AS {name}"))
    out = out.selectExpr("*", *columns)
    if rare:
        wide = []
        for key in names:
            usually = ", ".join(f"named_struct('bin', {b}, 'part', {_column(key, b)})" for b in usual)
            entries = f"filter(concat(array({usually}), {rare(key)}), e -> e.part <> 0)"
            wide.append(f"CASE WHEN {key}_o > 0 THEN {_total(entries)} END AS {key}_rare")
        out = out.selectExpr("*", *wide)
    return out.selectExpr("*", *sums)


def _plain(key: str, count: int) -> str:
    """The nearest double of the digits: 48 bits each are exact, so the addition is the one rounding."""
    def digit(i: int) -> str:
        return f"{key}_d{i}" if i >= 0 else "0L"

    cases = []
    for top in reversed(range(count)):
        below = " OR ".join(f"{key}_d{i} <> 0" for i in range(top - 3))
        mark = f" | CAST(({below}) AS BIGINT)" if below else ""
        cases.append(f"""WHEN {digit(top)} <> 0 THEN (CAST({digit(top)} * {1 << BITS}L + {digit(top - 1)} AS DOUBLE) * {float(1 << 2 * BITS)}D
            + CAST(({digit(top - 2)} * {1 << BITS}L + {digit(top - 3)}){mark} AS DOUBLE)) * pow(2D, {(USUAL[0] + top - 3) * BITS + LOWEST})""")
    return f"CASE {' '.join(cases)} ELSE 0D END"


def _let(value: str, name: str, use: str) -> str:
    """``use`` with the value worked out once."""
    return f"element_at(transform(array({value}), {name} -> {use}), 1)"


def _total(entries: str) -> str:
    """The double nearest to the sum of ``entries``, (bin, part) pairs with a bin at most once."""
    def has(kind: int) -> str:
        return f"exists(all, e -> e.bin = {kind})"

    def digits(sign: int) -> str:
        here = f"(coalesce(try_element_at(s.parts, i), 0L) * {sign} + a.carry)"
        # Three more digits take all that longs can carry; what is left is the sign.
        return f"""aggregate(sequence(s.low, s.high), named_struct('carry', 0L, 'digits', CAST(array() AS ARRAY<BIGINT>)),
            (a, i) -> named_struct('carry', shiftright({here}, {BITS}), 'digits', concat(a.digits, array({here} & {_MASK}L))))"""

    def digit(k: int) -> str:
        return f"coalesce(try_element_at(r.d, r.first + {k}), 0L)"

    mantissa = f"""(CAST({digit(0)} * {1 << BITS}L + {digit(1)} AS DOUBLE) * {float(1 << 2 * BITS)}D
        + CAST(({digit(2)} * {1 << BITS}L + {digit(3)}) | CAST(exists(slice(r.d, r.first + 4, size(r.d)), x -> x <> 0) AS BIGINT) AS DOUBLE))"""
    exponent = f"((s.high - r.first - 2) * {BITS} + {LOWEST})"
    lead = f"CASE WHEN r.first = 0 THEN 0D ELSE {_scaled(mantissa, exponent)} END"
    placed = _let("named_struct('d', reverse(f), 'first', CAST(array_position(transform(reverse(f), x -> x <> 0), true) AS INT))", "r", lead)
    positive, negative = _let("up.digits", "f", placed), _let(f"{digits(-1)}.digits", "f", placed)
    signed = _let(digits(1), "up", f"CASE WHEN up.carry < 0 THEN -{negative} ELSE {positive} END")
    bins = "transform(all, e -> e.bin)"
    finite = _let(f"named_struct('low', array_min({bins}), 'high', array_max({bins}) + 3, 'parts', map_from_entries(all))", "s", signed)
    return _let(entries, "all", f"""CASE WHEN {has(NAN)} OR ({has(PLUS)} AND {has(MINUS)}) THEN double('NaN')
        WHEN {has(PLUS)} THEN double('Infinity') WHEN {has(MINUS)} THEN double('-Infinity')
        WHEN size(all) = 0 THEN 0D ELSE {finite} END""")


def grouped(df: DataFrame, keys: Sequence[str | Column], sums: Mapping[str, Column],
            rows: str | None = None, counts: Mapping[str, Column] | None = None,
            tops: Mapping[str, Column] | None = None, weight: Column | None = None,
            sketches: Mapping[str, Column] | None = None, sketch_size: int = 800) -> DataFrame:
    """Exact sums per group beside counts, maxima and quantile sketches: one pass over the rows.

    ``sums`` are null where a group has no value. ``rows`` names the count of rows, ``counts`` that of
    values that are not null, ``tops`` the largest of them; a row counts ``weight`` times, a long.
    ``sketches`` are built-in sketches of values as binaries, without weights.
    """
    counts, tops, sketches = dict(counts or {}), dict(tops or {}), dict(sketches or {})
    named = [F.col(k) if isinstance(k, str) else k for k in keys]
    labels = [k if isinstance(k, str) else df.select(k).columns[0] for k in keys]
    group = [f"_k{i}" for i in range(len(named))]
    base = df.select(*[k.alias(g) for k, g in zip(named, group)],
                     (F.lit(1) if weight is None else weight).cast("long").alias("_w"),
                     *[v.alias(f"_s{i}") for i, v in enumerate(sums.values())],
                     *[v.isNotNull().alias(f"_n{i}") for i, v in enumerate(counts.values())],
                     *[v.alias(f"_m{i}") for i, v in enumerate(tops.values())],
                     *[v.cast("double").alias(f"_z{i}") for i, v in enumerate(sketches.values())])
    base = _with_parts(base, {f"_v{i}": F.col(f"_s{i}") for i in range(len(sums))})
    slots = range(len(sums))

    def per_row(own: str) -> list[Column]:
        return [F.expr(f"sum(CASE WHEN {own} THEN _w END) AS _rows"),
                *[F.expr(f"sum(CASE WHEN {own} AND _n{i} THEN _w END) AS _c{i}") for i in range(len(counts))],
                *[F.expr(f"max(CASE WHEN {own} THEN _m{i} END) AS _t{i}") for i in range(len(tops))],
                *[F.expr(f"kll_sketch_agg_double(CASE WHEN {own} THEN _z{i} END, {sketch_size}) AS _z{i}") for i in range(len(sketches))],
                *[F.expr(f"sum(CASE WHEN {own} THEN _v{i}_o END) AS _e{i}_o") for i in slots],
                *[F.expr(f"count(CASE WHEN {own} THEN _v{i}_x END) AS _e{i}_n") for i in slots]]

    if df.isStreaming:
        out = base.groupBy(*group).agg(*per_row("true"), *[
            F.expr(f"sum({p} * _w) AS {_column(f'_e{i}', b)}") for i in slots for b, p in zip(ALL, _wide(f"_v{i}", ALL))])

        def rare(key: str) -> str:
            return "array(" + ", ".join(f"named_struct('bin', {b}, 'part', {_column(key, b)})" for b in ALL if b not in USUAL) + ")"
    else:
        # The line of slot -1 stands for its row, the others bring parts.
        parts = [f"named_struct('slot', {i}, 'bin', _v{i}_b - {j}, 'part', _v{i}_{j})" for i in slots for j in range(4)]
        lines = base.selectExpr("*", f"inline(array(named_struct('slot', -1, 'bin', 0, 'part', 0L), {', '.join(parts)}))") \
            .where("part <> 0 OR slot < 0")
        here = lines.groupBy(*group, "slot", "bin").agg(F.expr("sum(part * _w) AS part"), *per_row("slot < 0"))
        merged = [F.expr(f"sum({c}) AS {c}") for c in ["_rows", *[f"_c{i}" for i in range(len(counts))],
                                                       *[f"_e{i}_{n}" for i in slots for n in "on"]]]
        merged += [F.expr(f"max(_t{i}) AS _t{i}") for i in range(len(tops))]
        merged += [F.expr(f"kll_merge_agg_double(_z{i}, {sketch_size}) AS _z{i}") for i in range(len(sketches))]
        merged += [F.expr(f"sum(CASE WHEN slot = {i} AND bin = {b} THEN part END) AS {_column(f'_e{i}', b)}") for i in slots for b in USUAL]
        merged += [F.expr(f"collect_list(CASE WHEN slot = {i} AND bin NOT BETWEEN {USUAL[0]} AND {USUAL[-1]} "
                          f"THEN named_struct('bin', bin, 'part', part) END) AS _e{i}_r") for i in slots]
        out = here.groupBy(*group).agg(*merged)

        def rare(key: str) -> str:
            return f"{key}_r"

    out = _put_together(out, {f"_e{i}": f"_sum{i}" for i in slots}, rare)
    return out.select(*[F.col(k).alias(n) for k, n in zip(group, labels)],
                      *[F.col(f"_sum{i}").alias(n) for i, n in enumerate(sums)],
                      *([F.expr(f"coalesce(_rows, 0L) AS {rows}")] if rows else []),
                      *[F.expr(f"coalesce(_c{i}, 0L)").alias(n) for i, n in enumerate(counts)],
                      *[F.col(f"_t{i}").alias(n) for i, n in enumerate(tops)],
                      *[F.col(f"_z{i}").alias(n) for i, n in enumerate(sketches)])


class RunningParts:
    """A column's parts, to be added up along an order; reads the column once for the bins in use."""

    def __init__(self, df: DataFrame, value: Column):
        self.rows = _with_parts(df, {"_v": value})
        used = self.rows.selectExpr("explode(CASE WHEN _v_b < 0 THEN array(_v_b) ELSE "
                                    "filter(array(_v_b, IF(_v_1 <> 0, _v_b - 1, null), IF(_v_2 <> 0, _v_b - 2, null), "
                                    "IF(_v_3 <> 0, _v_b - 3, null)), b -> b IS NOT NULL) END) AS bin").distinct()
        self.bins = sorted(r.bin for r in used.collect())

    def sums(self) -> dict[str, Column]:
        """By name what ``running`` shall add up."""
        return {"_e_n": F.col("_v_x").isNotNull().cast("long"), "_e_o": F.expr("coalesce(_v_o, 0L)"),
                **{_column("_e", b): F.expr(p) for b, p in zip(self.bins, _wide("_v", self.bins))}}

    def total(self, df: DataFrame, name: str) -> DataFrame:
        """Add the sum up to each row; null while there was no value."""
        odd = [b for b in self.bins if b not in USUAL]
        rare = "array(" + ", ".join(f"named_struct('bin', {b}, 'part', {_column('_e', b)})" for b in odd) + ")"
        return _put_together(df, {"_e": name}, (lambda _: rare) if odd else None, [b for b in self.bins if b in USUAL])
