"""Measurement cleaning: JSON-wrapped numbers and the clay class derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrafold import defaults as D

# Text accepted as a number. The cast alone would also take Java forms such as "2.5d".
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def _as_column(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def once(column: Column) -> Column:
    """The column, evaluated once per row.

    Filters on a computed column are pushed below it by repeating its expression. A one-element
    generator stops that; use it for costly expressions only.
    """
    return F.explode(F.array(column))


def _object(raw: Column, fields: dict[str, str]) -> Column:
    """Fields (name to type) of the one JSON object that the text holds; null when it holds anything else.

    The text is parsed twice, as the only element of an array and as the only field of an object: whatever
    follows the object breaks one of the two. Of repeated keys the last counts.
    """
    strict = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_bad"}
    inner = ", ".join(f"`{key}`: {kind}" for key, kind in fields.items())
    listed = F.from_json(F.concat(F.lit("["), raw, F.lit("]")), f"array<struct<{inner}>>", strict)
    held = F.from_json(F.concat(F.lit('{"x":'), raw, F.lit("}")), "x struct<_none: string>, _bad string", strict)
    return F.when(F.isnull(held["_bad"]), F.get(F.filter(F.array(listed), lambda x: F.size(x) == 1), F.lit(0))[0])


def _number(text: Column, raw: Column, value_key: str) -> Column:
    plain = F.regexp_replace(text, r'^"([+-]?(?:NaN|INF|Infinity))"$', "$1")
    flag = F.when(text.isin("true", "false"), _object(raw, {value_key: "boolean"})[value_key].cast("double"))
    return F.when(plain.rlike(NUMBER_TEXT), plain.try_cast("double")).otherwise(flag)


def measured_number(raw, value_key: str = "value") -> Column:
    """The numeric field of a JSON object held in a string; null when there is none.

    A number may be quoted. The words NaN and Infinity are numbers, true and false are 1 and 0.
    """
    raw = _as_column(raw)
    parsed = F.array(_object(raw, {value_key: "string"}))
    return F.transform(parsed, lambda p: _number(p[value_key], raw, value_key))[0]


def parse_measurement(raw, value_key: str = "value", method_key: str = "method") -> Column:
    """Struct (soc_percent, soc_method, soc_parsed).

    Anything without a usable number counts as 0.0 with an empty method; ``soc_parsed`` tells such
    rows apart from measured zeros. The text is parsed once for all fields.
    """
    raw = _as_column(raw)
    parsed = F.array(_object(raw, {value_key: "string", method_key: "string"}))
    found = F.transform(parsed, lambda p: F.struct(
        _number(p[value_key], raw, value_key).alias("n"), F.coalesce(p[method_key], F.lit("")).alias("m")
    ))
    return F.transform(found, lambda f: F.struct(
        F.coalesce(f["n"], F.lit(0.0)).alias("soc_percent"),
        F.when(f["n"].isNotNull(), f["m"]).otherwise(F.lit("")).alias("soc_method"),
        f["n"].isNotNull().alias("soc_parsed"),
    ))[0]


def clay_fraction(soc) -> Column:
    """Clay class of an organic-carbon percentage. NaN compares above every bound."""
    soc = _as_column(soc)
    return (
        F.when(soc < F.lit(D.SOC_LOW), F.lit(D.CLAY_LOW))
        .when(soc < F.lit(D.SOC_MEDIUM), F.lit(D.CLAY_MEDIUM))
        .otherwise(F.lit(D.CLAY_HIGH))
    )


def sample_key(id_column, seed: int | Column) -> Column:
    """Hex digest that orders rows at random but reproducibly for a seed."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.md5(F.concat(seed.cast("string"), F.lit(":"), _as_column(id_column).cast("string")))
