"""Nested payloads: JSON text with declared fields, parsed without losing what does not fit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "double", "boolean")


def parse(df: DataFrame, column: str, fields: Mapping[str, str], required: Sequence[str] = ()) -> DataFrame:
    """The table with the declared fields and ``problem``, null where the payload has all it should.

    ``fields`` maps a name to a type: string, a number, boolean, or an array of these. A problem is the first of: absent (null
    payload), malformed (not JSON), no object, the first field in declared order whose value does not have its type ("type of
    x"), the first required field that is missing or null ("no x"). A field that does not fit is null, the others keep their value.
    Numbers do not fit text, text does not fit numbers, and whole numbers do not fit when they have a fraction or too many digits.

    The payload is parsed once into a variant; the fields are read from that.
    """
    clash = [c for c in (*fields, "problem") if c in df.columns]
    if clash:
        raise ValueError(f"columns exist already: {', '.join(clash)}")
    doc = F.try_parse_json(F.col(f"`{column}`"))
    parsed = df.withColumn("_doc", doc)
    kind = F.schema_of_variant("_doc")
    values, wrong = {}, []
    for name, type_ in fields.items():
        raw = F.try_variant_get("_doc", f"$['{name}']", "variant")
        present = raw.isNotNull() & ~F.is_variant_null(raw)
        value = F.when(_fits(raw, type_), F.try_variant_get("_doc", f"$['{name}']", type_))
        values[name] = value
        wrong.append(F.when(present & value.isNull(), F.lit(f"type of {name}")))
    missing = [F.when(F.try_variant_get("_doc", f"$['{n}']", "variant").isNull()
                      | F.is_variant_null(F.try_variant_get("_doc", f"$['{n}']", "variant")), F.lit(f"no {n}")) for n in required]
    problem = (F.when(F.col(f"`{column}`").isNull(), "absent").when(F.col("_doc").isNull(), "malformed")
               .when(~kind.startswith("OBJECT"), "no object").otherwise(F.coalesce(*wrong, *missing, F.lit(None).cast("string"))))
    return parsed.withColumns({**values, "problem": problem}).drop("_doc")


def _fits(raw: Column, type_: str) -> Column:
    """Whether a value has the declared type itself, rather than one that could be converted."""
    found = F.schema_of_variant(raw)
    text = {"string": ["STRING"], "boolean": ["BOOLEAN"], "bigint": ["BIGINT"], "int": ["BIGINT"], "smallint": ["BIGINT"], "tinyint": ["BIGINT"]}
    if type_.startswith("array<"):
        inner = type_[6:-1]
        if inner == "double":
            return found.rlike(r"^ARRAY<(VOID|BIGINT|DOUBLE|DECIMAL\(\d+,\d+\))>$")
        return found.isin(*[f"ARRAY<{t}>" for t in (*text[inner], "VOID")])
    if type_ == "double":
        return found.rlike(r"^(BIGINT|DOUBLE|DECIMAL\(\d+,\d+\))$")
    return found.isin(*text[type_])


def problems(parsed: DataFrame) -> DataFrame:
    """problem, n: how many rows have each problem; ``ok`` counts those without."""
    return parsed.groupBy(F.coalesce("problem", F.lit("ok")).alias("problem")).agg(F.count(F.lit(1)).alias("n"))


def folded(df: DataFrame, column: str, into: Mapping[str, str]) -> DataFrame:
    """The table with one column for each way (n, sum, least, most, mean) to fold an array of numbers; nulls in it are skipped.

    Empty arrays have n 0, sum 0 and null otherwise; a null array folds to null. Sums run in the array's order.
    """
    held = F.filter(F.col(f"`{column}`"), lambda x: x.isNotNull())
    total = F.aggregate(held, F.lit(0.0), lambda s, x: s + x)
    ways = {"n": F.when(held.isNotNull(), F.size(held).cast("long")), "sum": total, "least": F.array_min(held), "most": F.array_max(held),
            "mean": F.try_divide(total, F.size(held))}
    return df.withColumns({name: ways[way] for name, way in into.items()})


def map_totals(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """by, name, n, total: the entries of a map column summed by name over the rows of a group; null values count but add nothing."""
    entries = df.select(*[F.col(f"`{c}`") for c in by], F.explode(F.col(f"`{column}`")).alias("name", "value"))
    return entries.groupBy(*[F.col(f"`{c}`") for c in by], "name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(28,4)")).cast("double").alias("total"))
