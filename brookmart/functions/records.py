"""JSON text to rows and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_dynamic(c: Column | str) -> Column:
    """JSON text of any shape -> variant; null where it is no JSON."""
    return F.try_parse_json(c)


def parse_typed(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """One column per field of `schema`, in place of the JSON text column.

    Numbers on the top level may also be given as text; what is no number reads as null.
    """
    rest = [c for c in df.columns if c != value]
    loose = T.StructType([
        T.StructField(f.name, T.StringType()) if isinstance(f.dataType, T.NumericType) else f
        for f in schema])
    text = df.select(*rest, parse_once(F.col(value), loose))
    return text.selectExpr(*[f"`{c}`" for c in rest], *[
        f"try_cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`"
        if isinstance(f.dataType, T.NumericType) else f"`{f.name}`" for f in schema])


def pick(schema: T.StructType, fields: Sequence[str]) -> T.StructType:
    """The part of `schema` that `fields` name; 'a.b' takes one field of the struct `a`."""
    chosen = []
    for f in schema:
        inner = [x.split(".", 1)[1] for x in fields if x.startswith(f.name + ".")]
        if f.name in fields:
            chosen.append(f)
        elif inner:
            chosen.append(T.StructField(f.name, pick(f.dataType, inner)))
    return T.StructType(chosen)


def parse_once(text: Column, schema: T.StructType) -> Column:
    """The fields of a JSON text as columns, for a select list.

    Written as a generator because the planner copies a plain `from_json` into every
    filter on one of its fields, and each copy parses the text again.
    """
    return F.inline(F.array(F.from_json(text, schema)))


def to_payload(df: DataFrame, keep: tuple[str, ...] = (), value: str = "value") -> DataFrame:
    """Each row as JSON text; null fields are left out."""
    fields = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.to_json(F.struct(*fields)).alias(value))


def is_blank(c: Column | str) -> Column:
    """Null or empty text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit("")) == ""


def is_object(text: Column) -> Column:
    """Whether a text is a JSON object whose keys differ."""
    return F.try_parse_json(text).try_cast("map<string, variant>").isNotNull()
