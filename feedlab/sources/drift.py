"""JSON exports whose fields drift: schema inference in one pass.

Lines are parsed once into a Variant column and written; the schema is one
aggregate over that column.  A field that holds one type (or types that widen to
one) becomes a column.  A field whose rows disagree becomes a column of the type
most of its rows hold, and the rows that do not fit are quarantined with the
field, the value and the type found.  Lines that are no JSON object go there too.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlab.session import materialize
from feedlab.sources.readers import read_lines


def _spark_type(schema: str) -> str:
    """A variant schema as a Spark type: objects are structs, decimal numbers are
    doubles, a field that is always null is a string."""
    out = schema.replace("OBJECT<", "STRUCT<")
    out = re.sub(r"DECIMAL\(\d+,\s*\d+\)", "DOUBLE", out)
    return re.sub(r"(?<=[:<] )VOID|(?<=<)VOID|^VOID$", "STRING", out)


def _get(col: str, field: str, type_: str):
    """The field's value, null where it does not convert.  A path can quote a name
    in one way or the other; a name with both quotes is looked up in a map."""
    for mark in ("'", '"'):
        if mark not in field:
            return F.try_variant_get(col, f"$[{mark}{field}{mark}]", type_)
    value = F.try_element_at(F.try_variant_get(col, "$", "map<string,variant>"), F.lit(field))
    return F.try_variant_get(value, "$", type_)


def parse_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``(value, v)``: each line and its variant, null where it is no JSON object."""
    v = F.try_parse_json(col)
    is_object = F.schema_of_variant(v).startswith("OBJECT<")
    return materialize(lines.select(F.col(col).alias("value"), F.when(is_object, v).alias("v")), "json-variant")


def infer_fields(parsed: DataFrame, col: str = "v") -> tuple[dict[str, str], set[str]]:
    """Field -> Spark type over all rows, and the fields whose rows disagree.

    One pass; a second one counts types, and only for fields that disagree.  Of
    equally frequent types the first by name is taken.
    """
    schema = parsed.filter(F.col(col).isNotNull()).agg(F.schema_of_variant_agg(col)).first()[0]
    if not schema.startswith("OBJECT<") or schema == "OBJECT<>":
        return {}, set()
    fields = {f.name: f.dataType for f in T._parse_datatype_string(_spark_type(schema)).fields}
    mixed = {n for n, t in fields.items() if isinstance(t, T.VariantType)}
    types = {n: t.simpleString() for n, t in fields.items()}
    if mixed:
        names = sorted(mixed)
        held = parsed.select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("field"), F.schema_of_variant(_get(col, n, "variant")).alias("type"))
            for n in names])).alias("x")).filter("x.type is not null and x.type <> 'VOID'")
        # numbers of several widths are one type
        number = F.when(F.col("x.type").rlike(r"^DECIMAL"), "DOUBLE").otherwise(F.col("x.type"))
        counts = held.groupBy("x.field", number.alias("type")).count().orderBy("field", F.desc("count"), "type").collect()
        for r in reversed(counts):
            types[r["field"]] = T._parse_datatype_string(_spark_type(r["type"])).simpleString()
    return types, mixed


def read_json_inferred(spark: SparkSession, path, lines: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The table with all fields found, in order of name, and the quarantine
    ``(value, field, found, type)``.

    A line that is no JSON object is quarantined with a null field.  A value that
    does not fit its field's type is quarantined, and null in the table: its row
    keeps its other fields.  A missing field and a JSON null are null.
    """
    parsed = parse_lines(lines if lines is not None else read_lines(spark, path))
    types, mixed = infer_fields(parsed)
    table = parsed.filter("v is not null").select(*[
        _get("v", n, t).alias(n) if n not in mixed else _fitting(n, t).alias(n)
        for n, t in types.items()])
    null = F.lit(None).cast("string")
    bad = parsed.filter("v is null and trim(value) <> ''").select("value", null.alias("field"), null.alias("found"),
                                                                  null.alias("type"))
    for n in sorted(mixed):
        raw = _get("v", n, "variant")
        misfit = raw.isNotNull() & (F.schema_of_variant(raw) != "VOID") & _fitting(n, types[n]).isNull()
        bad = bad.unionByName(parsed.filter(misfit).select(
            "value", F.lit(n).alias("field"), raw.cast("string").alias("found"), F.schema_of_variant(raw).alias("type")))
    return table, bad


def _fitting(name: str, type_: str):
    """The value if it is of the type itself; a string that happens to read as a
    number does not fit a number."""
    raw = _get("v", name, "variant")
    found = F.regexp_replace(F.regexp_replace(F.schema_of_variant(raw), "OBJECT<", "STRUCT<"), r"DECIMAL\([^)]*\)", "DOUBLE")
    want = type_.upper()
    numbers = ("BIGINT", "DOUBLE")
    fits = found.isin(*numbers) if want == "DOUBLE" else (F.upper(found) == want)
    if want.startswith(("STRUCT", "ARRAY")):
        fits = found.startswith(want.split("<")[0])
    return F.when(fits, _get("v", name, type_))
