"""JSON lines of any nesting to typed columns, with what does not fit kept by its path.

A line is parsed once, to a VARIANT. The schema is walked down to its leaves: a
value that its type cannot hold, and a field that the schema does not know, at
any depth, goes to the rescued column under its path (``$.user.id``,
``$.tags[2]``, ``$.attrs.size``); the typed column has NULL there. All of it is
one projection of built-in functions.

Modes for fields that the schema does not know (what the evolution of a load asks for):
``rescue`` keeps them in the rescued column, ``none`` drops them, ``failOnNewColumns`` raises, and
``addNewColumns`` adds new top-level fields as columns, of the type that all their values have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType, VariantType

from .files import RESCUED

_VALUE = "array<struct<path:string,value:variant>>"
MODES = ("rescue", "none", "failOnNewColumns", "addNewColumns")


def _none() -> Column:
    return F.array().cast(_VALUE)


def _one(path: Column, value: Column, when: Column) -> Column:
    return F.when(when, F.array(F.struct(path.alias("path"), value.alias("value")))).otherwise(_none())


def _there(value: Column) -> Column:
    """Neither absent nor a JSON null."""
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(True))


def fitted(value: Column, kind: DataType, path: Column, unknown: bool) -> tuple[Column, Column]:
    """``value`` (a VARIANT) as ``kind``, and an array of the paths and values that do not fit."""
    if isinstance(kind, VariantType):
        return value, _none()
    if isinstance(kind, StructType):
        fields = F.try_variant_get(value, "$", "map<string,variant>")
        typed, rescued = [], []
        for f in kind.fields:
            t, r = fitted(F.try_element_at(fields, F.lit(f.name)), f.dataType, F.concat(path, F.lit(f".{f.name}")), unknown)
            typed.append(t.alias(f.name))
            rescued.append(r)
        if unknown:
            other = F.map_entries(F.map_filter(fields, lambda k, _: ~k.isin([f.name for f in kind.fields])))
            other = F.transform(other, lambda e: F.struct(F.concat(path, F.lit("."), e["key"]).alias("path"), e["value"].alias("value")))
            rescued.append(F.coalesce(other, _none()))
        return F.when(fields.isNotNull(), F.struct(*typed)), F.when(fields.isNotNull(), F.concat(*rescued)).otherwise(
            _one(path, value, _there(value)))
    if isinstance(kind, ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        typed = F.transform(items, lambda x: fitted(x, kind.elementType, path, unknown)[0])
        rescued = F.flatten(F.transform(items, lambda x, i: fitted(
            x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), unknown)[1]))
        return typed, F.when(items.isNotNull(), rescued).otherwise(_one(path, value, _there(value)))
    if isinstance(kind, MapType):
        if not isinstance(kind.keyType, StringType):
            raise ValueError("JSON objects have string keys")
        items = F.try_variant_get(value, "$", "map<string,variant>")
        typed = F.transform_values(items, lambda _, x: fitted(x, kind.valueType, path, unknown)[0])
        rescued = F.flatten(F.transform(F.map_entries(items), lambda e: fitted(
            e["value"], kind.valueType, F.concat(path, F.lit("."), e["key"]), unknown)[1]))
        return typed, F.when(items.isNotNull(), rescued).otherwise(_one(path, value, _there(value)))
    typed = F.try_variant_get(value, "$", kind.simpleString())
    return typed, _one(path, value, _there(value) & typed.isNull())


def observed_fields(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """A row per top-level field of the lines: field, type (of all its values, as DDL) and n_lines."""
    fields = F.try_variant_get(F.try_parse_json(line_col), "$", "map<string,variant>")
    found = lines.select(F.explode(fields).alias("field", "v")).groupBy("field").agg(
        F.schema_of_variant_agg("v").alias("type"), F.count(F.lit(1)).alias("n_lines"))
    return found.withColumn("type", F.regexp_replace(F.regexp_replace("type", "OBJECT<", "STRUCT<"), "VOID", "VARIANT"))


def evolved(lines: DataFrame, schema: StructType, mode: str, line_col: str = "value") -> StructType:
    """``schema`` for a load of ``lines`` in this mode; one job, whose result has a row per field."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    if mode in ("rescue", "none"):
        return schema
    new = observed_fields(lines, line_col).filter(~F.col("field").isin(schema.names)).orderBy("field").collect()
    if new and mode == "failOnNewColumns":
        raise ValueError("new columns: " + ", ".join(r.field for r in new))
    return StructType([*schema.fields, *(StructField(r.field, DataType.fromDDL(r.type)) for r in new)])


def read_rescued(lines: DataFrame, schema: StructType, mode: str = "rescue", line_col: str = "value") -> DataFrame:
    """The columns of ``schema`` (and new ones in mode ``addNewColumns``) and ``_rescued_data``: a JSON object of
    paths and their original values, NULL if all fits. A line that is no JSON object is kept whole under ``_corrupt``."""
    schema = evolved(lines, schema, mode, line_col)
    value = F.try_parse_json(line_col)
    rows = lines.select(F.col(line_col).alias("_line"), value.alias("_v"))
    typed, rescued = fitted(F.col("_v"), schema, F.lit("$"), mode == "rescue" or mode == "addNewColumns")
    ok = F.try_variant_get("_v", "$", "map<string,variant>").isNotNull()
    rows = rows.select("_line", ok.alias("_ok"), typed.alias("_row"), F.when(ok, rescued).alias("_misfits"))
    kept = (F.when(~F.col("_ok") & F.col("_line").isNotNull(), F.to_json(F.create_map(F.lit("_corrupt"), F.col("_line"))))
            .when(F.size("_misfits") > 0, F.to_json(F.map_from_entries("_misfits"))))
    return rows.select("_row.*", kept.alias(RESCUED))


def drift_counts(df: DataFrame) -> DataFrame:
    """path (of array elements ``[*]``), n_values and n_rows: how much of each field was rescued, the drift monitor."""
    paths = F.map_keys(F.from_json(RESCUED, "map<string,string>"))
    paths = F.transform(paths, lambda p: F.regexp_replace(p, r"\[\d+\]", "[*]"))
    rows = df.filter(F.col(RESCUED).isNotNull()).select(F.explode(F.map_entries(F.aggregate(
        F.array_distinct(paths), F.create_map().cast("map<string,int>"),
        lambda m, p: F.map_concat(m, F.create_map(p, F.size(F.filter(paths, lambda q: q == p))))))).alias("e"))
    return rows.groupBy(F.col("e.key").alias("path")).agg(F.sum("e.value").alias("n_values"), F.count(F.lit(1)).alias("n_rows"))
