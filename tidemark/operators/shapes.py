"""What JSON of unknown shape holds: its paths and types, without a schema declared first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

ROOT, UNREADABLE = "$", "UNREADABLE"
_STRINGS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_NUMBERS = ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL")


def readable(df: DataFrame, column: str, out: str = "_value") -> DataFrame:
    """The frame with the JSON text of a column as a VARIANT, null where it can't be read."""
    return df.withColumn(out, F.try_parse_json(column))


def at_path(value: Column | str, path: str, kind: str) -> Column:
    """What stands at a path such as `$.flow_progress.metrics.num_output_rows`, as a type of Spark; null if it
    isn't there or isn't of that kind."""
    return F.try_variant_get(value, path, kind)


def merged_schema(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """One schema in DDL that fits all readable values of a group."""
    return readable(df, column).groupBy(*by).agg(F.schema_of_variant_agg("_value").alias("schema"))


def _kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, NUMBER, BOOLEAN or NULL."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.when(name == "VOID", "NULL").when(name.isin(*_NUMBERS), "NUMBER").otherwise(name)


def paths(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, path, kind, n): every path in the JSON of a column, the kinds of values met there and how often.

    Elements of an array share the path `[*]`. A text that is not JSON counts at the root as UNREADABLE, a null as NULL, so
    no row is lost. How deep the values are nested is found first, in one pass over the text; then each level is
    one explode of the level before.
    """
    spark = df.sparkSession
    values = readable(df, column).select(*by, F.col(column).alias("_text"), "_value")
    kind = F.when(F.col("_text").isNull(), "NULL").when(F.col("_value").isNull(), UNREADABLE).otherwise(_kind(F.col("_value")))
    nodes = values.select(*by, F.lit(ROOT).alias("path"), "_value", kind.alias("kind"))
    brackets = F.regexp_replace(F.regexp_replace("_text", _STRINGS, ""), r"[^\[\]{}]", "")
    step = F.transform(F.split(brackets, ""), lambda c: F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0))
    state = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    deep = F.aggregate(step, state, lambda s, d: F.struct(
        (s["now"] + d).alias("now"), F.greatest(s["most"], s["now"] + d).alias("most")))
    depth = values.where("_value IS NOT NULL").agg(F.max(deep["most"])).first()[0] or 0
    levels = [nodes]
    for _ in range(depth):
        keep = "".join(f"t.`{c}`, " for c in by)
        inner = levels[-1].where(F.col("kind").isin("OBJECT", "ARRAY"))
        opened = spark.sql(
            f"SELECT {keep}t.path, t.kind AS outer_kind, e.key, e.value AS _value FROM {{nodes}} t, LATERAL variant_explode(t._value) e",
            nodes=inner)
        path = F.concat("path", F.when(F.col("outer_kind") == "ARRAY", "[*]").otherwise(F.concat(F.lit("."), F.col("key"))))
        levels.append(opened.select(*by, path.alias("path"), "_value", _kind(F.col("_value")).alias("kind")))
    counted = [level.groupBy(*by, "path", "kind").agg(F.count("*").alias("n")) for level in levels]
    out = counted[0]
    for level in counted[1:]:
        out = out.unionByName(level)
    return out
