"""Wire codecs (U6, S7/S8, K8, F4/F5) as pairs of column expressions.

``Person`` travels as the UTF-8 bytes of ``"name,age"``. Decoding splits on ``,``,
takes token 0 as the name and token 1 as an int; extra tokens are ignored. In mode "strict" a
record that can't be encoded (a null field, a name with a comma) or decoded (no comma, no
whole number) fails the job. In mode "quarantine" it keeps going: the record has null fields
(a null value when encoding) and ``_corrupt`` says what it was. A null value decodes to nulls in
"quarantine" and fails in "strict".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _check_mode(mode: str) -> None:
    if mode not in ("strict", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")


def encode_person(df: DataFrame, name: str = "name", age: str = "age",
                  keep: list[str | Column] | None = None, mode: str = "strict") -> DataFrame:
    """Person -> ``value`` binary column (Kafka's value field)."""
    _check_mode(mode)
    text = F.concat_ws(",", F.coalesce(F.col(name), F.lit("null")), F.coalesce(F.col(age).cast("string"), F.lit("null")))
    wire = F.encode(text, "UTF-8")
    bad = F.col(name).isNull() | F.col(age).isNull() | F.contains(F.col(name), F.lit(","))
    if mode == "strict":
        return df.select(*(keep or []), F.when(bad, F.raise_error(F.concat(F.lit("not a person record: "), text)).cast("binary")).otherwise(wire).alias("value"))
    return df.select(*(keep or []), F.when(~bad, wire).alias("value"), F.when(bad, text).alias("_corrupt"))


def decode_person(df: DataFrame, value: str = "value", keep: list[str | Column] | None = None,
                  mode: str = "strict") -> DataFrame:
    """``value`` (binary or string) -> ``name``, ``age``."""
    _check_mode(mode)
    v = F.col(value)
    text = F.decode(v, "UTF-8") if dict(df.dtypes)[value] == "binary" else v.cast("string")
    parts = F.split(text, ",")
    name, age = F.get(parts, 0), F.get(parts, 1).try_cast("int")
    if mode == "strict":
        failed = F.raise_error(F.concat(F.lit("not a person record: "), F.coalesce(text, F.lit("null"))))
        return df.select(*(keep or []), F.when(age.isNull(), failed.cast("string")).otherwise(name).alias("name"),
                         F.when(age.isNull(), failed.cast("int")).otherwise(age).alias("age"))
    return df.select(*(keep or []), F.when(age.isNotNull(), name).alias("name"), age.alias("age"),
                     F.when(age.isNull(), text).alias("_corrupt"))
