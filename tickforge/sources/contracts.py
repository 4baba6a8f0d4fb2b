"""Wire contracts with versions: fields that topics gain, from the first message on to every reader.

Messages are decoded by the newest stored version.  Fields it does not name are kept in a map column, as text, so that
nothing is lost before anybody declares them.  Declaring a field stores a new version: streams that are started again
write it as a column, and readers find it in all rows, taken from the map where a row is older than the version.
Versions only add fields; a changed or missing one is an error.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from tickforge import schemas
from tickforge.sinks.lake import overwrite
from tickforge.sources.lake import snapshot, versions

#: Map of the fields that the contract in force did not name when a row was decoded.
UNKNOWN = "unknown_fields"
#: Versions are small and all of them stay.
KEEP = 1_000_000


def added(current: StructType, wanted: StructType) -> StructType:
    """``current`` with the fields that ``wanted`` has beyond it; refuses a field of another type."""
    known = {f.name: f.dataType for f in current}
    for field in wanted:
        if field.name == UNKNOWN or field.name in known and known[field.name] != field.dataType:
            raise ValueError(f"field {field.name} cannot become {field.dataType.simpleString()}")
    return StructType([*current, *(f for f in wanted if f.name not in known)])


def declare(spark: SparkSession, path: str, fields: str | StructType, start: StructType) -> StructType:
    """Add ``fields`` to the contract stored at ``path`` (``start`` before its first version); returns the new one.

    Declaring what is known already stores nothing.
    """
    current = contract(spark, path, start)
    wanted = added(current, schemas.struct(fields) if isinstance(fields, str) else fields)
    if wanted != current:
        overwrite(spark.createDataFrame([(wanted.json(),)], "contract string").coalesce(1), path, keep=KEEP)
    return wanted


def contract(spark: SparkSession, path: str, start: StructType) -> StructType:
    """Newest version stored at ``path``, ``start`` if there is none."""
    if not versions(spark, path):
        return start
    return StructType.fromJson(json.loads(snapshot(spark, path).first()[0]))


def unknown_fields(value: Column, known: StructType) -> Column:
    """Fields of a JSON object beyond ``known``, as text; null for none and for text that is no object."""
    fields = F.from_json(value, "map<string,string>")
    beyond = F.map_filter(fields, lambda name, _: ~name.isin([f.name for f in known]))
    # bound by a lambda, the text is parsed once, not for the test and again for the result
    return F.transform(F.array(beyond), lambda found: F.when(F.size(found) > 0, found))[0]


def promoted(df: DataFrame, known: StructType) -> DataFrame:
    """Rows as if all had been decoded by ``known``: declared fields come from the map where the column is null.

    A value that does not fit the declared type becomes NULL, as in decoding.  ``df`` without the map stays as it is.
    """
    if UNKNOWN not in df.columns:
        return df
    kept, late = F.col(UNKNOWN), [f for f in known if f.name in df.columns]

    def from_map(field) -> Column:
        text = F.try_element_at(kept, F.lit(field.name))
        if isinstance(field.dataType, StringType):
            return text
        return F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), StructType().add("v", field.dataType))["v"]

    rest = F.map_filter(kept, lambda name, _: ~name.isin([f.name for f in known]))
    return df.withColumns({f.name: F.coalesce(F.col(f.name), from_map(f)) for f in late}).withColumn(
        UNKNOWN, F.when(F.size(rest) > 0, rest))
