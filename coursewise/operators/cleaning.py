"""Bronze cleaning (C1-C7): schema-driven column rewrites, no data scan on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case, trim, spaces -> underscores."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


NESTED = (T.StructType, T.ArrayType, T.MapType)


def reconcile(df: DataFrame, schema: T.StructType) -> DataFrame:
    """C1 over files of differing columns: declared columns in their types and order, then the others as text.

    Names are normalised first; of columns whose names become the same the
    first non-null value counts.  A declared column that is missing is NULL; a
    value that its declared type cannot hold is an error.  Columns that are
    declared as nested are text here: give them as JSON (C2).
    """
    own: dict[str, list[str]] = {}
    for c in df.columns:
        own.setdefault(normalize_name(c), []).append(c)

    def merged(name: str, kind: str) -> Column:
        return F.coalesce(*(F.col(_quoted(c)).cast(kind) for c in own.get(name, [])), F.lit(None).cast(kind)).alias(name)

    declared = {normalize_name(f.name): "string" if isinstance(f.dataType, NESTED) else f.dataType.simpleString() for f in schema.fields}
    extra = [n for n in own if n not in declared]
    return df.select(*(merged(n, kind) for n, kind in declared.items()), *(merged(n, "string") for n in extra))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def nested_to_json(df: DataFrame) -> DataFrame:
    """Struct / array / map columns -> JSON text (chosen from the schema)."""
    return df.withColumns({f.name: F.to_json(F.col(_quoted(f.name)))
                           for f in df.schema.fields if isinstance(f.dataType, NESTED)})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating-point column (Q2/Q3)."""
    return df.withColumns({f.name: F.when(~F.isnan(F.col(_quoted(f.name))), F.col(_quoted(f.name)))
                           for f in df.schema.fields
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def to_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """C4: unparsable values -> NULL (``errors='coerce'``)."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def split_parent_child(records: DataFrame, parent: str = "course_data", children: str = "instructors",
                       id_field: str = "course_id") -> tuple[DataFrame, DataFrame]:
    """Nested page records -> parent rows and child rows carrying the parent id.

    Records without an id are dropped from both.  ``explode`` keeps the work
    per record; the child list of a record is small by construction.
    """
    with_id = records.filter(F.col(f"{parent}.{id_field}").isNotNull())
    parents = with_id.select(f"{parent}.*")
    kids = (with_id.select(F.col(f"{parent}.{id_field}").alias(id_field),
                           F.explode(children).alias("__c"))
                   .select(id_field, "__c.*"))
    return parents, kids


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs -> one column per leaf, named by the dotted path."""
    def leaves(schema: T.StructType, prefix: list[str]):
        for f in schema.fields:
            path = prefix + [f.name]
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, path)
            else:
                yield path

    cols = [F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)) for path in leaves(df.schema, [])]
    return df.select(*cols)


def fill_defaults(df: DataFrame, cols: list[str], value=0) -> DataFrame:
    """NULL -> a default in the given columns (type kept)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType)) for c in cols})
