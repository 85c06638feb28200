"""Spark helpers shared by the operators of this package."""

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from delaylens.session import cut, shared_dir, stored  # noqa: F401  (re-exported)

#: Vocabulary of the registered queries; every operator takes its path as a parameter.
VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name=VOCABULARY):
    import public_tokenizers
    return public_tokenizers.path(name)


def table(spark, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df, stem):
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def with_fields(schema, **extra):
    """Spark schema of ``schema`` without the extra names (any case), then the extra fields."""
    names = {n.lower() for n in extra}
    kept = [f for f in schema.fields if f.name.lower() not in names]
    return T.StructType(kept + [T.StructField(n, t, True) for n, t in extra.items()])


def appended(batch, arrays):
    """The record batch with the given columns in place of, or after, its own."""
    lower = {n.lower() for n in arrays}
    keep = [i for i, n in enumerate(batch.schema.names) if n.lower() not in lower]
    return pa.RecordBatch.from_arrays(
        [batch.column(i) for i in keep] + list(arrays.values()),
        names=[batch.schema.names[i] for i in keep] + list(arrays))


def map_arrow(df, fn, schema):
    return df.mapInArrow(fn, schema)


def id_remainder(doc_id, by):
    """Remainder of the crc32 of the id as text; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % by


def is_held_out(doc_id):
    """crc32 of the id as text leaves 1 when divided by 3."""
    return id_remainder(doc_id, 3) == 1
