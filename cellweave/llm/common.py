"""What the text operators share."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space; a word is a longest run of anything else.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
find_words = re.compile(WORD).findall


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text, a null as an empty one."""
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def word_count(column: Column) -> Column:
    return F.regexp_count(column, F.lit(WORD)).cast("long")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns whose names an operator's own output takes."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` for ``function(batch) -> dict of lists``, one output batch for each input batch.

    Arrow batches are bounded by Spark in rows and bytes, so a task holds one batch at a time.
    """
    from cellweave.session import ship

    ship(df.sparkSession)
    names = [f.name for f in df.sparkSession.createDataFrame([], schema).schema.fields]
    types = _arrow_schema(df, schema)

    def run(batches):
        for batch in batches:
            out = function(batch)
            yield pa.RecordBatch.from_arrays([pa.array(out[n], type=types.field(n).type) for n in names], schema=types)

    return df.mapInArrow(run, schema)


def _arrow_schema(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)
