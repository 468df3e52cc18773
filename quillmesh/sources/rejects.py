"""CSV files with their rejects: every row of a file is kept or told why it isn't.

Files are read once, permissively. A row is rejected whose width isn't the
schema's, which repeats the header, or which is blank; rejects keep their text
and reason. Counts of both come from the same pass, as observed metrics.

Files may be read line by line, so that a large one is split over tasks, or with
line ends inside quotes, which ties a file to one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RAW, REASON = "_raw", "_reason"


def read_checked(spark: SparkSession, path, schema: str, multiline: bool = True, header: bool = True, observed: Observation | None = None) -> DataFrame:
    """The columns of the schema (strings), _raw (the row's text if it is malformed) and _reason (null for good rows).

    observed: gets good, rejected and one count a reason when the result is used.
    """
    columns = StructType.fromDDL(schema).fieldNames()
    read = spark.read.options(header=str(header).lower(), multiLine=str(multiline).lower(), quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=RAW, encoding="UTF-8", enforceSchema="true")
    df = read.schema(f"{schema}, {RAW} string").csv(path)
    blank = reduce(lambda a, b: a & b, [F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")) == "" for c in columns])
    repeated = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"`{c}`") == c, F.lit(False)) for c in columns])
    reason = F.when(F.col(RAW).isNotNull(), "width").when(blank, "blank").when(repeated, "header")
    rows = df.withColumn(REASON, reason)
    if observed is None:
        return rows
    return rows.observe(observed, F.count_if(F.col(REASON).isNull()).alias("good"), F.count_if(F.col(REASON).isNotNull()).alias("rejected"), *[F.count_if(F.col(REASON) == r).alias(r) for r in ("width", "blank", "header")])


def split_rows(rows: DataFrame, as_text: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows without the two columns, and rejects as text and reason."""
    columns = [c for c in rows.columns if c not in (RAW, REASON)]
    text = as_text if as_text is not None else F.coalesce(RAW, F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in columns]))
    return rows.where(F.col(REASON).isNull()).select(*[f"`{c}`" for c in columns]), rows.where(F.col(REASON).isNotNull()).select(text.alias("text"), F.col(REASON).alias("reason"))
