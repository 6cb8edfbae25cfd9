"""Rows that a recipe turns away, kept with all reasons, so that they can be mended and played again.

A quarantined row has the raw columns as they were read, the reasons, the file it
came from and, where a line did not parse, the line itself. Equal rows of one file,
turned away for the same reasons, are one row with the number of times.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.cleaning import CleaningRecipe

#: Columns beside the raw ones. RECORD is null for a row that was read whole.
RECORD, SOURCE, REASONS, TIMES = "__record", "__source", "__reasons", "__times"
MALFORMED = "line does not parse"


@dataclass(frozen=True)
class Sorted:
    """clean: converted rows that pass all rules. rejected: the others, raw."""

    clean: DataFrame
    rejected: DataFrame


def sort_out(recipe: CleaningRecipe, rows: DataFrame) -> Sorted:
    """Rows by whether they pass. ``clean`` and ``TIMES`` of ``rejected`` add up to the rows.

    rows: may have RECORD and SOURCE; without them no line is malformed and no source known.
          A null in a column that a rule needs is a reason. An empty table gives two empty ones.
    """
    raw = [c for c in rows.columns if c not in (RECORD, SOURCE)]
    for name in (RECORD, SOURCE):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    held = rows.withColumn("__raw", F.struct(*(F.col(c) for c in raw)))
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in recipe.rules().items()]
    # of a line that does not parse, the columns say nothing
    why = F.when(F.col(RECORD).isNotNull(), F.array(F.lit(MALFORMED))).otherwise(F.array_compact(F.array(F.lit(None).cast("string"), *broken)))
    judged = recipe.convert(held).withColumn(REASONS, why)
    clean = judged.where(F.size(REASONS) == 0).select(*raw)
    turned = judged.where(F.size(REASONS) > 0).select("__raw.*", RECORD, SOURCE, REASONS)
    return Sorted(clean, turned.groupBy(*turned.columns).agg(F.count(F.lit(1)).alias(TIMES)))


def replay(recipe: CleaningRecipe, mended: DataFrame, csv: dict[str, str] | None = None) -> Sorted:
    """Sort out quarantined rows again, after someone mended their columns or records.

    Rows with a RECORD are parsed from it, with the CSV options of the source; what
    still doesn't parse stays malformed. Each row comes back as often as it was there.
    """
    extra = (RECORD, SOURCE, REASONS, TIMES)
    raw = [f for f in mended.schema.fields if f.name not in extra]
    lines = T.StructType([*(T.StructField(f.name, T.StringType()) for f in raw), T.StructField(RECORD, T.StringType())])
    options = {**(csv or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    parsed = F.from_csv(F.col(RECORD), lines.simpleString(), options)
    again = mended.withColumn("__parsed", parsed).select(
        *(F.when(F.col(RECORD).isNull(), F.col(f.name)).otherwise(F.col(f"__parsed.{f.name}").try_cast(f.dataType)).alias(f.name) for f in raw),
        F.col(f"__parsed.{RECORD}").alias(RECORD),
        SOURCE,
        F.explode(F.sequence(F.lit(1), F.col(TIMES))).alias(TIMES),
    )
    return sort_out(recipe, again.drop(TIMES))
