"""Data-quality counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idlink.functions import coerce
from idlink.schemas import Table
from idlink.sources.conform import lower_headers, rename_aliases


def check_types(raw: DataFrame, table: Table) -> DataFrame:
    """Per column of `table` found in `raw`: values present, and those that do not convert to its type."""
    df = rename_aliases(lower_headers(raw), table.aliases)
    source = {f.name: f.dataType for f in df.schema.fields}
    fields = [f for f in table.schema.fields if f.name in source]
    aggregates = []
    present_columns = [coerce.null_tokens(F.col(f.name).cast("string")).alias(f"_raw_{f.name}") for f in fields]
    df = df.select(*[f.name for f in fields], *present_columns)
    steps = [coerce.coerce_steps(f.name, source[f.name], f.dataType) for f in fields]
    for step in zip(*steps, strict=True):
        df = df.select(*step, *[f"_raw_{f.name}" for f in fields])
    for f in fields:
        present, converted = F.col(f"_raw_{f.name}"), F.col(f.name)
        aggregates.append(F.count(present).alias(f"{f.name}|n"))
        aggregates.append(F.count_if(present.isNotNull() & converted.isNull()).alias(f"{f.name}|bad"))
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("expected_type"),
                F.col(f"`{f.name}|n`").alias("n_present"),
                F.col(f"`{f.name}|bad`").alias("n_bad"),
            )
            for f in fields
        ]
    )
    return df.agg(*aggregates).select(F.inline(rows))


def check_spans(master: DataFrame) -> DataFrame:
    """Segments, and firm links, that end before they start."""
    return master.agg(
        F.count_if(F.expr("nameendt < namedt")).alias("n_bad_segments"),
        F.count_if(F.expr("gvkey IS NOT NULL AND linkenddt < linkdt")).alias("n_bad_links"),
    )


def check_primary(master: DataFrame) -> DataFrame:
    """Firms by their number of distinct primary securities: one, none, several."""
    flagged = F.when(F.col("is_primary_permno"), F.col("permno"))
    per_firm = (
        master.where("gvkey IS NOT NULL")
        .groupBy("gvkey")
        .agg(F.min(flagged).alias("_least"), F.max(flagged).alias("_most"))
    )
    return per_firm.agg(
        F.count_if(F.expr("_least = _most")).alias("n_one"),
        F.count_if(F.col("_least").isNull()).alias("n_zero"),
        F.count_if(F.expr("_least < _most")).alias("n_many"),
    )


def check_panel_duplicates(panel: DataFrame) -> DataFrame:
    """Rows in (date, gvkey) groups of more than one, all members counted; nulls are equal."""
    groups = panel.groupBy("date", "gvkey").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return groups.agg(F.coalesce(F.sum("_n"), F.lit(0).cast("long")).alias("n_duplicate_rows"))
