"""The monthly membership panel and its annual grid, from raw constituents and a master."""

from __future__ import annotations

from pyspark.sql import DataFrame

from idlink.operators.panel import ml_grid, monthly_panel
from idlink.operators.snapshots import month_snapshots
from idlink.sources.conform import clean_constituents, load_master


def build_panel(
    constituents: DataFrame, master: DataFrame, row_id: str = "row_id", collapse_unmatched: bool = False
) -> DataFrame:
    """`constituents` carries a unique `row_id`, the source order that settles ties."""
    snapshots = month_snapshots(clean_constituents(constituents, keep=[row_id]))
    return monthly_panel(snapshots, load_master(master), row_id, collapse_unmatched)


def build_grid(panel: DataFrame) -> DataFrame:
    return ml_grid(panel)
