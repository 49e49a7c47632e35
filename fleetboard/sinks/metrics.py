"""Counts taken on the way: the job that writes rows also tells how many were fresh, late or corrupt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fleetboard.functions.timefn import epoch_of
from fleetboard.sources.ingest import CORRUPT


def with_counts(
    rows: DataFrame, seconds: str | Column, *, horizon_s: int = 150, as_of: int | Column | None = None
) -> tuple[DataFrame, Observation]:
    """``rows`` and an observation that the first action on them fills: no second scan.

    rows; corrupt (a kept malformed message, where the rows have that column); fresh and late (by
    the horizon; corrupt rows and those without a time are neither); newest and oldest second.
    """
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in rows.columns else F.lit(False)
    sound = F.when(~corrupt, seconds)
    fresh = sound > epoch_of(as_of) - horizon_s
    seen = Observation()
    return rows.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(corrupt).alias("corrupt"), F.count_if(fresh).alias("fresh"),
        F.count_if(~fresh).alias("late"), F.max(sound).alias("newest"), F.min(sound).alias("oldest"),
    ), seen
