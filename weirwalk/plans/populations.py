"""Passage runs: from the three inputs to the filled passage tables.

All populations asked for run as one job keyed by (basin, run, tag_code).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from weirwalk import fixed_values as fv
from weirwalk.fixed_values import Population
from weirwalk.plans.batches import BATCH_NAMES, apply_batches, facts_written, needs
from weirwalk.plans.wide import passage_tables, wide_rows


def select_populations(
    basin: str | None = None, run: str | None = None
) -> tuple[Population, ...]:
    """The populations of a basin, a run, or both."""
    return tuple(
        p for p in fv.POPULATIONS if basin in (None, p.basin) and run in (None, p.run)
    )


def run_batches(
    detections: DataFrame,
    tagging: DataFrame,
    passage: DataFrame,
    populations: tuple[Population, ...] = fv.POPULATIONS,
    batches: tuple[str, ...] = BATCH_NAMES,
    dams: tuple[str, ...] = fv.FILLED_DAMS,
    added: bool = False,
    release_mcn_dam: str = "LMN",
    partitions: int = 1,
) -> DataFrame:
    """The passage tables of the given checkpoints after the given batches.

    Batches that none of these tables depends on are left out, and so are release
    sources and tagging rows where no batch that stays reads them. ``partitions`` raises
    ``spark.sql.shuffle.partitions`` for the rows that are dealt by tag, where the tables are large.
    """
    needed = needs(batches, dams, release_mcn_dam)
    aged = needed.ages and any(p.release_sources and p.age is not None for p in populations)
    read = tagging if needed.facts or aged else None
    wide = wide_rows(detections, read, passage, populations, needed.sources, partitions)
    wide = apply_batches(wide, needed.batches, release_mcn_dam)
    return passage_tables(wide, facts_written(batches), dams, added)
