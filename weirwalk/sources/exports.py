"""Tables as the database exports them: their names, column names, dates and spellings.

Every reader here is one narrow step over the exported rows. What an export holds
that the logical tables cannot is kept beside them: a date's text where it cannot be
read, and counts of such rows, which are observed while the rows go by.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirwalk import fixed_values as fv
from weirwalk import schema
from weirwalk.functions.features import number_in, required

# Column names as the detection and tagging exports spell them.
EXPORT_COLUMNS = {
    "Tag Code": "tag_code",
    "Site Name": "site_name",
    "Antenna Group Name": "antenna_group",
    "Obs Time Value": "obs_time",
    "Migration Year YYYY": "migration_year",
    "Run Name": "run_name",
    "Release Date MMDDYYYY": "release_date",
    "Age": "age",
}

# How exports write dates, beside what a cast reads.
EXPORT_DATES = ("MM/dd/yyyy", "MMddyyyy")

# What the tables of a basin are called.
TABLE_BASINS = {"clearwater": "Clearwater", "salmon": "Salmon", "snake": "Lower_Snake"}

# Spellings of the species, in lower case.
SPECIES = {
    "chinook": "Chinook",
    "chinook salmon": "Chinook",
    "chk": "Chinook",
    "steelhead": "Steelhead",
    "steelhead trout": "Steelhead",
    "sth": "Steelhead",
}


def text_of(column: str) -> Column:
    """The column's text without blanks around it; NULL if nothing is left."""
    return F.nullif(F.trim(F.col(f"`{column}`").cast("string")), F.lit(""))


def exported_date(column: str) -> Column:
    """A timestamp column as it is, or text in one of the exports' formats; NULL if none fits."""
    text = text_of(column)
    read = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in EXPORT_DATES]
    return F.coalesce(*read, F.expr(f"try_cast(trim(CAST(`{column}` AS string)) AS timestamp_ntz)"))


def unread_date(column: str) -> Column:
    """The text of a date that no format fits, NULL for all others."""
    return F.when(exported_date(column).isNull(), text_of(column))


def _named(rows: DataFrame, source: str, species_group: str | None) -> DataFrame:
    return rows.withColumnsRenamed(EXPORT_COLUMNS).withColumns(
        {"source": F.lit(source), "species_group": F.lit(species_group).cast("string")}
    )


def _values(rows: DataFrame, table: T.StructType, tag: Column) -> list[Column]:
    have = set(rows.columns)

    def value(field: T.StructField) -> Column:
        if field.name == "tag_code":
            return tag
        if field.name not in have:
            return F.lit(None)
        if isinstance(field.dataType, T.TimestampNTZType):
            return exported_date(field.name)
        return F.trim(field.name) if field.name == "site_name" else F.col(field.name)

    return [value(f).cast(f.dataType).alias(f.name) for f in table.fields]


def from_export(
    rows: DataFrame, table: T.StructType, source: str, species_group: str | None
) -> DataFrame:
    """An exported detection or tagging table under the logical column names.

    The export holds one source of one species group; both become columns. A NULL
    tag fails the job. Sites are trimmed. A date in no known format is NULL;
    ``ingest_export`` also keeps its text.
    """
    named = _named(rows, source, species_group)
    return named.select(*_values(named, table, required("tag_code")))


def ingest_export(
    rows: DataFrame, table: T.StructType, source: str, species_group: str | None
) -> tuple[DataFrame, Observation]:
    """The exported table as ``from_export`` gives it, with what could not be read.

    Each date column ``x`` gets a column ``x_raw``: the exported text where it is in
    no known format, else NULL. Rows without a tag are left out. The observation
    counts, in the pass that reads the rows, ``n_rows``, ``n_rejected`` (no tag) and
    ``n_unread_x`` of the rows that stay; for detections also ``n_unknown_site``, rows
    at a site that is neither in the catalogue nor an adult ladder. It can be read after
    the first action on the rows.
    """
    named = _named(rows, source, species_group)
    dates = [
        f.name
        for f in table.fields
        if isinstance(f.dataType, T.TimestampNTZType) and f.name in named.columns
    ]
    raw = [unread_date(name).alias(f"{name}_raw") for name in dates]
    read = named.select(*_values(named, table, text_of("tag_code")), *raw)
    stays = F.col("tag_code").isNotNull()
    counts = [F.count("*").alias("n_rows"), F.count_if(~stays).alias("n_rejected")]
    counts += [
        F.count_if(stays & F.col(f"{name}_raw").isNotNull()).alias(f"n_unread_{name}")
        for name in dates
    ]
    if "site_name" in table.fieldNames():
        ladder = reduce(Column.__or__, [F.col("site_name").ilike(f"%{w}%") for w in fv.ADULT_SITES])
        known = number_in("site_name", [name for _, _, name, _ in fv.SITES]).isNotNull() | ladder
        unknown = stays & ~F.coalesce(known, F.lit(False))
        counts.append(F.count_if(unknown).alias("n_unknown_site"))
    observation = Observation()
    return read.observe(observation, *counts).filter(stays), observation


@dataclass(frozen=True)
class PassageTable:
    """Which population and checkpoint a stored passage table is for, and its columns."""

    basin: str
    run: str
    dam: str

    @classmethod
    def named(cls, name: str) -> PassageTable:
        """From a table's name: basin, run and checkpoint, as in ``Lower_Snake_CH1_LGS``."""
        basins = {spelled.lower(): basin for basin, spelled in TABLE_BASINS.items()}
        pattern = rf"({'|'.join(basins)})_([a-z0-9]+)_({'|'.join(fv.DAMS).lower()})"
        found = re.fullmatch(pattern, name.strip().lower())
        if found is None:
            raise ValueError(f"not the name of a passage table: {name}")
        return cls(basins[found[1]], found[2].upper(), found[3].upper())

    @property
    def name(self) -> str:
        return f"{TABLE_BASINS[self.basin]}_{self.run}_{self.dam}"

    @property
    def columns(self) -> dict[str, str]:
        """Logical column → column of the table.

        A table holds the flags of the checkpoint above, its own and those below. The
        first table has no checkpoint above and records no passage.
        """
        flags = {"at_dam": self.dam, "below": f"Below_{self.dam}"}
        place = fv.DAMS.index(self.dam)
        if place == 0:
            return {"tag_code": "Tag Code", **flags}
        return {
            "tag_code": "Tag Code",
            "spp": "Spp",
            "run_type": "Run_type",
            "release_date": "Release_Date",
            "pass_date": f"{self.dam}_Pass_Date",
            "upstream": fv.DAMS[place - 1],
            **flags,
        }


def _flag(column: str) -> Column:
    """0, 1, 2 or NULL, as a number or as text; anything else fails the job."""
    value = F.expr(f"try_cast(trim(CAST(`{column}` AS string)) AS int)")
    wrong = F.raise_error(F.concat(F.lit(f"no flag in {column}: "), text_of(column)))
    return F.when(text_of(column).isNull(), F.lit(None).cast("int")).when(
        F.coalesce(value.isin(0, 1, 2), F.lit(False)), value
    ).otherwise(wrong.cast("int"))


def species_name(column: str) -> Column:
    """The species under its one name; a name that is not known stays, without blanks around it."""
    return F.coalesce(
        *[
            F.when(F.lower(text_of(column)).isin([s for s, to in SPECIES.items() if to == name]), name)
            for name in dict.fromkeys(SPECIES.values())
        ],
        text_of(column),
    )


def passage_from_export(rows: DataFrame, table: PassageTable) -> DataFrame:
    """One stored passage table as rows of the long table.

    The column set of the checkpoint (flags above, at and below it, and its pass
    date) becomes the columns that all checkpoints share. Columns that the table does
    not have are NULL, further ones are left out. A NULL or empty tag fails the job.
    """
    have = {name.lower(): name for name in rows.columns}
    stored = {to: have[name.lower()] for to, name in table.columns.items() if name.lower() in have}
    missing = {"tag_code", "at_dam", "below"} - set(stored)
    if missing:
        raise ValueError(f"{table.name} has no column for {sorted(missing)}")

    def value(field: T.StructField) -> Column:
        name = field.name
        if name in ("basin", "run", "dam"):
            return F.lit(getattr(table, name))
        if name not in stored:
            return F.lit(None)
        if isinstance(field.dataType, T.TimestampNTZType):
            return exported_date(stored[name])
        if isinstance(field.dataType, T.IntegerType):
            return _flag(stored[name])
        return species_name(stored[name]) if name == "spp" else text_of(stored[name])

    fields = schema.PASSAGE.fields
    read = rows.select(*[value(f).cast(f.dataType).alias(f.name) for f in fields])
    return read.withColumn("tag_code", required("tag_code"))


def passage_from_exports(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All stored passage tables, by their names, as one long table."""
    parts = [passage_from_export(rows, PassageTable.named(name)) for name, rows in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def passage_to_export(passage: DataFrame, table: PassageTable) -> DataFrame:
    """The rows of one population and checkpoint under the stored table's columns."""
    here = F.lit(True)
    for name in ("basin", "run", "dam"):
        here = here & (F.col(name) == getattr(table, name))
    return passage.filter(here).select(
        *[F.col(name).alias(stored) for name, stored in table.columns.items()]
    )
