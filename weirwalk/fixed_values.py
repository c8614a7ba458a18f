"""Reader sites, antenna and adult patterns, seasons, populations.

Everything in this file is data the results depend on. Nothing is computed here
beyond looking values up.
"""

from __future__ import annotations

from dataclasses import dataclass

# Reader sites in river order (ord, code, site name, dam).
SITES = (
    (1, "GOJ", "GOJ - Little Goose Dam Juvenile", "LGS"),
    (2, "LMJ", "LMJ - Lower Monumental Dam Juvenile", "LMN"),
    (3, "ICH", "ICH - Ice Harbor Dam (Combined)", None),
    (4, "MCJ", "MCJ - McNary Dam Juvenile", "MCN"),
    (5, "MCX", "MCX - MCNARY JUVENILE EXPERIMENTAL", "MCN"),
    (6, "JDJ", "JDJ - John Day Dam Juvenile", None),
    (7, "B2J", "B2J - Bonneville PH2 Juvenile", None),
    (8, "B1J", "B1J - BONNEVILLE PH1 JUVENILE", None),
    (9, "BVX", "BVX - Bonneville PH1 Juvenile (Exp.)", None),
    (10, "ESX", "ESX - Estuary Saltwater Experiment", None),
)

# The checkpoints in downstream order. LGR is read only.
DAMS = ("LGR", "LGS", "LMN", "MCN")
FILLED_DAMS = ("LGS", "LMN", "MCN")

# First and last river order counted as "below" a checkpoint.
# The fourth set leaves Ice Harbor (3) out.
BELOW_ORD = {
    "below_lgs": (2, 10),
    "below_lmn": (3, 10),
    "below_mcn": (6, 10),
    "below_lmn_101": (4, 10),
}

# Substrings, matched without regard to case.
REMOVAL_ANTENNAS = ("sample", "raceway")
ADULT_SITES = ("adult", "ladder")

# Detection and tagging sources.
MAIN = "main"
LGR_RELEASE = "lgr_release"
LGS_RELEASE = "lgs_release"
LMN_RELEASE = "lmn_release"
SOURCES = (MAIN, LGR_RELEASE, LGS_RELEASE, LMN_RELEASE)
RELEASE_SOURCES = (LGR_RELEASE, LGS_RELEASE, LMN_RELEASE)

# Seasons as first and last (month, day), both inclusive.
SEASONS = {
    "spring": ((4, 24), (5, 25)),
    "summer": ((6, 3), (7, 8)),
}


@dataclass(frozen=True)
class Population:
    """One (basin, run) population and what its passage run depends on."""

    basin: str
    run: str
    spp: str
    species_group: str
    season: str
    age: str | None
    release_sources: tuple[str, ...] = ()


# The nine populations.
POPULATIONS = (
    Population("clearwater", "CH0", "Chinook", "CHK", "summer", None),
    Population("clearwater", "CH1", "Chinook", "CHK", "spring", None),
    Population("clearwater", "STH", "Steelhead", "STH", "spring", None),
    Population("salmon", "CH0", "Chinook", "CHK", "summer", None),
    Population("salmon", "CH1", "Chinook", "CHK", "spring", None),
    Population("salmon", "STH", "Steelhead", "STH", "spring", None),
    Population("snake", "CH0", "Chinook", "CHK", "summer", "Subyearling", RELEASE_SOURCES),
    Population("snake", "CH1", "Chinook", "CHK", "spring", "Yearling+", RELEASE_SOURCES),
    Population("snake", "STH", "Steelhead", "STH", "spring", None, RELEASE_SOURCES),
)


def site_names(*codes: str) -> list[str]:
    """Site names of the given codes, in river order."""
    return [name for _, code, name, _ in SITES if code in codes]


def dam_site_names(dam: str) -> list[str]:
    """Site names of the readers that stand at a checkpoint."""
    return [name for _, _, name, at in SITES if at == dam]


def below_site_names(below: str) -> list[str]:
    """Site names of one of the four "below" sets."""
    first, last = BELOW_ORD[below]
    return [name for ord_, _, name, _ in SITES if first <= ord_ <= last]
