"""The driver tables as detections, tagging and passage tables, in SQL.

Written from the rules of FIXTURES.md, apart from the Spark code. Every check
statement starts with these common table expressions.
"""

from __future__ import annotations

# Fixed values, written here again so that a wrong one in the library shows: reader
# sites in river order, and those at and below each checkpoint.
GOJ = "GOJ - Little Goose Dam Juvenile"
LMJ = "LMJ - Lower Monumental Dam Juvenile"
ICH = "ICH - Ice Harbor Dam (Combined)"
MCJ = "MCJ - McNary Dam Juvenile"
MCX = "MCX - MCNARY JUVENILE EXPERIMENTAL"
JDJ = "JDJ - John Day Dam Juvenile"
B2J = "B2J - Bonneville PH2 Juvenile"
B1J = "B1J - BONNEVILLE PH1 JUVENILE"
BVX = "BVX - Bonneville PH1 Juvenile (Exp.)"
ESX = "ESX - Estuary Saltwater Experiment"
SITES = [GOJ, LMJ, ICH, MCJ, MCX, JDJ, B2J, B1J, BVX, ESX]
AT = {"LGS": [GOJ], "LMN": [LMJ], "MCN": [MCJ, MCX]}
BELOW = {
    "below_lgs": [LMJ, ICH, MCJ, MCX, JDJ, B2J, B1J, BVX, ESX],
    "below_lmn": [ICH, MCJ, MCX, JDJ, B2J, B1J, BVX, ESX],
    "below_mcn": [JDJ, B2J, B1J, BVX, ESX],
    "below_lmn_101": [MCJ, MCX, JDJ, B2J, B1J, BVX, ESX],
}

# Basin, run, species, species group, season, age, and whether it has releases.
POPULATIONS = (
    ("clearwater", "CH0", "Chinook", "CHK", "summer", None, False),
    ("clearwater", "CH1", "Chinook", "CHK", "spring", None, False),
    ("clearwater", "STH", "Steelhead", "STH", "spring", None, False),
    ("salmon", "CH0", "Chinook", "CHK", "summer", None, False),
    ("salmon", "CH1", "Chinook", "CHK", "spring", None, False),
    ("salmon", "STH", "Steelhead", "STH", "spring", None, False),
    ("snake", "CH0", "Chinook", "CHK", "summer", "Subyearling", True),
    ("snake", "CH1", "Chinook", "CHK", "spring", "Yearling+", True),
    ("snake", "STH", "Steelhead", "STH", "spring", None, True),
)


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def listed(values: list[str]) -> str:
    return ", ".join(text(v) for v in values)


def at(dam: str) -> str:
    return f"site_name IN ({listed(AT[dam])})"


def removed(dam: str) -> str:
    return f"({at(dam)} AND (antenna_group ILIKE '%SAMPLE%' OR antenna_group ILIKE '%RACEWAY%'))"


ADULT = (
    "((site_name ILIKE '%adult%' OR site_name ILIKE '%ladder%')"
    " AND year(obs_time) > migration_year)"
)


def below(name: str) -> str:
    return f"(site_name IN ({listed(BELOW[name])}) OR {ADULT})"


# The season windows as month and day tests.
SPRING = (
    "((month({0}) = 4 AND day({0}) BETWEEN 24 AND 31)"
    " OR (month({0}) = 5 AND day({0}) BETWEEN 1 AND 25))"
)
SUMMER = (
    "((month({0}) = 6 AND day({0}) BETWEEN 3 AND 31)"
    " OR (month({0}) = 7 AND day({0}) BETWEEN 1 AND 8))"
)


def in_season(when: str) -> str:
    """Season of the row's population."""
    return (
        f"CASE season WHEN 'spring' THEN {SPRING.format(when)} ELSE {SUMMER.format(when)} END"
    )


def _populations() -> str:
    rows = [
        f"({', '.join(map(text, values))}, {str(releases).lower()})"
        for *values, releases in POPULATIONS
    ]
    names = "basin, run, species, species_group, season, age, releases"
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS v({names})"


_SITE = " ".join(f"WHEN {n - 1} THEN {text(name)}" for n, name in enumerate(SITES, start=1))

CTES: list[tuple[str, str]] = [
    ("populations", _populations()),
    (
        "fish",
        """
SELECT o_orderkey AS k,
       printf('T%08d', o_orderkey) AS tag_code,
       CASE o_custkey % 3 WHEN 0 THEN 'clearwater' WHEN 1 THEN 'salmon' ELSE 'snake' END AS basin,
       CASE (o_orderkey // 60) % 3 WHEN 0 THEN 'CH0' WHEN 1 THEN 'CH1' ELSE 'STH' END AS run,
       CASE WHEN (o_orderkey // 60) % 3 = 2 THEN 'STH' ELSE 'CHK' END AS species_group,
       CASE WHEN o_custkey % 3 <> 2 THEN 'main' ELSE
         CASE (o_orderkey // 20) % 6 WHEN 3 THEN 'lgr_release' WHEN 4 THEN 'lgs_release'
              WHEN 5 THEN 'lmn_release' ELSE 'main' END END AS source,
       CAST(year(o_orderdate) AS INTEGER) AS migration_year,
       o_orderpriority AS run_name,
       o_orderdate AS release_date,
       CASE WHEN o_orderstatus = 'F' THEN 'Subyearling' ELSE 'Yearling+' END AS age
FROM orders""",
    ),
    # Who is listed in which source: everyone in one, some of the Snake in the next ones too.
    (
        "listed",
        """
SELECT f.* REPLACE (['main', 'lgr_release', 'lgs_release', 'lmn_release'][(own + copy) % 4 + 1] AS source),
       copy
FROM (SELECT *, CASE source WHEN 'main' THEN 0 WHEN 'lgr_release' THEN 1 WHEN 'lgs_release' THEN 2
                ELSE 3 END AS own FROM fish) f, (VALUES (0), (1), (2)) AS c(copy)
WHERE copy = 0 OR (basin = 'snake' AND (k // 7) % 16 = 3 AND (copy = 1 OR (k // 7) % 32 = 3))""",
    ),
    (
        "detections",
        f"""
SELECT tag_code, species_group, source, migration_year,
       CASE l_partkey % 12 {_SITE} WHEN 10 THEN 'AFF - Upper ADULT Fishway'
            ELSE 'LDR - East Ladder' END AS site_name,
       CASE WHEN copy = 0 AND l_returnflag = 'R' AND l_linestatus = 'F' THEN 'SAMPLE ROOM'
            WHEN copy = 0 AND l_returnflag = 'A' AND l_linestatus = 'F' THEN 'East Raceway 3'
            ELSE 'RIVER EXIT' END AS antenna_group,
       make_timestamp(year(l_shipdate), 4, 1, 0, 0, 0.0)
         + to_days(CAST(dayofyear(l_shipdate) % 100 AS INTEGER))
         + to_hours(l_linenumber)
         + to_days(CAST(copy * CASE WHEN l_linenumber % 2 = 1 THEN 2 ELSE -2 END AS INTEGER)) AS obs_time
FROM lineitem JOIN listed ON l_orderkey = k
WHERE copy = 0 OR (l_partkey // 12) % 3 <> 0""",
    ),
    (
        "tagging",
        """
SELECT tag_code, CASE WHEN copy > 0 THEN 'Conflict ' || copy ELSE run_name END AS run_name,
       release_date + to_days(CAST(copy * CASE WHEN k % 2 = 1 THEN 3 ELSE -3 END AS INTEGER)) AS release_date,
       CASE WHEN copy = 1 THEN CASE age WHEN 'Yearling+' THEN 'Subyearling' ELSE 'Yearling+' END
            ELSE age END AS age,
       source,
       CASE WHEN source = 'main' THEN NULL ELSE species_group END AS species_group
FROM listed""",
    ),
    (
        "passage",
        f"""
SELECT basin, run, 'LGR' AS dam, tag_code, CAST(NULL AS VARCHAR) AS spp,
       CAST(NULL AS VARCHAR) AS run_type, CAST(NULL AS TIMESTAMP) AS release_date,
       CAST(NULL AS TIMESTAMP) AS pass_date, CAST(NULL AS INTEGER) AS upstream,
       CAST(k % 3 AS INTEGER) AS at_dam,
       CASE WHEN k % 3 = 2 THEN 0 WHEN (k // 3) % 5 < 4 THEN 1 ELSE 0 END AS below
FROM fish
UNION ALL
SELECT basin, run, dam, tag_code,
       CASE WHEN k % 2 = 1 THEN CASE WHEN (k // 12) % 5 = 0 THEN 'Coho' WHEN run = 'STH' THEN 'Steelhead'
            ELSE 'Chinook' END END,
       CASE WHEN (k // 12 + place) % 4 <> 0 THEN 'Old run ' || (k // 12) % 3 END,
       CASE WHEN (k // 12 + place) % 3 <> 0
            THEN release_date - to_days(CAST((k // 12) % 20 + 5 AS INTEGER)) END,
       CASE WHEN (k // 12 + place) % 5 > 1
            THEN release_date + to_days(CAST((k // 12) % 7 AS INTEGER)) + to_hours(place) END,
       CASE (k // 12 + 2 * place) % 6 WHEN 2 THEN 1 WHEN 3 THEN 0 WHEN 5 THEN 1 END,
       CASE (k // 12 + 2 * place) % 6 WHEN 2 THEN 0 WHEN 3 THEN 1 WHEN 4 THEN 2 END,
       CASE (k // 12 + 2 * place) % 6 WHEN 2 THEN 1 WHEN 4 THEN 1 WHEN 5 THEN 0 END
FROM fish, (VALUES ('LGS', 1), ('LMN', 2), ('MCN', 3)) AS d(dam, place)
WHERE (dam = 'LGS' AND k % 3 = 1
       AND tag_code IN (SELECT tag_code FROM detections WHERE {at("LGS")}))
   OR (dam = 'LMN' AND k % 4 = 0
       AND tag_code IN (SELECT tag_code FROM detections WHERE {at("LMN")}))
   OR (dam = 'MCN' AND k % 5 = 0
       AND tag_code IN (SELECT tag_code FROM detections WHERE {at("MCN")}))""",
    ),
    (
        "states",
        """
SELECT p.basin, p.run, p.dam, p.tag_code, p.spp, p.run_type, p.release_date, p.pass_date,
       p.upstream, p.at_dam, p.below, q.species_group, q.species
FROM passage p JOIN populations q ON p.basin = q.basin AND p.run = q.run""",
    ),
]


def statement(body: str, more: list[tuple[str, str]] = ()) -> str:
    """The body after the mapping and further common table expressions."""
    parts = [f"{name} AS MATERIALIZED ({sql})" for name, sql in [*CTES, *more]]
    return "WITH " + ",\n".join(parts) + "\n" + body
