"""The operators in SQL: IN, NOT IN, UNION and joins over the mapped tables."""

from __future__ import annotations

from checks.sql_batches import COLUMNS, STEPS, batch_sql, history_sql
from checks.sql_mapping import ADULT, SPRING, SUMMER, at, below, removed, statement
from weirwalk import fixed_values as fv

TAG = "(species_group, tag_code)"
TAGS = "species_group, tag_code"
SOURCE_TAG = "(species_group, source, tag_code)"
SOURCE_TAGS = "species_group, source, tag_code"
ROW = "basin, run, tag_code"


def _state(dam: str, flags: str = "true") -> str:
    return f"SELECT {TAGS} FROM states WHERE dam = '{dam}' AND {flags}"


def _tags(condition: str) -> str:
    return f"SELECT {TAGS} FROM detections WHERE {condition}"


def _by_source(condition: str) -> str:
    return f"SELECT {SOURCE_TAGS} FROM detections WHERE {condition}"


def _last(condition: str, by: str = TAGS) -> str:
    return f"SELECT {by}, max(obs_time) AS last_obs FROM detections WHERE {condition} GROUP BY {by}"


def _in_season(dam: str, season: str) -> str:
    last = _last(f"source = 'main' AND {at(dam)}")
    return f"SELECT * FROM ({last}) WHERE {season.format('last_obs')}"


def _aged(condition: str) -> str:
    member = f"SELECT {SOURCE_TAGS} FROM tagging WHERE source <> 'main' AND {condition}"
    return f"{SOURCE_TAG} IN ({member})"


def _merge(column: str, value: str, members: str) -> str:
    return (
        f"SELECT {ROW}, CASE WHEN {TAG} IN ({members}) THEN {value} ELSE {column} END "
        f"AS {column} FROM states WHERE dam = 'LGS'"
    )


def _any_not_in(members: list[str], excluded: str, condition: str = "true") -> str:
    known = " OR ".join(f"{TAG} IN ({_state(m)})" for m in members)
    return (
        f"SELECT DISTINCT {TAGS} FROM detections WHERE source = 'main' AND ({known}) "
        f"AND {TAG} NOT IN ({_state(excluded)}) AND {condition}"
    )


_REMOVAL = "(antenna_group ILIKE '%SAMPLE%' OR antenna_group ILIKE '%RACEWAY%')"
_NEW = "upstream IS NULL AND at_dam IS NULL AND below IS NULL"
_SOURCE_RANK = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(fv.SOURCES))
_MCN_SOURCES = [f"({_tags(f'source = {chr(39)}{s}{chr(39)} AND ' + at('MCN'))})" for s in fv.SOURCES]
_NOT_LMN = f"{SOURCE_TAG} NOT IN ({_by_source(at('LMN'))})"
_LGR_BELOW = f"{_tags('true')} AND {TAG} IN ({_state('LGR')}) AND {below('below_lgs')}"

_BODIES = {
    "scan_detections": "SELECT tag_code, site_name, antenna_group, obs_time, migration_year, "
    "species_group FROM detections WHERE source = 'main'",
    "scan_release_detections": "SELECT * FROM detections WHERE source <> 'main'",
    "scan_tagging": "SELECT tag_code, run_name, release_date FROM tagging WHERE source = 'main'",
    "scan_release_tagging": "SELECT * FROM tagging WHERE source <> 'main'",
    "scan_passage_state": f"SELECT {ROW} FROM states WHERE dam = 'LGR' AND at_dam = 0 AND below = 1",
    "population_params": "SELECT p.basin, p.run, species AS spp, p.species_group, season, p.age, "
    "releases AS has_releases, count(*) AS n_tags FROM populations p JOIN fish f "
    "ON f.basin = p.basin AND f.run = p.run GROUP BY ALL",
    "filter_site_set": f"SELECT tag_code, site_name, obs_time FROM detections WHERE {at('MCN')}",
    "filter_site_equal": f"SELECT tag_code, site_name, obs_time FROM detections WHERE {at('LMN')}",
    "filter_removed_antenna": "SELECT tag_code, antenna_group, obs_time FROM detections "
    f"WHERE {_REMOVAL}",
    "filter_adult_return": "SELECT tag_code, site_name, obs_time, migration_year FROM detections "
    f"WHERE {ADULT}",
    "season_spring": _in_season("LMN", SPRING),
    "season_summer": _in_season("LMN", SUMMER),
    "age_yearling": f"SELECT DISTINCT {SOURCE_TAGS} FROM detections WHERE "
    + _aged("age = 'Yearling+'"),
    "age_subyearling": f"SELECT DISTINCT {SOURCE_TAGS} FROM detections WHERE "
    + _aged("age = 'Subyearling'"),
    "age_any": f"SELECT DISTINCT {SOURCE_TAGS} FROM detections WHERE source <> 'main'",
    "fill_null_species": f"SELECT {ROW}, dam, CASE WHEN spp IS NULL THEN species ELSE spp END AS spp "
    "FROM states WHERE dam <> 'LGR'",
    "fill_null_below": f"SELECT {ROW}, dam, CASE WHEN below IS NULL THEN 0 ELSE below END AS below "
    "FROM states WHERE dam <> 'LGR'",
    "new_row_detector": f"SELECT {ROW}, dam FROM states WHERE {_NEW}",
    "filter_state_flags": f"SELECT {ROW}, dam, at_dam, below FROM states WHERE below = 1",
    "project_release_facts": "SELECT s.basin, s.run, s.tag_code, t.run_name AS run_type, "
    "t.release_date, s.species AS spp FROM states s JOIN tagging t ON s.tag_code = t.tag_code "
    "WHERE s.dam = 'LGR' AND t.source = 'main'",
    "membership_precedence": _any_not_in(["LGR", "LGS"], "LMN", below("below_lmn_101")),
    "semi_join_state": "SELECT tag_code, site_name, obs_time FROM detections "
    f"WHERE source = 'main' AND {TAG} IN ({_state('LGR', 'below = 1')})",
    "anti_join_state": "SELECT tag_code, obs_time FROM detections "
    f"WHERE source = 'main' AND {at('LMN')} AND {TAG} NOT IN ({_state('LMN')})",
    "self_semi_detected_at": f"SELECT DISTINCT {SOURCE_TAGS} FROM detections "
    f"WHERE {SOURCE_TAG} IN ({_by_source(at('MCN'))})",
    "self_anti_never_at": f"SELECT DISTINCT {SOURCE_TAGS} FROM detections WHERE {at('LMN')} "
    f"AND {SOURCE_TAG} NOT IN ({_by_source(at('LGS'))})",
    "detected_never_removed": f"SELECT DISTINCT {SOURCE_TAGS} FROM detections WHERE {at('MCN')} "
    f"AND {SOURCE_TAG} NOT IN ({_by_source(removed('MCN'))})",
    "semi_join_state_difference": _last(
        f"source = 'main' AND {at('MCN')} AND {TAG} IN ("
        + _state("LGR", f"below = 1 AND {TAG} NOT IN ({_state('LMN')})")
        + ")"
    ),
    "membership_any_of_two": _any_not_in(["LGS", "LMN"], "MCN"),
    "membership_any_of_three": _any_not_in(["LGR", "LGS", "LMN"], "MCN"),
    "release_age_semi_join": "SELECT source, tag_code, site_name, obs_time FROM detections WHERE "
    + _aged("age = 'Yearling+'"),
    "last_obs_in_season": _in_season("LGS", SPRING),
    "distinct_tags": f"SELECT DISTINCT {TAGS} FROM detections",
    "last_obs_by_source": _last(at("LMN"), SOURCE_TAGS),
    "union_keys_2": " UNION ".join(_MCN_SOURCES[:2]),
    "union_keys_3": " UNION ".join(_MCN_SOURCES[:3]),
    "union_keys_4": " UNION ".join(_MCN_SOURCES),
    "union_last_obs": f"SELECT {TAGS}, max(last_obs) AS last_obs FROM ("
    + _last(f"source = 'main' AND {at('MCN')}", SOURCE_TAGS)
    + " UNION "
    + _last(f"source <> 'main' AND {at('MCN')} AND {_NOT_LMN}", SOURCE_TAGS)
    + f") GROUP BY {TAGS}",
    "union_tagging": "SELECT tag_code, run_name, release_date FROM (SELECT *, row_number() OVER ("
    f"PARTITION BY tag_code ORDER BY CASE source {_SOURCE_RANK} END, "
    "release_date NULLS FIRST, run_name NULLS FIRST) AS place FROM tagging) WHERE place = 1",
    "union_detected_below": " UNION ".join(
        f"({_tags(f'source = {chr(39)}{s}{chr(39)} AND ' + below('below_mcn'))})"
        for s in fv.SOURCES
    ),
    "chained_insert": f"SELECT DISTINCT {TAGS} FROM ({_LGR_BELOW} AND source <> 'lmn_release') "
    f"WHERE {TAG} NOT IN ({_state('LGS')})",
    "append_missing_tags": f"SELECT {ROW}, dam, spp, upstream, at_dam, below FROM states "
    f"WHERE dam = 'LGS' UNION ALL SELECT {ROW}, 'LGS', NULL, NULL, NULL, NULL FROM states "
    f"WHERE dam = 'LGR' AND at_dam = 0 AND below = 1 AND ({ROW}) NOT IN "
    f"(SELECT {ROW} FROM states WHERE dam = 'LGS')",
    "set_upstream_flag": f"SELECT {ROW}, 1 AS upstream, at_dam FROM states WHERE dam = 'LGS'",
    "removed_clears_below": f"SELECT {ROW}, at_dam, CASE WHEN at_dam = 2 THEN 0 ELSE 1 END AS below "
    "FROM states WHERE dam = 'LGR'",
    "set_history_101": f"SELECT {ROW}, dam, CASE WHEN {_NEW} THEN 1 ELSE upstream END AS upstream, "
    f"CASE WHEN {_NEW} THEN 0 ELSE at_dam END AS at_dam, "
    f"CASE WHEN {_NEW} THEN 1 ELSE below END AS below FROM states",
    "merge_detected": _merge(
        "at_dam",
        "1",
        _tags(
            f"source = 'main' AND {at('LGS')} AND tag_code NOT IN (SELECT tag_code FROM detections "
            f"WHERE source = 'main' AND {removed('LGS')})"
        ),
    ),
    "merge_removed": _merge("at_dam", "2", _tags(f"source = 'main' AND {removed('LGS')}")),
    "merge_below": _merge("below", "1", _tags(f"source = 'main' AND {below('below_lgs')}")),
    "merge_pass_date": f"SELECT {ROW}, CASE WHEN m.tag_code IS NULL THEN s.pass_date ELSE m.last_obs "
    "END AS pass_date "
    f"FROM states s LEFT JOIN ({_last('source = ' + chr(39) + 'main' + chr(39) + ' AND ' + at('LGS'))}"
    ") m USING (species_group, tag_code) WHERE dam = 'LGS'",
    "merge_release_facts": f"SELECT {ROW}, CASE WHEN t.source IS NULL THEN s.run_type ELSE t.run_name "
    "END AS run_type, CASE WHEN t.source IS NULL THEN s.release_date ELSE t.release_date END AS release_date "
    "FROM states s LEFT JOIN (SELECT * FROM tagging WHERE source = 'main') t USING (tag_code) "
    "WHERE dam = 'LGS'",
    "at_dam_code": f"SELECT {ROW}, CASE WHEN {TAG} IN "
    f"({_tags(f'source = {chr(39)}main{chr(39)} AND ' + removed('LGS'))}) THEN 2 WHEN {TAG} IN "
    f"({_tags(f'source = {chr(39)}main{chr(39)} AND ' + at('LGS'))}) THEN 1 ELSE at_dam END "
    "AS at_dam FROM states WHERE dam = 'LGS'",
}
_NUMBER = "CAST(substr(tag_code, 2) AS BIGINT)"
_EXPORTED = f"SELECT *, {_NUMBER} AS n FROM tagging WHERE source = 'main'"
_SEEN = f"SELECT *, {_NUMBER} AS n FROM detections WHERE source = 'main' AND species_group = 'CHK'"
_BODIES |= {
    "store_round_trip": "SELECT * FROM detections",
    "stored_site_set": _BODIES["filter_site_set"],
    "stored_site_equal": _BODIES["filter_site_equal"],
    "stored_last_obs_mcn": _last(f"source = 'main' AND {at('MCN')}"),
    "stored_last_obs_in_season": _BODIES["last_obs_in_season"],
    "stored_last_obs_by_source": _BODIES["last_obs_by_source"],
    "ingest_passage_export": f"SELECT {COLUMNS}, dam FROM states",
    "ingest_tagging_export": "SELECT tag_code, run_name, CASE WHEN n % 12 <> 3 THEN release_date END AS "
    "release_date, age, source, species_group, CASE WHEN n % 12 = 3 THEN 'week ' || n % 53 END AS "
    f"release_date_raw FROM ({_EXPORTED}) WHERE n % 97 <> 5",
    "ingest_tagging_counts": "SELECT count(*) AS n_rows, count(*) FILTER (n % 97 = 5) AS n_rejected, "
    f"count(*) FILTER (n % 97 <> 5 AND n % 12 = 3) AS n_unread_release_date FROM ({_EXPORTED})",
    "ingest_detections_counts": "SELECT count(*) AS n_rows, 0 AS n_rejected, count(*) FILTER (n % 50 = 7) "
    f"AS n_unread_obs_time, count(*) FILTER (n % 30 = 1) AS n_unknown_site FROM ({_SEEN})",
}
for _below in fv.BELOW_ORD:
    _BODIES[f"detected_{_below}"] = (
        f"SELECT DISTINCT {SOURCE_TAGS} FROM detections WHERE {below(_below)}"
    )
for _dam in fv.FILLED_DAMS:
    _BODIES[f"last_obs_{_dam.lower()}"] = _last(f"source = 'main' AND {at(_dam)}")


def statements(batch_queries: dict[str, str], first_release_batch: str) -> dict[str, str]:
    """Query name to SQL, for every operator, batch and whole run."""
    found = {name: statement(body) for name, body in _BODIES.items()}
    snake, tributary = "basin = 'snake'", "basin <> 'snake'"
    for name in STEPS:
        query = batch_queries[name]
        if name < first_release_batch:
            found[query] = batch_sql(name)
        else:
            found[query] = batch_sql(name, tributary)
            found[f"{query}_release"] = batch_sql(name, snake)
    for run in ("CH0", "CH1", "STH"):
        found[f"history_tributary_{run.lower()}"] = history_sql(f"{tributary} AND run = '{run}'")
        found[f"history_snake_{run.lower()}"] = history_sql(f"{snake} AND run = '{run}'")
    found["history_all_populations"] = history_sql()
    found["sink_round_trip"] = history_sql(dams=("LGR", "LGS", "LMN", "MCN"))
    return found
