"""The batches as a chain of table states in SQL, for all populations at once.

Every statement of a batch is one common table expression: the state of a
checkpoint's table before it goes in, the state after it comes out. Sets of tags
are set expressions over the detections, so this form shares nothing with the
one-pass plan but the rules.
"""

from __future__ import annotations

from checks.sql_mapping import at, below, in_season, listed, removed, statement

KEY = "(basin, run, tag_code)"
KEYS = "basin, run, tag_code"
COLUMNS = f"{KEYS}, spp, run_type, release_date, pass_date, upstream, at_dam, below"
MAIN, LGR_R, LGS_R, LMN_R = "main", "lgr_release", "lgs_release", "lmn_release"

# Detections as each population sees them: release sources only where it has any.
SEEN = (
    "seen",
    """
SELECT p.basin, p.run, p.season, p.age, p.releases,
       d.tag_code, d.source, d.site_name, d.antenna_group, d.obs_time, d.migration_year
FROM detections d JOIN populations p ON d.species_group = p.species_group
WHERE d.source = 'main' OR p.releases""",
)
OF_AGE = (
    "of_age",
    """
SELECT p.basin, p.run, t.tag_code, t.source
FROM tagging t JOIN populations p ON t.species_group = p.species_group AND t.age = p.age
WHERE p.releases""",
)


def rows(source: str, condition: str) -> str:
    return f"SELECT * FROM seen WHERE source = '{source}' AND {condition}"


def keys(source: str, condition: str) -> str:
    return f"SELECT {KEYS} FROM seen WHERE source = '{source}' AND {condition}"


def union(*parts: str) -> str:
    return " UNION ".join(parts)


def never(dam: str, source: str) -> str:
    return f"{KEY} NOT IN ({keys(source, at(dam))})"


def kept(dam: str, source: str) -> str:
    seen, gone = keys(source, at(dam)), keys(source, removed(dam))
    return f"{KEY} IN ({seen}) AND {KEY} NOT IN ({gone})"


def aged(source: str) -> str:
    member = f"SELECT {KEYS} FROM of_age WHERE source = '{source}'"
    return f"(age IS NULL OR {KEY} IN ({member}))"


class Chain:
    """Builds the states one statement at a time."""

    def __init__(self) -> None:
        self.ctes = [SEEN, OF_AGE]
        self.version = {"LGR": 0, "LGS": 0, "LMN": 0, "MCN": 0}
        self.names = 0
        for dam in self.version:
            sql = f"SELECT {COLUMNS}, species FROM states WHERE dam = '{dam}'"
            self.ctes.append((self.state(dam), sql))

    def state(self, dam: str) -> str:
        return f"{dam.lower()}_{self.version[dam]}"

    def _next(self, dam: str, sql: str) -> None:
        self.version[dam] += 1
        self.ctes.append((self.state(dam), sql))

    def _named(self, sql: str) -> str:
        self.names += 1
        name = f"set_{self.names}"
        self.ctes.append((name, sql))
        return name

    def member(self, dam: str, flags: str = "true") -> str:
        return f"{KEY} IN (SELECT {KEYS} FROM {self.state(dam)} WHERE {flags})"

    def absent(self, dam: str) -> str:
        return f"{KEY} NOT IN (SELECT {KEYS} FROM {self.state(dam)})"

    def append(self, batch: str, dam: str, candidates: str) -> None:
        new = f"SELECT DISTINCT {KEYS} FROM ({candidates}) WHERE {self.absent(dam)}"
        self.ctes.append((f"new_{batch}", new))
        species = "(SELECT species FROM populations p WHERE p.basin = n.basin AND p.run = n.run)"
        self._next(
            dam,
            f"SELECT * FROM {self.state(dam)} UNION ALL SELECT {KEYS}, NULL, NULL, NULL, NULL, "
            f"NULL, NULL, NULL, {species} FROM new_{batch} n",
        )

    def append_in_season(self, batch: str, dam: str, *candidates: str) -> None:
        last = [
            f"SELECT {KEYS} FROM ({c}) GROUP BY {KEYS}, season HAVING {in_season('max(obs_time)')}"
            for c in candidates
        ]
        self.append(batch, dam, union(*last))

    def update(self, dam: str, column: str, value: str, where: str = "true") -> None:
        case = f"CASE WHEN {where} THEN {value} ELSE {column} END AS {column}"
        self._next(dam, f"SELECT * REPLACE ({case}) FROM {self.state(dam)}")

    def merge(self, dam: str, column: str, value: str, key_set: str) -> None:
        name = self._named(f"SELECT DISTINCT {KEYS} FROM ({key_set})")
        self.update(dam, column, value, f"{KEY} IN (SELECT {KEYS} FROM {name})")

    def merge_dates(self, dam: str, *candidates: str) -> None:
        part = "SELECT basin, run, tag_code, max(obs_time) AS obs FROM ({}) GROUP BY {}"
        parts = " UNION ALL ".join(part.format(c, KEYS) for c in candidates)
        name = self._named(f"SELECT {KEYS}, max(obs) AS obs FROM ({parts}) GROUP BY {KEYS}")
        self._next(
            dam,
            "SELECT s.* REPLACE (CASE WHEN m.tag_code IS NULL THEN s.pass_date ELSE m.obs END "
            f"AS pass_date) FROM {self.state(dam)} s LEFT JOIN {name} m ON s.basin = m.basin "
            "AND s.run = m.run AND s.tag_code = m.tag_code",
        )

    def merge_facts(self, dam: str, sources: list[str]) -> None:
        rank = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(sources))
        name = self._named(
            "SELECT * FROM (SELECT p.basin, p.run, t.tag_code, t.run_name, t.release_date, "
            "row_number() OVER (PARTITION BY p.basin, p.run, t.tag_code "
            f"ORDER BY CASE t.source {rank} END, t.release_date NULLS FIRST, "
            "t.run_name NULLS FIRST) AS place FROM tagging t JOIN populations p "
            "ON coalesce(t.species_group, p.species_group) = p.species_group "
            f"WHERE t.source IN ({listed(sources)}) AND (t.source = 'main' OR p.releases)) "
            "WHERE place = 1"
        )
        self._next(
            dam,
            "SELECT s.* REPLACE ("
            "CASE WHEN m.tag_code IS NULL THEN s.run_type ELSE m.run_name END AS run_type, "
            "CASE WHEN m.tag_code IS NULL THEN s.release_date ELSE m.release_date END "
            f"AS release_date) FROM {self.state(dam)} s LEFT JOIN {name} m ON s.basin = m.basin "
            "AND s.run = m.run AND s.tag_code = m.tag_code",
        )

    def fill(
        self,
        dam: str,
        dates: list[str],
        sources: list[str],
        one: str,
        two: str,
        below_: str,
        zero: bool,
    ) -> None:
        self.update(dam, "spp", "species", "spp IS NULL")
        self.merge_dates(dam, *dates)
        self.merge_facts(dam, sources)
        self.update(dam, "upstream", "1")
        self.merge(dam, "at_dam", "1", one)
        self.merge(dam, "at_dam", "2", two)
        self.merge(dam, "below", "1", below_)
        self.update(dam, "below", "0", "at_dam = 2")
        if zero:
            self.update(dam, "below", "0", "below IS NULL")

    def history_101(self, batch: str, dam: str, candidates: str, sources: list[str]) -> None:
        self.append(batch, dam, candidates)
        self.update(dam, "spp", "species", "spp IS NULL")
        self.merge_facts(dam, sources)
        new = "upstream IS NULL AND at_dam IS NULL AND below IS NULL"
        cases = ", ".join(
            f"CASE WHEN {new} THEN {digit} ELSE {column} END AS {column}"
            for column, digit in (("upstream", 1), ("at_dam", 0), ("below", 1))
        )
        self._next(dam, f"SELECT * REPLACE ({cases}) FROM {self.state(dam)}")


def _at_sources(sources: list[str], condition: str) -> str:
    return union(*[keys(s, condition) for s in sources])


def _c01(c: Chain) -> None:
    member = c.member("LGR", "at_dam = 0 AND below = 1")
    c.append_in_season("C01", "LGS", rows(MAIN, f"{at('LGS')} AND {member}"))


def _c02(c: Chain) -> None:
    member = c.member("LGR", "at_dam = 0 AND below = 1")
    c.fill(
        "LGS",
        [rows(MAIN, f"{at('LGS')} AND {member}")],
        [MAIN],
        keys(MAIN, f"{member} AND {kept('LGS', MAIN)}"),
        keys(MAIN, f"{removed('LGS')} AND {c.member('LGR', 'below = 1')}"),
        keys(MAIN, below("below_lgs")),
        True,
    )


def _from_upstream(c: Chain, batch: str, upstream: str, dam: str) -> None:
    member = c.member(upstream, "below = 1")
    c.append_in_season(batch, dam, rows(MAIN, f"{at(dam)} AND {member}"))


def _fill_upstream(c: Chain, upstream: str, dam: str, zero: bool) -> None:
    member = c.member(upstream, "below = 1")
    c.fill(
        dam,
        [rows(MAIN, f"{at(dam)} AND {member}")],
        [MAIN],
        keys(MAIN, f"{member} AND {kept(dam, MAIN)}"),
        keys(MAIN, removed(dam)),
        keys(MAIN, below(f"below_{dam.lower()}")),
        zero,
    )


def _skipped(source: str, never_at: str, dam: str, with_age: bool = True) -> str:
    age = f" AND {aged(source)}" if with_age else ""
    return rows(source, f"{at(dam)} AND {never(never_at, source)}{age}")


def _c07(c: Chain) -> None:
    main = f"{c.member('LGR', 'below = 1')} AND {never('LGS', MAIN)} AND {at('LMN')}"
    c.append_in_season("C07", "LMN", rows(MAIN, main), _skipped(LGR_R, "LGS", "LMN"))


def _c08(c: Chain) -> None:
    member = c.member("LGR", "below = 1")
    main = rows(MAIN, f"{at('LMN')} AND {member}")
    release = _skipped(LGR_R, "LGS", "LMN")
    c.fill(
        "LMN",
        [main, release],
        [MAIN, LGR_R],
        union(
            keys(MAIN, f"NOT releases AND {member} AND {kept('LMN', MAIN)}"),
            keys(MAIN, f"releases AND {member} AND {at('LMN')}"),
            f"SELECT {KEYS} FROM ({release})",
        ),
        _at_sources([MAIN, LGR_R], f"{removed('LMN')} AND {member}"),
        _at_sources([MAIN, LGR_R], below("below_lmn")),
        True,
    )


def _c09_parts(c: Chain) -> list[str]:
    main = rows(MAIN, f"{at('MCN')} AND {c.member('LMN', 'below = 1')}")
    return [main, _skipped(LGR_R, "LGS", "LMN"), _skipped(LGS_R, "LGS", "LMN")]


def _c10(c: Chain) -> None:
    c.fill(
        "MCN",
        _c09_parts(c),
        [MAIN, LGR_R, LGS_R],
        union(
            keys(MAIN, f"{c.member('LMN', 'below = 1')} AND {kept('MCN', MAIN)}"),
            keys(LGR_R, kept("MCN", LGR_R)),
            keys(LGS_R, kept("MCN", LGS_R)),
        ),
        _at_sources([MAIN, LGR_R, LGS_R], removed("MCN")),
        _at_sources([MAIN, LGR_R, LGS_R], below("below_mcn")),
        False,
    )


def _c11(c: Chain) -> None:
    sources = [MAIN, LGR_R, LGS_R]
    found = _at_sources(sources, f"{c.member('LGR')} AND {below('below_lgs')}")
    c.history_101("C11", "LGS", found, sources)


def _c12(c: Chain) -> None:
    member = c.member("LGS", f"below = 1 AND {c.absent('LMN')}")
    releases = [_skipped(s, "LMN", "MCN") for s in (LGR_R, LGS_R, LMN_R)]
    c.append_in_season("C12", "MCN", rows(MAIN, f"{at('MCN')} AND {member}"), *releases)


def _c13(c: Chain) -> None:
    sources = [MAIN, LGR_R, LGS_R, LMN_R]
    member = c.member("LGS", "below = 1")
    c.fill(
        "MCN",
        [
            rows(MAIN, f"{at('MCN')} AND {member}"),
            *[_skipped(s, "LMN", "MCN", with_age=False) for s in sources[1:]],
        ],
        sources,
        union(
            keys(MAIN, f"{member} AND {kept('MCN', MAIN)}"),
            *[keys(s, kept("MCN", s)) for s in sources[1:]],
        ),
        _at_sources(sources, f"{removed('MCN')} AND {member}"),
        _at_sources(sources, below("below_mcn")),
        True,
    )


def _late_101(c: Chain, batch: str, dam: str, upstream: list[str], below_name: str) -> None:
    sources = [MAIN, LGR_R, LGS_R, LMN_R]
    known = " OR ".join(c.member(d) for d in upstream)
    found = _at_sources(sources, f"({known}) AND {below(below_name)}")
    c.history_101(batch, dam, found, sources)


STEPS = {
    "C01": ("LGS", _c01),
    "C02": ("LGS", _c02),
    "C03": ("LMN", lambda c: _from_upstream(c, "C03", "LGS", "LMN")),
    "C04": ("LMN", lambda c: _fill_upstream(c, "LGS", "LMN", True)),
    "C05": ("MCN", lambda c: _from_upstream(c, "C05", "LMN", "MCN")),
    "C06": ("MCN", lambda c: _fill_upstream(c, "LMN", "MCN", False)),
    "C07": ("LMN", _c07),
    "C08": ("LMN", _c08),
    "C09": ("MCN", lambda c: c.append_in_season("C09", "MCN", *_c09_parts(c))),
    "C10": ("MCN", _c10),
    "C11": ("LGS", _c11),
    "C12": ("MCN", _c12),
    "C13": ("MCN", _c13),
    "C14": ("LMN", lambda c: _late_101(c, "C14", "LMN", ["LGR", "LGS"], "below_lmn_101")),
    "C15": ("MCN", lambda c: _late_101(c, "C15", "MCN", ["LGR", "LGS", "LMN"], "below_mcn")),
}
APPENDS = ("C01", "C03", "C05", "C07", "C09", "C12")


def chain_to(last: str) -> Chain:
    chain = Chain()
    for name, (_, step) in STEPS.items():
        step(chain)
        if name == last:
            break
    return chain


def batch_sql(name: str, where: str = "true") -> str:
    """What the batch appends, or its checkpoint's table after it."""
    chain = chain_to(name)
    if name in APPENDS:
        return statement(f"SELECT {KEYS} FROM new_{name} WHERE {where}", chain.ctes)
    state = chain.state(STEPS[name][0])
    return statement(f"SELECT {COLUMNS} FROM {state} WHERE {where}", chain.ctes)


def history_sql(where: str = "true", dams: tuple[str, ...] = ("LGS", "LMN", "MCN")) -> str:
    """The tables of the checkpoints, by default the three filled ones, after all batches."""
    chain = chain_to("C15")
    parts = [
        f"SELECT {COLUMNS}, '{dam}' AS dam FROM {chain.state(dam)} WHERE {where}"
        for dam in dams
    ]
    return statement(" UNION ALL ".join(parts), chain.ctes)
