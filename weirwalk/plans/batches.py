"""The fifteen batches as column expressions on the wide row.

A batch either appends rows to one checkpoint, fills a checkpoint, or appends
rows with the history 1-0-1. Batches run in order: each reads the row as the
earlier ones left it. "Appending" sets the checkpoint's membership; every other
column of an absent row is NULL already. A batch names the checkpoints and the
sources that it reads, so that a plan can leave out what no wanted table depends on.

The marks of a population without releases show no release source, so the
release branches need no test of their own and one plan serves all populations.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirwalk.fixed_values import (
    FILLED_DAMS,
    LGR_RELEASE,
    LGS_RELEASE,
    LMN_RELEASE,
    MAIN,
    SOURCES,
)
from weirwalk.functions.features import Fact, has_all, has_any, last_column
from weirwalk.functions.predicates import any_of
from weirwalk.plans.wide import FLAGS, UNSET, Facts

# The sources a batch looks at, in order of precedence for tagging facts.
ONLY_MAIN = (MAIN,)
AND_LGR = (MAIN, LGR_RELEASE)
AND_LGS = (MAIN, LGR_RELEASE, LGS_RELEASE)
AND_LMN = (MAIN, LGR_RELEASE, LGS_RELEASE, LMN_RELEASE)

Test = Callable[[], Column]


def member(dam: str, at_dam: int | None = None, below: int | None = None) -> Column:
    """The tag is in the checkpoint's table with the given flags."""
    tests = [f"in_{dam}"]
    tests += [] if at_dam is None else [f"{dam}_at_dam = {at_dam}"]
    tests += [] if below is None else [f"{dam}_below = {below}"]
    return F.expr(" AND ".join(tests))


def at(dam: str, source: str = MAIN) -> Fact:
    return source, f"at_{dam.lower()}"


def removed(dam: str, source: str = MAIN) -> Fact:
    return source, f"removed_{dam.lower()}"


def kept(dam: str, source: str = MAIN) -> Column:
    """Seen at the checkpoint and never removed there."""
    return has_all([at(dam, source)], [removed(dam, source)])


def removed_in(dam: str, sources: tuple[str, ...]) -> Column:
    return has_any(removed(dam, s) for s in sources)


def seen_below(fact: str, sources: tuple[str, ...]) -> Column:
    return has_any((s, fact) for s in sources)


@dataclass(frozen=True)
class Dated:
    """One source of pass dates: who qualifies and by which last detection.

    ``reads`` are the checkpoints whose tables ``among`` looks at.
    """

    dam: str
    source: str = MAIN
    among: Test | None = None
    never_at: str | None = None
    aged: bool = False
    reads: tuple[str, ...] = ()

    def qualifies(self, in_season: bool = False) -> Column:
        needed = [at(self.dam, self.source)]
        if self.aged:
            needed.append((self.source, "aged"))
        if in_season:
            needed.append((self.source, f"season_{self.dam.lower()}"))
        marked = has_all(needed, [at(self.never_at, self.source)] if self.never_at else [])
        return self.among() & marked if self.among else marked

    def last(self) -> Column:
        return F.col(last_column(self.source, self.dam))


@dataclass(frozen=True)
class Append:
    """Add tags whose last detection, from any of the dated sources, is in season."""

    name: str
    dam: str
    dates: tuple[Dated, ...]

    @property
    def reads(self) -> set[str]:
        return {dam for d in self.dates for dam in d.reads}

    @property
    def looks_at(self) -> set[str]:
        return {d.source for d in self.dates}

    def apply(self, wide: DataFrame, last: bool) -> DataFrame:
        tests = [d.qualifies(in_season=True) for d in self.dates]
        if self.dam == "LMN":
            # Splits the generated code, see History101: the batches before have a method of their own.
            found = F.exists(F.array(*tests), lambda test: test)
            return _enter(wide, self, F.coalesce(found, F.lit(False)))
        return _enter(wide, self, any_of(tests))


@dataclass(frozen=True)
class Fill:
    """Set pass date and flags of a checkpoint's rows; facts follow at the end.

    ``two_reads`` are the checkpoints whose tables ``two`` looks at; ``one`` looks at those
    of the dates.

    ``last`` says that no later fill of the checkpoint runs. The upstream flag is
    left to that one: it sees all rows, and nothing reads the flag before.
    """

    name: str
    dam: str
    dates: tuple[Dated, ...]
    one: Test
    two: Test
    below: Test
    sources: tuple[str, ...] = ONLY_MAIN
    below_null_to_zero: bool = True
    two_reads: tuple[str, ...] = ()

    @property
    def reads(self) -> set[str]:
        return {dam for d in self.dates for dam in d.reads} | set(self.two_reads)

    @property
    def looks_at(self) -> set[str]:
        return {*self.sources, *(d.source for d in self.dates)}

    def apply(self, wide: DataFrame, last: bool) -> DataFrame:
        here = F.col(f"in_{self.dam}")
        dated = here & any_of([d.qualifies() for d in self.dates])
        latest = self.dates[0].last()
        if len(self.dates) > 1:
            latest = F.greatest(*[F.when(d.qualifies(), d.last()) for d in self.dates])
        code = F.when(here & self.two(), 2).when(here & self.one(), 1)
        columns = {
            f"{self.dam}_pass_date": F.when(dated, latest).otherwise(_old(self, "pass_date")),
            f"{self.dam}_at_dam": code.otherwise(_old(self, "at_dam")),
        }
        if last:
            columns[f"{self.dam}_upstream"] = F.when(here, 1).otherwise(_old(self, "upstream"))
        wide = wide.withColumns(columns)
        old = _old(self, "below")
        below = F.when(~here, old).when(_old(self, "at_dam") == 2, 0).when(self.below(), 1)
        if self.below_null_to_zero:
            below = below.when(old == UNSET, 0)
        return wide.withColumn(f"{self.dam}_below", below.otherwise(old))


@dataclass(frozen=True)
class History101:
    """Add tags seen only further down, as present above, missed here, seen below."""

    name: str
    dam: str
    upstream: tuple[str, ...]
    below_fact: str
    sources: tuple[str, ...]

    @property
    def reads(self) -> set[str]:
        return set(self.upstream)

    @property
    def looks_at(self) -> set[str]:
        return set(self.sources)

    def apply(self, wide: DataFrame, last: bool) -> DataFrame:
        # exists() also splits the generated code here: the batches in one function
        # would pass the 8000 bytecodes beyond which the JVM does not compile it.
        known = F.exists(F.array(*[member(d) for d in self.upstream]), lambda held: held)
        known = F.coalesce(known, F.lit(False))
        wide = _enter(wide, self, known & seen_below(self.below_fact, self.sources))
        new = F.col(f"in_{self.dam}")
        for flag in FLAGS:
            new = new & (_old(self, flag) == UNSET)
        history = {
            f"{self.dam}_{flag}": F.when(new, digit).otherwise(_old(self, flag))
            for flag, digit in zip(FLAGS, (1, 0, 1))
        }
        return wide.withColumns(history)


Batch = Append | Fill | History101


def _old(batch: Batch, value: str) -> Column:
    return F.col(f"{batch.dam}_{value}")


def _enter(wide: DataFrame, batch: Batch, entering: Column) -> DataFrame:
    here, added = f"in_{batch.dam}", f"added_{batch.dam}"
    new = ~F.col(here) & entering
    return wide.withColumns(
        {
            added: F.when(new, batch.name).otherwise(F.col(added)),
            here: F.col(here) | entering,
        }
    )


def _from(upstream: str, dam: str) -> Dated:
    """Main-source tags of the upstream table that were seen below it."""
    return Dated(dam, among=lambda: member(upstream, below=1), reads=(upstream,))


def _skipping(never_at: str, dam: str, sources: tuple[str, ...], aged: bool = True) -> list[Dated]:
    """Release-source tags seen at the checkpoint and never at the skipped one."""
    return [Dated(dam, s, None, never_at, aged) for s in sources if s != MAIN]


def _kept_from(upstream: str, dam: str, sources: tuple[str, ...]) -> Test:
    def test() -> Column:
        main = member(upstream, below=1) & kept(dam)
        return any_of([main, *[kept(dam, s) for s in sources if s != MAIN]])

    return test


def batches(release_mcn_dam: str = "LMN") -> tuple[Batch, ...]:
    """The batches in order.

    ``release_mcn_dam`` is the checkpoint whose readers date the release sources
    of C09 and C10.
    """
    missed_above = Dated("LGS", among=lambda: member("LGR", at_dam=0, below=1), reads=("LGR",))
    c07 = [
        Dated("LMN", among=lambda: member("LGR", below=1), never_at="LGS", reads=("LGR",)),
        *_skipping("LGS", "LMN", AND_LGR),
    ]
    c08 = [_from("LGR", "LMN"), *_skipping("LGS", "LMN", AND_LGR)]
    c09 = [_from("LMN", "MCN"), *_skipping("LGS", release_mcn_dam, AND_LGS)]
    c12 = [
        Dated(
            "MCN",
            among=lambda: member("LGS", below=1) & ~member("LMN"),
            reads=("LGS", "LMN"),
        ),
        *_skipping("LMN", "MCN", AND_LMN),
    ]
    c13 = [_from("LGS", "MCN"), *_skipping("LMN", "MCN", AND_LMN, aged=False)]

    def c08_one() -> Column:
        # With releases every dated tag counts as seen, removed or not.
        seen = has_all([at("LMN")]) & (F.col("has_releases") | kept("LMN"))
        return any_of([member("LGR", below=1) & seen, *[d.qualifies() for d in c08[1:]]])

    return (
        Append("C01", "LGS", (missed_above,)),
        Fill(
            "C02",
            "LGS",
            dates=(missed_above,),
            one=lambda: member("LGR", at_dam=0, below=1) & kept("LGS"),
            two=lambda: member("LGR", below=1) & removed_in("LGS", ONLY_MAIN),
            two_reads=("LGR",),
            below=lambda: seen_below("below_lgs", ONLY_MAIN),
        ),
        Append("C03", "LMN", (_from("LGS", "LMN"),)),
        Fill(
            "C04",
            "LMN",
            dates=(_from("LGS", "LMN"),),
            one=_kept_from("LGS", "LMN", ONLY_MAIN),
            two=lambda: removed_in("LMN", ONLY_MAIN),
            below=lambda: seen_below("below_lmn", ONLY_MAIN),
        ),
        Append("C05", "MCN", (_from("LMN", "MCN"),)),
        Fill(
            "C06",
            "MCN",
            dates=(_from("LMN", "MCN"),),
            one=_kept_from("LMN", "MCN", ONLY_MAIN),
            two=lambda: removed_in("MCN", ONLY_MAIN),
            below=lambda: seen_below("below_mcn", ONLY_MAIN),
            below_null_to_zero=False,
        ),
        Append("C07", "LMN", tuple(c07)),
        Fill(
            "C08",
            "LMN",
            dates=tuple(c08),
            one=c08_one,
            two=lambda: member("LGR", below=1) & removed_in("LMN", AND_LGR),
            two_reads=("LGR",),
            below=lambda: seen_below("below_lmn", AND_LGR),
            sources=AND_LGR,
        ),
        Append("C09", "MCN", tuple(c09)),
        Fill(
            "C10",
            "MCN",
            dates=tuple(c09),
            one=_kept_from("LMN", "MCN", AND_LGS),
            two=lambda: removed_in("MCN", AND_LGS),
            below=lambda: seen_below("below_mcn", AND_LGS),
            sources=AND_LGS,
            below_null_to_zero=False,
        ),
        History101("C11", "LGS", ("LGR",), "below_lgs", AND_LGS),
        Append("C12", "MCN", tuple(c12)),
        Fill(
            "C13",
            "MCN",
            dates=tuple(c13),
            one=_kept_from("LGS", "MCN", AND_LMN),
            two=lambda: member("LGS", below=1) & removed_in("MCN", AND_LMN),
            two_reads=("LGS",),
            below=lambda: seen_below("below_mcn", AND_LMN),
            sources=AND_LMN,
        ),
        History101("C14", "LMN", ("LGR", "LGS"), "below_lmn_101", AND_LMN),
        History101("C15", "MCN", ("LGR", "LGS", "LMN"), "below_mcn", AND_LMN),
    )


BATCH_NAMES = tuple(f"C{n:02d}" for n in range(1, 16))
APPENDS = ("C01", "C03", "C05", "C07", "C09", "C12")


def _chosen(names: tuple[str, ...], release_mcn_dam: str = "LMN") -> list[Batch]:
    unknown = set(names) - set(BATCH_NAMES)
    if unknown:
        raise ValueError(f"unknown batches: {sorted(unknown)}")
    return [b for b in batches(release_mcn_dam) if b.name in names]


@dataclass(frozen=True)
class Needs:
    """What the tables of some checkpoints after some batches depend on."""

    batches: tuple[str, ...]
    sources: tuple[str, ...]
    ages: bool
    facts: bool


def needs(
    names: tuple[str, ...] = BATCH_NAMES,
    dams: tuple[str, ...] = FILLED_DAMS,
    release_mcn_dam: str = "LMN",
) -> Needs:
    """Backwards from the wanted checkpoints: the batches that write a table which a later
    batch reads or which is wanted, and the detection sources and tagging columns they use.
    """
    chosen, wanted, live = _chosen(names, release_mcn_dam), set(dams), []
    for batch in reversed(chosen):
        if batch.dam in wanted:
            live.insert(0, batch)
            wanted |= batch.reads
    looked_at = {MAIN}.union(*[b.looks_at for b in live])
    return Needs(
        batches=tuple(b.name for b in live),
        sources=tuple(s for s in SOURCES if s in looked_at),
        ages=any(d.aged for b in live for d in getattr(b, "dates", ())),
        facts=bool(set(facts_written(names)) & set(dams)),
    )


def apply_batches(
    wide: DataFrame, names: tuple[str, ...] = BATCH_NAMES, release_mcn_dam: str = "LMN"
) -> DataFrame:
    """Run the named batches, in their fixed order, on the wide rows."""
    chosen = _chosen(names, release_mcn_dam)
    fills = {b.dam: b.name for b in chosen if isinstance(b, Fill)}
    for batch in chosen:
        wide = batch.apply(wide, last=fills.get(batch.dam) == batch.name)
    return wide


def facts_written(names: tuple[str, ...] = BATCH_NAMES) -> dict[str, Facts]:
    """Per checkpoint, where the named batches take species and tagging facts from.

    Every fill and every 1-0-1 batch sets them on all rows of its checkpoint. The
    last one sees all sources of the earlier ones, and no batch reads them, so they
    are written once, at the end, on all rows but those appended after it.
    """
    written: dict[str, Facts] = {}
    for batch in _chosen(names):
        if not isinstance(batch, Append):
            written[batch.dam] = Facts(batch.sources)
        elif batch.dam in written:
            before = written[batch.dam]
            written[batch.dam] = Facts(before.sources, (*before.not_added_by, batch.name))
    return written
