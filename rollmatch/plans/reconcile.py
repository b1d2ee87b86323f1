"""The matching pipeline: intake-cleaned rosters -> keys -> de-duplication -> match -> measures.

``Reconciliation`` holds the lazily built frames of one run; nothing executes
until a report is written or collected. Frames that feed several reports (the
de-duplicated sides and the match) are plain lazy plans; ``materialize`` writes
them to the shared checkpoint folder when a run writes many reports, so the
de-duplication shuffle runs once and a lost executor does not recompute it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.operators.cleaning import normalize_district_ids, prepare_side
from rollmatch.operators.keys import dedup_by_key, key_table
from rollmatch.operators.keys import keyed as keyed_rows
from rollmatch.operators.matching import match_one_to_one
from rollmatch.operators.measures import address_mismatch_counts, match_measure_table, pair_measure_table
from rollmatch.operators.summary import district_summary, district_summary_raw
from rollmatch.schema import MEAL, STUDENT, Side
from rollmatch.session import cut_lineage


@dataclass
class Reconciliation:
    s_rows: DataFrame          # S side: cleaned, both ids present, keyed, missing count
    p_rows: DataFrame          # P side: same
    dim: DataFrame             # district dimension (checked for unique ids)
    s: Side = STUDENT
    p: Side = MEAL
    order: tuple[str, ...] = ("seq",)
    parent_mode: str = "or"
    transpositions: str = "half"
    threshold: float = 0.9
    prefix_weight: float = 0.0

    @cached_property
    def s_undup(self) -> DataFrame:
        return dedup_by_key(self.s_rows, self.s, self.order)

    @cached_property
    def p_undup(self) -> DataFrame:
        return dedup_by_key(self.p_rows, self.p, self.order)

    @cached_property
    def s_keys(self) -> DataFrame:
        """The S side's key table, written once in the shared checkpoint folder."""
        return cut_lineage(key_table(self.s_rows, self.s, self.order))

    @cached_property
    def p_keys(self) -> DataFrame:
        return cut_lineage(key_table(self.p_rows, self.p, self.order))

    @cached_property
    def match(self) -> DataFrame:
        return match_one_to_one(self.p_undup, self.s_undup)

    @cached_property
    def table(self) -> DataFrame:
        """Every matched-student measure per S district."""
        return match_measure_table(self.match, self.s, self.p, self.parent_mode,
                                   self.threshold, self.transpositions, self.prefix_weight)

    @cached_property
    def slim_table(self) -> DataFrame:
        """The measures but the address one: a report on it reads no address (one aggregation over the 1:1 match)."""
        return match_measure_table(self.match, self.s, self.p, self.parent_mode, address=False)

    @cached_property
    def address_table(self) -> DataFrame:
        """Address mismatches per S district, over distinct pairs of texts of the 1:1 match."""
        a = self.s.col("aun9_3")
        return address_mismatch_counts(self.match, self.s, self.p, F.col(a), a, self.threshold, self.transpositions, self.prefix_weight)

    @cached_property
    def pair_table(self) -> DataFrame:
        """Same measures over the raw many-to-many match, counted from per-key aggregates."""
        return pair_measure_table(self.s_rows, self.p_rows, self.s, self.p, self.parent_mode)

    def pair_measures(self, *wanted: str) -> DataFrame:
        """``pair_table`` with the wanted measures only: nothing else is read or counted."""
        return pair_measure_table(self.s_rows, self.p_rows, self.s, self.p, self.parent_mode, wanted)

    def summary(self) -> DataFrame:
        """Every measure per plain district id, in one pass over the two de-duplicated sides."""
        return district_summary(self.s_undup, self.p_undup, self.s, self.p, self.dim, self.parent_mode,
                                self.threshold, self.transpositions, self.prefix_weight)

    def summary_raw(self) -> DataFrame:
        """The summary over raw rows and the raw many-to-many match (no address measure)."""
        return district_summary_raw(self.s_rows, self.p_rows, self.pair_table, self.s, self.p, self.dim)

    def materialize(self) -> "Reconciliation":
        """Checkpoint the de-duplicated sides into the shared checkpoint folder."""
        self.__dict__["s_undup"] = cut_lineage(self.s_undup)
        self.__dict__["p_undup"] = cut_lineage(self.p_undup)
        self.__dict__.pop("match", None)
        self.__dict__.pop("table", None)
        self.__dict__.pop("slim_table", None)
        self.__dict__.pop("address_table", None)
        return self


def keyed_side(raw: DataFrame, side: Side, policy: str = "name_dob", prepared: bool = False,
               normalize_aun: bool = False) -> DataFrame:
    """Raw (or intake-cleaned) roster -> cleaned rows with ``join_key`` and missing count.

    Snapshot this once (``sources.snapshot.write_snapshot``) and pass it to
    ``reconcile(..., keyed=True)``: reports then read only the columns they use, since
    the missing count, which needs every field, is already stored.
    """
    rows = raw if prepared else prepare_side(raw, side)
    if normalize_aun:
        rows = normalize_district_ids(rows, side)
    return keyed_rows(rows, side, policy)


def reconcile(s_raw: DataFrame, p_raw: DataFrame, dim: DataFrame, policy: str = "name_dob",
              s: Side = STUDENT, p: Side = MEAL, prepared: bool = False, normalize_aun: bool = False,
              keyed: bool = False, **options) -> Reconciliation:
    """Rosters -> a ``Reconciliation``.

    ``prepared=False``: raw rosters (unprefixed 25 fields + order columns) are prefixed,
    cleaned and filtered here. ``prepared=True``: intake snapshots, already prefixed and
    cleaned (``plans.intake``); pass ``order=sources.csv.ORDER`` for CSV intake.
    ``normalize_aun=True`` folds the dashed and undashed forms of a district id.
    ``keyed=True``: rosters already carry keys and missing counts (``keyed_side`` snapshots).
    """
    if keyed:
        return Reconciliation(s_rows=s_raw, p_rows=p_raw, dim=dim, s=s, p=p, **options)
    return Reconciliation(s_rows=keyed_side(s_raw, s, policy, prepared, normalize_aun),
                          p_rows=keyed_side(p_raw, p, policy, prepared, normalize_aun),
                          dim=dim, s=s, p=p, **options)
