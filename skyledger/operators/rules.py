"""Cell rules as column builders, and the pipeline that folds them.

A rule gives (rank, reason) columns for a value: rank 0 pass, 1 suspect, 2 fail; reason null where it passes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import schema
from skyledger.functions import columns as C

Verdict = tuple[Column, Column]


def passed() -> Verdict:
    return F.lit(0), F.lit(None).cast("string")


def _cases(*cases: tuple[Column, int, Column | str]) -> Verdict:
    """The first case that holds; pass if none does."""
    rank, reason = passed()
    for when, r, why in reversed(cases):
        why = F.lit(why) if isinstance(why, str) else why
        rank, reason = F.when(when, r).otherwise(rank), F.when(when, why).otherwise(reason)
    return rank, reason


def _labels(code: Column, names: Mapping[object, str]) -> Column:
    out = code.cast("string")
    for k, v in names.items():
        out = F.when(code == k, F.lit(v)).otherwise(out)
    return out


@dataclass(frozen=True)
class Rule:
    """A named predicate of one tier: check(value, variable, columns of the table) -> verdict."""

    name: str
    tier: int
    check: Callable[[Column, str, Mapping[str, Column]], Verdict]


def physical_bounds(bounds: Mapping[str, tuple[float, float]] = schema.BOUNDS) -> Rule:
    def check(v: Column, variable: str, row: Mapping[str, Column]) -> Verdict:
        if variable not in bounds:
            return passed()
        lo, hi = bounds[variable]
        return _cases(((v < lo) | (v > hi), 2, "out_of_bounds"))

    return Rule("physical_bounds", 1, check)


def dewpoint_consistency(tolerance: float = 0.5) -> Rule:
    def check(v: Column, variable: str, row: Mapping[str, Column]) -> Verdict:
        return _cases((v > row["tair"] + tolerance, 2, "td_exceeds_tair")) if variable == "td" and "tair" in row else passed()

    return Rule("dewpoint_consistency", 1, check)


# Native column prefixes of the variables.
MADIS_NATIVE = {"tair": "temperature", "td": "dewpoint", "rh": "relHumidity", "wind": "windSpeed", "wind_dir": "windDir", "prcp": "precipAccum", "rsds_hourly": "solarRadiation"}
GDAS_MARKERS = {"tair": "temperature_qm", "td": "humidity_qm", "psfc": "pressure_qm", "wind": "wind_qm", "wind_dir": "wind_qm", "u": "wind_qm", "v": "wind_qm", "q": "humidity_qm", "sst": "sst_qm"}
QCR_PROFILES = {"strict": 115, "permissive": 2}
QCR_BITS = {0: "master", 1: "validity", 2: "reserved", 3: "internal_consistency", 4: "temporal_consistency", 5: "statistical_spatial", 6: "spatial_buddy"}
ISD_GOOD = ("1", "5")
GDAS_LABELS = {
    0: "not_checked", 1: "good", 2: "neutral", 3: "suspect", 4: "reject_level1", 5: "reject_level2", 6: "reject_level3", 7: "reject_level4", 8: "reject_level5", 9: "purged",
    10: "reject_level6", 11: "reject_level7", 12: "purged", 13: "reject_level8", 14: "reject_level9", 15: "purged",
}
ISD_LABELS = {"0": "not_checked", "1": "passed_all", "2": "suspect", "3": "erroneous", "4": "corrected", "5": "estimated", "6": "exception", "9": "missing"}


def madis_descriptor(acceptable: tuple[str, ...] = ("V", "S", "C", "G")) -> Rule:
    def check(v: Column, variable: str, row: Mapping[str, Column]) -> Verdict:
        name = f"{MADIS_NATIVE.get(variable)}DD"
        if name not in row:
            return passed()
        dd = F.trim(row[name])
        return _cases((dd.isNull() | (dd == ""), 1, "dd_missing"), (~dd.isin(*acceptable), 2, F.concat(F.lit("dd_rejected_"), F.lower(dd))))

    return Rule("madis_dd", 0, check)


def madis_qcr(mask: int = QCR_PROFILES["strict"]) -> Rule:
    def check(v: Column, variable: str, row: Mapping[str, Column]) -> Verdict:
        name = f"{MADIS_NATIVE.get(variable)}QCR"
        return _cases((row[name].cast("long").bitwiseAND(F.lit(mask)) != 0, 2, "qcr_reject")) if name in row else passed()

    return Rule("madis_qcr", 0, check)


def qcr_detail(qcr: Column, mask: int = QCR_PROFILES["strict"]) -> Column:
    """Names of the failed checks."""
    bits = F.array(*(F.when(qcr.cast("long").bitwiseAND(F.lit(mask & (1 << k))) != 0, F.lit(n)) for k, n in QCR_BITS.items()))
    return F.array_join(F.filter(bits, lambda x: x.isNotNull()), ",")


def gdas_marker(labels: Mapping[int, str] = GDAS_LABELS) -> Rule:
    def check(v: Column, variable: str, row: Mapping[str, Column]) -> Verdict:
        name = GDAS_MARKERS.get(variable)
        if name not in row:
            return passed()
        qm = row[name].cast("int")
        return _cases((qm == 3, 1, "qm_suspect"), (qm >= 4, 2, F.concat(F.lit("qm_rejected_"), _labels(qm, labels))))

    return Rule("gdas_qm", 0, check)


def isd_quality(labels: Mapping[str, str] = ISD_LABELS) -> Rule:
    def check(v: Column, variable: str, row: Mapping[str, Column]) -> Verdict:
        name = f"{variable}_qc"
        if name not in row:
            return passed()
        qc = F.trim(row[name].cast("string"))
        return _cases((qc.isNull() | (qc == ""), 1, "qc_missing"), (~qc.isin(*ISD_GOOD), 2, F.concat(F.lit("qc_rejected_"), _labels(qc, labels))))

    return Rule("isd_quality", 0, check)


def sentinel(values: tuple[float, ...] = (99.0, 999.0, 9999.0)) -> Rule:
    return Rule("sentinel", 0, lambda v, variable, row: _cases((v.isNull(), 2, "value_none"), (v.isin(*values), 2, "sentinel_detected")))


def default_pipeline(source: str, *, qcr_mask: int = QCR_PROFILES["strict"]) -> list[Rule]:
    native = {"madis": [madis_descriptor(), madis_qcr(qcr_mask)], "gdas": [gdas_marker()]}.get(source, [])
    return [*native, physical_bounds(), dewpoint_consistency()]


def apply_pipeline(df: DataFrame, pipeline: list[Rule], variables: list[str] | None = None, *, source: str | None = None) -> DataFrame:
    """Adds {var}_qc_state and {var}_qc_reason_codes, and the row's qc_state and qc_reason_codes.

    States are seeded from columns that exist and only get worse; null cells keep their seed.  Row reasons come in
    order of variables, then rules.  One projection, no Python.
    """
    names = variables or schema.QC_COLUMNS.get(source or "", ())
    names = [v for v in names if v in df.columns]
    row = {c: F.col(c) for c in df.columns}
    new: dict[str, Column] = {}
    ranks, reasons = [], []
    for v in names:
        value, given = F.col(v), F.col(v).isNotNull()
        verdicts = [r.check(value, v, row) for r in pipeline]
        state, why = (row.get(f"{v}_{k}", F.lit(None).cast("string")) for k in ("qc_state", "qc_reason_codes"))
        rank = F.greatest(C.state_rank(state), F.when(given, F.greatest(F.lit(0), *(x for x, _ in verdicts))).otherwise(0))
        found = [F.when(given & (x > 0), y) for x, y in verdicts]
        new[f"{v}_qc_state"] = C.state_of(rank)
        new[f"{v}_qc_reason_codes"] = C.join_reasons(why, *found)
        ranks.append(F.when(given, rank).otherwise(0))
        reasons += [F.concat(F.lit(f"{v}:"), x) for x in found]
    seed, why = row.get("qc_state", F.lit(None).cast("string")), row.get("qc_reason_codes", F.lit(None).cast("string"))
    new["qc_state"] = C.state_of(F.greatest(F.lit(0), C.state_rank(seed), *ranks))
    new["qc_reason_codes"] = C.join_reasons(why, *reasons)
    return df.withColumns(new).drop("qc_passed")


# Bounds in Kelvin and native units for the extract step.
MADIS_EXTRACT_BOUNDS = {"temperature": (223.15, 333.15), "dewpoint": (205.15, 305.15), "relHumidity": (2, 110), "windSpeed": (0, 35), "windDir": (0, 360)}


def madis_extract_qc(df: DataFrame, mask: int = QCR_PROFILES["strict"]) -> DataFrame:
    """Nulls values whose descriptor is not acceptable, whose QCR meets the mask, or that are out of bounds; adds
    qc_passed: whether one of the five core variables is left."""
    new = {}
    for v, (lo, hi) in MADIS_EXTRACT_BOUNDS.items():
        if v not in df.columns:
            continue
        ok = F.col(v).between(lo, hi)
        if f"{v}DD" in df.columns:
            ok &= F.coalesce(F.trim(F.col(f"{v}DD")).isin("V", "S", "C", "G"), F.lit(False))
        if f"{v}QCR" in df.columns:
            ok &= F.coalesce(F.col(f"{v}QCR").cast("long"), F.lit(0)).bitwiseAND(F.lit(mask)) == 0
        new[v] = F.when(ok, F.col(v))
    out = df.withColumns(new)
    return out.withColumn("qc_passed", F.coalesce(*(F.col(v) for v in new)).isNotNull() if new else F.lit(False))


def isd_mask(df: DataFrame, variables: list[str]) -> DataFrame:
    """Nulls values whose quality code is not 1 or 5."""
    return df.withColumns({v: F.when(F.coalesce(F.trim(F.col(f"{v}_qc").cast("string")).isin(*ISD_GOOD), F.lit(False)), F.col(v)) for v in variables})
