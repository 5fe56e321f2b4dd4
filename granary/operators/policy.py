"""Options, thresholds and records of a run: small values on the driver, checked before any job starts."""

from __future__ import annotations

import difflib
import inspect
import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Thresholds, resolutions, tiers that are left out, the share of Ensembl ids among the first ones.
MIN_GENES, MAX_GENES, MAX_MITO = 200, 6000, 15.0
PRIMARY, SWEEP = 0.5, (0.2, 0.4, 0.5, 0.8, 1.0)
TIERS = ("Low/Review",)
ENSEMBL_SHARE, ENSEMBL_FIRST = 0.6, 50


@dataclass(frozen=True)
class Thresholds:
    min_genes: int
    max_genes: int
    max_mito: float


def _number(x, otherwise, name: str):
    if x is None or x == "":
        return otherwise
    if isinstance(x, bool) or not math.isfinite(float(x)):
        raise ValueError(f"{name}: {x!r} is no number")
    return float(x)


def thresholds(min_genes=None, max_genes=None, max_mito=None) -> Thresholds:
    """None or '' is the default; min >= 0, max > min, 0 < mito <= 100; booleans are rejected."""
    lo, hi, mito = (_number(x, d, n) for x, d, n in ((min_genes, MIN_GENES, "min_genes"), (max_genes, MAX_GENES, "max_genes"), (max_mito, MAX_MITO, "max_mito")))
    if lo < 0 or hi <= lo or not 0 < mito <= 100:
        raise ValueError(f"thresholds out of range: {lo}, {hi}, {mito}")
    return Thresholds(int(lo), int(hi), mito)


def resolution(x=None) -> float:
    r = _number(x, PRIMARY, "resolution")
    if r <= 0:
        raise ValueError(f"resolution {x!r} is not above 0")
    return r


def resolution_column(x: float) -> str:
    """0.2 -> leiden_res_0_2"""
    return "leiden_res_" + f"{resolution(x):g}".replace(".", "_")


def resolutions(candidates: Iterable | None = None, *, primary: float = PRIMARY) -> list[float]:
    """Valid, with the primary one, sorted; one of those that share a column name."""
    every = {resolution_column(x): resolution(x) for x in [*(SWEEP if candidates is None else candidates), primary]}
    return sorted(every.values())


def excluded_tiers(tiers: Iterable | str | None = None) -> list[str]:
    return list(TIERS) if not tiers else [tiers] if isinstance(tiers, str) else list(tiers)


def looks_like_ensembl(ids: DataFrame, column: str, prefix: str = "ENSG") -> bool:
    """Whether most of the first ids start with the prefix, in any case; a documented probe of that many rows."""
    share = ids.select(column).limit(ENSEMBL_FIRST).agg(F.avg(F.upper(column).startswith(prefix.upper()).cast("int")).alias("x")).first().x
    return (share or 0) > ENSEMBL_SHARE


def merged(options: dict, **overrides) -> dict:
    """Options with some replaced; an unknown name raises and is told what it may mean."""
    for k in overrides:
        if k not in options:
            near = difflib.get_close_matches(k, options, 1)
            raise ValueError(f"unknown option {k!r}" + (f"; did you mean {near[0]!r}?" if near else ""))
    return options | overrides


def flattened(config: dict, known: set[str]) -> tuple[dict, list[str]]:
    """Sections as one level of options, and the keys that are not known. A name given twice with other values raises."""
    out, unknown = {}, []

    def walk(section, at):
        for k, v in section.items():
            if isinstance(v, dict) and k not in known:
                walk(v, [*at, k])
            elif k not in known:
                unknown.append(".".join([*at, k]))
            elif k in out and out[k] != v:
                raise ValueError(f"option {k!r} is given twice")
            else:
                out[k] = v

    walk(config, [])
    return out, sorted(unknown)


def contract_faults(options: set[str], function: Callable, *, ours: set[str] = frozenset()) -> dict[str, list[str]]:
    """Options that the function does not take, and parameters that no option sets; ``ours`` are used by the caller alone."""
    takes = {n for n, p in inspect.signature(function).parameters.items() if p.kind in (p.KEYWORD_ONLY, p.POSITIONAL_OR_KEYWORD)}
    return {"not_taken": sorted(options - takes - set(ours)), "not_set": sorted(takes - options)}


def integration_policy(cells: DataFrame, method: str | None, batch: str | None, group: str = "grp") -> dict:
    """What an integration may be used for. It warns and never stops a run: a batch that is missing, single or the same as the group is told; results serve annotation only."""
    warnings = []
    if method and not batch:
        warnings.append("no batch column")
    elif method and batch not in cells.columns:
        warnings.append(f"batch column {batch!r} is missing")
    elif method:
        n = cells.select(batch).distinct().count()
        pairs = cells.select(batch, group).distinct().count()
        if n < 2:
            warnings.append("a single batch")
        if pairs == n and cells.select(group).distinct().count() > 1:
            warnings.append("batches are nested in groups: the difference between groups would be removed")
    return {"method": method or "none", "batch_key": batch, "requested": bool(method), "applied": bool(method) and not any("batch" in w and "nested" not in w for w in warnings), "scope": "annotation_only" if method else "none", "de_input": "raw_counts", "warnings": warnings}


def preflight(checks: DataFrame) -> list[tuple[str, str, int]]:
    """(check, status, n) of a validation report; raises if one failed."""
    rows = [(r.check, r.status, r.n) for r in checks.collect()]
    if bad := [r for r in rows if r[1] == "fail"]:
        raise ValueError(f"validation failed: {bad}")
    return rows


def annotation_provenance(requested: dict, resolved: dict) -> dict:
    """What was asked for and what was used, by resource, and which differ."""
    keys = sorted({*requested, *resolved})
    return {"requested": {k: requested.get(k) for k in keys}, "resolved": {k: resolved.get(k) for k in keys}, "changed": [k for k in keys if requested.get(k) != resolved.get(k)]}


def biocontext(taxon: str | None, tissue: str | None, choose: Callable[[], str | None] | None = None) -> tuple[str | None, str | None]:
    """Species from a taxon; the tissue as given, else from ``choose`` if it is unset or 'auto'."""
    species = {"9606": "human", "10090": "mouse", "10116": "rat"}.get(str(taxon or "").strip())
    given = (tissue or "").strip()
    return species, given if given and given.lower() != "auto" else (choose() if choose else None)


def refined_model(model: str, profile: dict, specialists: dict[str, str], valid: set[str] | None = None, least: float = 0.9) -> str:
    """A specialist model instead of the general one if at least that share of clusters has its lineage."""
    to = specialists.get(profile.get("dominant_lineage"))
    return to if to and profile.get("fraction", 0.0) >= least and (valid is None or to in valid) else model


def rerun_plan(types: Iterable[str], command: str = "annotate") -> str:
    """Shell lines that run the annotation again, one for each type that is held out of the vocabulary."""
    import shlex

    return "".join(f"{command} --held-out {shlex.quote(t)} --out {shlex.quote('heldout_' + ''.join(c if c.isalnum() else '_' for c in t))}\n" for t in sorted(set(types)))
