"""Parameters of a run."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SampleSpec:
    """frac: share of households in the base year. years: half-open range. departments or provinces: not both.

    method: `exact` or `bernoulli`. on_invalid: `skip` leaves strata with an unusable rate empty, `cap` keeps all
    households of those with a rate above 1, `raise` stops.
    """

    frac: float = 0.01
    years: tuple[int, int] = (2021, 2022)
    base_year: int = 2010
    departments: tuple[int, ...] | None = None
    provinces: tuple[int, ...] | None = None
    seed: int = 1
    method: str = "exact"
    on_invalid: str = "skip"
    name: str = "sample"

    def __post_init__(self):
        if self.departments is not None and self.provinces is not None:
            raise ValueError("give departments or provinces, not both")
        if self.method not in ("exact", "bernoulli") or self.on_invalid not in ("skip", "cap", "raise"):
            raise ValueError("unknown method or on_invalid")


@dataclass(frozen=True)
class Hierarchy:
    """Columns of the levels: source name to ours. Keys are dwelling_id, household_id and tract_id."""

    dwelling: dict[str, str]
    household: dict[str, str]
    person: dict[str, str]


#: Columns of the 2010 microdata files.
CENSUS = Hierarchy(
    dwelling={"VIVIENDA_REF_ID": "dwelling_id", "RADIO_REF_ID": "tract_id", "URP": "URP", "TIPVV": "TIPVV", "V01": "V01"},
    household={"HOGAR_REF_ID": "household_id", "VIVIENDA_REF_ID": "dwelling_id"} | {c: c for c in "H05 H06 H07 H08 H09 H10 H11 H12 H13 H14 H15 H16 PROP TOTPERS".split()},
    person={"PERSONA_REF_ID": "person_id", "HOGAR_REF_ID": "household_id"} | {c: c for c in "P01 P02 P03 P05 P06 P07 P12 P08 P09 P10 CONDACT".split()},
)
