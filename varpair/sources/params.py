"""Run parameters (tissue, sexes, optional expression table, flags)."""

from __future__ import annotations

from dataclasses import dataclass

# Accepted spellings of the two sexes.
MALE_SPELLINGS = {"m", "male"}
FEMALE_SPELLINGS = {"f", "female"}


def normalise_sex(value: str | None) -> str:
    v = (value or "").strip().lower()
    if v in MALE_SPELLINGS:
        return "M"
    if v in FEMALE_SPELLINGS:
        return "F"
    return "unknown"


@dataclass(frozen=True)
class RunParams:
    tissue: str
    host_sex: str = "unknown"
    donor_sex: str = "unknown"
    tpm_path: str | None = None
    gvhd: bool = True
    pad: int = 10
    keep_nonsense: bool = False  # keep changes that make or lose a stop

    def __post_init__(self):
        object.__setattr__(self, "host_sex", normalise_sex(self.host_sex))
        object.__setattr__(self, "donor_sex", normalise_sex(self.donor_sex))

    @property
    def female_to_male(self) -> bool:
        """the Y branch runs when a male host receives a female donor."""
        return self.host_sex == "M" and self.donor_sex == "F"
