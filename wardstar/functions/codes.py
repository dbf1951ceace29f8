"""Clinical code groupings and encounter-level derived flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ICD-9 chapters as label -> closed numeric ranges; the first
# chapter that fits counts (459.5 is in none of Circulatory's).
ICD9_RANGES: dict[str, list[tuple[float, float]]] = {
    "Circulatory": [(390, 459), (785, 785)],
    "Respiratory": [(460, 519), (786, 786)],
    "Digestive": [(520, 579), (787, 787)],
    "Genitourinary": [(580, 629)],
    "Injury": [(800, 999)],
    "Musculoskeletal": [(710, 739)],
    "Neoplasms": [(140, 239)],
}
# Codes told by their first letter, and diabetes, whose range is
# open above so that all of 250.xx is in it.
ICD9_LETTERS = {"V": "Supplemental (V-code)", "E": "External cause (E-code)"}
ICD9_DIABETES = ("Diabetes", 250, 251)
ICD9_NONE, ICD9_OTHER = "Unknown", "Other"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def icd9_group(code: Column | str) -> Column:
    """Group an ICD-9 code string into one of twelve chapters.

    The code is cast to double with ``try_cast`` so malformed text falls
    through to "Other" instead of failing the query under ANSI mode. A lambda
    binds the number, so that it is cast once and not in every comparison: that
    made a method too long for the JVM to compile.
    """
    c = _c(code)
    cases = [(c.isNull(), ICD9_NONE)]
    cases += [(c.startswith(letter), name) for letter, name in ICD9_LETTERS.items()]
    by_number = F.get(F.transform(F.array(c.try_cast("double")), _icd9_chapter), 0)
    return F.coalesce(*[F.when(fits, name) for fits, name in cases], by_number)


def _icd9_chapter(d: Column) -> Column:
    label, lo, hi = ICD9_DIABETES
    cases = [((d >= lo) & (d < hi), label)]
    for name, ranges in ICD9_RANGES.items():
        cases += [(d.between(first, last), name) for first, last in ranges]
    return F.coalesce(*[F.when(fits, name) for fits, name in cases], F.lit(ICD9_OTHER))


def prior_visits(outpatient="number_outpatient", emergency="number_emergency",
                 inpatient="number_inpatient") -> Column:
    """Sum of prior visits; NULL if any part is NULL."""
    return _c(outpatient) + _c(emergency) + _c(inpatient)


def risk_tier(prior: Column | str = "prior_visits_total",
              inpatient: Column | str = "number_inpatient") -> Column:
    """High if prior >= 3 or inpatient >= 2, Medium if prior >= 1, else Low.

    Three-valued: a NULL prior with inpatient >= 2 is High; all NULL is Low.
    """
    p, i = _c(prior), _c(inpatient)
    return F.when((p >= 3) | (i >= 2), "High").when(p >= 1, "Medium").otherwise("Low")


def readmit_target(readmitted: Column | str = "readmitted", positive: str = "<30") -> Column:
    return F.when(_c(readmitted) == positive, 1).otherwise(0)
