"""References, defaults and code systems."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What codes of a system look like, and the system's address.
CODE_SYSTEMS = {
    "loinc": ("http://loinc.org", r"^[0-9]{1,7}-[0-9]$"),
    "icd10": ("http://hl7.org/fhir/sid/icd-10-cm", r"^[A-Z][0-9][0-9A-Z](\.[0-9A-Z]{1,4})?$"),
    "rxnorm": ("http://www.nlm.nih.gov/research/umls/rxnorm", r"^[0-9]{1,8}$"),
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_reference(c: Column | str, kind: str) -> Column:
    """``Patient/p1`` to ``p1``: every ``kind/`` goes, wherever it stands."""
    return F.replace(_col(c), F.lit(f"{kind}/"), F.lit(""))


def default_text(c: Column | str, default: str = "UNKNOWN") -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(default))


def code_system_valid(code: Column | str, system: str, given: Column | str | None = None) -> Column:
    """Whether a code has its system's form and, where ``given`` is known, names that system. Null code: false."""
    address, form = CODE_SYSTEMS[system]
    ok = F.coalesce(_col(code).rlike(form), F.lit(False))
    return ok if given is None else ok & F.coalesce(_col(given) == address, F.lit(False))
