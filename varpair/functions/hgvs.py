"""HGVS change parsers (C5 cDNA, C6 protein) as native regex expressions.

Each parser returns a struct; rows whose text does not fit the grammar of
their variant type get a NULL struct (the caller counts them) instead of
shifting later rows as a positional paste would.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import col_

# Variant types handled like substitutions.
SUBSTITUTION_TYPES = ["SNP", "DNP", "TNP", "ONP"]

# Grammar of the change strings.
CDNA_SUB = r"^c\.(\d+)([A-Z]+)>([A-Z]+)$"
CDNA_INS_RANGE = r"^c\.(\d+)_(\d+)ins([A-Z]*)$"
CDNA_INS_POINT = r"^c\.(\d+)ins([A-Z]*)$"
CDNA_DEL_RANGE = r"^c\.(\d+)_(\d+)del([A-Z]*)$"
CDNA_DEL_POINT = r"^c\.(\d+)del([A-Z]*)$"

PROT_SUB = r"^p\.([A-Z]+)(\d+)([A-Z]*)$"
PROT_SUB_STAR = r"^p\.([A-Z*]+)(\d+)([A-Z*]*)$"  # a substitution may read or make a stop
PROT_LEAD = r"^p\.([A-Z]+)(\d+)"
PROT_INS_RANGE = r"^p\.[A-Z]*(\d+)_[A-Z]*(\d+)ins([A-Z]*)$"
PROT_DEL_SUBST = r"^p\.[A-Z]*(\d+)(?:_[A-Z]*\d+)?([A-Z]+)>([A-Z]+)$"
PROT_STAR_FS = r"\*(\d+)fs"
PROT_DEL_STAR = r"^p\.([A-Z]+)\*([A-Z]+)(\d+)$"  # a deletion written across a stop


def _int(s: Column) -> Column:
    return F.when(s != "", s.cast("int"))


def _rx(s: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(s, pattern, group)


def _matches(s: Column, pattern: str) -> Column:
    return F.coalesce(s.rlike(pattern), F.lit(False))


def _cdna(start: Column, end: Column, ref: Column, alt: Column) -> Column:
    return F.struct(start.alias("mutstart"), end.alias("mutend"), ref.alias("mutref"), alt.alias("mutalt"))


def parse_cdna(change: str | Column, vtype: str | Column) -> Column:
    """``struct(mutstart, mutend, mutref, mutalt)`` from a cDNA change."""
    c, t = col_(change), col_(vtype)
    sub_start = _int(_rx(c, CDNA_SUB, 1))
    sub_ref = _rx(c, CDNA_SUB, 2)
    sub = _cdna(sub_start, sub_start + F.length(sub_ref) - 1, sub_ref, _rx(c, CDNA_SUB, 3))
    ins_r = _cdna(_int(_rx(c, CDNA_INS_RANGE, 1)), _int(_rx(c, CDNA_INS_RANGE, 2)), F.lit(""), _rx(c, CDNA_INS_RANGE, 3))
    ins_p_start = _int(_rx(c, CDNA_INS_POINT, 1))
    ins_p = _cdna(ins_p_start, ins_p_start, F.lit(""), _rx(c, CDNA_INS_POINT, 2))
    del_r = _cdna(_int(_rx(c, CDNA_DEL_RANGE, 1)), _int(_rx(c, CDNA_DEL_RANGE, 2)), _rx(c, CDNA_DEL_RANGE, 3), F.lit(""))
    del_p_start = _int(_rx(c, CDNA_DEL_POINT, 1))
    del_p = _cdna(del_p_start, del_p_start, _rx(c, CDNA_DEL_POINT, 2), F.lit(""))
    return (
        F.when(t.isin(*SUBSTITUTION_TYPES) & _matches(c, CDNA_SUB), sub)
        .when((t == "INS") & _matches(c, CDNA_INS_RANGE), ins_r)
        .when((t == "INS") & _matches(c, CDNA_INS_POINT), ins_p)
        .when((t == "DEL") & _matches(c, CDNA_DEL_RANGE), del_r)
        .when((t == "DEL") & _matches(c, CDNA_DEL_POINT), del_p)
    )


def _prot(start: Column, end: Column, ref: Column, alt: Column, fs: Column) -> Column:
    return F.struct(
        start.alias("protstart"), end.alias("protend"), ref.alias("protref"), alt.alias("protalt"), fs.alias("frameshift")
    )


def parse_protein(change: str | Column, vtype: str | Column) -> Column:
    """``struct(protstart, protend, protref, protalt, frameshift)``."""
    c, t = col_(change), col_(vtype)
    has_fs = F.coalesce(c.contains("fs"), F.lit(False))
    has_svp = F.coalesce(c.contains("SVP"), F.lit(False))
    has_star = F.coalesce(c.contains("*"), F.lit(False))
    no, yes = F.lit(False), F.lit(True)

    sub_n = _int(_rx(c, PROT_SUB, 2))
    sub = _prot(sub_n, sub_n, _rx(c, PROT_SUB, 1), _rx(c, PROT_SUB, 3), no)
    stop_n = _int(_rx(c, PROT_SUB_STAR, 2))
    sub_star = _prot(stop_n, stop_n, _rx(c, PROT_SUB_STAR, 1), _rx(c, PROT_SUB_STAR, 3), no)
    del_star_n = _int(_rx(c, PROT_DEL_STAR, 3))
    del_star = _prot(del_star_n, del_star_n, _rx(c, PROT_DEL_STAR, 1), _rx(c, PROT_DEL_STAR, 2), no)
    lead_n = _int(_rx(c, PROT_LEAD, 2))
    lead_ref = _rx(c, PROT_LEAD, 1)
    ins_fs = _prot(lead_n, lead_n, lead_ref, F.lit(""), yes)
    ins_svp = _prot(lead_n, lead_n, F.lit(""), lead_ref, no)
    ins_r = _prot(
        _int(_rx(c, PROT_INS_RANGE, 1)), _int(_rx(c, PROT_INS_RANGE, 2)), F.lit(""), _rx(c, PROT_INS_RANGE, 3), no
    )
    del_sub_n = _int(_rx(c, PROT_DEL_SUBST, 1))
    del_sub = _prot(del_sub_n, del_sub_n, _rx(c, PROT_DEL_SUBST, 2), _rx(c, PROT_DEL_SUBST, 3), no)
    star_n = _int(_rx(c, PROT_STAR_FS, 1))
    del_star_fs = _prot(star_n, star_n, F.lit("*"), F.lit("*"), yes)
    del_plain = _prot(lead_n, lead_n, lead_ref, F.lit(""), has_fs)

    return (
        F.when(t.isin(*SUBSTITUTION_TYPES) & _matches(c, PROT_SUB_STAR), sub_star)
        .when((t == "INS") & has_fs & _matches(c, PROT_LEAD), ins_fs)
        .when((t == "INS") & has_svp & _matches(c, PROT_LEAD), ins_svp)
        .when((t == "INS") & c.contains("_") & _matches(c, PROT_INS_RANGE), ins_r)
        .when((t == "INS") & ~c.contains("_") & _matches(c, PROT_SUB), sub)
        .when((t == "DEL") & c.contains(">") & _matches(c, PROT_DEL_SUBST), del_sub)
        .when((t == "DEL") & has_star & has_fs & _matches(c, PROT_STAR_FS), del_star_fs)
        .when((t == "DEL") & has_star & ~has_fs & _matches(c, PROT_DEL_STAR), del_star)
        .when((t == "DEL") & ~has_star & _matches(c, PROT_LEAD), del_plain)
    )
