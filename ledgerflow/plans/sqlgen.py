"""DuckDB SQL fragments for the oracle side of the driver queries.

Each fragment restates an operator's semantics in plain SQL from the same
fixed tables in ``config``; none shares code with the Spark side.
"""
from __future__ import annotations

from ..config import (CAR_TERMS, COMPANY_SUFFIXES, CONTACT_TERMS, FACEBOOK_TERMS,
                      NAME_KEEP_CHARS, PERSONAL_MODEL_CATEGORIES, SOURCE_VOCAB, TRANSFER_TERMS,
                      VENDOR_TERMS)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip_ws(e: str) -> str:
    return f"regexp_replace({e}, '^\\s+|\\s+$', '', 'g')"


def clean_desc(e: str) -> str:
    s = f"coalesce(CAST({e} AS VARCHAR), '')"
    s = f"regexp_replace({s}, '^\\[.*?\\]\\s*', '')"
    s = f"regexp_replace({s}, '\\b\\d{{10,}}\\b', '', 'g')"
    s = f"regexp_replace({s}, '\\s{{2,}}', ' ', 'g')"
    return strip_ws(s)


def norm_name(e: str) -> str:
    s = f"regexp_replace(lower(coalesce({e}, '')), '[^a-z0-9{NAME_KEEP_CHARS}]', ' ', 'g')"
    s = f"regexp_replace({s}, '\\s{{2,}}', ' ', 'g')"
    return strip_ws(s)


def contains_any(e: str, terms) -> str:
    return "(" + " OR ".join(f"contains({e}, {q(t)})" for t in terms) + ")"


def first_label(e: str, table, default="NULL") -> str:
    parts = " ".join(f"WHEN contains({e}, {q(t)}) THEN {q(lab)}" for t, lab in table)
    return f"(CASE {parts} ELSE {default} END)"


def vendor(e: str) -> str:
    return first_label(e, VENDOR_TERMS)


def contact_map(e: str) -> str:
    return first_label(e, [(t, "business" if k == "expense" else "personal") for t, k in CONTACT_TERMS])


def model_lean(cat: str) -> str:
    lst = ", ".join(q(c) for c in PERSONAL_MODEL_CATEGORIES)
    return f"(CASE WHEN upper(coalesce({cat}, '')) IN ({lst}) THEN 'personal' ELSE 'business' END)"


def suffix_business(e: str) -> str:
    alt = "|".join(COMPANY_SUFFIXES)
    return f"regexp_matches({e}, '\\b(?:{alt})\\b')"


def doc_bank(src: str) -> str:
    banks = ", ".join(q(b) for b in SOURCE_VOCAB + ("Other",))
    n = len(SOURCE_VOCAB) + 1
    return (f"([{banks}][(TRY_CAST(regexp_extract({src}, '(\\d+)$', 1) AS INTEGER) % {n}) + 1])")


LANG_CATEGORY = (("en", "EXPENSES"), ("fr", "PERSONAL"), ("de", "REVENUE"), ("es", "CAREGIVER"))


def lang_category(lang: str) -> str:
    parts = " ".join(f"WHEN {lang} = {q(k)} THEN {q(v)}" for k, v in LANG_CATEGORY)
    return f"(CASE {parts} ELSE NULL END)"


def chain(src: str, dn: str, cat: str, transfer: dict | None = None) -> dict:
    """The decision chain as four CASE expressions (category, lean, decision,
    unresolved). ``transfer`` supplies SQL for is_transfer / matched / xcat /
    xlean when an index is used."""
    mlean = model_lean(cat)
    s = f"coalesce({src}, '')"
    car = contains_any(dn, CAR_TERMS)
    fb = contains_any(dn, FACEBOOK_TERMS)
    cm = contact_map(dn)
    rows = [(f"starts_with({s}, 'TD')", "'Advertising'", "'business'", "'source_td'", "false")]
    if transfer:
        it, m, xc, xl = transfer["is_transfer"], transfer["matched"], transfer["xcat"], transfer["xlean"]
        rows += [
            (f"{it} AND {m} AND {xc} IS NOT NULL", xc, xl, "'etransfer_xref'", "false"),
            (f"{it} AND {m}", cat, f"coalesce({xl}, {mlean})", "'etransfer_unresolved'", "true"),
            (f"{it}", cat, mlean, "'etransfer_unresolved'", "true"),
        ]
    rows += [
        (car, "'Business Expense'", "'business'", "'keyword_car'", "false"),
        (fb, "'Advertising'", "'business'", "'keyword_facebook'", "false"),
        (f"starts_with({s}, 'BMO')", cat, "'business'", "'source_prior'", "false"),
        (f"{s} = 'Tangerine'", cat, "'personal'", "'source_prior'", "false"),
        (f"{cm} IS NOT NULL", cat, cm, "'contact_map'", "false"),
    ]
    default = (cat, mlean, "'model'", "false")
    out = {}
    for i, name in enumerate(("category", "lean", "decision", "unresolved")):
        body = " ".join(f"WHEN {r[0]} THEN {r[i + 1]}" for r in rows)
        out[name] = f"(CASE {body} ELSE {default[i]} END)"
    return out


def transfer_terms(dn: str) -> str:
    return contains_any(dn, TRANSFER_TERMS)
