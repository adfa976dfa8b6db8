"""A small invented sales table, its lookup tables, and the cleaning rules as a plain loop."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

from ledgerlens.plans.settings import DATE_COLUMNS, PRICE_COLUMNS, Lookups

TEXT = [
    "project_name", "phase", "phase_property_type", "build_type", "financier1_name", "is_cash_buyer",
    "customer_gender", "contact_gender", "customer_marital_status", "contact_marital_status",
    "customer_race", "contact_race", "customer_race_group", "customer_nationality",
    "contact_nationality", "customer_bumi_status", "contact_nric", "contact_identification_type",
    "contact_purchaser_type", "contact_salutation", "contact_occupation", "contact_city",
    "contact_staff", "contact_lifestyle_registration_status", "contact_annual_income",
]
NUMBERS = ["built_up_area_sqft", "built_up_area_sqm", "land_area_sqft", "land_area_sqm", "customer_age"]
COLUMNS = ["sales_id", *DATE_COLUMNS, *TEXT, *NUMBERS]
SCHEMA = (
    "sales_id long, contact_nric_masked string, project_country string, last_sales_status string, "
    "date_type string, "
    + ", ".join(f"{c} timestamp_ntz" for c in DATE_COLUMNS) + ", "
    + ", ".join(f"{c} string" for c in TEXT) + ", "
    + ", ".join(f"{c} double" for c in NUMBERS + PRICE_COLUMNS)
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


def make_sales(n=260, seed=11):
    """Attribute and price rows per sale, some filtered out by country, status or view."""
    rng = random.Random(seed)
    pick = rng.choice
    out = []
    for i in range(n):
        sold = dt.datetime(2001, 1, 1) + dt.timedelta(days=rng.randrange(7600))
        row = {
            "sales_id": 1000 + i,
            "contact_nric_masked": pick([f"C{rng.randrange(60):03d}"] * 20 + [None]),
            "project_country": pick(["Malaysia"] * 12 + ["Vietnam"]),
            "last_sales_status": pick(["Sold"] * 12 + ["Cancelled"]),
            "spa_date": sold, "spa_stamp_date": sold + dt.timedelta(days=3),
            "buyer_dob": pick([None, dt.datetime(1950 + rng.randrange(70), 5, 1)]),
            "project_name": pick(["HILLS", "BOTANIC", "PARK", None]), "phase": pick(["1A", "2B", "3C"]),
            "phase_property_type": pick(["Landed", "High Rise", "Commercial", "RSKU", "Industrial"] * 6 + [None]),
            "build_type": pick(["Bungalow", " terrace", "SHOP", "Condo"] * 8 + [None]),
            "financier1_name": pick([None, "Big Bank", "Small Bank"]),
            "is_cash_buyer": pick(["Cash", "Loan", " loan"] * 9 + [None]),
            "customer_gender": pick(["Male", "Female", "Undefined", " others ", "-"]),
            "contact_gender": pick(["Male", "Female", "Not Applicable", "-", "-"]),
            "customer_marital_status": pick(["Single", "Married", "Other", "Undefined", "-"]),
            "contact_marital_status": pick(["Single", "Married", "-", "Not Applicable"]),
            "customer_race": pick(["Chinese", "Malay", "N/A", "Others", "undefined", None]),
            "contact_race": pick(["Indian", "Others", "Undefined", None]),
            "customer_race_group": pick(["Bumi", "others", None]),
            "customer_nationality": pick(["Malaysia", "malaysia ", "China", "Undefined", "Others"]),
            "contact_nationality": pick(["Malaysia", "Japan", "-", "others", "Undefined"]),
            "customer_bumi_status": pick(["Bumi", "Non-Bumi"] * 12 + [None]),
            "contact_nric": pick([f"90{rng.randrange(1000):04d}", "AB12X", None]),
            "contact_identification_type": pick(["NRIC No.", "Passport", "Reg No", "Reg No.", "Undefined", "Others", "Army", None]),
            "contact_purchaser_type": pick(["Individual", "Corporate", "Undefined", None]),
            "contact_salutation": pick(["Mr", "Dato", "Undefined", "-", "Others", None]),
            "contact_occupation": pick([" Engineer", "Doctor "] * 12 + [None]),
            "contact_city": pick(["Klang", " ipoh", "Rawang"] * 9 + [None]),
            "contact_staff": pick(["Undefined", "Staff"] * 12 + [None]),
            "contact_lifestyle_registration_status": pick(["Undefined", "Registered", None]),
            "contact_annual_income": pick(["Rm1", "Rm2", "Rm3", "-", "Undefined", "Not Applicable", None]),
            "built_up_area_sqft": pick([None, 0.0, 60.0, 190.0, 240.0, 1000.0, 1800.0, 5000.0]),
            "built_up_area_sqm": pick([None, 0.0, 80.0, 120.0, 1200.0]),
            "land_area_sqft": pick([None, 0.0, 900.0, 1100.0]),
            "land_area_sqm": pick([None, 1400.0, 1600.0]),
            "customer_age": pick([None, 0.0, -4.0, 25.0, 37.0, 61.0]),
        }
        prices = {c: pick([None, 0.0, rng.randrange(100, 900) * 1000.0]) for c in PRICE_COLUMNS}
        for view in pick([["spa_date_type", "spa_month_type"]] * 14 + [["spa_date_type"]]):
            part = prices if view == "spa_month_type" else {}
            full = {**row, **part, "date_type": view}
            out.append(tuple(full.get(c) for c in NAMES))
    return out


MAPPINGS = {
    "salutation": [("MR", "MALE"), ("MS", "FEMALE"), (" dato", "TITLED"), ("NOT APPLICABLE", "NONE")],
    "nationality": [("MALAYSIA", "LOCAL"), ("CHINA", "FOREIGN"), ("OTHERS", "OTHERS")],
    "occupation": [("ENGINEER", "KNOWN"), ("DOCTOR", "KNOWN")],
    "financier": [("CASH", "CASH"), ("BIG BANK", "BIG")],
    "race": [("CHINESE", "CHINESE"), ("MALAY", "BUMI"), ("OTHERS", "OTHERS")],
    "city": [("KLANG", "KLANG"), ("IPOH", "IPOH"), ("PENANG", "PENANG")],
    "annual_income": [("RM1", "LOW"), ("RM2", "HIGH")],
}
RANGES = [
    ("HILLS", "1A", "Bungalow", 900.0, 1500.0, 1200.0, 83.6, 139.4),
    ("HILLS", "2B", "Terrace", 1700.0, 1900.0, None, 157.9, 176.5),
    ("BOTANIC", "1A", " shop", 150.0, 210.0, 0.0, 13.9, 19.5),
]
OVERRIDES = {
    "id_type": [(1000 + i, v) for i, v in ((3, "NRIC No."), (9, "Reg No."), (14, "Passport"), (30, "NRIC No."))]
    + [(1000 + i, "NRIC No.") for i in range(50, 120, 3)],
    "nationality": [(1000 + i, "Korea") for i in range(0, 200, 7)],
    "city": [(1000 + i, "Penang") for i in range(0, 200, 11)],
}
RANGE_SCHEMA = (
    "project_name string, phase string, build_type string, min_area_transformed_to_sqft double, "
    "max_area_transformed_to_sqft double, mean_sqft double, min_area_transformed_to_sqm double, "
    "max_area_transformed_to_sqm double"
)


def make_lookups(spark):
    make = spark.createDataFrame
    return Lookups(
        id_type=make(OVERRIDES["id_type"], "sales_id long, derived_id_type string"),
        nationality=make(OVERRIDES["nationality"], "sales_id long, derived_nationality string"),
        city=make(OVERRIDES["city"], "sales_id long, derived_contact_city string"),
        area_range=make(RANGES, RANGE_SCHEMA),
        mappings={
            n: make([(k, k, 1.0, v) for k, v in rows], "raw string, clean string, count double, map string")
            for n, rows in MAPPINGS.items()
        },
    )


def text(v):
    return v.strip().upper() if v is not None else None


def mode(values):
    counts = Counter(v for v in values if v is not None)
    return min(counts, key=lambda v: (-counts[v], v)) if counts else None


def mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def plain_clean(rows):
    """(clean rows, Counter of rows dropped per column), rule by rule over lists."""
    rows, dropped = [dict(r) for r in rows], Counter()

    def step(column, rule):
        nonlocal rows
        for r in rows:
            r[column] = rule(r)
        kept = [r for r in rows if r[column] is not None]
        if len(kept) < len(rows):
            dropped[column] += len(rows) - len(kept)
        rows = kept

    over = {k: dict(v) for k, v in OVERRIDES.items()}
    id_col = "derived_contact_identification_type"

    def id_type(r):
        raw = r["contact_identification_type"]
        v = text(over["id_type"].get(r["sales_id"]) if raw == "Undefined" else raw)
        if v in (None, "OTHERS"):
            if r["contact_purchaser_type"] == "Corporate":
                v = "REG NO."
            elif r["contact_purchaser_type"] in ("Individual", "Undefined"):
                v = "NRIC NO." if text(r["customer_nationality"]) == "MALAYSIA" else "PASSPORT"
        return "REG NO." if v == "REG NO" else v

    step(id_col, id_type)
    company = lambda r: r[id_col] == "REG NO."
    person = lambda r: r[id_col] in ("NRIC NO.", "PASSPORT")
    step("derived_bumi_status", lambda r: r["customer_bumi_status"] and r["customer_bumi_status"].upper())

    common = mode(r["customer_gender"] for r in rows).upper()

    def gender(r):
        if company(r):
            return "NOT APPLICABLE"
        if person(r):
            for v in (r["customer_gender"], r["contact_gender"]):
                if text(v) not in (None, "UNDEFINED", "NOT APPLICABLE", "OTHERS", "-"):
                    return v.upper()
            if (r["contact_nric"] or "x")[-1] in "0123456789":
                return ("FEMALE", "MALE")[int(r["contact_nric"][-1]) % 2]
        return common

    step("derived_gender", gender)
    married = mode(r["customer_marital_status"] for r in rows).upper()

    def marital(r):
        if company(r):
            return "NOT APPLICABLE"
        if person(r):
            for v in (r["customer_marital_status"], r["contact_marital_status"]):
                if text(v) not in (None, "UNDEFINED", "NOT APPLICABLE", "OTHER", "-"):
                    return v.upper()
        return married

    step("derived_marital_status", marital)

    def salutation(r):
        if company(r):
            return "NOT APPLICABLE"
        if r["contact_salutation"] in ("Not Applicable", "Undefined", "Others", "-", None) and person(r):
            if r["derived_gender"] in ("MALE", "FEMALE"):
                return {"MALE": "MR", "FEMALE": "MS"}[r["derived_gender"]]
        return (r["contact_salutation"] or "nan").upper()

    step("derived_contact_salutation", salutation)
    step(
        "derived_contact_purchaser_type",
        lambda r: "INDIVIDUAL" if person(r) else "CORPORATE" if company(r) else None,
    )

    def nationality(r):
        v = r["customer_nationality"]
        if text(v) in ("UNDEFINED", "OTHERS") and text(r["contact_nationality"]) not in ("UNDEFINED", "OTHERS", "-"):
            v = r["contact_nationality"]
        if text(v) in ("UNDEFINED", "OTHERS"):
            v = over["nationality"].get(r["sales_id"])
        return v or "OTHERS"

    step("derived_nationality", nationality)
    age_mean = mean(r["customer_age"] for r in rows if not company(r))

    def age(r):
        if company(r):
            return -1.0
        v = r["customer_age"]
        if r["buyer_dob"] is not None:
            v = float(r["spa_date"].year - r["buyer_dob"].year)
        return age_mean if v is None or v <= 0 else v

    step("derived_age", age)
    step("derived_contact_occupation", lambda r: text(r["contact_occupation"]))
    step(
        "derived_is_cash_buyer",
        lambda r: "CASH" if r["financier1_name"] is None and text(r["is_cash_buyer"]) == "LOAN"
        else r["is_cash_buyer"] and r["is_cash_buyer"].upper(),
    )

    def race(r):
        if company(r):
            return "NOT APPLICABLE"
        vague = ("N/A", "OTHERS", "UNDEFINED")
        for v in (r["customer_race"], r["contact_race"], r["customer_race_group"]):
            if v is None:
                break
            if text(v) not in vague:
                return v.upper()
        return "OTHERS"

    step("derived_race", race)
    step("derived_contact_city", lambda r: text(over["city"].get(r["sales_id"], r["contact_city"])))

    def status(column, instead, fill):
        def rule(r):
            if company(r):
                return "NOT APPLICABLE"
            v = instead if r[column] == "Undefined" else r[column]
            v = instead if v is None and fill else v
            return v.upper() if v is not None else None

        return rule

    step("derived_contact_staff", status("contact_staff", "Not Staff", False))
    life = "contact_lifestyle_registration_status"
    step(f"derived_{life}", status(life, "Non-Registered", True))
    income = mode(r["contact_annual_income"] for r in rows)
    step(
        "derived_contact_annual_income",
        lambda r: (income if r["contact_annual_income"] in (None, "Not Applicable", "Undefined", "-")
                   else r["contact_annual_income"]).upper(),
    )

    limits = {(p, ph, text(b)): rest for p, ph, b, *rest in RANGES}
    found = lambda r: limits.get((r["project_name"], r["phase"], text(r["build_type"])))

    def ranged(r):
        low, high, avg, low_m, high_m = found(r)
        s, m = r["built_up_area_sqft"] or 0, r["built_up_area_sqm"] or 0
        if s > 0:
            return s if low * 0.8 <= s <= high * 1.2 else s * 0.092903
        if m > 0:
            return m * 10.7639 if low_m * 0.8 <= m <= high_m * 1.2 else m
        return avg if avg else None

    groups = {}
    for r in rows:
        if found(r):
            groups.setdefault(text(r["build_type"]), []).append(ranged(r))
    means = {k: mean(v) for k, v in groups.items()}

    def area(r):
        avg = means.get(text(r["build_type"]))
        s, m = r["built_up_area_sqft"] or 0, r["built_up_area_sqm"] or 0
        ls, lm = r["land_area_sqft"] or 0, r["land_area_sqm"] or 0
        if found(r):
            v = ranged(r)
        elif avg is not None:
            v = avg
        elif s >= 250:
            v = s
        elif m > 0:
            v = m * 10.7639 if m <= 1000 else m
        elif ls > 0:
            v = ls if ls >= 1000 else ls * 10.7639
        elif lm > 0:
            v = lm if lm >= 1500 else lm * 0.092903
        else:
            v = None
        if not v and avg is not None:
            v = avg
        if v is not None and 0 < v < 200:
            v = avg if avg is not None else v * 10.7639
        return v

    step("derived_built_up_area_sqft", area)
    step("derived_build_type", lambda r: r["build_type"] and r["build_type"].upper())
    step("derived_phase_property_type", lambda r: r["phase_property_type"] and r["phase_property_type"].upper())
    step(
        "derived_financier_name",
        lambda r: "CASH" if r["derived_is_cash_buyer"] == "CASH" else (r["financier1_name"] or "NOT APPLICABLE").upper(),
    )
    return rows, dropped
