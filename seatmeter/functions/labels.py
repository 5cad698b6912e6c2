"""Tenant code labels and classifiers as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plan and premium codes. The vendor's own flagship plan and in-house premium pack
# carry neutral labels here ("Platform Protect", "In-house Pack"); the label lists are configuration.
PLAN_NAMES = {
    1: "Phishing Simulation and Training",
    2: "Starter",
    3: "Core",
    4: "Email Protect",
    5: "Complete Protect",
    6: "Platform Protect",
    7: "SAT Suite",
}
PREMIUM_NAMES = {1: "NINJIO", 3: "Habitu8", 4: "Cybermaniacs Videos", 5: "Wizer", 6: "In-house Pack"}
INTEGRATION_TYPES = {1: "EXCHANGE", 2: "GMAIL", 3: "OFFICE365", 4: "POWERSHELL"}
POC_DAYS = 30


def label(code: Column, names: dict, default: str) -> Column:
    """Code -> label, unknown codes fall back to the code's text, NULL to ``default``."""
    expr = None
    for k, v in names.items():
        expr = F.when(code == k, F.lit(v)) if expr is None else expr.when(code == k, F.lit(v))
    return expr.otherwise(F.coalesce(code.cast("string"), F.lit(default)))


def billing_status(plan: Column, trial: Column, plan_expiry: Column, trial_expiry: Column,
                   registered: Column, roundup: Column) -> Column:
    """POC -> Active-POC -> Inactive-POC -> Active -> Inactive, first match wins."""
    trial_live = trial.isNotNull() & (F.to_date(trial_expiry) >= F.to_date(roundup))
    age = F.datediff(F.to_date(roundup), F.to_date(registered))
    return (F.when(trial_live & (age < POC_DAYS), "POC")
            .when(trial_live & (age >= POC_DAYS) & plan.isNotNull(), "Active-POC")
            .when(trial_live & (age >= POC_DAYS) & plan.isNull(), "Inactive-POC")
            .when(plan.isNotNull() & (F.to_date(plan_expiry) >= F.to_date(roundup)), "Active")
            .otherwise("Inactive"))


def integration(server_type: Column, enabled: Column) -> tuple[Column, Column]:
    """(flag, type) from the server-side code and the webhook flag."""
    off = (server_type == 0) & ((enabled == F.lit(False)) | enabled.isNull())
    flag = F.when(off, F.lit(False)).otherwise(F.lit(True))
    kind = F.when((server_type == 0) & (enabled == F.lit(True)), "GMAIL").when(server_type == 0, "NONE")
    for k, v in INTEGRATION_TYPES.items():
        kind = kind.when(server_type == k, v)
    return flag, kind


def days(n) -> dt.timedelta:
    return dt.timedelta(days=n)
