"""Tiny claims tables for unit tests: only the columns a test cares about."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from claimscope.schema import TABLE_NAMES, TABLES
from claimscope.sources.tables import ClaimsTables, conform

DX_FLAGS = {"is_diabetes_flag": True, "is_htn_flag": False, "is_hf_flag": False}


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def tables(spark: SparkSession, **given: list[dict]) -> ClaimsTables:
    """ClaimsTables from lists of dicts; unspecified tables are empty, missing columns NULL."""
    frames = {}
    for name in TABLE_NAMES:
        rows = given.get(name, [])
        schema = TABLES[name].struct
        if rows:
            full = [{c: r.get(c) for c in schema.names} for r in rows]
            df = spark.createDataFrame([tuple(r[c] for c in schema.names) for r in full], schema)
        else:
            df = spark.createDataFrame([], schema)
        frames[name] = conform(df, name)
    return ClaimsTables(frames)


def basic_dims() -> dict[str, list[dict]]:
    return {
        "diagnosis_dim": [
            {"icd10": "E11.9", "is_diabetes_flag": True},
            {"icd10": "I10", "is_diabetes_flag": False},
        ],
        "drug_dim": [
            {"ndc": "00000000001", "therapeutic_class": "Antidiabetic", "is_antidiabetic_flag": True},
            {"ndc": "00000000002", "therapeutic_class": "Insulin", "is_antidiabetic_flag": True},
            {"ndc": "00000000009", "therapeutic_class": "Statin", "is_antidiabetic_flag": False},
        ],
    }
