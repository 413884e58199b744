"""Readable labels for codes and measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label of each profile field; all others read "Unknown".
FIELD_LABELS = {
    "Pfp": "Profile Picture",
    "Display": "Display Name",
    "Bio": "Bio",
    "Url": "URL",
}

# Latency limits in milliseconds.
NEAR_REAL_TIME_MS = 1000
HIGH_LATENCY_MS = 5000


def field_label(kind: Column) -> Column:
    label = F.lit("Unknown")
    for name, text in FIELD_LABELS.items():
        label = F.when(kind == name, text).otherwise(label)
    return label


def latency_band(millis: Column) -> Column:
    return (
        F.when(millis > HIGH_LATENCY_MS, "high")
        .when(millis < NEAR_REAL_TIME_MS, "near real time")
        .otherwise("normal")
    )


def preview(text: Column, size: int = 100) -> Column:
    """First ``size`` characters, with dots when something was left out."""
    return F.when(
        F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("..."))
    ).otherwise(text)
