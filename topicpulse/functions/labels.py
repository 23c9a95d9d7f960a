"""Sentiment labels, buckets and the small display rules of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels, their display names, and the limits used by the reports.
LABELS = ("NEG", "NEU", "POS")
DISPLAY = {"POS": "Positivo", "NEG": "Negativo", "NEU": "Neutro"}
MOOD_LIMIT = 0.1
SHARE_LIMIT = 0.05
HOT_FREQUENCY = 5
HOT_Z = 2
POINT_SCALE = 3


def signed_score(label: Column, score: Column) -> Column:
    return F.when(label == "POS", score).when(label == "NEG", -score).otherwise(F.lit(0.0))


def mood(mean: Column) -> Column:
    """Positive above 0.1, negative below -0.1, neutral otherwise and for NULL."""
    return (F.when(mean > MOOD_LIMIT, "positivo").when(mean < -MOOD_LIMIT, "negativo")
            .otherwise("neutro"))


def label_name(label: Column) -> Column:
    """Display name; unknown labels pass through."""
    out = label
    for key, name in DISPLAY.items():
        out = F.when(label == key, name).otherwise(out)
    return out


def percent_text(share: Column) -> Column:
    """Whole percent, blank for shares of 5 % or less."""
    return F.when(share > SHARE_LIMIT, F.format_string("%.0f%%", F.bround(share * 100, 0))).otherwise("")


def row_class(emergente: Column, label: Column) -> Column:
    return (F.when(F.coalesce(emergente, F.lit(False)), "emergente")
            .when(label == "POS", "positivo").when(label == "NEG", "negativo")
            .otherwise("normal"))


def hot_zone(frequencia: Column, z_score: Column) -> Column:
    return F.coalesce((frequencia >= HOT_FREQUENCY) & (z_score >= HOT_Z), F.lit(False))


def predominant(n_neg: Column, n_neu: Column, n_pos: Column) -> Column:
    """Most frequent label; ties go to the first label in alphabetical order."""
    top = F.greatest(n_neg, n_neu, n_pos)
    return F.when(n_neg == top, "NEG").when(n_neu == top, "NEU").otherwise("POS")
