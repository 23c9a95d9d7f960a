"""Parameters of the registered queries (the provided tables hold no Portuguese text)."""

from __future__ import annotations

from topicpulse.config import Config

RUN_DAY = "2024-01-30"

# Function words of the four languages in the documents table.
DOCUMENT_STOPWORDS = frozenset(
    "the and of that for with was are this from les des est une que pour dans sur avec qui "
    "der die das und ist von ein eine den los las del por con para una".split())

DOCUMENT_THEMES = {
    "política": ("keiten", "ndorea"),
    "economia": ("mentelle", "blewh"),
    "esporte": ("time", "thtion"),
    "saúde": ("sus", "ereaer"),
    "tecnologia": ("ouvi", "inghe"),
}
EVENT_THEMES = {
    "política": ("k1",),
    "economia": ("k2", "k30"),
    "esporte": ("k4", "k14"),
    "saúde": ("k5", "k6"),
    "tecnologia": ("k7",),
}
POSITIVE_WORDS = ("the", "les", "der", "los", "with")
NEGATIVE_WORDS = ("and", "des", "die", "las", "from")

CONFIG = Config(custom_stopwords=DOCUMENT_STOPWORDS, themes=DOCUMENT_THEMES)
