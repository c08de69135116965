"""Language dictionaries."""

from __future__ import annotations

# Supported languages, names of bibliography sections, citation templates.
SUPPORTED = ("en", "it")
BIBLIOGRAPHY = {
    "en": (
        "bibliography",
        "references",
        "reference",
        "further reading",
        "notes",
        "sources",
        "footnotes",
        "citations",
        "publications",
        "publication history",
        "literature",
    ),
    "it": ("bibliografia",),
}
CITATION = {"en": ("Citation", "cite", "vcite")}


def check_language(language: str) -> str:
    if language not in SUPPORTED:
        raise ValueError(f"language must be one of {', '.join(SUPPORTED)}, not {language!r}")
    return language


def bibliography_terms(language: str) -> tuple[str, ...]:
    return BIBLIOGRAPHY[check_language(language)]


def citation_terms(language: str) -> tuple[str, ...]:
    if language not in CITATION:
        raise ValueError(f"no citation templates are known for language {language!r}")
    return CITATION[language]
