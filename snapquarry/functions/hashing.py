"""Ids and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nested import canonical_json
from .text import clean, fold


def record_id(prefix: str, **fields: Column) -> Column:
    """Prefix and 24 hex digits of the SHA-256 of the named fields; neither season nor text is among them."""
    return F.concat(F.lit(f"{prefix}:"), F.substring(F.sha2(canonical_json(fields), 256), 1, 24))


def definition_hash(title: Column, text: Column) -> Column:
    """Hash of title and text."""
    return F.sha2(F.to_json(F.array(title, text)), 256)


def fingerprint(text: Column) -> Column:
    """Hash of a text in one case and with single blanks; null stays null."""
    return F.sha2(fold(clean(text)), 256)


def integrity(content: Column) -> Column:
    """Integrity value of a file."""
    return F.concat(F.lit("sha384-"), F.base64(F.unhex(F.sha2(content, 384))))


def signature(**parts: Column) -> Column:
    """12 hex digits over the parts of a structure, which hold no text."""
    return F.substring(F.sha2(canonical_json(parts), 256), 1, 12)
