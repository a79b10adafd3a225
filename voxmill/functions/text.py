"""Scalar text functions as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxmill.config import Asr


def contains_script(text: Column, script: str = Asr.script) -> Column:
    """Whether a character of the class occurs (CJK ideographs by default)."""
    return F.coalesce(text.rlike(f"[{script}]"), F.lit(False))


def non_linguistic(text: Column) -> Column:
    """Only digits, white space and characters that are no word characters, by Unicode's classes."""
    return text.rlike(r"(?U)^[\d\s\W]+$")


def safe_filename(name: Column) -> Column:
    """Letters, digits, dot, underscore, blank and hyphen, trimmed."""
    return F.trim(F.regexp_replace(name, r"(?U)[^\p{L}\p{N}._\- ]", ""))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """Basename without its last extension."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def model_name(model: Column) -> Column:
    """Last path component without .ckpt."""
    return basename(F.replace(model, F.lit(".ckpt"), F.lit("")))


def encode_key(*parts: Column) -> Column:
    return F.concat_ws("|||", *parts)


def decode_key(key: Column) -> Column:
    """The two parts of a composite key; null if there aren't two."""
    parts = F.split(key, r"\|\|\|")
    return F.when(F.size(parts) == 2, parts)


def fill_prompt(prompt: str, text: Column) -> Column:
    return F.replace(F.lit(prompt), F.lit("{text}"), F.coalesce(text, F.lit("")))


def preview(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def stem_kind(name: Column) -> Column:
    """vocals, no_vocals or null by what a stem file's name contains."""
    low = F.lower(name)
    # fixed values: what names of stems hold
    rest = low.contains("instrumental") | low.contains("no_vocals") | low.contains("other") | low.contains("accompaniment")
    return F.when(rest, "no_vocals").when(low.contains("vocal"), "vocals")
