"""Projection and schema operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcorpus.functions import text as T

TEXT_SUFFIX = "_text"


def select_pair(df: DataFrame, src: str, tgt: str, src_name: str = "en",
                tgt_name: str = "target") -> DataFrame:
    """Keep two columns under the training names."""
    return df.select(F.col(src).alias(src_name), F.col(tgt).alias(tgt_name))


def tag_language(df: DataFrame, code: str, col: str = "language") -> DataFrame:
    """Constant language column."""
    return df.withColumn(col, F.lit(code))


def drop_keys(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop columns when present; absent names are ignored."""
    return df.drop(*list(cols))


def require_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Fail before any job runs when required columns are missing."""
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def ensure_columns(df: DataFrame, cols: Sequence[str], fill=None) -> DataFrame:
    """P5: add missing columns filled with NULL (CSV) or "" (merge)."""
    add = {c: F.lit(fill).cast("string") for c in cols if c not in df.columns}
    return df.withColumns(add) if add else df


def version_columns(df: DataFrame) -> list[str]:
    """Columns carrying one version's text."""
    return [c for c in df.columns if c.endswith(TEXT_SUFFIX)]


def to_long(df: DataFrame, keys: Sequence[str], versions: Sequence[str] | None = None,
            version_col: str = "version", text_col: str = "text",
            keep_empty: bool = False) -> DataFrame:
    """Wide row -> one row per (key, version) with stripped text, keeping
    non-empty texts only. ``versions`` are the text column names; the version
    value is the name without the ``_text`` suffix."""
    cols = list(versions) if versions is not None else version_columns(df)
    stacked = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c[:-len(TEXT_SUFFIX)] if c.endswith(TEXT_SUFFIX) else c).alias(version_col),
                 T.strip(F.col(c)).alias(text_col))
        for c in cols])).alias("_v")).select(*keys, "_v.*")
    if keep_empty:
        return stacked
    return stacked.where(F.col(text_col) != "")


def add_prompt(df: DataFrame, mode: str = "tag", en: str = "en", language: str = "language",
               col: str = "prompt", strip_text: bool = False,
               language_label: str = "Breton") -> DataFrame:
    """Instruction prefix for a text-to-text model.

    ``tag``: ``"translate English to <code>: " + en``; ``double``:
    ``"translate English to <label>: <code>: " + en``.
    """
    src = T.strip(F.col(en)) if strip_text else F.col(en)
    if mode == "tag":
        p = F.concat(F.lit("translate English to "), F.col(language), F.lit(": "), src)
    elif mode == "double":
        p = F.concat(F.lit(f"translate English to {language_label}: "), F.col(language),
                     F.lit(": "), src)
    else:
        raise ValueError(f"unknown prompt mode {mode!r}")
    return df.withColumn(col, p)


def to_nested(df: DataFrame, a: str = "br", b: str = "en", col: str = "translation") -> DataFrame:
    """``{"translation": {a: ..., b: ...}}``."""
    return df.select(F.struct(F.struct(F.col(a).alias(a), F.col(b).alias(b)).alias(col))
                     .alias("_n")).select("_n.*")


def with_chapter_url(df: DataFrame, version_id="version_id", abbr="abbr", chapter="chapter",
                     suffix="suffix", col: str = "url", on_null: str = "reject") -> DataFrame:
    """P10: chapter page URL; rows with a missing part are rejected (or raise)."""
    url = T.chapter_url(version_id, abbr, chapter, suffix)
    if on_null == "raise":
        return df.withColumn(col, F.coalesce(url, F.raise_error(F.lit("chapter url has a NULL part"))))
    return df.withColumn(col, url).where(F.col(col).isNotNull())


def wide_name(version: str) -> str:
    """Column name of a version's text."""
    return f"{version.lower()}{TEXT_SUFFIX}"


def non_empty_guard(df: DataFrame, on_empty: str = "raise") -> DataFrame | None:
    """C14: stop before writing or processing an empty table (``raise``), or
    return None so the caller skips the output (``skip``)."""
    if df.isEmpty():
        if on_empty == "raise":
            raise ValueError("input table is empty")
        return None
    return df
