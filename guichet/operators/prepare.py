"""Cleaning and projection of ticket tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from ..schema import BALANCED_COLUMNS, URGENCY_ALIASES


def clean_text_columns(df: DataFrame, columns: Sequence[str] = ("texte", "titre")) -> DataFrame:
    """Null text becomes the empty string."""
    return df.withColumns({c: T.text_or_empty(c) for c in columns})


def add_full_text(df: DataFrame, titre: str = "titre", texte: str = "texte", out: str = "text_full") -> DataFrame:
    return df.withColumn(out, T.full_text(titre, texte))


def add_word_count(df: DataFrame, text: str = "text_full", out: str = "nb_mots") -> DataFrame:
    return df.withColumn(out, T.word_count(text))


def normalize_values(df: DataFrame, column: str = "urgence", aliases: Mapping[str, str] = URGENCY_ALIASES) -> DataFrame:
    return df.replace(dict(aliases), subset=[column])


def normalization_count(df: DataFrame, column: str = "urgence", aliases: Mapping[str, str] = URGENCY_ALIASES) -> DataFrame:
    """How many rows :func:`normalize_values` rewrites."""
    return df.agg(F.count_if(F.col(column).isin(list(aliases))).alias("n_replaced"), F.count("*").alias("n_rows"))


def select_columns(df: DataFrame, columns: Sequence[str] = tuple(BALANCED_COLUMNS)) -> DataFrame:
    """The given columns in the given order, everything else dropped."""
    return df.select(*columns)


def clean_tickets(df: DataFrame) -> DataFrame:
    """Null text filled, ``text_full`` built, urgency spelling unified."""
    return normalize_values(add_full_text(clean_text_columns(df)))


def keep_value(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(F.col(column) == value)


def clamp_non_negative(c: Column | str) -> Column:
    return F.greatest(T.as_col(c), F.lit(0.0))


def with_errors(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Signed and absolute error of a numeric prediction."""
    return df.withColumns({"error": F.col(predicted) - F.col(actual), "abs_error": F.abs(F.col(predicted) - F.col(actual))})


def render_chunk() -> Column:
    """A ticket as the text that is indexed. The layout is fixed."""
    return F.concat(
        F.lit("Ticket ID: "), T.text_or_empty("ID"),
        F.lit("\nTitre: "), T.text_or_empty("titre"),
        F.lit("\nCatégorie: "), T.text_or_empty("categorie"),
        F.lit("\nUrgence: "), T.text_or_empty("urgence"),
        F.lit("\nType: "), T.text_or_empty("type_ticket"),
        F.lit("\nTemps de résolution: "), T.text_or_empty("temps_resolution"),
        F.lit(" heures\n\nTexte: "), T.text_or_empty("text_full"),
    )


def chunk_metadata() -> Column:
    return F.struct(F.col("ID").cast("string").alias("id"), "categorie", "urgence", "type_ticket")


def build_chunks(df: DataFrame, max_chunks: int | None = None) -> DataFrame:
    """``(id, chunk, metadata)`` per ticket; ``max_chunks`` keeps the first by ID."""
    if max_chunks is not None:
        df = df.orderBy("ID").limit(max_chunks)
    return df.select(F.col("ID").cast("string").alias("id"), render_chunk().alias("chunk"), chunk_metadata().alias("metadata"))
