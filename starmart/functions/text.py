"""Text helpers: localised names and folded terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

LOCALES = ("es_ES", "es_419", "en_US")

# Accented letters of the business vocabulary and their plain forms.
ACCENTED = "áéíóúüñ"
PLAIN = "aeiouun"


def txt(value: Column | str, locales: Sequence[str] = LOCALES) -> Column:
    """Display text of a translatable field.

    The field is either a JSON object keyed by locale or, in older sources, plain text.
    The first locale that is present wins; otherwise the stored value is returned as is.
    """
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(*[F.get_json_object(column, f"$.{loc}") for loc in locales], column)


def fold(value: Column | str) -> Column:
    """Lower case without Spanish accents, for matching what people type."""
    column = F.col(value) if isinstance(value, str) else value
    return F.translate(F.lower(F.trim(column)), ACCENTED, PLAIN)


def fold_text(value: str) -> str:
    """Driver-side twin of :func:`fold`, for looking a term up in the vocabulary."""
    return value.strip().lower().translate(str.maketrans(ACCENTED, PLAIN))


def register_txt(spark: SparkSession, locales: Sequence[str] = LOCALES) -> None:
    """Make ``txt`` callable from SQL."""
    tries = ", ".join(f"get_json_object(v, '$.{loc}')" for loc in locales)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION txt(v STRING) RETURNS STRING "
        "COMMENT 'Texto legible de un campo traducible, o el valor tal cual' "
        f"RETURN coalesce({tries}, v)"
    )
