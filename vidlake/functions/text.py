"""Title/description expressions shared by the analytic queries, the feature
job and batch scoring (one definition, so serving and training agree)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed day names, Sunday = 1 (Spark dayofweek numbering).
DAY_NAMES = {1: "Sunday", 2: "Monday", 3: "Tuesday", 4: "Wednesday",
             5: "Thursday", 6: "Friday", 7: "Saturday"}


def day_name(dow: Column, unknown: str | None = "Unknown") -> Column:
    """REC-9: day number -> name; other numbers -> ``unknown``."""
    m = F.create_map(*[x for k, v in DAY_NAMES.items() for x in (F.lit(k), F.lit(v))])
    name = F.try_element_at(m, dow)
    return name if unknown is None else F.coalesce(name, F.lit(unknown))


def has_question(title: Column) -> Column:
    return F.when(title.contains("?"), 1).otherwise(0)


def has_exclamation(title: Column) -> Column:
    return F.when(title.contains("!"), 1).otherwise(0)


def has_numbers(title: Column) -> Column:
    return F.when(title.rlike("[0-9]"), 1).otherwise(0)


def word_count(text: Column) -> Column:
    """Pieces between single spaces (empty pieces count)."""
    return F.size(F.split(text, " "))


def caps_ratio(title: Column) -> Column:
    return F.try_divide(F.length(F.regexp_replace(title, "[^A-Z]", "")), F.length(title))


def has_link(text: Column) -> Column:
    return F.when(text.rlike("https?://"), 1).otherwise(0)


def title_class(title: Column) -> Column:
    """Q9 classes, first match wins."""
    return (F.when(has_question(title) == 1, F.lit("Has Question"))
            .when(has_exclamation(title) == 1, F.lit("Has Exclamation"))
            .when(has_numbers(title) == 1, F.lit("Has Numbers"))
            .otherwise(F.lit("Standard")))
