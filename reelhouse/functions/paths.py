"""Column functions over object paths and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelhouse import specs


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_name(path: Column | str) -> Column:
    """Last part of a '/'-separated path."""
    return F.element_at(F.split(_col(path), "/"), -1)


def _dataset_alternation() -> str:
    return "|".join(specs.DATASETS)


def _separator_class() -> str:
    return "[" + "".join("\\-" if s == "-" else s for s in specs.NAME_SEPARATORS) + "]"


def dataset_pattern(require_csv: bool = True) -> str:
    """Regex over a lower-cased file name: the dataset is the whole stem or
    follows one of the separators at its end."""
    ext = r"\.csv" if require_csv else r"(?:\.csv)?"
    return rf"(?:^|{_separator_class()})({_dataset_alternation()}){ext}\z"


def infer_dataset(path: Column | str, strict: bool = False) -> Column:
    """Dataset of an export file name, or NULL when it names none.

    The name is lower-cased; it must end in ``.csv`` and its stem must be a
    dataset name or end with ``_``, ``-`` or space plus a dataset name. With
    ``strict`` the ``.csv`` ending is optional and an unknown name stops the
    job with an error instead of giving NULL.
    """
    low = F.lower(file_name(path))
    found = F.nullif(F.regexp_extract(low, dataset_pattern(not strict), 1), F.lit(""))
    if not strict:
        return found
    return F.coalesce(
        found,
        F.raise_error(
            F.concat(
                F.lit("No dataset can be told from the file name "),
                file_name(path),
                F.lit(f" (datasets: {', '.join(specs.DATASETS)})"),
            )
        ),
    )


def has_suffix(path: Column | str, suffix: str) -> Column:
    """Case-insensitive suffix test."""
    return F.lower(_col(path)).endswith(suffix.lower())
