"""Column expressions on file paths."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    """Last segment of a path."""
    return F.substring_index(path, "/", -1)


def class_name(path: Column) -> Column:
    """Name of the folder a file lies in; empty when the path has no folder."""
    return F.regexp_extract(path, "([^/]*)/+[^/]*$", 1)


def plain_path(uri: Column) -> Column:
    """Percent-decoded path. A plus sign is a plain character in a file name."""
    return F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def file_path() -> Column:
    """Decoded path of the file a row comes from.

    It is a constant of the file, so a filter on it drops files when they are listed,
    before any of them is opened.
    """
    return plain_path(F.col("_metadata.file_path"))
