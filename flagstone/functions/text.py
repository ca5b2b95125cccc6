"""Small text columns: display ids, object keys, class labels from paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flagstone.config import CATEGORIES
from flagstone.functions.features import UNKNOWN


def short_id(column: Column, length: int = 16) -> Column:
    return F.substring(column.cast("string"), 1, length)


def display_id(image_id: Column, comment_id: Column, flag_id: Column) -> Column:
    """First eight characters of the first id present, else `N/A`."""
    return F.substring(F.coalesce(image_id, comment_id, flag_id, F.lit("N/A")), 1, 8)


def object_key(upload_id: Column, filename: Column) -> Column:
    """Upload id plus the file's last extension."""
    return F.concat_ws(".", upload_id, F.element_at(F.split(filename, "[.]"), -1))


def object_url(endpoint: Column, bucket: Column, key: Column) -> Column:
    return F.concat_ws("/", endpoint, bucket, key)


def category_from_path(path: Column) -> Column:
    """Class name from a parent folder `class_<index>`; `Unknown` if there is none."""
    index = F.regexp_extract(path, r"(?:^|/)class_(\d+)(?:_[^/]*)?/[^/]*$", 1).try_cast("int")
    names = F.array(*[F.lit(c) for c in CATEGORIES])
    return F.coalesce(F.try_element_at(names, index + 1), F.lit(UNKNOWN))
