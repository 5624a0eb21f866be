"""Ids that follow from names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The namespace of ids of postings.
POSTINGS = uuid.uuid5(uuid.NAMESPACE_URL, "urn:hiretide:postings")


def name_uuid(namespace: uuid.UUID, name: Column) -> Column:
    """The version 5 UUID of a text in a namespace, as text; null for null."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), name.cast("binary")))
    # Version and variant stand in two of the digits: 5, and one of 8, 9, a and b.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    parts = (F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.lit("5"), F.substring(digest, 14, 3), variant,
             F.substring(digest, 18, 3), F.substring(digest, 21, 12))
    marks = ("", "-", "-", "", "-", "", "-")
    return F.concat(*(x for mark, part in zip(marks, parts) for x in (F.lit(mark), part)))
