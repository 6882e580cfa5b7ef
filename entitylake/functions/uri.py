"""Parts of the slash-separated URIs that carry the keys.

=====================================  ===========================================
``entities/<E>/crosswalks/<C>``        1 entity id, 3 crosswalk id
``configuration/sources/<S>``          2 source name
``entities/<E>/attributes/<A>/<id>``   1 entity id, 3 attribute name
``.../<A>/<id>/<Sub>/<sid>``           4 instance id, 5 sub-attribute name
=====================================  ===========================================
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENTITY, SOURCE, NAME, CROSSWALK, INSTANCE, SUB_NAME = 1, 2, 3, 3, 4, 5


def uri_part(uri: Column | str, index: int) -> Column:
    """The part at ``index``; NULL, not an error, when the URI has fewer parts."""
    column = F.col(uri) if isinstance(uri, str) else uri
    return F.get(F.split(column, "/"), F.lit(index))


def entity_id(uri: Column | str) -> Column:
    return uri_part(uri, ENTITY)


def source_name(uri: Column | str) -> Column:
    return uri_part(uri, SOURCE)


def crosswalk_id(uri: Column | str) -> Column:
    return uri_part(uri, CROSSWALK)


def attribute_name(uri: Column | str) -> Column:
    return uri_part(uri, NAME)


def instance_id(uri: Column | str) -> Column:
    return uri_part(uri, INSTANCE)


def sub_attribute_name(uri: Column | str) -> Column:
    return uri_part(uri, SUB_NAME)
