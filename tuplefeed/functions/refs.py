"""Column expressions for ``type:id`` references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_USER_TYPE = "user"
DEFAULT_OBJECT_TYPE = "object"


def _split(ref: Column, has_type: Column, default_type: str) -> tuple[Column, Column]:
    colon = F.instr(ref, ":")
    ref_type = F.when(has_type, F.substr(ref, F.lit(1), colon - 1)).otherwise(F.lit(default_type))
    ref_id = F.when(has_type, F.substr(ref, colon + 1)).otherwise(ref)
    return ref_type, ref_id


def split_user_ref(ref: Column) -> tuple[Column, Column]:
    """(type, id) of a user. A userset (with ``#``) keeps even an empty type before the colon."""
    colon = F.instr(ref, ":")
    has_type = (colon > 1) | ((colon == 1) & (F.instr(ref, "#") > 0))
    return _split(ref, has_type, DEFAULT_USER_TYPE)


def split_object_ref(ref: Column) -> tuple[Column, Column]:
    """(type, id) of an object."""
    return _split(ref, F.instr(ref, ":") > 1, DEFAULT_OBJECT_TYPE)


def join_ref(ref_type: Column, ref_id: Column) -> Column:
    """``type:id``, or the bare id when there is no type."""
    return F.when(ref_type != "", F.concat(ref_type, F.lit(":"), ref_id)).otherwise(ref_id)


def tuple_key(user: Column, relation: Column, object: Column) -> Column:
    """The three references and their parts as one struct."""
    user_type, user_id = split_user_ref(user)
    object_type, object_id = split_object_ref(object)
    return F.struct(
        user.alias("user"),
        user_type.alias("user_type"),
        user_id.alias("user_id"),
        relation.alias("relation"),
        object.alias("object"),
        object_type.alias("object_type"),
        object_id.alias("object_id"),
    )


def display(
    object_type: Column, object_id: Column, relation: Column, user_type: Column, user_id: Column
) -> Column:
    """``object_type:object_id#relation@user_type:user_id``."""
    return F.format_string("%s:%s#%s@%s:%s", object_type, object_id, relation, user_type, user_id)
