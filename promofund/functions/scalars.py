"""Scalar helpers whose reference semantics differ from Spark's defaults
(I9–I26, N2). All are compositions of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def json_scalar(text_col, path: str) -> Column:
    """I26 ``JSON_VALUE``: the scalar at ``path`` as text; objects and arrays
    give NULL (``get_json_object`` would return them as JSON text). The value's
    JSON type decides, so a string that starts with a bracket stays."""
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(_col(text_col)), path, "variant"))
    v = F.get_json_object(_col(text_col), path)
    return F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(None).cast("string")).otherwise(v)


def safe_double(text_col) -> Column:
    """I24 ``SAFE_CAST(x AS FLOAT64)``: NULL instead of an error."""
    return _col(text_col).try_cast("double")


def strict_least(*cols) -> Column:
    """I19 ``LEAST`` that is NULL when any argument is NULL (Spark skips NULLs)."""
    cs = [_col(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


def safe_divide(a, b) -> Column:
    """I21 ``SAFE_DIVIDE``: NULL on a zero or NULL divisor."""
    return F.try_divide(_col(a), _col(b))


def text_to_bool(text_col) -> Column:
    """I25 ``CAST(text AS BOOL)`` accepting only 'true'/'false' (any case);
    Spark's cast also accepts '1', 'yes', ... which the reference rejects."""
    t = F.lower(F.trim(_col(text_col)))
    return F.when(t == "true", F.lit(True)).when(t == "false", F.lit(False))


def split_part_safe(text_col, sep: str, index: int) -> Column:
    """I10 ``SPLIT(x, sep)[SAFE_OFFSET(i)]``: NULL when the part is absent."""
    return F.get(F.split(_col(text_col), sep), index)


def array_to_string_strict(arr_col, sep: str) -> Column:
    """I14 ``ARRAY_TO_STRING``: NULL array -> NULL (NULL elements skipped)."""
    a = _col(arr_col)
    return F.when(a.isNull(), F.lit(None).cast("string")).otherwise(F.array_join(a, sep))


def size_or_null(arr_col) -> Column:
    """I15 ``ARRAY_LENGTH``: NULL for a NULL array (Spark's ``size`` gives -1
    with legacy settings)."""
    a = _col(arr_col)
    return F.when(a.isNull(), F.lit(None).cast("int")).otherwise(F.size(a))
