"""Typed values out of JSON text, by one reader with one set of rules whatever a document's length.

Text is read strictly: names and texts in double quotes, no ``NaN`` or
``Infinity``, nothing after the document's end. If an object's name is
repeated, the last value counts; inside a record it makes the whole
document malformed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _end_mark(text: Column) -> Column:
    """What comes after the document to show where it ends; no text holds its own hash by chance."""
    return F.xxhash64(text).cast("string")


def parse_document(text: Column) -> Column:
    """The document as first element of an array, to be reached by ``$[0]``; NULL for malformed text.

    The array's second element is a mark. If it isn't there, the document's
    text closed the array before.
    """
    mark = _end_mark(text)
    both = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))
    ended = (F.try_variant_get(both, "$[1]", "string") == mark) & F.try_variant_get(both, "$[2]", "variant").isNull()
    return F.when(ended, both)


def with_members(df: DataFrame, text: str, field: str | None = None) -> tuple[DataFrame, Column]:
    """``df``, and the values of the array or object that its column ``text`` is, or that is its ``field``; NULL for anything else.

    Each value becomes a variant of its own, so a document may be longer than
    a variant. ``df`` gets the columns ``_array`` and ``_pairs``, which the values are taken
    from: a document is read once as the one and, only where it isn't that, once as the other.
    Inside one expression it would be read anew for each use.
    """
    column = F.col(text)
    mark = _end_mark(column)

    def read(kind: str, end: Column, shape: str) -> Column:
        document = F.concat(F.lit("["), column, F.lit(","), end, F.lit("]"))
        return F.from_json(document, f"array<{shape.format(kind)}>", _STRICT)

    def checked(both: Column, marked) -> Column:
        first, last = F.get(both, F.lit(0)), F.get(both, F.lit(1))
        return F.when((F.size(both) == 2) & (marked(last) == mark), first if field is None else first[field])

    array, pairs = F.col("_array"), F.col("_pairs")
    end = F.concat(F.lit('{"end":"'), mark, F.lit('"}'))
    if field is not None:
        shape = f"struct<`{field}`:{{}},end:string>"
        array_end, of_array, of_pairs = end, lambda last: last["end"], lambda last: last["end"]
    else:
        shape = "{}"
        array_end, of_array = F.concat(F.lit('["'), mark, F.lit('"]')), lambda last: variant_string(F.get(last, F.lit(0)), "$")
        of_pairs = lambda last: variant_string(last["end"], "$")
    df = df.withColumn("_array", read(_KINDS[0], array_end, shape))
    df = df.withColumn("_array", checked(array, of_array))
    df = df.withColumn("_pairs", F.when(array.isNull(), read(_KINDS[1], end, shape)))
    return df.withColumn("_pairs", checked(pairs, of_pairs)), F.coalesce(array, F.map_values(pairs))


_KINDS = ("array<variant>", "map<string,variant>")


def variant_bigint(value: Column, path: str) -> Column:
    """A whole number, rounding fractions half up and reading numeric strings."""
    return F.try_variant_get(value, path, "decimal(38,0)").cast("bigint")


def variant_double(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "double")


def variant_string(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")
