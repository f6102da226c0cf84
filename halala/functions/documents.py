"""Reading JSON documents held in text columns.

Two readers, by need. VARIANT keeps numbers exact (`from_json` to text passes them through a
double and would cut a 20-digit price), so documents with prices as JSON numbers use it.
`text_members` has no document size limit and suits documents whose leaves are text anyway.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halala.functions.casts import as_column


def document(text: Column | str) -> Column:
    """Parsed document; malformed JSON raises."""
    return F.parse_json(as_column(text))


def _path(keys: Sequence[str]) -> str:
    return "$" + "".join("['" + key.replace("'", "\\'") + "']" for key in keys)


def node_at(doc: Column | str, *keys: str) -> Column:
    """Subtree at a path, still a document; NULL when missing."""
    return F.try_variant_get(as_column(doc), _path(keys), "variant")


def text_at(doc: Column | str, *keys: str) -> Column:
    """Text of the value at a path; NULL when missing or JSON null."""
    return F.try_variant_get(as_column(doc), _path(keys), "string")


def members(doc: Column | str) -> Column:
    """Document object as map of member name to member text; NULL when not an object."""
    return as_column(doc).try_cast("map<string,string>")


def text_members(text: Column | str) -> Column:
    """JSON text of an object as map of member name to member text; nested members stay JSON.

    Malformed text raises.
    """
    return F.from_json(as_column(text), "map<string,string>", {"mode": "FAILFAST"})


def explode_members(df: DataFrame, member_map: Column, key: str, value: str) -> DataFrame:
    """One row per member; rows with no member drop out."""
    return df.select("*", F.explode(member_map).alias(key, value))


def one_object(text: Column | str) -> Column:
    """True when the text is exactly one JSON object; anything malformed raises."""
    wrapped = F.concat(F.lit("["), as_column(text), F.lit("]"))
    found = F.from_json(wrapped, "array<map<string,string>>", {"mode": "FAILFAST"})
    return (F.size(found) == 1) & F.get(found, 0).isNotNull()
