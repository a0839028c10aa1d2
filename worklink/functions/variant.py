"""Semi-structured values as variants (FN-08..FN-14, FN-35).

A document is parsed once per row; every field is then a path read on the
binary variant. Texts of numbers, booleans, objects and arrays are JSON style.
Expressions name their operand as few times as possible: hundreds of them
share one projection and have to fit into its generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from worklink.functions.text import TRUE_WORDS, clean_phone, clean_str, join_items, strip

# JSON texts of the values that count as absent in an `a or b` chain
FALSY = r'^(""|null|false|\[\]|\{\}|-?0(\.0+)?([eE][+-]?\d+)?)$'

# texts of such values; some texts that count as present read the same
FALSY_TEXT = r'^(|null|false|\[\]|\{\}|-?0(\.0+)?([eE][+-]?\d+)?)$'


def _step(key: str) -> str:
    return f".{key}" if key.isidentifier() else f'["{key}"]'


def get(v: Column, key: str) -> Column:
    """FN-10: the member of an object, null when there is none."""
    return F.try_variant_get(v, "$" + _step(key), "variant")


def get_text(v: Column, key: str) -> Column:
    """Text of an object's member; JSON null is null."""
    return F.try_variant_get(v, "$" + _step(key), "string")


def text_of(v: Column) -> Column:
    """Text of any variant; JSON null is null."""
    return F.try_variant_get(v, "$", "string")


def is_object(v: Column) -> Column:
    # reads at most one member, unlike schema_of_variant
    return F.try_variant_get(v, "$", "struct<_: variant>").isNotNull()


def is_text(v: Column) -> Column:
    return F.coalesce(F.to_json(v).startswith('"'), F.lit(False))


def parsed(c: Column) -> Column:
    """An array whose only element is the JSON object that a text holds; more elements if there is more in the text.

    The parser stops at the end of the first value, so the text is parsed as the one element of an
    array: whatever follows the object then breaks it.
    """
    text = F.when(c.startswith("{") & c.endswith("}"), c).otherwise(strip(c))
    return F.when(text.startswith("{") & text.endswith("}"), F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))))


def _alone(wrapped: Column) -> Column:
    return F.try_variant_get(wrapped, "$[1]", "variant").isNull()


def parse_obj(c: Column) -> Column:
    """FN-08: JSON object held by a text, null for anything else."""
    wrapped = parsed(c.cast("string"))
    return F.when(_alone(wrapped), F.try_variant_get(wrapped, "$[0]", "variant"))


def _struct(keys: dict[str, str]) -> str:
    return "struct<" + ", ".join(f"`{key}`: {kind}" for key, kind in keys.items()) + ">"


def members(v: Column, keys: dict[str, str]) -> Column:
    """FN-10: some members of an object as a struct, each as variant or as text; null for any other value."""
    return F.try_variant_get(v, "$", _struct(keys))


def members_of_parsed(wrapped: Column, keys: dict[str, str]) -> Column:
    """The same of an object that `parsed` gives."""
    return F.when(_alone(wrapped), F.try_variant_get(wrapped, "$[0]", _struct(keys)))


def as_obj(v: Column) -> Column:
    """FN-09: an object as it is, a text parsed once more, null otherwise.

    An array as JSON text starts with '[', so of all other values only a text
    can pass parse_obj.
    """
    return F.when(is_object(v), v).otherwise(parse_obj(text_of(v)))


def truthy(v: Column, text: Column | None = None) -> Column:
    """Whether a value counts as present in an `a or b` chain (FN-11).

    A text that was read before decides for most values; only where it reads like an absent one JSON style tells the
    kinds apart.
    """
    if text is None:
        return F.coalesce(~F.to_json(v).rlike(FALSY), F.lit(False))
    return F.when(text.rlike(FALSY_TEXT), ~F.to_json(v).rlike(FALSY)).otherwise(text.isNotNull())


def first_truthy(*values: Column) -> Column:
    """FN-11: first truthy operand, otherwise the last one."""
    *head, last = values
    return F.coalesce(*[F.when(truthy(v), v) for v in head], last)


def to_bool(v: Column, text: Column | None = None) -> Column:
    """FN-06: booleans kept, texts compared with the true words, others by truthiness."""
    read = text_of(v) if text is None else text
    # what reads like a true word is true as a text and by truthiness
    return F.when(F.lower(strip(read)).isin(TRUE_WORDS), F.lit(True)).when(read.isNotNull(), ~is_text(v) & truthy(v, text))


def to_list_text(v: Column) -> Column:
    """FN-07: items of a list joined by '|', a scalar as trimmed text."""
    return list_text(F.try_variant_get(v, "$", "array<string>"), text_of(v))


def list_text(items: Column, text: Column) -> Column:
    """FN-07 on the items of a list (null for a scalar) and its text."""
    return F.when(items.isNotNull(), join_items(items)).otherwise(clean_str(text))


def to_elements_text(v: Column) -> Column:
    """Every element of a list as text, joined; a plain text counts as its characters."""
    items = F.try_variant_get(v, "$", "array<string>")
    spelled = F.transform(items, lambda x: F.coalesce(x, F.lit("null")))
    return F.when(items.isNotNull(), join_items(spelled)).when(
        is_text(v), join_items(F.split(text_of(v), ""))
    )


def to_json_text(v: Column) -> Column:
    """FN-12: JSON text, null when the value is missing or JSON null."""
    return F.nullif(F.to_json(v), F.lit("null"))


def to_phone(v: Column, text: Column | None = None) -> Column:
    """FN-02 behind a truthiness guard."""
    return F.when(truthy(v, text), clean_phone(text_of(v) if text is None else text))


def name_or_text(v: Column, text: Column | None = None) -> Column:
    """FN-14: `name` of an object, a scalar as it is."""
    return F.when(is_object(v), get_text(v, "name")).otherwise(text_of(v) if text is None else text)


def text_field(v: Column) -> Column:
    """FN-35: a prediction field only when it is a text."""
    return F.when(is_text(v), text_of(v))
