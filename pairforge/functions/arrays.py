"""Array, JSON, hash and vector functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_list(a: Column) -> Column:
    """Trimmed non-blank elements; null is the empty list."""
    return F.filter(F.transform(F.coalesce(a, F.array().cast("array<string>")), lambda x: F.trim(F.coalesce(x, F.lit("")))), lambda x: x != "")


def exactly_three(a: Column) -> Column:
    return F.slice(F.concat(to_list(a), F.array_repeat(F.lit(""), 3)), 1, 3)


def parse_json_list(c: Column) -> Column:
    return to_list(F.from_json(c, "array<string>"))


def strip_fence(c: Column) -> Column:
    """JSON text without the code fence around it."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s*(```[a-zA-Z]*)?\s*|\s*(```)?\s*$", "")


def jaccard(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def mapped(a: Column, table: dict[str, str]) -> Column:
    """Each element's entry in ``table``, itself where there is none; duplicates go."""
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.array_distinct(F.transform(a, lambda t: F.coalesce(F.try_element_at(m, t), t)))


def expanded(a: Column, table: dict[str, list[str]]) -> Column:
    """The elements and, one step only, the terms ``table`` lists under them."""
    m = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    more = F.flatten(F.transform(a, lambda t: F.coalesce(F.try_element_at(m, t), F.array().cast("array<string>"))))
    return F.array_distinct(F.concat(a, more))


def overlaps(a: Column, terms: list[str]) -> Column:
    return F.arrays_overlap(a, F.array(*map(F.lit, terms)))


def literal(values: list, kind: str) -> Column:
    """A constant array of numbers, folded once when the plan is made; short to build however many there are."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    return F.transform(a, lambda x: x / F.greatest(norm(a), F.lit(1e-12)))


def half_up(c: Column, digits: int = 3) -> Column:
    """Rounded half up; a half that float noise has put just below counts as one."""
    return F.round(c + 1e-9, digits)


def clamp(c: Column, low: float = 0.0, high: float = 1.0, digits: int = 3) -> Column:
    return F.round(F.least(F.greatest(c, F.lit(low)), F.lit(high)), digits)


def agreement(c: Column) -> tuple[Column, Column]:
    """k and n of a vote count written ``k/n``; null where it is not one."""
    parts = F.split(F.coalesce(c, F.lit("")), "/")
    return F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("int")


def rotating(items: list[str], index: Column) -> Column:
    """The items in turn, by an index from 0."""
    return F.element_at(F.array(*map(F.lit, items)), (F.pmod(index, F.lit(len(items))) + 1).cast("int"))


def rubric_version(*parts: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("", *parts).cast("binary")), 1, 8)
