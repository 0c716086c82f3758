"""Text forms of numbers, items, rules and days."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from basketlab.functions.labels import DAY_NAMES, UNKNOWN_DAY_PREFIX


def percent_text(part: Column, whole: Column) -> Column:
    """``part`` as a share of ``whole`` in the form ``12.34%``; null when ``whole`` is 0."""
    share = part * F.lit(100.0) / F.when(whole != 0, whole)
    return F.when(share.isNotNull(), F.format_string("%.2f%%", share))


def thousands(number: Column) -> Column:
    """Whole number with ``.`` between groups of three digits."""
    return F.translate(F.format_number(number, 0), ",", ".")


def day_name(dow: Column) -> Column:
    """Name of the day 0..6 (0 = Sunday); other numbers keep a generic label."""
    names = F.create_map(*[F.lit(v) for pair in DAY_NAMES.items() for v in pair])
    return F.coalesce(
        F.try_element_at(names, dow.cast("int")),
        F.concat(F.lit(UNKNOWN_DAY_PREFIX), dow.cast("string")),
    )


def itemset_label(items: Column) -> Column:
    return F.array_join(items, " + ")


def rule_label(antecedent: Column, consequent: Column) -> Column:
    return F.concat(F.array_join(antecedent, ", "), F.lit(" → "), F.array_join(consequent, ", "))


def mentions(items: Column, keyword: str) -> Column:
    """Case-insensitive substring search in the space-joined items."""
    return F.lower(F.array_join(items, " ")).contains(keyword.strip().lower())


def same_items(left: Column, right: Column) -> Column:
    """Equality of two item arrays as sets."""
    return F.array_sort(left) == F.array_sort(right)


def default_name(name: Column, key: Column, prefix: str) -> Column:
    return F.coalesce(name, F.concat(F.lit(prefix), key.cast("string")))
