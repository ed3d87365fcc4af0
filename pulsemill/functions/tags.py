"""Tag map expressions. A tag set is compared by content, never by order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsemill.functions.text import blank, sanitize_name, sanitize_tag_value
from pulsemill.model import NO_VALUE

PAIR_MARK, ENTRY_MARK = "\u001e", "\u001f"


def canonical_tags(tags: Column, pair: str = PAIR_MARK, entry: str = ENTRY_MARK) -> Column:
    """One string per tag content, whatever the map's order. The default marks are control characters.

    A key without a value stands without the pair mark, apart from an empty value and from no key.
    """
    return F.array_join(
        F.transform(F.sort_array(F.map_entries(tags)), lambda e: F.concat(e["key"], F.coalesce(F.concat(F.lit(pair), e["value"]), F.lit("")))),
        entry,
    )


def from_canonical(canonical: Column) -> Column:
    """The tag map of a canonical string. Grouping by the string keeps maps out of aggregation buffers."""
    tags = F.str_to_map(canonical, F.lit(ENTRY_MARK), F.lit(PAIR_MARK))
    return F.when(canonical == "", empty_tags()).otherwise(tags)


def tags_text(tags: Column) -> Column:
    """Tags as ``k=v,k=v`` in key order, for reports."""
    return canonical_tags(tags, "=", ",")


def tags_suffix(tags: Column) -> Column:
    """Line-protocol suffix `` "k"="v"...`` of a tag map in key order; empty for no tags."""
    return F.coalesce(pairs_suffix(F.sort_array(F.map_entries(tags))), F.lit(""))


def pairs_suffix(pairs: Column) -> Column:
    """Line-protocol suffix of a list of (key, value) pairs; repeats and order survive."""
    return F.array_join(
        F.transform(
            pairs,
            lambda e: F.concat(F.lit(" "), sanitize_name(e["key"]), F.lit("="), sanitize_tag_value(e["value"])),
        ),
        "",
    )


def first_wins(first: Column, second: Column) -> Column:
    """Union of two tag maps in which the first map keeps its entries."""
    keys = F.map_keys(first)
    return F.map_concat(first, F.map_filter(second, lambda k, v: ~F.array_contains(keys, k)))


def last_wins(first: Column, second: Column) -> Column:
    """Union of two tag maps in which the second map overrides."""
    return first_wins(second, first)


def tag_difference(left: Column, right: Column) -> Column:
    """Entries of ``left`` that ``right`` does not hold with the same value, as an array of pairs."""
    return F.array_except(F.map_entries(left), F.map_entries(right))


def app_point_tags(application: Column, service: Column, cluster: Column, shard: Column, custom: Column) -> Column:
    """Standard application tags with ``none`` for missing ones, plus custom tags under keys still free."""
    standard = F.create_map(
        F.lit("application"), application,
        F.lit("cluster"), F.coalesce(cluster, F.lit(NO_VALUE)),
        F.lit("service"), service,
        F.lit("shard"), F.coalesce(shard, F.lit(NO_VALUE)),
    )
    return first_wins(standard, F.coalesce(custom, empty_tags()))


def empty_tags() -> Column:
    return F.create_map().cast("map<string,string>")


def tags_by_pattern(properties: Column, pattern: str) -> Column:
    """Properties whose key matches ``pattern`` in any letter case and whose value is not blank."""
    return F.map_filter(properties, lambda k, v: k.rlike(f"(?i){pattern}") & ~blank(v))


def tag_from_property(properties: Column, key: str, tag: str) -> Column:
    """The one-entry map ``{tag: properties[key]}``, empty when the value is blank."""
    value = F.try_element_at(properties, F.lit(key))
    return F.when(blank(value), empty_tags()).otherwise(F.create_map(F.lit(tag), value))
