"""Order-keeping sets, image references and versions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import Text, col, command_key, filled, stripped


def distinct_strings(items: Text) -> Column:
    """Trimmed, blanks dropped, first of equals kept, order kept."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(col(items), F.array().cast("array<string>")), lambda x: stripped(x)), lambda x: x != ""))


def comma_set(items: Text) -> Column:
    """The sorted set of all comma-separated parts of an array's elements."""
    parts = F.flatten(F.transform(F.coalesce(col(items), F.array().cast("array<string>")), lambda x: F.split(filled(x), ",")))
    return F.array_sort(F.array_distinct(F.filter(F.transform(parts, lambda x: F.lower(stripped(x))), lambda x: x != "")))


def image_version(image: Text) -> Column:
    """What follows ``@``, else what follows the last colon of the last path part."""
    ref = filled(image)
    last = F.substring_index(ref, "/", -1)
    return F.when(ref.contains("@"), F.substring_index(ref, "@", -1)).when(last.contains(":"), F.substring_index(last, ":", -1)).otherwise("")


def image_name(image: Text) -> Column:
    """The last path part without tag and digest."""
    return F.substring_index(F.substring_index(F.substring_index(filled(image), "/", -1), "@", 1), ":", 1)


def image_error(image: Text) -> Column:
    """The first thing wrong with an image reference; empty if nothing is."""
    ref = stripped(image)
    return (
        F.when(ref == "", "empty")
        .when(ref.rlike(r"[{}$]|<[^>]*>"), "placeholder")
        .when(ref.rlike(r"^[a-z]+://") & ~ref.startswith("docker://"), "scheme")
        .when(ref.rlike(r"\s"), "white space")
        .when(ref.rlike(r"[;&|`'\"\\()*?!]"), "shell character")
        .when(ref.startswith("-"), "leading dash")
        .when(ref.contains("=="), "double equals sign")
        .otherwise("")
    )


def version_text(version: Text) -> Column:
    """Without a comparison sign, a leading v and blanks; lower case."""
    return F.regexp_replace(F.lower(stripped(version)), r"^(?:[<>=!~]+\s*)?v?(?=\d)|^[<>=!~]+\s*", "")


def version_numbers(version: Text) -> Column:
    """All runs of digits, as numbers."""
    return F.transform(F.regexp_extract_all(version_text(version), F.lit(r"(\d{1,18})"), F.lit(1)), lambda x: x.cast("long"))


def version_tokens(version: Text) -> Column:
    """Runs of digits without leading zeros and runs of letters, trailing zeros dropped."""
    tokens = F.transform(F.regexp_extract_all(version_text(version), F.lit(r"(\d+|[a-z]+)"), F.lit(1)), lambda x: F.regexp_replace(x, r"^0+(?=\d)", ""))
    text = F.array_join(tokens, ".")
    return F.regexp_replace(text, r"^0$|(?:\.0)+$", "")


def padded_compare(left: Column, right: Column) -> Column:
    """-1, 0 or 1 for two arrays of numbers, the shorter one padded with zeros."""
    pairs = F.zip_with(left, right, lambda a, b: F.signum(F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))))
    return F.coalesce(F.try_element_at(F.filter(pairs, lambda s: s != 0), F.lit(1)), F.lit(0.0)).cast("int")


def version_distance(left: Column, right: Column) -> Column:
    """Absolute difference of each part."""
    return F.zip_with(left, right, lambda a, b: F.abs(F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))))


def version_match(required: Text, offered: Text) -> Column:
    """not_required, unknown, exact, numeric_equivalent or mismatch."""
    want, have = version_text(required), version_text(offered)
    return (
        F.when(want == "", "not_required")
        .when(have == "", "unknown")
        .when(want == have, "exact")
        .when(version_tokens(required) == version_tokens(offered), "numeric_equivalent")
        .otherwise("mismatch")
    )


def version_rank(required: Text, offered: Text) -> Column:
    """(tier, distance, version): smaller is nearer to what is required.

    Tiers: 0 same text, 1 same tokens, 2 same numbers, 3 same major and newer, 4 same major and older, 5 other
    major, 6 no numbers.
    """
    want, have = version_numbers(required), version_numbers(offered)
    order = padded_compare(have, want)
    same_major = (F.size(want) > 0) & (F.size(have) > 0) & (F.try_element_at(want, F.lit(1)) == F.try_element_at(have, F.lit(1)))
    tier = (
        F.when(version_text(required) == version_text(offered), 0)
        .when(version_tokens(required) == version_tokens(offered), 1)
        .when((F.size(want) == 0) | (F.size(have) == 0), 6)
        .when(order == 0, 2)
        .when(same_major & (order > 0), 3)
        .when(same_major, 4)
        .otherwise(5)
    )
    distance = version_distance(have, want)
    # Of other majors at one distance the newest is nearest.
    by_major = F.concat(F.slice(distance, 1, 1), F.transform(F.slice(have, 2, 1_000), lambda x: -x))
    return F.struct(tier.alias("tier"), F.when(tier == 5, by_major).otherwise(distance).alias("distance"), version_text(offered).alias("version"))


def natural_key(x: Text) -> Column:
    """Sorts runs of digits by value: each is preceded by its length."""
    chunks = F.regexp_extract_all(F.lower(filled(x)), F.lit(r"(\d+|\D+)"), F.lit(1))
    digits = lambda c: F.regexp_replace(c, r"^0+(?=\d)", "")
    return F.array_join(F.transform(chunks, lambda c: F.when(c.rlike(r"^\d"), F.concat(F.lpad(F.length(digits(c)).cast("string"), 4, "0"), digits(c))).otherwise(c)), "\x01")


def matching_keys(a: Text, b: Text) -> Column:
    """Equal command keys, or one within the other where both have four characters or more."""
    x, y = command_key(a), command_key(b)
    return (x != "") & ((x == y) | ((F.length(x) >= 4) & (F.length(y) >= 4) & (x.contains(y) | y.contains(x))))
