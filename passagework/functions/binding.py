"""Small helpers shared by column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

_MINOR_RANGE = 10**18


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it many times inside `body`.

    A projected column does not give that: the optimizer may move its
    expression into a lambda, where it runs once per element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def sequence_key(major: Column, minor: Column) -> Column:
    """One number that sorts like (major, minor), for minor below 10^18.

    Being of fixed width, it can be the buffer of a hash aggregate; a minimum
    over a struct would sort all rows by the grouping key instead.
    """
    wide = F.lit(_MINOR_RANGE).cast("decimal(19,0)")
    return (major.cast("decimal(19,0)") * wide + minor.cast("decimal(19,0)")).cast("decimal(38,0)")


def split_key(key: Column) -> tuple[Column, Column]:
    """The (major, minor) that `sequence_key` packed."""
    minor = key % F.lit(_MINOR_RANGE).cast("decimal(19,0)")
    major = (key - minor) / F.lit(_MINOR_RANGE).cast("decimal(19,0)")
    return major.cast("bigint"), minor.cast("bigint")
