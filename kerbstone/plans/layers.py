"""The pipeline as lazy plans: nothing here runs a job."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from kerbstone import rules
from kerbstone.operators.dimensions import build_dimension
from kerbstone.operators.facts import build_fact
from kerbstone.operators.routing import quarantine_rows, valid_rows
from kerbstone.operators.silver import to_silver


class Refined(NamedTuple):
    silver: DataFrame
    quarantine: DataFrame


def refine(bronze: DataFrame) -> Refined:
    """Every bronze row ends up in exactly one of the two results."""
    return Refined(to_silver(valid_rows(bronze)), quarantine_rows(bronze))


def dimensions(silver: DataFrame, more: dict[str, tuple[str, ...]] | None = None) -> dict[str, DataFrame]:
    return {name: build_dimension(silver, name, (more or {}).get(name, ())) for name in rules.DIMENSIONS}


def facts(silver: DataFrame) -> dict[str, DataFrame]:
    return {name: build_fact(silver, name) for name in rules.FACTS}


def gold(silver: DataFrame) -> dict[str, DataFrame]:
    return {**dimensions(silver), **facts(silver)}
