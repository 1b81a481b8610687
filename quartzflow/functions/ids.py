"""Identifiers: the same when equal without outer blanks and tabs, whatever the letter case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t"


def bare(c: Column | str) -> Column:
    """Without blanks and tabs at both ends; null if nothing is left."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.btrim(c, F.lit(BLANKS)), F.lit(""))


def account_id(c: Column | str) -> Column:
    return F.upper(bare(c))


def trade_id(c: Column | str) -> Column:
    return F.lower(bare(c))


def annotator_id(c: Column | str) -> Column:
    return F.lower(bare(c))
