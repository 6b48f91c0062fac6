"""Tables kept between steps, and joins against small tables of unproven size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.operators.joins import fits_broadcast, salted_join
from wordloom.scratch import use_shared_checkpoints


def kept(rows: DataFrame) -> DataFrame:
    """``rows`` as a checkpoint in the shared folder."""
    use_shared_checkpoints(rows.sparkSession)
    return rows.checkpoint()


def attached(left: DataFrame, right: DataFrame, on: list[str], salt_by: list[str]) -> DataFrame:
    """``left`` with the row of ``right`` for its key, if any; a key may hold most of ``left``."""
    if fits_broadcast(right):
        return left.join(F.broadcast(right), on, "left")
    return salted_join(left, right, on, "left", salt_by)
