"""Join helper: a left join whose NULL keys are spread over all tasks.

Which side of a join is broadcast is left to Spark: AQE decides by the bytes
that a stage has really written. Only tables that are small by construction
(k ranks, one row per range partition, fixed dimensions) carry a broadcast hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_spread_nulls(left: DataFrame, right: DataFrame, key: str, salt: str) -> DataFrame:
    """``left`` LEFT JOIN ``right`` USING ``key``, with NULL left keys spread over all tasks.

    A NULL key never matches, but a shuffle join still hashes every NULL-key row
    to the same reducer: with a tenth of all tracks lacking an album, that is one
    hot task. The join runs on ``(coalesce(key, salt), key IS NULL)`` instead:
    ``salt`` (a unique column of ``left``) spreads the NULL rows, and the flag
    keeps them from ever matching a right row. Deterministic, so a recomputed
    task routes every row the same way. The result has ``left``'s columns plus
    ``right``'s non-key columns.
    """
    lk = left.withColumns({
        "__jk": F.coalesce(F.col(key).cast("string"), F.col(salt).cast("string")),
        "__jn": F.col(key).isNull(),
    })
    rk = right.withColumns({"__jk": F.col(key).cast("string"), "__jn": F.lit(False)}).drop(key)
    return lk.join(rk, ["__jk", "__jn"], "left").drop("__jk", "__jn")
