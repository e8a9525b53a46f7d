"""As-of lookup by union + ordered scan (no nested loop, no join back).

Left and right rows are put in one ordered series per key; each left row
carries itself as a struct, each right row carries its values as a struct,
and a skew-safe running ``last`` hands every left row the nearest right row
before it (``backward``) or after it (``forward``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import Agg, ordered_scan


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def asof_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], left_t, right_t,
                values: Sequence[str], direction: str = "backward", strict: bool = False,
                right_seq: str | None = None, prefix: str = "") -> DataFrame:
    """Left rows with the values of the nearest right row per key.

    backward: latest right row with ``t_r <= t_l`` (``<`` when strict);
    forward: earliest right row with ``t_r >= t_l`` (``>`` when strict).
    Right rows at equal time: the one with the highest ``right_seq`` wins
    (the last inserted), for either direction.  No match gives nulls.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(direction)
    fwd = direction == "forward"
    lcols = left.columns
    # sort code: which of left/right comes first at equal time in scan order
    right_first = not strict
    r_kind, l_kind = (0, 1) if right_first else (1, 0)
    if fwd:  # descending scan: a higher code comes first
        r_kind, l_kind = l_kind, r_kind
    seq = _c(right_seq) if right_seq else F.lit(0)
    if fwd and right_seq:
        seq = -seq  # the last inserted must still be seen last
    lu = left.select(*[F.col(k) for k in keys], _c(left_t).alias("_t"), F.lit(l_kind).alias("_kind"),
                     F.lit(0).cast("long").alias("_seq"),
                     F.struct(*[F.col(c) for c in lcols]).alias("_l"))
    ru = right.select(*[F.col(k) for k in keys], _c(right_t).alias("_t"), F.lit(r_kind).alias("_kind"),
                      seq.cast("long").alias("_seq"),
                      F.struct(*[F.col(v).alias(v) for v in values]).alias("_r"))
    u = lu.unionByName(ru, allowMissingColumns=True)
    s = ordered_scan(u, keys, ["_t", "_kind", "_seq"], [Agg("_m", "last", F.col("_r"))], descending=fwd)
    return (s.where(F.col("_l").isNotNull())
            .select(*[F.col("_l")[c].alias(c) for c in lcols],
                    *[F.col("_m")[v].alias(f"{prefix}{v}") for v in values]))
