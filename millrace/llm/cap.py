"""At most a given number of items of each contributor.

Stratum-aware cap: a contributor's cap is split over strata (topics, periods or bands of quality) by
largest-remainder apportionment, spare slots go on to strata that have items left, and inside a stratum the
best items stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def apportion(cap: int, have: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Slots of each stratum: at most have, in all min(cap, sum(have)).

    Largest remainder of cap by weight, equal remainders by position; slots beyond what a stratum has are
    split again among the others until none is left. Whole weights are divided without rounding.
    """
    have = np.asarray(have, np.int64)
    slots, left = np.zeros(len(have), np.int64), int(min(cap, have.sum()))
    w = np.maximum(np.nan_to_num(np.asarray(weight, float)), 0)
    whole = bool((w == np.floor(w)).all()) and w.sum() < 2**53
    w = [int(x) for x in w] if whole else w.tolist()
    while left > 0:
        room = have - slots
        share = [x if r > 0 else 0 for x, r in zip(w, room.tolist(), strict=True)]
        if sum(share) <= 0:
            share = [int(r > 0) for r in room.tolist()]
        total = sum(share)
        give = np.array([int(left * x // total) for x in share], np.int64)
        rest = [left * x % total if whole else left * x / total - g for x, g in zip(share, give.tolist(), strict=True)]
        for k in sorted(range(len(rest)), key=lambda k: (-rest[k], k))[: left - int(give.sum())]:
            give[k] += 1
        give = np.minimum(give, room)
        slots += give
        left -= int(give.sum())
    return slots


def cap_per_contributor(
    df: DataFrame,
    contributor: str,
    stratum: Column,
    order: list[Column],
    cap: int | None = None,
    share: float | None = None,
    weight: Column | None = None,
    best_first: bool = False,
    over_only: bool = False,
) -> DataFrame:
    """The rows of df that stay, all its columns, with `stratum_slots` and `stratum_rank` added.

    cap limits the number of items of each contributor; share limits it to that share of all rows (rounded
    down, at least 1). weight (default: the stratum's number of items) steers the split; it must be equal
    within a stratum. best_first: strata are bands of quality, the better the higher their weight, and the
    split must keep the best of the contributor as a whole. Then the weights are taken from the histogram of
    the bands: each counts with as many items as it has among the contributor's best `cap`. The split by
    largest remainder comes out even with these, so it has no freedom: that is what the best ones mean. The
    strata of a contributor must be few (topics, periods, bands), since one task splits them. order ranks the items of a stratum and must be total for a defined result. Rows of a
    null contributor are nobody's and all stay (with over_only they are left out, as are contributors within
    their cap). Null strata form one stratum. An empty table gives no rows.
    """
    if cap is None:
        cap = max(1, int(df.count() * share))
    df = df.drop("stratum_slots", "stratum_rank")
    names = df.columns
    rows = df.withColumns({"_cap_stratum": stratum.cast("string"), "_cap_weight": weight.cast("double") if weight is not None else F.lit(None).cast("double")})
    own = rows.filter(F.col(contributor).isNotNull())
    counts = own.groupBy(contributor, "_cap_stratum").agg(F.count(F.lit(1)).alias("_cap_n"), F.max("_cap_weight").alias("_cap_w"))
    if best_first:
        earlier = Window.partitionBy(contributor).orderBy(F.col("_cap_w").desc_nulls_last(), "_cap_stratum").rowsBetween(Window.unboundedPreceding, -1)
        better = F.coalesce(F.sum("_cap_n").over(earlier), F.lit(0))
        counts = counts.withColumn("_cap_w", F.greatest(F.lit(0), F.least(F.col("_cap_n"), F.lit(cap) - better)).cast("double"))
    gathered = counts.groupBy(contributor).agg(F.sum("_cap_n").alias("_cap_all"), F.array_sort(F.collect_list(F.struct("_cap_stratum", "_cap_n", "_cap_w"))).alias("_cap_strata"))
    over = gathered.filter(F.col("_cap_all") > cap)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[tuple] = []
            for who, strata in zip(pdf[contributor], pdf["_cap_strata"], strict=True):
                n = np.array([x["_cap_n"] for x in strata])
                w = np.array([np.nan if x["_cap_w"] is None else x["_cap_w"] for x in strata], float)
                slots = apportion(cap, n, np.where(np.isnan(w), n, w))
                out += [(who, x["_cap_stratum"], int(k)) for x, k in zip(strata, slots, strict=True) if k]
            yield pd.DataFrame(out, columns=[contributor, "_cap_stratum", "_cap_slots"])

    kind = dict(df.dtypes)[contributor]
    slots = over.select(contributor, "_cap_strata").mapInPandas(split, f"`{contributor}` {kind}, _cap_stratum string, _cap_slots long")
    # The constant bound lets Spark cut every stratum to `cap` rows before the shuffle, so a hot contributor is never gathered whole.
    best = own.withColumn("stratum_rank", F.row_number().over(Window.partitionBy(contributor, "_cap_stratum").orderBy(*order))).filter(F.col("stratum_rank") <= cap)
    a, b = best.alias("a"), slots.alias("b")
    kept = a.join(b, (F.col(f"a.{contributor}") == F.col(f"b.{contributor}")) & F.col("a._cap_stratum").eqNullSafe(F.col("b._cap_stratum")) & (F.col("a.stratum_rank") <= F.col("b._cap_slots")))
    kept = kept.select(*[F.col(f"a.`{c}`") for c in names], F.col("b._cap_slots").alias("stratum_slots"), "a.stratum_rank")
    if over_only:
        return kept
    rest = rows.join(over.select(contributor), contributor, "left_anti").select(*names, F.lit(None).cast("long").alias("stratum_slots"), F.lit(None).cast("int").alias("stratum_rank"))
    return kept.unionByName(rest)
