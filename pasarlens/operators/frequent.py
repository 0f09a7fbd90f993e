"""Keys with most copies: candidates from bounded counters of each task, exact counts of the candidates, and a proof that none is missing."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.operators.keys import check_duplicates
from pasarlens.sources.tables import stored

#: Counters that a task holds.
COUNTERS = 4096


def _counters(most: int):
    """Misra-Gries over the batches of a task. A key that has no counter in the end, or a count below its own, has lost at most
    ``lost`` of its rows; the last row tells that."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        lost = 0
        for batch in batches:
            held.update(k if isinstance(k, str) else None for k in batch["key"])
            if len(held) > most:
                cut = sorted(held.values(), reverse=True)[most]
                held = Counter({k: n - cut for k, n in held.items() if n > cut})
                lost += cut
        yield pd.DataFrame({
            "key": pd.Series([*held, None], dtype=object),
            "counted": pd.Series([*held.values(), 0], dtype="int64"),
            "lost": pd.Series([*[0] * len(held), lost], dtype="int64"),
        })

    return run


def frequent_duplicates(df: DataFrame, key: str, limit: int = 100, counters: int = COUNTERS) -> DataFrame:
    """The keys (texts, dates or whole numbers) with most copies, as ``check_duplicates`` gives them, without shuffling all keys.

    Each task sends at most ``counters`` keys. Summed over the tasks, a key's counters miss no more than what all tasks have
    ``lost``, so a key without a candidate's place has at most that many rows. The candidates with the highest sums are
    counted exactly; if the last of the wanted ones has more rows than any other key can have, the list is complete. Otherwise
    the keys are counted in full.
    """
    texts = df.select(F.col(key).cast("string").alias("key"))
    summaries = stored(texts.mapInPandas(_counters(counters), "key string, counted bigint, lost bigint"), "counters")
    lost = summaries.agg(F.sum("lost")).first()[0] or 0
    sums = summaries.where("counted > 0").groupBy("key").agg(F.sum("counted").alias("least"))
    chosen = sums.orderBy(F.desc("least"), F.asc_nulls_first("key")).limit(4 * limit + 1)
    chosen = stored(chosen, "candidates")  # 4 * limit + 1 rows at most
    sizes = chosen.agg(F.count("*"), F.min("least")).first()
    # a key that is not among the candidates: its counters sum up to no more than the smallest candidate's, or to nothing
    others = lost + (sizes[1] if sizes[0] > 4 * limit else 0)
    same = df[key].cast("string").eqNullSafe(chosen["key"])
    exact = stored(check_duplicates(df.join(F.broadcast(chosen), same, "left_semi"), key, limit), "duplicates")
    n, last = exact.agg(F.count("*"), F.min("count")).first()
    complete = others < last if n == limit else others <= 1
    if complete:
        return exact.orderBy(F.desc("count"), F.asc_nulls_first(key))
    return check_duplicates(df, key, limit)
