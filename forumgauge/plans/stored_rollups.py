"""Roll-ups that are kept and brought up to date by the new dates alone.

What is stored of a roll-up are sums, counts, minima and maxima per key, which can
be merged; averages are worked out from them at the end.  A commit file beside the
state says which dates it holds, and from which written folder of each.  Dates
published since are read and merged in.  Where a date that the state holds was
published again or taken back, the state is made anew from all dates, as a minimum
cannot be taken back.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumgauge.operators.rollups import MEAN_OF_MEANS, ROLLUPS, WEIGHTED, MetricRollup, Rollup
from forumgauge.sources import marts as mart_files
from forumgauge.sources.commits import CommitLog

STATES = "_rollups"
# Part of a state -> how parts of the same key are merged.
MERGES = {"sum": F.sum, "n": F.sum, "min": F.min, "max": F.max, "wsum": F.sum, "w": F.sum}


def partial_state(table: DataFrame, rollup: Rollup) -> DataFrame:
    """The mergeable state of some dates: one column per source column and part."""
    known = reduce(lambda t, key: t.filter(F.col(key).isNotNull()), rollup.keys, table)
    parts = {}
    for sources, how in rollup.outputs.values():
        for source in (s for s in sources if s in table.columns):
            value = F.col(source)
            if how != "mean":
                parts[f"{how}__{source}"] = MERGES[how](value)
                continue
            parts[f"sum__{source}"], parts[f"n__{source}"] = F.sum(value), F.count(value)
            if rollup.weight in table.columns:
                weight = F.when(value.isNotNull(), F.col(rollup.weight))
                parts[f"wsum__{source}"], parts[f"w__{source}"] = F.sum(value * weight), F.sum(weight)
    return known.groupBy(*rollup.keys).agg(*(part.alias(name) for name, part in parts.items()))


def merged(states: Sequence[DataFrame], rollup: Rollup) -> DataFrame:
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), states)
    return both.groupBy(*rollup.keys).agg(*(
        MERGES[c.partition("__")[0]](c).alias(c) for c in both.columns if c not in rollup.keys))


def finished(state: DataFrame, rollup: Rollup, avg_mode: str = MEAN_OF_MEANS) -> DataFrame:
    """The roll-up that a state stands for, as the roll-up of all its dates would give it."""
    if avg_mode not in (MEAN_OF_MEANS, WEIGHTED):
        raise ValueError(f"unknown avg_mode {avg_mode!r}")
    top, below = ("wsum", "w") if avg_mode == WEIGHTED else ("sum", "n")
    columns = {c.partition("__")[2] for c in state.columns if "__" in c}
    out = []
    for name, (source, how) in rollup.aggregates(columns).items():
        if how == "mean":
            count = F.col(f"{below}__{source}")
            value = F.when(count != 0, F.col(f"{top}__{source}") / count)
        else:
            value = F.col(f"{how}__{source}")
        out.append(value.alias(name))
    rolled = state.select(*rollup.keys, *out)
    return rollup.chosen(rolled) if isinstance(rollup, MetricRollup) else rolled


def update(spark: SparkSession, path: str, name: str, fmt: str = "csv") -> DataFrame:
    """Bring the stored state of a published table up to date and return it."""
    rollup = ROLLUPS[name]
    commits = mart_files.committed(spark, path)
    live = {date: tables[name]["folder"] for date, tables in commits.items() if name in tables}
    base = f"{path}/{STATES}/{name}"
    log = CommitLog(spark, base)
    before = log.latest()
    held = before["dates"] if before else {}
    follows = all(live.get(date) == folder for date, folder in held.items())
    new = sorted(live.keys() - held.keys()) if follows else sorted(live)
    if before and follows and not new:
        return spark.read.parquet(f"{base}/{before['state']}")
    table = mart_files.load_mart_dates(spark, name, new, path, fmt, commits)
    states = [partial_state(table, rollup)]
    if held and follows:
        states.append(spark.read.parquet(f"{base}/{before['state']}"))
    state = f"state={uuid.uuid4().hex}"
    merged(states, rollup).write.parquet(f"{base}/{state}")
    # Of two updates at once the later one counts; both are right.
    log.change(lambda now: {"state": state, "dates": live})
    if before and before["number"] > 0:
        for old in log.folder.names("state=*"):
            if old not in (state, before["state"]):
                log.folder.delete(old)
    return spark.read.parquet(f"{base}/{state}")


def stored_rollup(spark: SparkSession, path: str, name: str, fmt: str = "csv",
                  avg_mode: str = MEAN_OF_MEANS) -> DataFrame:
    """A published table rolled up over all dates, reading only the dates published since the last time."""
    return finished(update(spark, path, name, fmt), ROLLUPS[name], avg_mode)
