"""History of each group over a stream: days since its last row, carry-over, first rows.

State is one number for each group, kept in the state store of the query, many groups to an entry.  Once all
files have been read, results equal those of the batch operators, provided that the
rows of a group arrive in their order from batch to batch.
"""

from __future__ import annotations

import pickle
from collections.abc import Hashable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tillwork.operators.timeseries import decay_rate
from tillwork.session import scratch_path


#: Parts, by hash of the keys, that groups are dealt to; a part is one call and one state, however many groups it holds.
PARTS = 1_024


def _known(value):
    """A key as it is looked up: not-a-number is one value, nested values go by their bytes."""
    if isinstance(value, float) and value != value:
        return None
    return value if isinstance(value, Hashable) else pickle.dumps(value)


def _stateful(stream: DataFrame, keys: Sequence[str], time: str, order: str, step, added: str, kind: str, parts: int = PARTS) -> DataFrame:
    """Add a column to the rows of each group, ordered by (time, order), from one number that the group carries on.

    ``step(rows, first, carried)`` gets the rows of many groups, one group after
    another, where each starts, and the numbers carried (None for a new group); it
    returns the column, and the numbers to carry on.  Groups share calls and
    states, since a call for each group costs more than its rows.
    """
    longs = [f.name for f in stream.schema.fields if f.dataType.simpleString() == "bigint" and f.name not in keys]
    absent, hidden = {c: f"_no_{c}" for c in longs}, ["_part", "_gaps"]
    if {*absent.values(), *hidden} & set(stream.columns):
        raise ValueError(f"{', '.join([*absent.values(), *hidden])} are names of this operator")
    # pandas reads integers with nulls as floats: keys are null in all rows of a call or in none, other integers have a flag
    gaps = F.concat(F.lit(""), *[F.col(k).isNull().cast("int").cast("string") for k in keys])
    dealt = stream.withColumns({"_part": F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"), "_gaps": gaps})
    dealt = dealt.withColumns({absent[c]: F.col(c).isNull() for c in longs}).withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in longs})
    sent = dealt.drop(*hidden)
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sent.schema.fields)
    sorting = ["_group", time, *([absent[order]] if order in absent else []), order]

    def run(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(chunks), ignore_index=True).drop(columns=hidden)
        by = pd.DataFrame({str(i): rows[k].map(_known) if rows[k].dtype == object else rows[k]
                           for i, (k, gap) in enumerate(zip(keys, key[1])) if gap == "0"} | {"all": 0}, index=rows.index)
        group = by.groupby(list(by.columns), dropna=False, sort=False).ngroup()
        rows = rows.assign(_group=group).sort_values(sorting, kind="stable")
        group = rows.pop("_group").to_numpy()
        first = np.r_[True, group[1:] != group[:-1]]
        ids = [tuple(map(_known, i)) for i in by.loc[rows.index[first]].itertuples(index=False, name=None)]
        held = pickle.loads(state.get[0]) if state.exists else {}
        column, carried = step(rows, first, [held.get(i) for i in ids])
        held.update(zip(ids, carried))
        state.update((pickle.dumps(held),))
        yield rows.assign(**{added: column})

    out = dealt.groupBy(*hidden).applyInPandasWithState(run, f"{names}, `{added}` {kind}", "carried binary", "append", GroupStateTimeout.NoTimeout)
    return out.select(*[F.when(~F.col(absent[c]), F.col(c)).alias(c) if c in absent else F.col(c) for c in stream.columns], added)


def days_since_previous(stream: DataFrame, keys: Sequence[str], time: str, order: str, name: str = "days_since") -> DataFrame:
    """Add the days between a row and the row of its group before it, by (time, order); 0 for the first one.

    Rows without time are left out.
    """
    def step(rows: pd.DataFrame, first: np.ndarray, carried: list) -> tuple[np.ndarray, list]:
        day = (rows[time].dt.normalize() - pd.Timestamp(0)).dt.days.to_numpy()
        before = np.r_[day[:1], day[:-1]]
        before[first] = [own if known is None else known for own, known in zip(day[first].tolist(), carried)]
        return (day - before).astype("int32"), day[np.r_[first[1:], True]].tolist()

    return _stateful(stream.filter(F.col(time).isNotNull()), keys, time, order, step, name, "int")


def carry_over(stream: DataFrame, keys: Sequence[str], time: str, order: str, value: str, half_life: float, name: str = "adstock") -> DataFrame:
    """Add ``a[t] = value[t] + d * a[t - 1]`` over the rows of a group by (time, order); ``half_life`` is in rows, a null value counts as 0."""
    decay = decay_rate(half_life)

    def step(rows: pd.DataFrame, first: np.ndarray, carried: list) -> tuple[list, list]:
        known, out, total = iter(carried), [], 0.0
        for x, starts in zip(rows[value].fillna(0.0).tolist(), first.tolist()):
            total = x + decay * ((next(known) or 0.0) if starts else total)
            out.append(total)
        return out, [a for a, ends in zip(out, np.r_[first[1:], True].tolist()) if ends]

    return _stateful(stream, keys, time, order, step, name, "double")


def first_within(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """One row for each key within ``delay`` of its time; the state of a key is dropped after that."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def read_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the parquet files that a path or pattern names, oldest first."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def run_available(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over all files there are, and read its result; state and result lie in the shared folder."""
    spark = stream.sparkSession
    out, state = scratch_path(spark, name), scratch_path(spark, f"{name}-state")
    query = stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
