"""Latest start per person kept by a stateful stream: a state of dates and counts for each person.

A delete or update that takes away a person's latest date needs the one before it. Instead of a second look at all loans, each person's
state holds how many loans start on each date. Every call of the state store from Python is a message, so people share ``GROUPS`` states by hash, each one value that
a micro-batch reads and writes once; it touches the states of its own people's groups only. What a batch changes of the latest dates goes to a keyed table
(`streaming.keyed`) that is merged on read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tablewright.streaming.feeds import run_available
from tablewright.streaming.keyed import KeyedTable

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: People share this many states; fixed, as a checkpoint holds them by number.
GROUPS = 8_192


def _processor(kind: str):
    # a class of this function's own, so that workers get it by value and need no package of ours
    from collections import Counter, defaultdict

    from pyspark.sql.streaming import StatefulProcessor

    class LatestStart(StatefulProcessor):
        def init(self, handle):
            # one entry per person and date: days since 1970, and how many loans start then
            self.state = handle.getValueState("starts", f"persons array<{kind}>, days array<int>, counts array<bigint>")

        def handleInitialState(self, key, row, timers):
            self.state.update((row["persons"], row["days"], row["counts"]))

        def handleInputRows(self, key, rows, timers):
            moves = defaultdict(Counter)
            for row in rows:
                moves[row["person"]][row["day"]] += row["sign"]
            state = self.state.get()
            held = defaultdict(dict)
            for person, day, n in zip(*state) if state else ():
                held[person][day] = n
            changed = []
            for person, by_day in moves.items():
                days = held[person]
                before = max(days, default=None)
                for day, move in by_day.items():
                    n = days.get(day, 0) + move
                    if n > 0:
                        days[day] = n
                    else:
                        days.pop(day, None)
                after = max(days, default=None)
                if before != after:
                    changed.append(Row(**{"person": person, "last": after}))
            entries = [(person, day, n) for person, days in held.items() for day, n in days.items()]
            if entries:
                self.state.update(tuple(map(list, zip(*entries))))
            elif state:
                self.state.clear()
            yield from changed

        def close(self):
            pass

    return LatestStart()


def stream_last_visit(feed: DataFrame, loans: DataFrame, table: KeyedTable, person: str, start: str, checkpoint: str) -> DataFrame:
    """Take all changes the stream ``feed`` (op, old, new) has; returns (person, last visit) of the people in ``table``.

    ``loans`` are the rows before the first change, ``table`` holds the people with their latest start by then: its columns are the person and the
    date. People who first come with the feed get a row as well; rows without a person or a start have no part.
    """
    spark = feed.sparkSession
    kind = table.schema[person].dataType
    both = F.array(*[F.struct(F.lit(sign).alias("sign"), F.col(f"{row}.{person}").alias("person"), F.unix_date(F.col(f"{row}.{start}").cast("date")).alias("day")) for sign, row in ((-1, "old"), (1, "new"))])
    signed = feed.select(F.explode(both).alias("c")).select("c.*").where("person is not null and day is not null")
    first = loans.select(F.col(person).alias("person"), F.unix_date(F.col(start).cast("date")).alias("day")).where("person is not null and day is not null")
    group = F.pmod(F.xxhash64("person"), F.lit(GROUPS))
    first = first.groupBy("person", "day").agg(F.count("*").alias("n")).groupBy(group.alias("group")).agg(F.collect_list(F.struct("person", "day", "n")).alias("held"))
    first = first.select("group", F.col("held.person").alias("persons"), F.col("held.day").alias("days"), F.col("held.n").alias("counts"))
    moved = signed.withColumn("group", group).groupBy("group").transformWithState(
        _processor(kind.simpleString()), StructType([StructField("person", kind), StructField("last", IntegerType())]), "Update", "None", first.groupBy("group")
    )
    date = next(f.name for f in table.schema.fields if f.name != person)

    def write(batch: DataFrame, batch_id: int) -> None:
        row = F.struct(F.col("person").alias(person), F.date_from_unix_date("last").alias(date))
        table.apply(batch.select(F.col("person").alias(person), row.alias("row")), batch_id)
        table.merge(batch_id)

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        run_available(moved.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint))
    finally:
        spark.conf.set(_PROVIDER, before)
    return table.read()
