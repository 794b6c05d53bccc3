"""Ordered state of a stream as a blocked scan per micro-batch, with a small row per key carried on.

A processor (``processors.py``) gets all of a key's rows of a micro-batch in one task. Here each
micro-batch goes through the same blocked scan as the batch operators, so a hot key is spread
over its blocks, in the JVM; what earlier micro-batches add is one row per key (``Carried``). Carried rows and output
are folders by batch id, replaced when a batch is run again, so a restart from the
checkpoint gives the same rows once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import epoch_micros, interval_us, sorted_map_string
from ..operators import sessions, state
from ..operators.blocks import FANOUT, measured_blocks
from ..operators.scan import Scan, null_safe_equal, scan
from ..session import scratch_path

TOTAL = "decimal(38,0)"


def run_batches(spark: SparkSession, stream: DataFrame, name: str, step: Callable[[DataFrame, int], None], checkpoint: str | None = None) -> None:
    """Run ``step(batch, id)`` over everything available; ``step`` replaces what it wrote for that id. A given
    ``checkpoint`` goes on where a run with it ended."""
    query = (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint or scratch_path(spark, "streams", f"{name}_checkpoint"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _file_system(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_batches(spark: SparkSession, path: str, empty: DataFrame) -> DataFrame:
    """All batches' rows under ``path``, of the schema of ``empty``; that itself if no batch came."""
    folder, system = _file_system(spark, path)
    if not system.exists(folder):
        return empty
    return spark.read.schema(empty.schema).option("recursiveFileLookup", "true").parquet(path)


class Carried:
    """The latest row of each key, over the micro-batches so far, in the shared folder.

    A batch writes the rows of the keys that it changes. Every ``every``-th batch also writes the rows of all keys that are
    still wanted, so reading takes one such base and less than ``every`` changes, what is no longer wanted goes, and so do the
    folders that no rerun of the last batch can ask for. Without keys it is one row. Null keys are a key.
    """

    def __init__(self, path: str, keys: list[str], every: int = 8):
        self.path, self.keys, self.every = path, keys, every

    def _latest(self, session: SparkSession, base: int, last: int) -> DataFrame | None:
        """The rows as of batch ``last``, from the base of batch ``base`` (-1: none)."""
        found = session.read.parquet(f"{self.path}/base={base}").withColumn("_batch", F.lit(base)) if base >= 0 else None
        for b in range(base + 1, last + 1):
            own = session.read.parquet(f"{self.path}/changed={b}").withColumn("_batch", F.lit(b))
            found = own if found is None else found.unionByName(own)
        if found is None:
            return None
        values = [c for c in found.columns if c not in (*self.keys, "_batch")]
        return found.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "_batch").alias("_v")).select(*self.keys, "_v.*")

    def before(self, session: SparkSession, batch_id: int) -> DataFrame | None:
        """The rows as of the batch before ``batch_id``; None before the first."""
        return self._latest(session, batch_id // self.every * self.every - 1, batch_id - 1)

    def put(self, session: SparkSession, batch_id: int, changed: DataFrame, wanted: Column | None = None) -> None:
        """The rows of the keys that this batch changes. Rows for which ``wanted`` is not true may go."""
        changed.write.mode("overwrite").parquet(f"{self.path}/changed={batch_id}")
        if (batch_id + 1) % self.every:
            return
        rows = self._latest(session, batch_id - self.every, batch_id)
        (rows if wanted is None else rows.filter(wanted)).write.mode("overwrite").parquet(f"{self.path}/base={batch_id}")
        before = batch_id - self.every  # a rerun of this batch needs that base and what came after it
        for name in [f"base={before - self.every}", *[f"changed={b}" for b in range(before - self.every + 1, before + 1)]]:
            folder, system = _file_system(session, f"{self.path}/{name}")
            system.delete(folder, True)


def _joined(rows: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with what ``before`` has for their key (nulls if nothing); null keys match."""
    named = before.select(*[F.col(k).alias(f"_c_{k}") for k in keys], *[c for c in before.columns if c not in keys])
    return rows.join(named, null_safe_equal([F.col(k) for k in keys], [F.col(f"_c_{k}") for k in keys]), "left").drop(*[f"_c_{k}" for k in keys])


class Watermark:
    """The latest time of all batches so far, less a delay."""

    def __init__(self, path: str, time: str, delay_us: int = 0):
        self.seen, self.time, self.delay_us = Carried(path, []), time, delay_us

    def advance(self, batch: DataFrame, batch_id: int) -> tuple[Column, Column]:
        """The watermark before and after this batch, as timestamps (null: none yet)."""
        before = self.seen.before(batch.sparkSession, batch_id)
        old = before.first()["seen"] if before is not None else None
        new = batch.agg(F.max(epoch_micros(self.time)).alias("seen")).first()["seen"]
        new = old if new is None else new if old is None else max(old, new)
        self.seen.put(batch.sparkSession, batch_id, batch.sparkSession.createDataFrame([(new,)], "seen long"))
        return tuple(F.lit(None if t is None else t - self.delay_us).cast("long") for t in (old, new))


def running_sums(spark: SparkSession, stream: DataFrame, name: str, *, keys: list[str], order: list[str], at: str | Column, values: dict[str, Column],
                 finish: Callable[[DataFrame], DataFrame], closes: str | None = None, time: str | None = None, delay_us: int = 0,
                 checkpoint: str | None = None, path: str | None = None) -> DataFrame:
    """``finish(rows)`` of every row with the running sum of each of ``values`` per key under its name, over all batches.

    Rows of a batch are ordered by ``order`` (``at`` is its first column, see ``measured_blocks``); batches follow
    each other. Sums are exact (decimal(38,0)). Without keys there is one carried row, whose sums go into the plan as
    numbers. With ``closes``, a time among the keys, totals are dropped once the latest ``time`` less ``delay_us`` has reached it,
    and rows that come later than that for a closed key are left out.
    """
    path = path or scratch_path(spark, "streams", name)
    carried, clock = Carried(f"{path}_totals", keys), Watermark(f"{path}_clock", time, delay_us) if closes else None
    names = {n: f"_t_{n}" for n in values}

    def summed(rows: DataFrame) -> DataFrame:
        rows, block = measured_blocks(rows, keys=keys, at=at, tie=order[1] if len(order) > 1 else None)
        specs = {n: Scan("sum", v.cast("decimal(20,0)")) for n, v in values.items()}
        local = scan(rows, keys=keys, order=order, block=block, specs=specs, fanout=FANOUT)
        return local.withColumns({n: F.coalesce(F.col(n).cast(TOTAL), F.lit(0).cast(TOTAL)) for n in values})

    def added(rows: DataFrame, before: DataFrame | None) -> DataFrame:
        """``rows`` with what their key had before added to the columns of ``values``."""
        if before is None:
            return rows
        if keys:
            rows, old = _joined(rows, before.withColumnsRenamed(names), keys), {n: F.coalesce(F.col(t), F.lit(0)) for n, t in names.items()}
        else:
            found = before.first()
            old = {n: F.lit(found[n] if found else 0) for n in names}
        return rows.withColumns({n: (F.col(n) + o).cast(TOTAL) for n, o in old.items()}).drop(*names.values())

    def step(batch: DataFrame, batch_id: int) -> None:
        session, wanted = batch.sparkSession, None
        if clock:
            old, new = clock.advance(batch, batch_id)
            batch = batch.filter(F.coalesce(epoch_micros(closes) > old, F.lit(True)))
            wanted = F.coalesce(epoch_micros(closes) > new, F.lit(True))
        before = carried.before(session, batch_id)
        finish(added(summed(batch), before)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        own = batch.groupBy(*keys).agg(*[F.coalesce(F.sum(v.cast("decimal(20,0)")).cast(TOTAL), F.lit(0).cast(TOTAL)).alias(n) for n, v in values.items()])
        carried.put(session, batch_id, added(own, before), wanted)

    run_batches(spark, stream, name, step, checkpoint)
    return read_batches(spark, path, finish(summed(spark.createDataFrame([], stream.schema))))


def running_sum(spark: SparkSession, stream: DataFrame, name: str, *, keys: list[str], order: list[str], at: str | Column, value: Column,
                finish: Callable[[DataFrame, str], DataFrame], **more) -> DataFrame:
    """``running_sums`` of one value: ``finish(rows, column)``."""
    return running_sums(spark, stream, name, keys=keys, order=order, at=at, values={"_carried": value}, finish=lambda rows: finish(rows, "_carried"), **more)


def type_counts(spark: SparkSession, stream: DataFrame, name: str, *, key: str, type_col: str, order: list[str], finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """V4: ``finish(rows)`` of every row with ``counts``, the text of its key's counts by type so far. Carried is a map per key."""
    path = scratch_path(spark, "streams", name)
    carried, kind = Carried(f"{path}_counts", [key]), "map<string,bigint>"

    def here(rows: DataFrame) -> DataFrame:
        rows, block = measured_blocks(rows, keys=[key], at=order[0], tie=order[1])
        return state.running_type_counts(rows, key=key, type_col=type_col, order=order, block=block, fanout=FANOUT, name="counts", as_text=False)

    def added(rows: DataFrame, before: DataFrame | None) -> DataFrame:
        if before is None:
            return rows
        zero = F.lit(0).cast("long")
        rows = _joined(rows, before.withColumnRenamed("counts", "_earlier"), [key])
        both = F.map_zip_with("counts", F.coalesce("_earlier", F.map_from_arrays(F.array(), F.array()).cast(kind)), lambda k, a, b: F.coalesce(a, zero) + F.coalesce(b, zero))
        return rows.withColumn("counts", both).drop("_earlier")

    def shown(rows: DataFrame) -> DataFrame:
        return finish(rows.withColumn("counts", sorted_map_string(F.col("counts"))))

    def step(batch: DataFrame, batch_id: int) -> None:
        before = carried.before(batch.sparkSession, batch_id)
        shown(added(here(batch), before)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        own = batch.groupBy(key, F.col(type_col).alias("_type")).agg(F.count(F.lit(1)).alias("_n"))
        own = own.groupBy(key).agg(F.map_from_entries(F.collect_list(F.when(F.col("_type").isNotNull(), F.struct("_type", "_n")))).cast(kind).alias("counts"))
        carried.put(batch.sparkSession, batch_id, added(own, before))

    run_batches(spark, stream, name, step)
    return read_batches(spark, path, shown(here(spark.createDataFrame([], stream.schema))))


def recent_lists(spark: SparkSession, stream: DataFrame, name: str, *, key: str, order: list[str], item: Column, clear_above: int,
                 finish: Callable[[DataFrame], DataFrame], ttl_us: int | None = None) -> DataFrame:
    """V5: ``finish(rows)`` of every row with ``list_size`` and ``items``, its key's list after it, over all batches.

    Carried are the rows of each key's open list, ``clear_above`` at most; they go before the batch's rows, so that the batch's first
    list goes on. With ``ttl_us`` lists expire (``state.open_lists``), carried ones once the latest time is so far past them.
    ``order`` is a time and what orders rows at one time.
    """
    path, ts = scratch_path(spark, "streams", name), order[0]
    carried, clock = Carried(f"{path}_open", [key]), Watermark(f"{path}_clock", ts) if ttl_us is not None else None
    entry = F.struct(F.col(ts).alias("_time"), item.alias("_item"))

    def lists(rows: DataFrame, before: DataFrame | None) -> DataFrame:
        new = rows.withColumns({"_at": F.col(ts), "_new": F.lit(1), "_seq": F.lit(0), "_entry": entry})
        if before is not None:
            keys = rows.select(F.col(key).alias("_k")).distinct()
            old = before.join(keys, F.col(key).eqNullSafe(F.col("_k")), "left_semi").select(F.col(key), F.posexplode("open").alias("_seq", "_entry"))
            # rows of earlier batches come first, whatever their time: as rows without one do
            old = old.withColumns({"_new": F.lit(0), ts: F.col("_entry._time")})
            new = new.unionByName(old, allowMissingColumns=True)
        new, block = measured_blocks(new, keys=[key], at="_at")
        return state.open_lists(new, key=key, order=["_at", "_new", "_seq", *order[1:]], block=block, fanout=FANOUT, item=F.col("_entry"), clear_above=clear_above, ttl_us=ttl_us, ts=ts)

    def shown(rows: DataFrame) -> DataFrame:
        items = F.array_join(F.transform("_list", lambda e: e["_item"]), ", ")
        return finish(rows.filter(F.col("_new") == 1).withColumns({"list_size": F.size("_list"), "items": items}))

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = lists(batch, carried.before(batch.sparkSession, batch_id))
        shown(rows).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        last = rows.groupBy(key).agg(F.max_by("_list", "_rn").alias("_list"))
        none = F.array().cast(rows.schema["_list"].dataType)
        wanted = F.size("open") > 0
        if clock:
            _, now = clock.advance(batch, batch_id)
            newest = F.array_max(F.transform("open", lambda e: epoch_micros(e["_time"])))
            wanted = wanted & F.coalesce(newest + ttl_us > now, F.lit(True))
        carried.put(batch.sparkSession, batch_id, last.select(key, F.when(F.size("_list") <= clear_above, F.col("_list")).otherwise(none).alias("open")), wanted)

    run_batches(spark, stream, name, step)
    return read_batches(spark, path, shown(lists(spark.createDataFrame([], stream.schema), None)))


def session_windows(spark: SparkSession, stream: DataFrame, name: str, *, ts: str, gap_us: int, sums: dict[str, Column], tiebreak: list[str],
                    keys: list[str] | None = None, delay_us: int = 0) -> DataFrame:
    """T11 with or without keys: (keys, session_start, session_end, sums) of each session once it has closed.

    A micro-batch's own sessions come from the blocked pass of the batch operator; with the open ones of earlier
    batches they are put together where they touch. A session is closed once the latest time less ``delay_us`` is past its
    last row by the gap: no row that is on time can touch it. Rows that are later than that are left out. Open sessions are carried,
    with their bounds and sums; rows without a time are one session of their key, closed with the first watermark. Neither a hot key nor the
    whole stream is ever in one task, and no key column is needed, as Spark's own session window has it.
    """
    path, keys = scratch_path(spark, "streams", name), keys or []
    clock = Watermark(f"{path}_clock", ts, delay_us)
    kind = T.StructType([*[stream.schema[k] for k in keys], T.StructField("first", stream.schema[ts].dataType), T.StructField("last", stream.schema[ts].dataType),
                         *[T.StructField(n, T.LongType()) for n in sums]])

    def shown(found: DataFrame) -> DataFrame:
        return found.select(*keys, F.col("first").alias("session_start"), (F.col("last") + interval_us(gap_us)).alias("session_end"), *sums)

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        old, new = clock.advance(batch, batch_id)
        rows, block = measured_blocks(batch.filter(F.coalesce(epoch_micros(ts) + gap_us >= old, F.lit(True))), keys=keys, at=ts, tie=tiebreak[0])
        own = sessions.session_ids(rows, ts=ts, gap_us=gap_us, keys=keys, block=block, tiebreak=tiebreak, fanout=FANOUT)
        own = own.groupBy(*keys, sessions.SID).agg(F.min(ts).alias("first"), F.max(ts).alias("last"), *[F.sum(v).cast("long").alias(n) for n, v in sums.items()]).drop(sessions.SID)
        if batch_id:
            own = own.unionByName(session.read.schema(kind).parquet(f"{path}_open/batch={batch_id - 1}"))
        merged = sessions.merge_sessions(own, gap_us=gap_us, sums=list(sums), keys=keys)
        closed = F.coalesce(F.coalesce(epoch_micros("last"), F.lit(-(1 << 62))) + gap_us < new, F.lit(False))
        merged.withColumn("_closed", closed).write.mode("overwrite").parquet(f"{path}_merged/batch={batch_id}")
        merged = session.read.parquet(f"{path}_merged/batch={batch_id}")
        shown(merged.filter("_closed")).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        merged.filter("not _closed").drop("_closed").write.mode("overwrite").parquet(f"{path}_open/batch={batch_id}")
        for place in (f"{path}_open/batch={batch_id - 2}", f"{path}_merged/batch={batch_id - 2}"):
            folder, system = _file_system(session, place)
            system.delete(folder, True)

    run_batches(spark, stream, name, step)
    return read_batches(spark, path, shown(spark.createDataFrame([], kind)))
