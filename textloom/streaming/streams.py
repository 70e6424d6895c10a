"""The chat operators on Structured Streaming; the column logic is the batch one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from textloom.operators.chat import canned_response, intent
from textloom.sources.scratch import new_path

#: Rows of one file of an arriving part.
ROWS_PER_FILE = 500_000


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """File stream over one driver table, with the schema of its batch form."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


class Arrivals:
    """A folder that fills with ``df``, cut into ``batches`` along ``order``, one part after another as they would arrive.

    The table is read once and staged by part; a part is then delivered in ``files`` files, as many as keep the rows of a file bounded, and all
    parts in equally many, so that a stream which takes ``files`` at a time takes one part per micro-batch. With ``late_copies``
    every part is delivered a second time together with the next one.
    """

    def __init__(self, df: DataFrame, order: str, name: str, batches: int = 4, late_copies: bool = False, rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.schema = df.sparkSession, df.schema
        self.path, self._staged = new_path(self.spark, name), new_path(self.spark, f"{name}-staged")
        cuts = df.approxQuantile(order, [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
        part = F.lit(0)
        for cut in cuts:
            part = part + F.coalesce((F.col(order) > cut).cast("int"), F.lit(0))
        df.withColumn("_part", part).write.partitionBy("_part").parquet(self._staged)
        sizes = [r["count"] for r in self._read().groupBy("_part").count().collect()]  # one row a part
        self._copies = 1 + late_copies
        self.files = max(1, -(-max(sizes, default=0) * self._copies // rows_per_file))
        self._delivered, self._end = 0, batches + late_copies

    def _read(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema.fields, StructField("_part", IntegerType())])).parquet(self._staged)

    def deliver(self, parts: int | None = None) -> Arrivals:
        """Add the next ``parts`` parts to the folder, by default all that are left."""
        stop = self._end if parts is None else min(self._end, self._delivered + parts)
        for i in range(self._delivered, stop):
            wanted = self._read().filter(F.col("_part").isin([i - c for c in range(self._copies)])).drop("_part")
            wanted.repartition(self.files).write.mode("append").parquet(self.path)
        self._delivered = stop
        return self


def arrivals(df: DataFrame, order: str, name: str, batches: int = 4, late_copies: bool = False) -> Arrivals:
    return Arrivals(df, order, name, batches, late_copies).deliver()


def file_stream(spark: SparkSession, arrived: Arrivals | str, like: DataFrame) -> DataFrame:
    """Stream over the files of a folder in the order they were written, one part (of a plain folder: one file) a micro-batch."""
    path, files = (arrived.path, arrived.files) if isinstance(arrived, Arrivals) else (arrived, 1)
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).parquet(path)


def classify_stream(messages: DataFrame, text: str = "text", mode: str = "search") -> DataFrame:
    """Intent and response of every arriving message; stateless."""
    return messages.withColumn("intent", intent(text, mode=mode)).withColumn(
        "response", canned_response("intent")
    )


def running_rewards(feedback: DataFrame, option: str, reward: str) -> DataFrame:
    """Mean reward and count per option so far."""
    return feedback.groupBy(option).agg(F.avg(reward).alias("value"), F.count(reward).alias("n"))


def session_stream(events: DataFrame, gap: str = "60 minutes", delay: str = "10 minutes") -> DataFrame:
    """Closed sessions per user. ``ts`` is cast because a watermark needs a zoned timestamp."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return timed.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(
        F.count(F.lit(1)).alias("n_events")
    ).select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events")


def thread_state(
    messages: DataFrame,
    phrases: tuple[str, ...] = ("not satisfied",),
    describing: tuple[str, ...] = ("report_issue", "provide_details"),
    mode: str = "search",
    ts: str | None = None,
    expiry: str = "60 minutes",
    delay: str = "10 minutes",
) -> DataFrame:
    """State per thread: attempt level and latest slots.

    With a timestamp column ``ts`` a thread's state expires once it has been silent for ``expiry``: a later message starts
    anew, and the expired state leaves the store when the watermark passes it. Results then carry the ``start`` of the span.

    Built-in aggregates keep the state to one row per thread, combine before the shuffle and do
    not depend on arrival order, since "latest" goes by the turn number.
    """
    name = intent("text", mode=mode)
    voiced = F.lit(False)
    for phrase in phrases:
        voiced = voiced | F.lower("text").contains(phrase)

    def latest(value: Column) -> Column:
        return F.max_by(value, F.when(value.isNotNull(), F.col("turn")))

    keys: list = ["conv_id"]
    if ts:
        messages = messages.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
        keys.append(F.session_window(ts, expiry).alias("span"))
    state = messages.groupBy(*keys).agg(
        (F.count_if(voiced) + 1).alias("attempt_level"),
        latest(F.when(name.isin(*describing), F.col("text"))).alias("description"),
        latest(F.when(name == "affirm", "yes").when(name == "deny", "no")).alias("feedback"),
        F.max("turn").alias("last_turn"),
    )
    return state.select("conv_id", F.col("span.start").alias("start"), *state.columns[2:]) if ts else state


def dedup_stream(events: DataFrame, key: str, delay: str = "1 hour") -> DataFrame:
    """First arrival of every key inside the watermark."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return timed.dropDuplicatesWithinWatermark([key])


def drain_append(stream: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Run an append-mode stream over all input present and return what it wrote.

    Given the ``path`` of an earlier run, goes on where that one stopped.
    """
    spark = stream.sparkSession
    path = path or new_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{path}-state")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _drain_batches(stream: DataFrame, name: str, mode: str) -> str:
    """Run a stream over all input present; every micro-batch writes its own folder, so a
    retried batch overwrites only itself. Returns the folder of the batches."""
    spark = stream.sparkSession
    path = new_path(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", new_path(spark, f"{name}-state"))
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return path


def drain_complete(stream: DataFrame, name: str) -> DataFrame:
    """Last state of a small complete-mode aggregate."""
    path = _drain_batches(stream, name, "complete")
    batches = stream.sparkSession.read.schema(stream.schema).parquet(path)
    return batches.filter(F.col("batch") == batches.agg(F.max("batch")).scalar()).drop("batch")


def drain_update(stream: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Last state per key of an update-mode aggregate: batches hold only the keys they changed."""
    path = _drain_batches(stream, name, "update")
    batches = stream.sparkSession.read.schema(stream.schema).parquet(path)
    values = F.struct(*[c for c in stream.columns if c not in keys])
    latest = batches.groupBy(*keys).agg(F.max_by(values, "batch").alias("_v"))
    return latest.select(*keys, "_v.*").select(*stream.columns)
