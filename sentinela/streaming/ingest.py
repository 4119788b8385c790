"""Streaming versions of the load, the weekly counts and the audit.

Batches are written to one folder per batch id in overwrite mode, so a batch repeated after a
failure replaces itself.
"""

from __future__ import annotations

import datetime as dt
import sys
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sentinela.functions.dates import week_start
from sentinela.operators.audit import audit_log, log_rows
from sentinela.operators.rules import (
    EARLIEST,
    apply_rules,
    clinical_rules,
    fill_derived,
    insert_rules,
    known_state,
    split_quarantine,
)
from sentinela.operators.staging import judged_staging, split_judged
from sentinela.plans.marts import confirmed, count_of, total
from sentinela.schemas import RAW_SCHEMA
from sentinela.session import scratch_dir, wide_rows
from sentinela.sources.csvfiles import CSV_OPTIONS, MALFORMED, raw_columns
from sentinela.sources.warehouse import remove_folder

# Functions of this module travel to the executors as code, which need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Lines of a batch get numbers below 2^40; that leaves eight million batches.
LINE_BITS = 40
# The lower bits of Spark's increasing ids count the rows of a partition.
PART_BITS = 33
SECONDS_PER_DAY = 86_400


def read_raw_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Raw CSV files as they arrive; a file with another header order stops the stream."""
    schema = T.StructType([*RAW_SCHEMA, T.StructField(MALFORMED, T.StringType())])
    return (
        spark.readStream.schema(schema)
        .options(**CSV_OPTIONS)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )


def numbered(batch: DataFrame, batch_id: int) -> DataFrame:
    """The batch's lines with ``linha_id``: the batch number in the high bits, then 0, 1, 2, …

    ``batch`` should be stored, since it is read twice and has to keep its partitions.
    """
    marked = batch.withColumn("linha_id", F.monotonically_increasing_id())
    return renumbered(marked, batch_id).select("linha_id", *batch.columns)


def renumbered(lines: DataFrame, batch_id: int) -> DataFrame:
    """Lines with Spark's increasing ids as ``linha_id``, numbered like those of ``numbered`` instead.

    Lines are counted per partition first, so numbers leave no gaps however many partitions there
    are. ``lines`` should be stored with the ids, since they are read twice; all lines have to be there.
    """
    if batch_id >= 1 << (63 - LINE_BITS):
        raise ValueError("batch numbers do not fit the line ids any more")
    part = F.shiftright("linha_id", PART_BITS)
    before = Window.orderBy("_parte").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    counts = lines.groupBy(part.alias("_parte")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_parte", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_antes"))
    within = F.col("linha_id").bitwiseAND(F.lit((1 << PART_BITS) - 1))
    line = F.lit(batch_id << LINE_BITS) + F.col("_antes") + within
    joined = lines.withColumn("_parte", part).join(F.broadcast(offsets), "_parte")
    return joined.select(*[line.alias(name) if name == "linha_id" else name for name in lines.columns])


def write_batch(rows: DataFrame, folder: str, batch_id: int) -> None:
    with wide_rows(rows.sparkSession):
        rows.write.mode("overwrite").parquet(f"{folder}/lote={batch_id}")


def checked_rows(
    staged: DataFrame,
    mode: str,
    dim_uf: DataFrame | None,
    today: dt.date | None = None,
    earliest: dt.date = EARLIEST,
) -> DataFrame:
    """Fact rows with errors and warnings; unless checks are off, missing derived values filled."""
    rules = clinical_rules()
    if dim_uf is not None:
        staged = known_state(staged, dim_uf)
        day = F.current_date() if today is None else F.lit(today)
        rules = insert_rules(day, F.lit(earliest)) + rules
    checked = apply_rules(staged, rules).drop("uf_conhecida")
    return checked if mode == "off" else fill_derived(checked)


def stream_ingest(
    raw: DataFrame,
    out: str,
    checkpoint: str,
    mode: str = "enforce",
    dim_uf: DataFrame | None = None,
    today: dt.date | None = None,
    earliest: dt.date = EARLIEST,
) -> StreamingQuery:
    """Clean, check and store arriving rows: ``fato``, ``quarentena`` and ``recusadas`` below ``out``.

    The same column functions as in the batch load; ``mode`` is that of ``split_quarantine``. With
    ``dim_uf``, the rules of the validated insert apply as well, with their ``today`` and ``earliest``.
    A batch is read, judged and checked in one pass, stored in the scratch folder, and split from there.
    """

    def ingest(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        lines = raw_columns(batch).select(F.monotonically_increasing_id().alias("linha_id"), "*")
        folder = scratch_dir(spark, "lote")
        try:
            with wide_rows(spark):
                checked_rows(judged_staging(lines), mode, dim_uf, today, earliest).write.parquet(folder)
            accepted, rejected = split_judged(renumbered(spark.read.parquet(folder), batch_id), lines.columns)
            passed, blocked = split_quarantine(accepted.withColumn("id_notif", F.col("linha_id")), mode)
            write_batch(passed.drop("errors", "warnings", "first_error"), f"{out}/fato", batch_id)
            write_batch(blocked, f"{out}/quarentena", batch_id)
            write_batch(rejected, f"{out}/recusadas", batch_id)
        finally:
            remove_folder(spark, folder)

    return (
        raw.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def weekly_counts(notifications: DataFrame, lateness: str | None = None) -> DataFrame:
    """Running counts per Monday week and residence state of a stream of fact rows.

    There is one state row per state and week, so the default keeps them all and counts a form
    however late it comes. ``lateness`` sets a watermark that forgets older weeks.
    """
    # Midnight UTC whatever the session's time zone, so that windows and dates agree.
    midnight = F.timestamp_seconds(F.unix_date("dt_sintomas").cast("bigint") * SECONDS_PER_DAY)
    timed = notifications.withColumn("_moment", midnight)
    if lateness:
        timed = timed.withWatermark("_moment", lateness)
    # Windows count from Thursday, 1 January 1970; four days later is a Monday.
    return (
        timed.groupBy(F.window("_moment", "7 days", startTime="4 days"), "cod_uf_resi")
        .agg(total(), count_of(confirmed(), "casos_confirmados"))
        .select(
            F.date_from_unix_date(
                F.floor(F.unix_seconds("window.start") / SECONDS_PER_DAY).cast("int")
            ).alias("inicio_sem"),
            "cod_uf_resi",
            "casos_total",
            "casos_confirmados",
        )
    )


def _of_batch(spark: SparkSession, folder: str, batch_id: int, schema: str) -> DataFrame:
    """What a batch has stored; nothing before the first."""
    if batch_id < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/lote={batch_id}")


COUNTS = "inicio_sem date, cod_uf_resi int, casos_total bigint, casos_confirmados bigint"


def stream_weekly_counts(
    notifications: DataFrame, out: str, checkpoint: str, lateness: str | None = None
) -> StreamingQuery:
    """Weekly counts of a stream of fact rows, merged batch by batch; read them with ``latest_counts``.

    A batch stores the counts of the open weeks in ``abertas`` below ``out``, which holds one row per
    open week and state and replaces that of the batch before. With ``lateness``, a week closes when
    it ended so long before the latest onset of earlier batches; its counts are then final and are
    appended once to ``fechadas``. Forms that come for a closed week, or without an onset date, are
    not counted; they go whole to ``atrasadas`` with the reason and the limit they missed. Every
    batch follows from the one before and its own rows, so a repeated batch replaces itself.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _of_batch(spark, f"{out}/marcas", batch_id - 1, "ultima date, limite date").first()
        last, limit = (before["ultima"], before["limite"]) if before else (None, None)
        batch = batch.withColumn("_semana", week_start(F.col("dt_sintomas"))).persist()
        try:
            ended = F.date_add("_semana", 7) <= F.lit(limit).cast("date")
            reason = F.when(F.col("_semana").isNull(), "dt_sintomas:missing").when(ended, "dt_sintomas:late")
            judged = batch.withColumn("motivo", reason)
            late = judged.where("motivo IS NOT NULL").drop("_semana").withColumn("limite", F.lit(limit).cast("date"))
            write_batch(late, f"{out}/atrasadas", batch_id)
            counted = (
                judged.where("motivo IS NULL")
                .groupBy(F.col("_semana").alias("inicio_sem"), F.col("cod_uf_resi").cast("int").alias("cod_uf_resi"))
                .agg(total(), count_of(confirmed(), "casos_confirmados"))
            )
            open_weeks = _of_batch(spark, f"{out}/abertas", batch_id - 1, COUNTS)
            merged = open_weeks.unionByName(counted).groupBy("inicio_sem", "cod_uf_resi")
            merged = merged.agg(F.sum("casos_total").alias("casos_total"), F.sum("casos_confirmados").alias("casos_confirmados"))
            latest = batch.agg(F.greatest(F.max("dt_sintomas"), F.lit(last).cast("date")).alias("ultima"))
            closing = F.lit(None) if lateness is None else F.col("ultima") - F.expr(f"INTERVAL {lateness}")
            marks = latest.withColumn("limite", F.greatest(closing.cast("date"), F.lit(limit).cast("date")))
            write_batch(marks.coalesce(1), f"{out}/marcas", batch_id)
            now = _of_batch(spark, f"{out}/marcas", batch_id, "ultima date, limite date").first()["limite"]
            closed = F.coalesce(F.date_add("inicio_sem", 7) <= F.lit(now).cast("date"), F.lit(False))
            write_batch(merged.where(closed), f"{out}/fechadas", batch_id)
            write_batch(merged.where(~closed), f"{out}/abertas", batch_id)
            if batch_id > 1:
                # Only the batch before is ever read again.
                remove_folder(spark, f"{out}/abertas/lote={batch_id - 2}")
        finally:
            batch.unpersist()

    return (
        notifications.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def closed_weeks(spark: SparkSession, out: str) -> DataFrame:
    """Final counts of the weeks that have closed, each once."""
    return spark.read.schema(f"{COUNTS}, lote bigint").parquet(f"{out}/fechadas").drop("lote")


def late_forms(spark: SparkSession, out: str) -> DataFrame:
    """Forms that were not counted, with ``motivo``, ``limite`` and the batch ``lote`` they came in."""
    return spark.read.parquet(f"{out}/atrasadas")


def latest_counts(spark: SparkSession, out: str) -> DataFrame:
    """Closed weeks and the newest counts of the open ones."""
    snapshots = spark.read.schema(f"{COUNTS}, lote bigint").parquet(f"{out}/abertas")
    marks = spark.read.schema("lote bigint").parquet(f"{out}/marcas")
    newest = marks.agg(F.max("lote")).first()[0]
    return snapshots.where(F.col("lote") == newest).drop("lote").unionByName(closed_weeks(spark, out))


JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "true"}


def _sortable(order: Column, kind: T.DataType) -> Column:
    """The order column as text that sorts alike; null comes first."""
    if isinstance(kind, T.StringType):
        return F.coalesce(F.concat(F.lit("1"), order), F.lit("0"))
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        number = order.cast("bigint")
    elif isinstance(kind, T.DateType):
        number = F.unix_date(order).cast("bigint")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        number = F.unix_micros(order.cast("timestamp"))
    else:
        raise TypeError(f"versions cannot be ordered by {kind.simpleString()}")
    # With the sign bit turned, sixteen hexadecimal digits sort like the number.
    digits = F.lpad(F.hex(number.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.coalesce(F.concat(F.lit("1"), digits), F.lit("0"))


def place_versions(keep: int | None) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """Pairs each arriving version with the one before it by key and order; the last ``keep`` of a key rest as state."""

    def place(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        stored = state.get if state.exists else ([], [], [])
        # Keys, places and rows, in the order of keys and places.
        known, rows = list(zip(stored[0], stored[1])), list(stored[2])
        arrived = pd.concat(list(batches), ignore_index=True)
        before, after = [], []
        for key, where, row in sorted(zip(arrived["_chave"], arrived["_lugar"], arrived["_linha"])):
            at = bisect_right(known, (key, where))
            same_key = at > 0 and known[at - 1][0] == key
            before.append(rows[at - 1] if same_key else None)
            after.append(row)
            if same_key and known[at - 1][1] == where and rows[at - 1] == row:
                continue  # the same version once more
            known.insert(at, (key, where))
            rows.insert(at, row)
        if keep is not None:
            last = [i for i, (key, _) in enumerate(known) if i + keep >= len(known) or known[i + keep][0] != key]
            known, rows = [known[i] for i in last], [rows[i] for i in last]
        state.update(([key for key, _ in known], [where for _, where in known], rows))
        yield pd.DataFrame({"antes": pd.Series(before, dtype=object), "depois": pd.Series(after, dtype=object)})

    return place


def stream_audit(
    changes: DataFrame,
    out: str,
    checkpoint: str,
    key: str,
    order: str,
    table: str,
    keep: int | None = None,
    groups: int | None = None,
) -> StreamingQuery:
    """Audit a stream of row versions: the log is ``auditoria`` below ``out``, one folder per batch.

    The versions of each key lie in Spark's state store, sorted by ``order``, so a batch reads and
    writes the state of the keys it touches and no other. A version is logged against the one
    before it by ``order``, whenever it arrives; one that arrives late leaves the last version as it
    is. With ``keep``, a key's state holds its last ``keep`` versions; one that is older than those
    counts as inserted. A version that comes twice is logged once. ``order`` is whole numbers, dates,
    timestamps or text; rows without it come first.

    Each state entry costs a task some tenths of a millisecond. With ``groups``, keys are hashed to
    so many entries that a batch with many keys touches fewer of them, each read and written whole;
    one for every fifty keys expected is a good number. It cannot change after the first batch.
    """
    if keep is not None and keep < 1:
        raise ValueError("the last version has to stay")
    schema = changes.schema
    columns = [name for name in changes.columns if name != order]
    # Rows travel and rest as JSON text, so that Python neither widens integers nor loses nulls.
    versions = changes.select(
        F.coalesce(F.concat(F.lit("1"), F.col(key).cast("string")), F.lit("0")).alias("_chave"),
        _sortable(F.col(order), schema[order].dataType).alias("_lugar"),
        F.to_json(F.struct(*changes.columns), JSON_OPTIONS).alias("_linha"),
    )
    entry = F.col("_chave") if groups is None else F.pmod(F.xxhash64("_chave"), F.lit(groups))
    paired = versions.withColumn("_grupo", entry).groupBy("_grupo").applyInPandasWithState(
        place_versions(keep),
        outputStructType="antes string, depois string",
        stateStructType="chaves array<string>, lugares array<string>, linhas array<string>",
        outputMode="append",
        timeoutConf=GroupStateTimeout.NoTimeout,
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        sides = {side: F.from_json(side, schema, JSON_OPTIONS) for side in ("antes", "depois")}
        parsed = batch.withColumns(sides)
        audited = {
            side: F.when(F.col(side).isNotNull(), F.struct(*[F.col(f"{side}.{name}").alias(name) for name in columns]))
            for side in ("antes", "depois")
        }
        pairs = parsed.withColumns({key: F.col(f"depois.{key}"), **audited})
        write_batch(audit_log(log_rows(pairs, columns, [key], table)), f"{out}/auditoria", batch_id)

    return (
        paired.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_state(spark: SparkSession, checkpoint: str, schema: T.StructType | str) -> DataFrame:
    """The last version of each key that a stream audit has seen, read from its state store.

    ``schema`` is that of the audited rows.
    """
    stored = spark.read.format("statestore").load(checkpoint).select("value.groupState.*")
    versions = stored.select(F.inline(F.arrays_zip("chaves", "lugares", "linhas")))
    last = versions.groupBy("chaves").agg(F.max_by("linhas", "lugares").alias("_linha"))
    return last.select(F.from_json("_linha", schema, JSON_OPTIONS).alias("_linha")).select("_linha.*")
