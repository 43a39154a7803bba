"""Raw -> silver -> gold by increments: every raw file is read once, every batch of silver is aggregated once.

A batch is what one micro-batch of a file stream holds. Its name (``lote``) is that of the source and the number that the
stream's checkpoint gave it; each step writes a batch whole to a place of its own, so a batch that is run again, after
a fault at any point, replaces what the first attempt left.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliovent.functions.timekeys import month_text
from heliovent.operators.normalise import normalise, union_sources
from heliovent.operators.partials import daily_from_partials, merge_partials, partial_gold, patterns_from_partials
from heliovent.operators.quality import observe_reasons, reasons
from heliovent.operators.records import normalise_records
from heliovent.operators.silver import silver_columns, stamp_ingestion
from heliovent.plans.session import require_utc
from heliovent.sources import folders
from heliovent.sources.readers import read_accepted, read_json_records, read_like_groups
from heliovent.sources.writers import write_batch, write_months

log = logging.getLogger(__name__)

_FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)

# By default the stream would pass over files a week older than the newest it has seen, such as late copies of old days.
_ANY_AGE = "36500d"

DONE = "_merged"  # folder of marks, one for each batch that gold holds
FORMATS = {"parquet": "*.parquet", "json": "*.json*"}


@dataclass(frozen=True)
class BatchRun:
    lote: str
    files: int
    total_rows: int
    clean_rows: int
    rejected_rows: int
    reasons: dict[str, int] = field(default_factory=dict)


def _normalised(spark: SparkSession, kind: str, files: Sequence[str]) -> list[DataFrame]:
    """Raw files as normalised rows with the file of each."""
    if kind == "json":
        return [normalise_records(read_json_records(spark, *files), carry=["archivo"])]
    frames = [df.withColumn("archivo", F.col("_metadata.file_path")) for df in read_like_groups(spark, files)]
    return [normalise(df, carry=["archivo"]) for df in frames]


def judged_rows(normalised: Sequence[DataFrame]) -> DataFrame:
    """Silver columns of all rows, valid or not, the reasons to reject each and the file it is from."""
    return silver_columns(union_sources(normalised), carry=["archivo"]).withColumn("motivos", reasons())


def silver_batch(silver_path: str, source: str, kind: str, now: Callable[[], datetime], runs: list[BatchRun]) -> Callable[[DataFrame, int], None]:
    """What a stream of file names does with a batch: reads those files and writes accepted and rejected rows in one pass."""

    def write(batch: DataFrame, number: int) -> None:
        files = sorted(row["path"] for row in batch.select("path").toLocalIterator())
        if not files:
            return
        lote = f"{source}-{number:08d}"
        counts = Observation()
        judged = observe_reasons(judged_rows(_normalised(batch.sparkSession, kind, files)), counts)
        write_batch(stamp_ingestion(judged, now()), silver_path, lote)
        got = dict(counts.get)
        rows = [got.pop(name) for name in ("total_rows", "clean_rows", "rejected_rows")]
        runs.append(BatchRun(lote, len(files), *rows, reasons=got))
        log.info("silver batch %s", runs[-1])

    return write


def run_silver_increment(
    spark: SparkSession,
    silver_path: str,
    checkpoint: str,
    parquet: Mapping[str, str] | None = None,
    json: Mapping[str, str] | None = None,
    files_per_batch: int = 1000,
    now: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
) -> list[BatchRun]:
    """Read what has come below the sources since the last run, and stop. Sources: name -> folder; a name must stay the same.

    A stream of the source's file listing says which files are new, without opening them; ``files_per_batch`` of them at
    most make a batch, whose names the driver holds. A folder that does not exist yet is passed over. A batch's files may have unlike types (Parquet) or records of unlike shapes (JSON). All
    rows are written in one pass, the accepted apart from the rejected with their reasons. Returns the batches of this run.
    """
    require_utc(spark)
    runs: list[BatchRun] = []
    for kind, sources in (("parquet", parquet or {}), ("json", json or {})):
        for name, path in sources.items():
            if not folders.exists(spark, path):
                log.error("source %s is not there yet: %s", name, path)
                continue
            listing = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", True)
            listing = listing.option("pathGlobFilter", FORMATS[kind]).option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", _ANY_AGE)
            new = listing.load(path).select("path").writeStream.option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}")
            new = new.foreachBatch(silver_batch(silver_path, name, kind, now, runs))
            new.trigger(availableNow=True).start().awaitTermination()
    return runs


def complete_batches(spark: SparkSession, silver_path: str) -> list[str]:
    """Batches whose write came to its end."""
    names = [n for n in folders.children(spark, silver_path) if n.startswith("lote=")]
    root = silver_path.rstrip("/")
    return [n.removeprefix("lote=") for n in names if folders.exists(spark, f"{root}/{n}/_SUCCESS")]


def new_partials(spark: SparkSession, silver_path: str, lotes: Sequence[str]) -> DataFrame:
    """Partial aggregates of these batches; reads no other one's folders."""
    partials = partial_gold(read_accepted(spark, silver_path, lotes), "lote")
    return partials.withColumn("mes_anio", month_text(F.col("mes")))


def run_gold_increment(spark: SparkSession, silver_path: str, gold_path: str) -> list[str]:
    """Bring gold up to the batches that silver has and gold has not; returns their names.

    Partial aggregates of the new batches join those kept of the earlier ones (``partials``, by month and batch). The months
    that they touch are merged anew and replace their folders of ``daily`` and ``patterns``; others stay as they are. A batch
    is marked last, so after a fault the next run does it again, with the same result.
    """
    require_utc(spark)
    root = gold_path.rstrip("/")
    done = set(folders.children(spark, f"{root}/{DONE}"))
    new = [lote for lote in complete_batches(spark, silver_path) if lote not in done]
    if not new:
        return []
    partials = new_partials(spark, silver_path, new)
    write_months(partials, f"{root}/partials", "lote")
    kept = spark.read.schema(partials.schema).parquet(f"{root}/partials")
    touched = [row[0] for row in kept.where(F.col("lote").isin(new)).select("mes_anio").distinct().collect()]
    if touched:
        merged = merge_partials(kept.where(F.col("mes_anio").isin(touched)))
        daily = daily_from_partials(merged)
        write_months(daily.withColumn("mes_anio", month_text(F.col("fecha_solo"))), f"{root}/daily")
        write_months(patterns_from_partials(merged), f"{root}/patterns")
    for lote in new:
        folders.mark(spark, f"{root}/{DONE}/{lote}")
    return new
