"""Loading extracts into the landing zone, admissibility of load requests, load log."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.sources import landing, profile
from cartwright.sources.entities import BY_KEY, ENTITIES, Entity
from cartwright.sources.files import MISSING_TEXTS, read_text, typed

# The columns of the load log.
LOG_SCHEMA = """run_id string, source string, entity string, source_file string, status string,
    rows_ingested bigint, raw_path string, schema_hash string, schema_columns string,
    error_message string, started_at timestamp, completed_at timestamp, duration_seconds double"""


def known_entities(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{e.source}', '{e.name}', '{e.table}')" for e in ENTITIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(source, entity, table_name)")


def rejected_requests(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Every reason to refuse a load request, one row per request and reason.

    ``requests`` has source, entity and partition_date as text; ``registry`` the known
    source and entity pairs. A date must be a real day written as ``YYYY-MM-DD``.
    """
    names = registry.select("source", "entity").distinct()
    pairs = names.withColumn("_known", F.lit(True))
    sources = names.select("source").distinct().withColumn("_source", F.lit(True))
    dt = F.col("partition_date")
    blank = F.coalesce(F.trim("entity"), F.lit("")) == ""
    well_dated = F.coalesce(
        dt.rlike(r"^\d{4}-\d{2}-\d{2}$") & dt.try_cast("date").isNotNull(), F.lit(False)
    )
    reasons = F.array_compact(
        F.array(
            F.when(~well_dated, F.lit("bad date")),
            F.when(blank, F.lit("blank entity")),
            F.when(F.col("_source").isNull(), F.lit("unknown source")),
            F.when(
                F.col("_source").isNotNull() & F.col("_known").isNull() & ~blank,
                F.lit("unknown entity"),
            ),
        )
    )
    checked = requests.join(sources, "source", "left").join(pairs, ["source", "entity"], "left")
    return checked.select(*requests.columns, F.explode(reasons).alias("reason"))


def entity_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per entity and whether the extract may be landed (it has rows)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows_ingested")).select(
            F.lit(name).alias("entity"), "rows_ingested"
        )
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result.withColumn("admissible", F.col("rows_ingested") > 0)


def ingest(
    spark: SparkSession,
    files: dict[str, str | list[str]],
    root: str,
    dt: str,
    run_id: str | None = None,
    json_lines: bool = False,
) -> DataFrame:
    """Land one day of the given extracts and return the load log.

    ``files`` maps ``source/entity`` to paths. A failed entity is logged and the others are
    still landed.
    """
    run_id = run_id or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S")
    datetime.strptime(dt, "%Y-%m-%d")
    unknown = sorted(set(files) - set(BY_KEY))
    if unknown:
        raise KeyError(f"unknown entities: {unknown}")

    def load(key: str) -> tuple:
        entity, paths = BY_KEY[key], files[key]
        started, clock = datetime.now(timezone.utc), time.monotonic()
        status, rows, path, schema_hash, names, error = "failed", 0, "", "", "", ""
        try:
            texts = read_text(spark, entity, paths, json_lines)
            # Counted and profiled on their way to the landing zone; a load that fails replaces nothing.
            observed, seen = profile.observed(_cleaned(texts, entity))
            landing.write_day(typed(observed, entity), root, entity, dt)
            found = {name: n for part in seen for name, n in part.get.items()}
            counted = profile.from_measures(spark, texts.columns, found)
            rows = landing.refuse_empty(found["rows"], entity, dt)
            schema_hash, names = profile.fingerprint(_with_dtype(counted, entity)).first()
            path = f"{landing.entity_path(root, entity)}/dt={dt}"
            status = "success"
        except Exception as problem:  # noqa: BLE001 - any failure is logged, the rest go on
            error = f"{type(problem).__name__}: {problem}"
        return (
            run_id, entity.source, entity.name, str(paths), status, rows, path, schema_hash, names, error,
            started, datetime.now(timezone.utc), time.monotonic() - clock,
        )

    if not files:
        return spark.createDataFrame([], LOG_SCHEMA)
    # Entities do not depend on each other: their jobs fill the cluster side by side.
    with ThreadPoolExecutor(len(files)) as pool:
        log = list(pool.map(inheritable_thread_target(spark)(load), files))
    return spark.createDataFrame(log, LOG_SCHEMA)


def _cleaned(texts: DataFrame, entity: Entity) -> DataFrame:
    """Missing-value texts of CSV blanked."""
    if entity.file_format != "csv":
        return texts
    return texts.select(*[F.when(~F.col(f"`{c}`").isin(MISSING_TEXTS), F.col(f"`{c}`")).alias(c) for c in texts.columns])


def _with_dtype(column_profile: DataFrame, entity: Entity) -> DataFrame:
    # JSON carries its own types: a quoted number stays text.
    quoted = [] if entity.file_format == "csv" else [
        f.name for f in entity.schema if f.dataType.simpleString() == "string"
    ]
    return profile.with_dtype(column_profile, list(entity.parsed_dates), quoted)


def entity_fingerprint(texts: DataFrame, key: str) -> DataFrame:
    """Fingerprint of an extract as read, with missing-value texts blanked."""
    entity = BY_KEY[key]
    return profile.fingerprint(_with_dtype(profile.column_profile(_cleaned(texts, entity)), entity))


def other_columns(log: DataFrame, entity: Entity) -> list[str]:
    """Columns beyond the registered ones that the logged loads of an entity have landed."""
    loaded = log.where((F.col("status") == "success") & (F.col("source") == entity.source) & (F.col("entity") == entity.name))
    names = loaded.select(F.explode(F.split("schema_columns", ",")).alias("name")).groupBy("name").count().collect()
    known = {f.name for f in entity.schema}
    # Names of columns, not rows.
    return sorted(r["name"] for r in names if r["name"] not in known)


def append_log(log: DataFrame, folder: str) -> None:
    """Keep the load log; it also is the registry of the fingerprints seen so far."""
    log.write.mode("append").parquet(f"{folder}/ingestion_log")


def log_drift(log: DataFrame) -> DataFrame:
    """Successful loads whose fingerprint is compared with the entity's previous load."""
    loaded = log.where(F.col("status") == "success").select(
        F.concat_ws("/", "source", "entity").alias("entity"),
        "run_id",
        "completed_at",
        "schema_hash",
        "schema_columns",
    )
    return profile.drift(loaded, dt="completed_at")
