"""Raw observation documents: scan and landing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.functions.time import obs_date
from skylattice.operators.filters import between_half_open
from skylattice.schemas import BODY, CORRUPT, DIGEST, DOCUMENT, OBS_DATE, RAW, RAW_LANDED, RAW_WITH_CORRUPT
from skylattice.storage import exists, staged

#: A folder with this log belongs to a file stream: readers see only what the log lists.
STREAM_LOG = "_spark_metadata"
#: Dates of a batch up to which the look-up of landed documents names them one by one.
DATES = 400
#: Digests up to which those met before are broadcast.
SMALL = 1_000_000


def json_options(multiline: bool = False) -> dict[str, str]:
    """Malformed documents become rows that keep their text in the corrupt column."""
    return {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "multiLine": str(multiline).lower(),
    }


def read_raw(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    start: datetime | None = None,
    end: datetime | None = None,
    schema: str | None = None,
    multiline: bool = False,
    **options: str,
) -> DataFrame:
    """Observations with ``start <= dt < end``.

    ``parquet`` reads what :func:`land_raw` wrote and prunes its date partitions, or observations
    in files without partitions; ``json`` reads
    documents, one per line unless ``multiline``; any other ``fmt`` names an installed connector
    (a document store, for instance), configured through ``options``. The schema is declared in
    each case, so nothing is sampled and only the fields in use are read.
    """
    if fmt == "json":
        options = json_options(multiline) | options
    declared = schema or (RAW_WITH_CORRUPT if fmt in ("parquet", "json") else RAW)
    scan = spark.read.format(fmt).schema(declared).options(**options).load(path)
    return between_half_open(scan, "dt", start, end)


def parse_documents(lines: DataFrame, text: str = "value") -> DataFrame:
    """Observations from a text or binary column, one document a row.

    Any source of texts will do: files, or a message source, batch or stream. The text itself
    stays in ``document``, so that fields without a declared column can be read later. Blank texts
    are no documents.
    """
    body = F.col(text).cast("string")
    options = {k: v for k, v in json_options().items() if k != "multiLine"}
    parsed = F.from_json(F.col(DOCUMENT), RAW_WITH_CORRUPT, options)
    written = lines.select(body.alias(DOCUMENT)).filter(F.col(DOCUMENT).rlike(r"\S"))
    return written.select(parsed.alias("o"), DOCUMENT).select("o.*", DOCUMENT)


def undeclared(landed: DataFrame, path: str) -> Column:
    """A field of a landed document by JSON path, as text: ``undeclared(df, "$.snow.kind")``.

    Documents are parsed once, on landing; only texts that were no JSON are looked at again.
    """
    kept = F.get_json_object(landed[DOCUMENT], path)
    return F.coalesce(F.try_variant_get(landed[BODY], path, "string"), kept)


def with_obs_date(raw: DataFrame) -> DataFrame:
    """Add the UTC observation date; it is null where the document had no usable ``dt``."""
    return raw.withColumn(OBS_DATE, obs_date(F.col("dt")))


def land_raw(
    spark: SparkSession, incoming_path: str, raw_path: str, multiline: bool = False
) -> None:
    """Append JSON documents to the raw table, partitioned by observation date.

    Nothing is lost: a document lands with all its fields, and a malformed one with its text, in the
    partition without a date. With ``multiline`` a file is one document. Use
    ``streaming.land_stream`` where a re-run should not read a file twice; both may write to one folder.
    """
    land(parse_documents(spark.read.text(incoming_path, wholetext=multiline)), raw_path)


def land(documents: DataFrame, raw_path: str) -> None:
    """Append parsed documents that have not landed yet.

    Two documents are the same if their texts are, under whatever file names they came. The look-up
    reads the digests of the dates in the batch only. The rebalance writes few files per date and splits a date
    that is too large for one task.
    """
    spark = documents.sparkSession
    if exists(spark, f"{raw_path}/{STREAM_LOG}"):
        raise ValueError(f"{raw_path} holds the log of a file stream, which hides what others write")
    body = F.try_parse_json(DOCUMENT)
    rows = with_obs_date(documents).withColumns({DIGEST: F.unhex(F.md5(DOCUMENT)), BODY: body})
    rows = rows.withColumn(DOCUMENT, F.when(F.col(BODY).isNull(), F.col(DOCUMENT)))
    with staged(rows) as batch, staged(_met_before(batch, raw_path)) as odd:
        n = odd.count()
        if n:  # digests and numbers only, broadcast up to a million of them
            told = batch.join(F.broadcast(odd) if n <= SMALL else odd, DIGEST, "left")
            once = told.filter("_n > 1 and not _known").dropDuplicates([DIGEST])
            batch = told.filter("_n is null").unionByName(once).drop("_n", "_known")
        batch.hint("rebalance", OBS_DATE).write.mode("append").partitionBy(OBS_DATE).parquet(raw_path)


def _met_before(batch: DataFrame, raw_path: str) -> DataFrame:
    """Digests that stand in the batch several times (``_n``) or have landed already (``_known``)."""
    spark = batch.sparkSession
    each = batch.groupBy(DIGEST).agg(F.count("*").alias("_n"))
    if not exists(spark, raw_path):
        return each.withColumn("_known", F.lit(False)).filter("_n > 1")
    landed = spark.read.schema(f"{RAW_LANDED}, {OBS_DATE} date").parquet(raw_path).select(DIGEST, OBS_DATE)
    dates = [r[0] for r in batch.select(OBS_DATE).distinct().limit(DATES + 1).collect()]
    if len(dates) <= DATES:
        landed = landed.filter(F.col(OBS_DATE).isin([d for d in dates if d]) | F.col(OBS_DATE).isNull())
    known = landed.select(DIGEST).distinct().withColumn("_known", F.lit(True))
    told = each.join(known, DIGEST, "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    return told.filter("_n > 1 or _known")
