"""Scoring as stateless Structured Streaming jobs and as request tables.

The reference scored one flow record at a time through an HTTP call.  Here
the same per-record enrichment (clean content -> request JSON -> score ->
label and probability attached as string attributes) is a streaming query:
file source -> expressions -> parquet sink with a checkpoint, so a restarted
or retried job neither loses nor duplicates records.  Scoring happens in
process; a scorer is a function from DataFrame to DataFrame that adds
``prediction_label`` and ``prediction_prob``.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ocellus.functions import text as TX

Scorer = Callable[[DataFrame], DataFrame]

REQUEST_SCHEMA = T.StructType([T.StructField("image", T.StringType())])
RESPONSE_SCHEMA = T.StructType([T.StructField("prediction_label", T.StringType()),
                                T.StructField("prediction_prob", T.DoubleType())])


def threshold_scorer(value_col: str, scale: float = 100.0, cut: float = 50.0,
                     labels: tuple[str, str] = ("LOW", "HIGH")) -> Scorer:
    """Fixture scorer with an exact oracle: probability = 1 / (1 + exp(-v /
    scale)) rounded to 6, label = HIGH when v >= cut."""

    def score(df: DataFrame) -> DataFrame:
        v = F.col(value_col).cast("double")
        return (df.withColumn("prediction_prob", F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-v / F.lit(scale))), 6))
                .withColumn("prediction_label", F.when(v >= cut, F.lit(labels[1])).otherwise(F.lit(labels[0]))))

    return score


def format_attribute(p) -> F.Column:
    """Attributes are strings; probabilities get six fixed decimals."""
    return F.format_string("%.6f", p)


def enrich_records(df: DataFrame, content_col: str, scorer: Scorer) -> DataFrame:
    """Per record: content without CR/LF wrapped as ``{"image": ...}``,
    scored, label/probability attached as string attributes.  A record the
    scorer cannot score keeps flowing with ``error`` set (the reference had
    no failure route)."""
    cleaned = df.withColumn("content", TX.image_request_json(F.col(content_col)))
    scored = scorer(cleaned)
    return (scored
            .withColumn("attributes", F.create_map(
                F.lit("prediction_label"), F.col("prediction_label"),
                F.lit("prediction_prob"), format_attribute(F.col("prediction_prob"))))
            .withColumn("error", F.when(F.col("prediction_prob").isNull(), F.lit("not scored"))))


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def listing_tasks(spark: SparkSession):
    """A batch's files are listed by a Spark job with a task per file (up to
    10,000); few files a task are enough for as many tasks as the cluster
    runs at once.  A setting of the submitter's stays."""
    before = spark.conf.get(LISTING, None)
    if before in (None, "10000"):
        spark.conf.set(LISTING, str(max(32, 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.unset(LISTING) if before is None else spark.conf.set(LISTING, before)


def stream_to_sink(spark: SparkSession, source_dir: str, schema: T.StructType | str, transform: Callable,
                   sink_dir: str, checkpoint_dir: str, fmt: str = "parquet", options: dict | None = None,
                   max_files_per_trigger: int | None = None, clean_source: str | None = None,
                   archive_dir: str | None = None) -> None:
    """Run a file-source stream to completion (``availableNow``) into a
    parquet sink with its own checkpoint.

    ``clean_source="delete"`` (or ``"archive"`` with ``archive_dir``)
    removes input files once they are committed, as the flow processor
    removed each record after routing it; off by default."""
    reader = spark.readStream.format(fmt).schema(schema)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = transform(reader.load(source_dir))
    with listing_tasks(spark):
        q = (out.writeStream.format("parquet").option("path", sink_dir)
             .option("checkpointLocation", checkpoint_dir).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()


def run_stream(spark: SparkSession, source_dir: str, schema: T.StructType | str, transform: Callable,
               sink_dir: str, checkpoint_dir: str, **options) -> DataFrame:
    """``stream_to_sink``, and the sink as a table."""
    stream_to_sink(spark, source_dir, schema, transform, sink_dir, checkpoint_dir, **options)
    return spark.read.parquet(sink_dir)


OPEN_COST, LISTED = "spark.sql.files.openCostInBytes", "spark.sql.hive.filesourcePartitionFileCacheSize"


@contextmanager
def many_small_files(spark: SparkSession):
    """By default a file counts as 4 MB at least, so that a task reads a few
    dozen and the driver keeps account of thousands of tasks; small files read
    whole are counted nearly as they are (a setting of the submitter's stays).
    Files already listed, which no batch lists again, are not kept."""
    before = {key: spark.conf.get(key) for key in (OPEN_COST, LISTED)}
    if before[OPEN_COST] in ("4194304", "4194304b", "4MB"):
        spark.conf.set(OPEN_COST, str(64 << 10))
    spark.conf.set(LISTED, "0")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def run_folder_streams(spark: SparkSession, source_dir: str, schema: T.StructType | str, transform: Callable,
                       sink_dir: str, checkpoint_dir: str, **options) -> DataFrame:
    """``run_stream`` for each folder of ``source_dir``, one after the other,
    with a sink and a checkpoint of the folder's name; the sinks as one table.
    A file stream lists all files of its source on the driver and keeps the
    names it has seen, so a source of many small files is dealt out to folders
    and the driver holds the files of one of them.  A folder without accepted
    files gives no rows."""
    kinds = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    none = transform(spark.createDataFrame([], kinds))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = path(source_dir).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = store.listStatus(path(source_dir)) if store.exists(path(source_dir)) else []
    names = sorted(f.getPath().getName() for f in there if f.isDirectory())
    tables = []
    with many_small_files(spark):
        for name in names:
            if not name.startswith(("_", ".")):
                sink = f"{sink_dir}/{name}"
                stream_to_sink(spark, f"{source_dir}/{name}", schema, transform, sink, f"{checkpoint_dir}/{name}", **options)
                if store.exists(path(sink)):
                    tables.append(spark.read.schema(none.schema).parquet(sink))
    return reduce(DataFrame.unionByName, tables) if tables else none


def request_table(df: DataFrame, id_col: str, method_col: str, body_col: str) -> DataFrame:
    """Requests as rows: (id, method, JSON body)."""
    return df.select(F.col(id_col).alias("request_id"), F.col(method_col).alias("method"),
                     F.col(body_col).alias("body"))


def answer_requests(requests: DataFrame, decode_value: Callable, scorer: Scorer) -> DataFrame:
    """The scoring API as a table job: POST bodies are parsed, the image
    payload decoded (data-URI prefix and line breaks removed), scored and
    answered with JSON; GET has no answer (null response); an undecodable
    payload is answered with an error instead of failing the job."""
    req = requests.withColumn("_req", F.from_json("body", REQUEST_SCHEMA))
    raw = TX.decode_base64(F.col("_req.image"))
    dec = req.withColumn("_payload", F.when(F.col("method") == "POST", raw))
    scored = scorer(dec.withColumn("_value", decode_value(F.col("_payload"))))
    ok = (F.col("method") == "POST") & F.col("prediction_prob").isNotNull()
    return (scored
            .withColumn("prediction_label", F.when(ok, F.col("prediction_label")))
            .withColumn("prediction_prob", F.when(ok, F.col("prediction_prob")))
            .withColumn("response", F.when(ok, F.to_json(F.struct("prediction_label", "prediction_prob"))))
            .withColumn("error", F.when((F.col("method") == "POST") & ~ok, F.lit("bad request")))
            .drop("_req", "_payload", "_value"))
