"""Session construction, table loading and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "ocellus") -> SparkSession:
    """Session for tests and the bench.  On a cluster the submitter's
    configuration wins: ``getOrCreate`` keeps an existing session."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the session has none (tests, the local bench) a fresh temporary
    folder is made and registered; on a cluster the configured shared folder
    is always used.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ocellus-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the shared checkpoint folder for a
    written intermediate table (feature store, stream sink, model)."""
    base = ensure_checkpoint_dir(spark)
    # the SparkContext registers a per-app subfolder; keep ours beside it
    base = base.rstrip("/")
    return f"{base}/ocellus/{name}-{uuid.uuid4().hex[:12]}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ocellus`` importable in every Python worker (pandas UDFs and
    grouped-map functions are pickled by reference): zip the package once per
    application and hand it to ``addPyFile``, which distributes it.  The zip
    is named by a hash of its sources, so the same code is never registered
    twice under different names; if Spark refuses it (the package was already
    shipped another way, e.g. ``--py-files``), the existing copy is used."""
    import hashlib
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    sources = []
    for d, _, files in sorted(os.walk(pkg)):
        for f in sorted(files):
            if f.endswith(".py"):
                sources.append(os.path.join(d, f))
    digest = hashlib.sha1()
    for full in sources:
        digest.update(os.path.relpath(full, root).encode())
        with open(full, "rb") as fh:
            digest.update(fh.read())
    zpath = os.path.join(tempfile.mkdtemp(prefix="ocellus-pkg-"), f"ocellus_{digest.hexdigest()[:12]}.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for full in sources:
            z.write(full, os.path.relpath(full, root))
    try:
        sc.addPyFile(zpath)
    except Exception as e:
        if "already" not in str(e):     # distributed by the submitter: keep theirs
            raise
    _SHIPPED.add(sc.applicationId)


#: Batches that go to Python workers: small enough that long texts and images
#: need little memory there.
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
               "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def prepare(spark: SparkSession) -> str:
    """Everything a registered query needs from the session: the package on
    the workers, bounded Arrow batches (unless the submitter has set them) and
    a checkpoint folder.  Returns the checkpoint folder."""
    ship_package(spark)
    for key, value in ARROW_BATCH.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return ensure_checkpoint_dir(spark)
