"""File sources: image folders, labelled folder trees, URL manifests and
feature CSVs.  All are Spark's own readers; nothing is listed or read on
the driver."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ocellus.functions import text as TX


def read_images(spark: SparkSession, path: str, drop_invalid: bool = True, recursive: bool = True) -> DataFrame:
    """One row per decodable image: ``image`` struct (origin, height, width,
    nChannels, mode, data in BGR order).  With ``drop_invalid=False`` bad
    files come back with height -1 (not null), so filter ``height > 0``."""
    return (spark.read.format("image").option("dropInvalid", drop_invalid)
            .option("recursiveFileLookup", recursive).load(path))


def valid_images(df: DataFrame, image_col: str = "image") -> DataFrame:
    return df.where(F.col(image_col).isNotNull() & (F.col(f"{image_col}.height") > 0))


def labelled_images(spark: SparkSession, path: str, label: int) -> DataFrame:
    """Folder of one class with a literal label, undecodable files dropped."""
    return valid_images(read_images(spark, path)).withColumn("label", F.lit(int(label)))


def labelled_dir_scan(spark: SparkSession, root: str, allowed: Iterable[str] | None = None,
                      with_content: bool = False) -> DataFrame:
    """``root/<class>/<file>`` -> (path, class, [content]); class = parent
    folder name.  The path is the key; nothing is sorted."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    cols = [F.col("path"), F.element_at(F.split("path", "/"), -2).alias("class"), F.col("length")]
    if with_content:
        cols.append(F.col("content"))
    out = df.select(*cols)
    if allowed is not None:
        out = out.where(TX.extension_allowed(TX.file_name("path"), allowed, require_dot=True))
    return out


def with_class_labels(scan: DataFrame, class_mode: str | None = "categorical") -> DataFrame:
    """The directory generator's label columns: none for ``class_mode=None``;
    for ``"categorical"`` the alphabetical class index and a full-width
    one-hot."""
    if class_mode is None:
        return scan
    if class_mode != "categorical":
        raise ValueError(f"unsupported class_mode {class_mode!r}")
    from ocellus.operators.features import class_index_table, one_hot

    table = class_index_table(scan, "class")
    return one_hot(scan.join(table, "class", "left"), "class_index", table.count())


def class_file_counts(scan: DataFrame) -> DataFrame:
    return scan.groupBy("class").agg(F.count(F.lit(1)).alias("n_files"))


def read_url_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line; blank lines are kept as empty URLs (they fail to
    fetch and get an ``error`` outcome)."""
    return spark.read.text(path).select(F.col("value").alias("url"))


def write_url_manifest(df: DataFrame, url_col: str, path: str) -> None:
    df.select(F.col(url_col).alias("value")).write.mode("overwrite").text(path)


def read_feature_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                     infer: bool = False) -> DataFrame:
    """Header CSV of a label column plus numeric features.  Pass a schema on
    large inputs; inference costs a full extra pass."""
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


#: Types that a CSV column may get, the narrowest first, and what their texts
#: look like: a cast that fails is slow, so only such texts are cast.
CSV_TYPES = {"bigint": r"^\s*[+-]?\d+\s*$", "double": r"^\s*[+-]?(?:\.?\d|[Nn]a[Nn]|[Ii]nf)", "boolean": r"^\s*(?i:t|true|y|yes|1|f|false|n|no|0)[\x00-\x20\x7F-\x9F]*$",
             "timestamp": r"^\s*\d{4,6}-"}
CORRUPT = "_corrupt_record"


def infer_csv_types(texts: DataFrame, columns: list[str], share: float = 0.9) -> dict[str, str]:
    """The narrowest of ``CSV_TYPES`` that at least ``share`` of a column's
    values (nulls aside) can be read as; ``string`` if there is none.  One
    aggregate over all rows, in which each value is a row of its column; only
    counts reach the driver."""
    if not columns:
        return {}
    values = texts.select(F.posexplode(F.array(*[F.col(c) for c in columns])).alias("column", "value"))
    found = {row["column"]: row for row in values.where(F.col("value").isNotNull()).groupBy("column").agg(
        F.count("value").alias("n"), *[F.count(F.when(F.col("value").rlike(shape), F.col("value").try_cast(t))).alias(t)
                                       for t, shape in CSV_TYPES.items()]).collect()}
    return {c: next((t for t in CSV_TYPES if i in found and found[i][t] >= share * found[i]["n"]), "string")
            for i, c in enumerate(columns)}


def read_checked_csv(spark: SparkSession, path: str, share: float = 0.9,
                     types: dict[str, str] | None = None, escape: str = "\\") -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` rows of a header CSV (``escape``: before a quote inside quotes).  Column types are inferred over all
    rows (or given).  A line with another number of fields, or with a value
    that its column's type can't hold, goes to ``bad`` as ``line, reason``."""
    reader = spark.read.option("header", True).option("escape", escape)
    names = reader.csv(path).columns
    schema = ", ".join(f"`{c}` string" for c in names) + f", `{CORRUPT}` string"
    rows = reader.option("columnNameOfCorruptRecord", CORRUPT).schema(schema).csv(path)
    whole = rows.where(F.col(CORRUPT).isNull())
    types = types or infer_csv_types(whole, names, share)
    wrong = {c: F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in types.items()}
    typed = reduce(lambda a, b: a | b, wrong.values(), F.lit(False))
    line = F.to_csv(F.struct(*[F.col(c) for c in names]))
    reason = F.when(F.col(CORRUPT).isNotNull(), "fields").otherwise(F.concat(
        F.lit("type of "), F.array_join(F.array_compact(F.array(*[F.when(w, F.lit(c)) for c, w in wrong.items()])), ", ")))
    good = rows.where(F.col(CORRUPT).isNull() & ~typed).select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])
    bad = rows.where(F.col(CORRUPT).isNotNull() | typed).select(F.coalesce(F.col(CORRUPT), line).alias("line"), reason.alias("reason"))
    return good, bad
