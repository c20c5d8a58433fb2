"""Tables that the library writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.panel import KEY, high_water_mark, upsert


def exists(spark: SparkSession, path: str) -> bool:
    return files(spark, path).exists(at(spark, path))


def write_panel(df: DataFrame, path: str) -> None:
    """Overwrite a table, partitioned by year so that date filters prune files."""
    df.withColumn("year", F.year("trade_date")).repartition("year").write.mode("overwrite").partitionBy("year").parquet(path)


def upsert_panel(new: DataFrame, path: str, key: list[str] = KEY) -> bool:
    """Merge rows into a stored panel, newest value that isn't null first; only the years that ``new`` touches are rewritten.

    Returns whether anything was written: an empty ``new`` leaves the table alone.  The merged years are written beside the table,
    marked as whole, and only then take their places; a run that dies before the mark changes nothing, and one that dies after it is
    finished by whatever opens the table next (``settle``).
    """
    spark = new.sparkSession
    settle(spark, path)
    years = [r[0] for r in new.select(F.year("trade_date").alias("y")).distinct().collect()]
    if not years:
        return False
    if exists(spark, path):
        old = spark.read.parquet(path)
        new = upsert(old.where(F.col("year").isin(years)).drop("year"), new, key)
    new.withColumn("year", F.year("trade_date")).repartition("year").write.mode("overwrite").partitionBy("year").parquet(f"{path}.next")
    files(spark, path).create(at(spark, f"{path}.next/{WHOLE}")).close()
    settle(spark, path)
    return True


#: Marks a set of years beside a table as whole.
WHOLE = "_whole"


def at(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def files(spark: SparkSession, path: str):
    return at(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def settle(spark: SparkSession, path: str) -> bool:
    """Finish or forget an upsert that didn't end; returns whether years took their places.  To do so again changes nothing."""
    beside = f"{path}.next"
    if not exists(spark, beside):
        return False
    whole = exists(spark, f"{beside}/{WHOLE}")
    if whole and not exists(spark, path):
        files(spark, path).rename(at(spark, beside), at(spark, path))
        files(spark, path).delete(at(spark, f"{path}/{WHOLE}"), False)
        return True
    if whole:
        take_places(spark, beside, path)
    files(spark, path).delete(at(spark, beside), True)
    return whole


def take_places(spark: SparkSession, beside: str, path: str) -> None:
    """The years beside a table replace its own."""
    spark.read.parquet(beside).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def upsert_outputs(new: dict[str, DataFrame], expected: list[str], root: str) -> list[str]:
    """Upsert several outputs; one that is expected and missing is an error before anything is written.  Returns those written."""
    gone = sorted(set(expected) - set(new))
    if gone:
        raise ValueError(f"missing outputs: {gone}")
    return [n for n, df in new.items() if upsert_panel(df, f"{root}/{n}")]


def latest_date(spark: SparkSession, path: str, default: str) -> str:
    """High-water mark of a stored panel as text, or the default."""
    settle(spark, path)
    return str(high_water_mark(spark.read.parquet(path), default).first()["latest"]) if exists(spark, path) else default


def write_csv(df: DataFrame, path: str) -> None:
    """A small result for people: one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
