"""Raw exports: CSV in Latin-1 or gzip, permissive casts, and Parquet caches of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.functions.columns import c


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, encoding: str = "UTF-8", sep: str = ",", quote: str | None = '"') -> DataFrame:
    """All columns as text, by the header or the names given. Only an empty field is null: None and NA are
    data. A .gz file is read by one task and should be written to Parquet once (see cached)."""
    reader = spark.read.option("header", True).option("encoding", encoding).option("sep", sep).option("nullValue", "").option("emptyValue", "").option("quote", quote or "").option("escape", quote or "").option("multiLine", encoding.upper() != "UTF-8")
    df = reader.csv(path)
    return df.select(*[c(x) for x in columns]) if columns else df


def read_latin1_csv(spark: SparkSession, path: str, types: Mapping[str, str]) -> DataFrame:
    """A Latin-1 CSV with known types; text that isn't of its type is null."""
    return cast_columns(read_csv(spark, path, encoding="ISO-8859-1"), types)


def read_gzip_csv(spark: SparkSession, path: str, types: Mapping[str, str], partitions: int | None = None) -> DataFrame:
    """A gzip CSV; it can't be split, so its rows are spread before they are cast."""
    df = read_csv(spark, path)
    return cast_columns(df.repartition(partitions) if partitions else df, types)


def read_tab_concepts(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated vocabulary without quoting, all text."""
    return read_csv(spark, path, sep="\t", quote=None)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Known columns cast, those that don't fit null; other columns as they are."""
    return df.select(*[(c(x).try_cast(types[x]).alias(x) if x in types else c(x)) for x in df.columns])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system that Spark knows."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def cached(spark: SparkSession, path: str, build, rebuild: bool = False) -> DataFrame:
    """The Parquet dataset at path, made by build() and written first if it isn't there (or rebuild). A
    dataset is there once it has been written whole: it appears by a rename."""
    from wardgrid.sources.sinks import replace

    if rebuild or not exists(spark, path):
        replace(build(), path)
    return spark.read.parquet(path)


def input_mode(spark: SparkSession, csv: str, shards: str | None) -> str:
    """`shards` if there is such a dataset, else `csv` if there is such a file; neither is an error."""
    if shards and exists(spark, shards):
        return "shards"
    if exists(spark, csv):
        return "csv"
    raise FileNotFoundError(f"neither {shards} nor {csv}")


def prefer(spark: SparkSession, derived: str, raw: str) -> str:
    """The derived dataset's path if it is there, else the raw one's."""
    return derived if exists(spark, derived) else raw


def read_ids(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Ids of a text file, one a line; what isn't a number is passed over."""
    return spark.read.text(path).select(F.trim("value").try_cast("bigint").alias(key)).filter(f"{key} is not null").distinct()


def scoped(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, list[str]]:
    """(df's rows of the listed ids, warnings): how many ids df doesn't have, and the first few of them."""
    unknown = ids.join(df.select(key).distinct(), key, "left_anti")
    n, few = unknown.count(), [str(r[0]) for r in unknown.orderBy(key).limit(10).collect()]
    return df.join(ids, key, "left_semi"), [f"{n} ids of {key} are unknown, such as {', '.join(few)}"] if n else []
