"""Readers and writers for conversation, message and shard files."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str | list[str], sep: str = ",", quote: str = '"', schema: T.StructType | None = None, drop_null: str | None = None) -> DataFrame:
    """Header row, every column a string, quoted fields may span lines. ``drop_null``: rows with NULL there are left out."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", quote).option("quote", quote).option("sep", sep)
    reader = reader.option("encoding", "UTF-8").option("inferSchema", False).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    # a field without anything is NULL, a pair of quotes an empty text; by default both would be NULL
    reader = reader.option("nullValue", "\0").option("emptyValue", "")
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.na.drop(subset=[drop_null]) if drop_null else df


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Row groups are the splits; ``spark.sql.files.maxPartitionBytes`` sizes them."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def suffix(path: str) -> str:
    return PurePosixPath(path.rstrip("/")).suffix.lower()


def list_shards(spark: SparkSession, path: str) -> list[str]:
    """The file itself; of a directory its ``*.parquet`` in order, then its ``*.csv`` in order. Works on any Hadoop file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        raise FileNotFoundError(path)
    if suffix(path) in (".parquet", ".csv") or fs.getFileStatus(where).isFile():
        return [path]
    names = sorted(str(s.getPath()) for s in fs.listStatus(where))
    shards = [n for end in (".parquet", ".csv") for n in names if suffix(n) == end]
    if not shards:
        raise ValueError(f"no .parquet or .csv files in {path}")
    return shards


def first_lines(spark: SparkSession, paths: list[str], threads: int = 32) -> list[str]:
    """First line of each file, or of a folder's first file; one short read each."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def first(path: str) -> str:
        where = jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(conf)
        if fs.getFileStatus(where).isDirectory():
            parts = sorted((str(f.getPath()) for f in fs.listStatus(where) if f.isFile() and f.getPath().getName()[0] not in "._"))
            if not parts:
                return ""
            where = jvm.org.apache.hadoop.fs.Path(parts[0])
        stream = fs.open(where)
        try:
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine() or ""
        finally:
            stream.close()

    if len(paths) < 2:
        return [""] * len(paths)
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(first, paths))


def read_shards(spark: SparkSession, path: str, **csv: str) -> DataFrame:
    """One frame over all shards of a file or directory; columns are matched by name, missing ones are NULL."""
    shards = list_shards(spark, path)
    parquet, texts = [s for s in shards if suffix(s) == ".parquet"], [s for s in shards if suffix(s) == ".csv"]
    if len(parquet) + len(texts) < len(shards):
        raise ValueError(f"unsupported suffix: {path}")
    parts = [spark.read.option("mergeSchema", True).parquet(*parquet)] if parquet else []
    # one scan per distinct header: the plan doesn't grow with the number of shards
    headers: dict[str, list[str]] = {}
    for s, head in zip(texts, first_lines(spark, texts)):
        headers.setdefault(head, []).append(s)
    parts += [read_csv(spark, own, **csv) for own in headers.values()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_csv(df: DataFrame, path: str, sep: str = ",", quote: str = '"') -> None:
    """Header and minimal quoting, an empty text being a pair of quotes so that it isn't read as NULL; the committer moves
    finished files into place, so no half-written output is visible."""
    own = df.write.mode("overwrite").option("header", True).option("sep", sep).option("quote", quote).option("escape", quote).option("emptyValue", quote * 2)
    # the writer would strip white space at both ends of a field
    own.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write(df: DataFrame, path: str, **csv: str) -> None:
    """Format by suffix."""
    if suffix(path) == ".parquet":
        write_parquet(df, path)
    elif suffix(path) == ".csv":
        write_csv(df, path, **csv)
    else:
        raise ValueError(f"unsupported suffix: {path}")


def write_if_any(df: DataFrame, path: str, **csv: str) -> bool:
    """Nothing is written for an empty frame."""
    if df.isEmpty():
        return False
    write(df, path, **csv)
    return True


def save_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def output_path(path: str, ending: str, new_suffix: str | None = None) -> str:
    """``a/b.csv`` and ``_fixed`` give ``a/b_fixed.csv``."""
    p = PurePosixPath(path)
    return str(p.with_name(p.stem + ending + (new_suffix or p.suffix)))
