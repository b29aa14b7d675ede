"""Tab-separated sources and sinks, the normalised parquet cache, and the submission bundle.

Paths go through Hadoop's file systems, so local, distributed and mounted paths are all the same.
"""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from weftline.functions import text

COLUMNS = ("entity_id", "business_name", "business_address", "country")
#: Source order: rows of a file stand in order below this bit, sources above it.
SOURCE_BIT = 56


def file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = file_system(spark, path)
    return fs.exists(hadoop)


def modified(spark: SparkSession, path: str) -> int:
    fs, hadoop = file_system(spark, path)
    return fs.getFileStatus(hadoop).getModificationTime()


def data_dir(spark: SparkSession, root: str, split: str) -> str:
    """`data/` under the root, or `dataset/` where only that holds the split's files."""
    for name in ("data", "dataset"):
        path = f"{root}/{name}/{split}"
        if exists(spark, path):
            fs, hadoop = file_system(spark, path)
            if any(s.getPath().getName().endswith(".tsv") for s in fs.listStatus(hadoop)):
                return path
    return f"{root}/data/{split}"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(no, value): the lines of a file with numbers that grow in file order."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("no"), "value")


def load_tsv(spark: SparkSession, path: str, rows: int | None = None) -> DataFrame:
    """A source as text columns, empty for missing values, with `no` growing in file order; columns may be missing.

    Quoting is standard; short rows are padded; a file whose header has one column but whose rows have tabs, and
    a row with too many columns, are refused. `rows` keeps the first rows of the file.
    """
    if not exists(spark, path):
        raise FileNotFoundError(path)
    head = spark.read.text(path).limit(2).collect()
    header = head[0].value.split("\t") if head else []
    if len(header) == 1 and len(head) > 1 and "\t" in head[1].value:
        raise ValueError(f"{path}: the header has one column, its rows have more")
    names = [h.strip().strip('"') for h in header]
    schema = StructType([StructField(n, StringType()) for n in (*names, "_rest")])
    raw = spark.read.csv(path, sep="\t", header=True, schema=schema, quote='"', escape='"', multiLine=True, enforceSchema=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    columns = [F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names]
    columns += [F.lit("").alias(c) for c in COLUMNS if c not in names]
    too_long = F.raise_error(F.lit(f"{path}: a row has more columns than the header"))
    out = raw.select(*columns, F.when(F.col("_rest").isNotNull(), too_long.cast("bigint")).otherwise(F.monotonically_increasing_id()).alias("no"))
    return out.where(F.col("no") < rows) if rows is not None and rows < 1 << 33 else out


def normalised(source: DataFrame, src: int, full: bool = False) -> DataFrame:
    """A source as records: `src`, `ord` and the normalised name, address and country."""
    return source.select(
        *COLUMNS,
        F.lit(src).alias("src"),
        (F.lit(src << SOURCE_BIT) + F.col("no")).alias("ord"),
        text.business_name(F.col("business_name"), full=full).alias("norm_name"),
        text.address(F.col("business_address"), full=full).alias("norm_address"),
        text.country(F.col("country"), full=full).alias("norm_country"),
        *(c for c in source.columns if c not in (*COLUMNS, "no", "src", "ord")),
    )


def load_source(spark: SparkSession, path: str, src: int, rows: int | None = None, cache: str | None = None, full: bool = True) -> DataFrame:
    """Records of one source, by way of a parquet cache that is written where it is older than the source.

    `full` transliterates other scripts as well; without it their letters are lost to the keys.
    """
    if cache is None or rows is not None:
        return normalised(load_tsv(spark, path, rows), src, full)
    if not (exists(spark, f"{cache}/_SUCCESS") and modified(spark, f"{cache}/_SUCCESS") >= modified(spark, path)):
        normalised(load_tsv(spark, path), src, full).write.mode("overwrite").parquet(cache)
    return spark.read.parquet(cache)


def load_ground_truth(spark: SparkSession, path: str, s1: DataFrame | None = None) -> DataFrame:
    """(s1_id, matched_ids): a row for each entity, trimmed ids without blanks or repeats; the header is optional.

    Of repeated rows the last counts. `s1` (entity_id) restricts the rows.
    """
    parts = F.split("value", "\t")
    lines = numbered_lines(spark, path).where("trim(value) <> ''").select("no", F.trim(parts[0]).alias("s1_id"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("list"))
    lines = lines.where(F.lower("s1_id") != "source1_entity_id")
    ids = F.array_distinct(F.filter(F.transform(F.split("list", ","), lambda x: F.trim(x)), lambda x: x != ""))
    out = lines.groupBy("s1_id").agg(F.max_by(ids, "no").alias("matched_ids"))
    return out if s1 is None else out.join(s1.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")


def links(truth: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(s1_id) of all entities, singletons included, and (s1_id, target_id) of the known links."""
    return truth.select("s1_id"), truth.select("s1_id", F.explode("matched_ids").alias("target_id"))


def load_split(spark: SparkSession, folder: str, prefix: str, sample_s1: int | None = None, cache: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """All records of a split, and its ground truth where `prefix` is train and there is one."""
    sources = [load_source(spark, f"{folder}/{prefix}_source{k}.tsv", k, sample_s1 if k == 1 else None, f"{cache}/{prefix}_source{k}" if cache else None) for k in (1, 2, 3)]
    records = sources[0].unionByName(sources[1], allowMissingColumns=True).unionByName(sources[2], allowMissingColumns=True)
    truth = f"{folder}/{prefix}_ground_truth.tsv"
    known = load_ground_truth(spark, truth, sources[0]) if prefix == "train" and exists(spark, truth) else None
    return records, known


def export_tsv(lists: DataFrame, path: str, column: str, ids: str) -> None:
    """Write (s1_id, ids) as one tab-separated file with a header: sorted by entity, ids joined by commas.

    Executors write sorted parts beside the file; the driver's JVM strings them together as streams of bytes.
    """
    spark = lists.sparkSession
    fs, target = file_system(spark, path)
    parts = file_system(spark, f"{path}.parts")[1]
    out = lists.select(F.col("s1_id").alias("source1_entity_id"), F.concat_ws(",", ids).alias(column))
    out.orderBy("source1_entity_id").write.mode("overwrite").csv(f"{path}.parts", sep="\t", header=False, emptyValue="", nullValue="", quoteAll=False)
    if fs.exists(target):
        fs.delete(target, True)
    stream = fs.create(target, True)
    stream.write(bytearray(f"source1_entity_id\t{column}\n".encode()))
    for part in sorted((s.getPath() for s in fs.listStatus(parts)), key=lambda p: p.getName()):
        if part.getName().startswith("part-"):
            source = fs.open(part)
            spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, stream, 1 << 16, False)
            source.close()
    stream.close()
    fs.delete(parts, True)


def package(folder: str, files: list[str], archive: str, strict: bool = False) -> list[str]:
    """Bundle local files into a zip archive; returns the missing ones, which `strict` refuses."""
    missing = [f for f in files if not (Path(folder) / f).is_file()]
    if missing and strict:
        raise FileNotFoundError(", ".join(missing))
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as bundle:
        for f in files:
            if f not in missing:
                bundle.write(Path(folder) / f, f)
    return missing
