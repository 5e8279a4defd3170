"""Reading and writing of record tables, truths and result lists.

Raw files are tab-separated without quoting. Missing columns and nulls are empty
strings; other columns are dropped.
"""

from __future__ import annotations

import json

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.address import ADDRESS_VIEWS, address_views
from tessera.functions.text import NAME_VIEWS, country, name_views
from tessera.shared import join_slim, materialize, ranked

RAW = ("entity_id", "business_name", "business_address", "country")


def read_tsv(spark: SparkSession, path: str, columns: tuple = RAW, position: str | None = None) -> DataFrame:
    """The named columns of a headed tab-separated file, by name, as strings; and, if named, a column that grows with the row's place:
    by file name, then in the file. Readers open large files first, so the rows' order of reading says nothing across files."""
    df = spark.read.csv(path, sep="\t", header=True, quote="", escape="", inferSchema=False, nullValue="\0", emptyValue="")
    named = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns]
    place = F.struct("_metadata.file_path", F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    return df.select(*named, *([place.alias(position)] if position else []))


def write_tsv(df: DataFrame, path: str, compression: str = "none") -> None:
    # Compressed fast: what is saved is the disk that files of long lists take until they are read.
    writer = df.write.mode("overwrite").option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
    writer.csv(path, sep="\t", header=True, quote="", escape="", emptyValue="")


def packed(text: Column) -> Column:
    """Texts of many bytes as binaries of few, to be shuffled: the length in 8 bytes, and Zstandard."""

    def run(texts: pd.Series) -> pd.Series:
        codec = pa.Codec("zstd", 1)
        return texts.map(lambda t: len(b := t.encode()).to_bytes(8) + codec.compress(b, asbytes=True))

    return F.pandas_udf(run, "binary")(text)


def unpacked(binary: Column) -> Column:
    def run(binaries: pd.Series) -> pd.Series:
        codec = pa.Codec("zstd")
        return binaries.map(lambda b: codec.decompress(memoryview(b)[8:], int.from_bytes(b[:8]), asbytes=True).decode())

    return F.pandas_udf(run, "string")(binary)


def rows_of_both(spark: SparkSession, one: tuple[str, str], two: tuple[str, str], entity: str = "source1_entity_id", parts: int = 8) -> DataFrame:
    """place (from 0), entity and a list of each of two result files, (path, header), in which every entity has one row: rows that have the
    same place and entity in both. Places are found without the lists, which are shuffled once, packed."""

    def lines(file: tuple[str, str]) -> DataFrame:
        # The two columns that write_tsv writes: a parser of any columns takes several times as long over long lists.
        rows = spark.read.text(file[0]).filter(F.col("value") != f"{entity}\t{file[1]}")
        at = F.struct("_metadata.file_path", F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
        name = F.substring_index("value", "\t", 1)
        return rows.select(name.alias(entity), F.expr("substring(value, instr(value, '\t') + 1)").alias(file[1]), at.alias("at"), F.lit(1).alias("file"))

    place = lambda file: ranked(lines(file).select(entity, "file", "at"), ["file"], [F.col("at")], parts).select(entity, (F.col("rank") - 1).alias("place"))
    places = materialize(place(one).join(place(two), ["place", entity]), "places")
    a, b = (lines(file).select(entity, packed(F.col(file[1])).alias(file[1])) for file in (one, two))
    # Lists are many times their number of rows: the optimizer's sizes would have one of them sent to all.
    met = a.hint("shuffle_merge").join(b, entity)
    return join_slim(met, places, [entity], "inner").select("place", entity, *[unpacked(F.col(c)).alias(c) for c in (one[1], two[1])])


def truth_pairs(lines: DataFrame, text: str = "value", order: str | None = None) -> DataFrame:
    """entity, pool from lines 'entity TAB id,id': the header goes, empty ids go, and of lines with one
    entity the last in the order column counts (file order where the rows have none)."""
    order_col = F.col(order) if order else F.monotonically_increasing_id()
    rows = lines.select(order_col.alias("_o"), F.split(F.col(text), "\t", 2).alias("_p")).filter(F.size("_p") == 2)
    rows = rows.select("_o", F.col("_p")[0].alias("entity"), F.col("_p")[1].alias("ids")).filter(F.col("entity") != "source1_entity_id")
    last = rows.groupBy("entity").agg(F.max_by("ids", "_o").alias("ids"))
    ids = F.filter(F.transform(F.split("ids", ","), lambda t: F.trim(t)), lambda x: x != "")
    return last.select("entity", F.explode(ids).alias("pool"))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return truth_pairs(spark.read.text(path))


def normalised(raw: DataFrame, src: int) -> DataFrame:
    """Records with name and address views; a raw table's rows keep their ids."""
    parsed = raw.select(F.lit(src).alias("src"), F.col("entity_id").alias("eid"), country("country").alias("country"), F.col("business_name").alias("raw_name"), F.col("business_address").alias("raw_addr"), name_views(F.col("business_name")).alias("n"), address_views(F.col("business_address")).alias("a"))
    names = [F.col(f"n.{c}").alias(f"n_{c}") for c in NAME_VIEWS]
    parts = [F.col(f"a.{c}").alias(f"a_{c}") for c in ADDRESS_VIEWS]
    return parsed.select("src", "eid", "country", "raw_name", "raw_addr", *names, *parts).withColumn("addr_empty", (F.size("a_comps") == 0).cast("int"))


def pool_of(second: DataFrame, third: DataFrame) -> DataFrame:
    return normalised(second, 2).unionByName(normalised(third, 3))


def stage(df: DataFrame, path: str, by: tuple = (), force: bool = False) -> DataFrame:
    """Writes df to path unless a finished result is there, and reads it."""
    spark = df.sparkSession
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if force or not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        df.write.mode("overwrite").option("compression", "zstd").partitionBy(*by).parquet(path)
    return spark.read.parquet(path)


def countries(df: DataFrame) -> list[str]:
    return sorted(r.country for r in df.select("country").distinct().collect())


def id_lists(entities: DataFrame, pairs: DataFrame, entity: str, item: str, chosen: str | None = None, order: str | None = None) -> DataFrame:
    """One row per entity: its items, comma-joined in the given order (else sorted as text), empty allowed; and, with a flag
    column, those chosen. The chosen are a subset of all by construction. Other columns of entities stay."""
    key = [order] if order else []
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_set(c)), lambda x: x[item]), ",")
    place = F.struct(*key, item)
    sums = [joined(place).alias("ids")] + ([joined(F.when(F.col(chosen), place)).alias("chosen_ids")] if chosen else [])
    lists = pairs.groupBy(entity).agg(*sums)
    names = ["ids"] + (["chosen_ids"] if chosen else [])
    return entities.join(lists, entity, "left").select(*entities.columns, *[F.coalesce(n, F.lit("")).alias(n) for n in names])


def write_lists(lists: DataFrame, path: str, entity: str, order: str, matches: str = "chosen_ids", all_ids: str = "ids") -> None:
    """The two result lists as folders of tab-separated files, matching_results.tsv and candidate_pairs.tsv, rows in the given order."""
    for name, column, header in (("matching_results", matches, "matched_entity_ids"), ("candidate_pairs", all_ids, "candidate_entity_ids")):
        write_tsv(lists.orderBy(order).select(F.col(entity).alias("source1_entity_id"), F.col(column).alias(header)), f"{path}/{name}.tsv")


def write_block_lists(entities: DataFrame, blocks: DataFrame, on: list[str], path: str, entity: str, order: str, lists: dict, most: int = 64 << 20, compression: str = "none") -> None:
    """The result lists of entities whose candidates are the whole block that they share columns ``on`` with: lists are made in the row that
    is written, and no pair or list is shuffled. blocks: materialized, ``on``, the column ids and what else lists need; lists: name of a
    file to its header and a column. Entities are dealt in the given order before they meet blocks, which are
    copied to all where they have ``most`` characters at most; more of them meet first, and rows are dealt then."""
    size, total = (x or 0 for x in blocks.select(F.length("ids").alias("_n"), *on).join(entities.groupBy(*on).agg(F.count("*").alias("_k")), on, "left").agg(F.sum("_n"), F.sum(F.col("_n") * F.col("_k"))).first())
    # Rows are sorted with their lists: about 32 MB a part.
    parts = max(int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions")), total >> 25)
    if size <= most:
        rows = entities.repartitionByRange(parts, order).join(F.broadcast(blocks), on, "left")
    else:
        rows = entities.join(blocks, on, "left").repartitionByRange(parts, order)
    rows = rows.sortWithinPartitions(order)
    for name, (header, column) in lists.items():
        write_tsv(rows.select(F.col(entity).alias("source1_entity_id"), F.coalesce(column, F.lit("")).alias(header)), f"{path}/{name}.tsv", compression)


def read_lists(spark: SparkSession, path: str) -> DataFrame:
    """s1_id, ids of a result list, whatever its header; rows without a tab have no ids."""
    fields = F.split("value", "\t", 2)
    rows = spark.read.text(path).select(F.trim(fields[0]).alias("s1_id"), F.coalesce(F.get(fields, 1), F.lit("")).alias("ids"))
    return rows.filter((F.col("s1_id") != "") & (F.col("s1_id") != "source1_entity_id"))


def read_ids(spark: SparkSession, path: str, header: str = "entity_id") -> DataFrame:
    """Distinct ids of a tab-separated file's first column."""
    ids = spark.read.text(path).filter(F.trim("value") != "").select(F.trim(F.split_part("value", F.lit("\t"), F.lit(1))).alias("id"))
    return ids.filter(F.col("id") != header).distinct()


def write_by_country(df: DataFrame, path: str) -> None:
    """A folder per country, so that a scan of one reads nothing else."""
    df.write.mode("overwrite").option("compression", "zstd").partitionBy("country").parquet(path)


def read_country(spark: SparkSession, path: str, country_name: str, columns: list[str]) -> DataFrame:
    return spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(path).filter(F.col("country") == country_name).select(*columns)


def exploded_lists(lists: DataFrame, entity: str, ids: str = "ids") -> DataFrame:
    """entity, item of comma lists, with repetitions."""
    return lists.select(entity, F.explode(F.filter(F.transform(F.split(ids, ","), lambda t: F.trim(t)), lambda x: x != "")).alias("item"))


def save_dictionary(df: DataFrame, path: str) -> None:
    """A learned table as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def load_dictionary(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def save_settings(spark: SparkSession, settings: dict, path: str) -> None:
    """A few values as one JSON row in a folder that Spark can reach."""
    spark.createDataFrame([(json.dumps(settings),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_settings(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=False).first()[0])
