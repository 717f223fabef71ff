"""Readers of the supported text formats, each with a declared schema.

Every reader returns the well-formed rows and, as `rejects (line)`, the lines that do
not fit, so that nothing disappears uncounted. Lines are parsed by Spark's own CSV
expression or by `split`; header lines are recognised by content, wherever they stand.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinia.session import store

LONGEST = 10_000  # lines of a record
FEW_BLOCKS = 100_000  # blocks of files that are copied to all tasks; more are joined

# Fixed column layout of the conditions file: patient, code and description stand at 2, 4 and 5.
CONDITION_COLUMNS = ("START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION")


class Adjacency(NamedTuple):
    vertices: DataFrame
    edges: DataFrame
    rejects: DataFrame


class Rows(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def read_adjacency(spark: SparkSession, path: str) -> Adjacency:
    """`user TAB friend,friend,…`; the list may be missing or empty.

    Users without friends are kept as vertices, repeated friends collapse and several
    lines of one user are merged. Blank lines and lines with a non-numeric id are rejected.
    """
    fields = F.split(F.trim("value"), "\t")
    listed = F.when(F.size(fields) == 2, F.get(fields, F.lit(1))).otherwise(F.lit(""))
    friends = F.filter(F.split(listed, ","), lambda f: F.trim(f) != "")
    parsed = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.expr("try_cast(split(trim(value), '\t')[0] AS BIGINT)").alias("id"),
        friends.alias("friends"),
    )
    numbers = F.transform("friends", lambda f: F.trim(f).try_cast("bigint"))
    parsed = parsed.withColumn("friends", numbers)
    good = F.col("id").isNotNull() & ~F.exists("friends", lambda f: f.isNull())
    rows = parsed.filter(good)
    return Adjacency(
        rows.select("id").distinct(),
        rows.select(F.col("id").alias("src"), F.explode("friends").alias("dst")).distinct(),
        parsed.filter(~good).select("line"),
    )


def _parsed(spark: SparkSession, path: str, schema: str, sep: str, header: Sequence[str] | None) -> DataFrame:
    """`(line, row, bad)` of all lines but the header's."""
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    if header:
        bare = F.regexp_replace(F.trim("line"), '"', "")
        lines = lines.filter(bare != sep.join(header))
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = lines.select("line", F.from_csv("line", f"{schema}, _bad string", options).alias("row"))
    bad = (F.trim("line") == "") | F.col("row").isNull() | F.col("row._bad").isNotNull()
    return parsed.withColumn("bad", bad)


def read_delimited(
    spark: SparkSession, path: str, schema: str, sep: str = ",", header: Sequence[str] | None = None
) -> Rows:
    """Delimited lines of a declared schema, fields optionally in double quotes.

    `header` names the fields of the header line, which is dropped in every file. Blank lines
    are rejected like all others that do not fit.
    """
    parsed = _parsed(spark, path, schema, sep, header)
    return Rows(
        parsed.filter(~F.col("bad")).select("row.*").drop("_bad"), parsed.filter("bad").select("line")
    )


def read_transactions(
    spark: SparkSession,
    path: str,
    basket: str = "PATIENT",
    item: str = "CODE",
    description: str = "DESCRIPTION",
    columns: Sequence[str] = CONDITION_COLUMNS,
) -> Rows:
    """`(basket, item, description)` of a CSV file with the given header."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    found = read_delimited(spark, path, schema, header=columns)
    rows = found.rows.select(
        F.col(basket).alias("basket"), F.col(item).alias("item"), F.col(description).alias("description")
    )
    return Rows(rows, found.rejects)


RATINGS = "user bigint, item bigint, rating double, ts bigint"
ITEMS = "item bigint, title string, genres string"


def read_ratings(
    spark: SparkSession, path: str, sep: str = "::", header: Sequence[str] | None = None
) -> Rows:
    """`(user, item, rating, ts)`; a file without header keeps its first line."""
    return read_delimited(spark, path, RATINGS, sep, header)


def read_items(spark: SparkSession, path: str, sep: str = "::", header: Sequence[str] | None = None) -> Rows:
    """`(item, title, genres)`."""
    return read_delimited(spark, path, ITEMS, sep, header)


def _all_numbers(fields: Column) -> Column:
    return F.transform(fields, lambda x: F.trim(x).try_cast("double"))


#: What the first field of a header line says.
FEATURE_LEVELS = ("feature", "statistics", "number", "track_id")


def read_features(spark: SparkSession, path: str, levels: Sequence[str] = FEATURE_LEVELS) -> Rows:
    """`(id, features)`: the first field is the id, all others are numbers.

    Header lines begin with the name of their level. Any other line without a numeric id,
    or with a field that is no number, is rejected.
    """
    fields = F.split("value", ",")
    first = F.trim(F.get(fields, F.lit(0)))
    parsed = spark.read.text(path).select(
        F.col("value").alias("line"),
        first.alias("first"),
        first.try_cast("bigint").alias("id"),
        _all_numbers(F.slice(fields, F.lit(2), F.greatest(F.size(fields) - 1, F.lit(0)))).alias("features"),
    )
    data = parsed.filter(~F.col("first").isin(list(levels)))
    bad = F.col("id").isNull() | F.exists("features", lambda x: x.isNull())
    return Rows(data.filter(~bad).select("id", "features"), data.filter(bad).select("line"))


def read_feature_names(spark: SparkSession, path: str, levels: Sequence[str] = ("feature", "statistics", "number")) -> list[str]:
    """Flat names `feature__statistic__nn` from the header lines, which begin with the level's name."""
    first = F.get(F.split("value", ","), F.lit(0))
    lines = spark.read.text(path).filter(first.isin(list(levels))).select("value").distinct().collect()
    by_level = {line[0].split(",")[0]: line[0].split(",")[1:] for line in lines}
    return ["__".join(parts) for parts in zip(*[by_level[level] for level in levels])]


def statistic_features(df: DataFrame, names: Sequence[str], statistic: str) -> DataFrame:
    """Keep the vector components of one statistic."""
    places = [i for i, name in enumerate(names) if f"__{statistic}__" in name]
    kept = F.transform(F.array(*[F.lit(i) for i in places]), lambda i: F.get("features", i))
    return df.withColumn("features", kept)


def read_labels(
    spark: SparkSession,
    path: str,
    subset: tuple[str, str] = ("set", "subset"),
    label: tuple[str, str] = ("track", "genre_top"),
    multi_line: bool = True,
) -> Rows:
    """`(id, subset, label)` of a table with a two-line column header; empty fields are null.

    The two header lines name each column's group and name; a third one may name the id
    only. Records may hold quoted line breaks, see `quoted_records`; `multi_line=False`
    spares the count of quotes and rejects lines that leave a quote open.
    """
    def positions(row: str) -> list[str]:
        return next(csv.reader([row]))

    marks = [F.col("value").contains(name) & F.col("value").startswith(",") for name in (subset[0], subset[1])]
    groups, names = [
        positions(spark.read.text(path).filter(mark).first()[0]) for mark in (marks[0] & ~marks[1], marks[1])
    ]
    place = {pair: i for i, pair in enumerate(zip(groups, names))}
    columns = [f"c{i}" for i in range(len(names))]
    schema = ", ".join(f"{c} string" for c in columns)
    if multi_line:
        records = quoted_records(spark, path)
    else:
        quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
        records = spark.read.text(path).select(F.col("value").alias("line"), (quotes % 2 == 1).alias("open"))
    row = F.from_csv("line", schema, {"quote": '"', "escape": '"', "multiLine": "true"})
    table = records.select("line", row.alias("row"), "open").select("line", "row.*", "open")
    fields = F.array(*[F.coalesce(F.col(c), F.lit("")) for c in columns])
    alone = F.array(F.lit("track_id"), *[F.lit("")] * (len(columns) - 1))
    heads = [F.array(*map(F.lit, groups)), F.array(*map(F.lit, names)), alone]
    data = table.filter(~(fields.eqNullSafe(heads[0]) | fields.eqNullSafe(heads[1]) | fields.eqNullSafe(heads[2])))
    good = F.col("c0").try_cast("bigint").isNotNull() & ~F.col("open")
    rows = data.filter(good).select(
        F.col("c0").try_cast("bigint").alias("id"),
        F.col(f"c{place[subset]}").alias("subset"),
        F.col(f"c{place[label]}").alias("label"),
    )
    return Rows(rows, data.filter(~good).select("line"))


def quoted_records(spark: SparkSession, path: str, longest: int = LONGEST) -> DataFrame:
    """`(line, open)`: the records of text files whose quoted fields may hold line breaks.

    A line begins a record if the number of quotes before it in its file is even. Each block of a file is
    counted by itself; sums over the blocks before it, of which there are few, then say where its records begin.
    Lines that are a record of their own never leave their task, only the lines of longer ones are gathered. A record of
    more than `longest` lines, as an unclosed quote makes of the rest of a file, comes line by line and as `open`.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )
    lines = store(lines, "lines")  # keeps the places
    before = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    # a line begins a record where the quotes before it in the block are as odd as those before the block
    blocks = lines.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), *[F.count_if(F.col("inside") == odd).alias(f"begin{odd}") for odd in (0, 1)]
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("odd", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("odd") == 0, F.col("begin0")).otherwise(F.col("begin1"))
    blocks = store(blocks.select("file", "block", "odd", F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("begun")), "blocks")
    so_far = Window.partitionBy("file", "block").orderBy("place")
    lines = lines.join(F.broadcast(blocks) if blocks.count() <= FEW_BLOCKS else blocks, ["file", "block"])
    begins = F.col("inside") == F.col("odd")
    lines = lines.withColumn("record", F.col("begun") + F.count_if(begins).over(so_far)).withColumn("begins", begins)
    lines = lines.select("file", "place", "line", "quotes", "record", "begins")
    alone = F.col("begins") & (F.col("quotes") % 2 == 0)
    several = store(lines.filter(~alone), "broken_lines")
    sizes = several.groupBy("file", "record").agg(F.count(F.lit(1)).alias("n"), (F.sum("quotes") % 2 == 1).alias("open"))
    sized = several.join(sizes, ["file", "record"])
    whole = (
        sized.filter(F.col("n") <= longest)
        .groupBy("file", "record")
        .agg(F.sort_array(F.collect_list(F.struct("place", "line"))).alias("all"), F.first("open").alias("open"))
        .select(F.array_join(F.transform("all", lambda x: x.line), "\n").alias("line"), "open")
    )
    too_long = sized.filter(F.col("n") > longest).select("line", F.lit(True).alias("open"))
    return lines.filter(alone).select("line", F.lit(False).alias("open")).union(whole).union(too_long)


ASSIGNMENTS = "id bigint, kind string, cluster string"


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    """The map from id to cluster as written by `write_assignments`."""
    return spark.read.schema(ASSIGNMENTS).parquet(path)


def read_labelled(spark: SparkSession, path: str, label: str = "Label", columns: Sequence[str] | None = None) -> Rows:
    """`(id, label, features vector)` of a CSV file with header whose columns are numbers.

    The id is a hash of the line; equal lines share it, which the folds do not mind. Lines
    with an empty field are rejected.
    """
    if columns is None:
        columns = next(csv.reader([spark.read.text(path).first()[0]]))
    schema = ", ".join(f"`{c}` double" for c in columns)
    parsed = _parsed(spark, path, schema, ",", columns)
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(f"row.`{c}`").isNull()
    parsed = parsed.withColumn("bad", F.col("bad") | missing)
    complete = parsed.filter(~F.col("bad")).select("row.*").drop("_bad")
    rows = VectorAssembler(inputCols=[c for c in columns if c != label], outputCol="features").transform(complete)
    return Rows(
        rows.select(F.xxhash64(*columns).alias("id"), F.col(label).alias("label"), "features"),
        parsed.filter("bad").select("line"),
    )
