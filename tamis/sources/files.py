"""Reading batches and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamis.functions import json
from tamis.operators.checks import ContractError, assert_columns, long_form


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_json_batch(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Records of JSON batch files as (fichier, position, record), the record being its own text.

    By lines there is no position, only the start of the block (``bloc``) that the line was read from.

    A batch file is one JSON array, written with or without line breaks; it is the unit of work,
    since an array cannot be split. ``lines`` reads one record per line instead, which splits
    files of any size. A file whose root is no list, or whose text is not JSON to its end, fails
    the job, and so does a bad line.
    """
    source = F.col("_metadata.file_path").alias("fichier")

    def failure(message: str, kind: str):
        return F.raise_error(F.concat(F.lit(message), F.col("fichier"))).cast(kind)

    if lines:
        rows = spark.read.text(path).filter(F.trim("value") != "").select(
            source, F.col("_metadata.file_block_start").alias("bloc"), "value")
        checked = F.when(json.is_valid(F.col("value")), F.col("value")).otherwise(
            failure("line is not JSON: ", "string"))
        return rows.select("fichier", "bloc", checked.alias("record"))
    whole = spark.read.text(path, wholetext=True).select(source, "value")
    is_list = F.col("value").rlike(r"\A\s*\[") & F.col("value").rlike(r"\]\s*\z")
    # Inside an object, a second array or stray text behind the first is an error, not ignored.
    held = F.concat(F.lit('{"v":'), F.col("value"), F.lit("}"))
    items = F.from_json(held, "v array<string>", {"mode": "FAILFAST"})["v"]
    return whole.select(
        "fichier",
        F.posexplode(F.when(is_list, items).otherwise(failure("root is not a list: ", "array<string>")))
        .alias("position", "record"),
    )


_STRING = r'"(?:[^"\\]|\\.)*+"'
_TOKEN = _STRING + r'|[\[\]{},]|[^"\[\]{},]+|"'
_PIECES = """
    aggregate(regexp_extract_all(value, token, 0),
        named_struct('d', depth, 'done', cast(array() as array<string>), 'open', ''),
        (s, t) -> case
            when t = ',' and s.d = 1 then named_struct('d', s.d, 'done', s.done || array(s.open), 'open', '')
            when t = '[' and s.d = 0 then named_struct('d', s.d + 1, 'done', s.done, 'open', s.open)
            when t = ']' and s.d = 1 then named_struct('d', s.d - 1, 'done', s.done || array(s.open), 'open', '')
            else named_struct('d', s.d + case when t in ('[', '{') then 1 when t in (']', '}') then -1 else 0 end,
                'done', s.done, 'open', s.open || t) end,
        s -> named_struct('done', s.done, 'open', s.open))"""


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON array files of any size as (fichier, position, record), read by byte ranges.

    A raw line break cannot stand inside a JSON string, so the change of bracket depth is known for every line alone. Sums
    per byte range give the depth at which a range begins, a running sum within it the depth of each line, and in the same
    way the number of elements that ended before. An element's lines then meet by its number. Tasks hold a range or an
    element, never a file. A line is the smallest unit: an array without line breaks is read by one task, as by
    ``read_json_batch``. Records keep their own text, spaces around it trimmed.

    A file that is no list, lacks its end, has text outside the list or an element that is no JSON fails the job. An empty
    list gives no rows, and so does an empty folder.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("fichier"), F.col("_metadata.file_block_start").alias("bloc"),
        F.monotonically_increasing_id().alias("n"), "value")
    # In the order of the file; the number grows within a range.
    inside = Window.partitionBy("fichier", "bloc").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("fichier").orderBy("bloc").rowsBetween(Window.unboundedPreceding, -1)  # a row per range

    def running(df: DataFrame, change: str, into: str) -> DataFrame:
        """The sum of ``change`` over the lines before, and over the whole file (``into_total``)."""
        ranges = df.groupBy("fichier", "bloc").agg(F.sum(change).alias("_sum"))
        whole = Window.partitionBy("fichier")
        starts = ranges.select("fichier", "bloc", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_start"),
                               F.sum("_sum").over(whole).alias(f"{into}_total"))
        own = F.coalesce(F.sum(change).over(inside), F.lit(0))
        return df.withColumn("_own", own).join(starts, ["fichier", "bloc"]).withColumn(into, F.col("_start") + F.col("_own")).drop(
            "_own", "_start")

    marks = F.regexp_replace(F.regexp_replace("value", _STRING, ""), r"[^\[\]{}]", "")
    change = F.length(F.regexp_replace(marks, r"[\]}]", "")) - F.length(F.regexp_replace(marks, r"[\[{]", ""))
    lines = running(lines.withColumn("change", change.cast("long")).withColumn("marks", F.length(marks)), "change", "depth")
    # Most lines lie inside an element and hold no bracket.
    plain = (F.col("marks") == 0) & (F.col("depth") > 1)
    whole = F.struct(F.expr("cast(array() as array<string>)").alias("done"), F.col("value").alias("open"))
    lines = lines.withColumns({"token": F.lit(_TOKEN), "depth": F.col("depth").cast("int")})
    lines = lines.withColumn("pieces", F.when(plain, whole).otherwise(F.expr(_PIECES)))
    lines = lines.withColumn("ended", F.size("pieces.done").cast("long")).drop("value", "token", "marks", "change")
    lines = running(lines, "ended", "before")
    parts = lines.select(
        "fichier", "bloc", "n", "before", "depth_total", "before_total",
        F.posexplode(F.concat("pieces.done", F.array("pieces.open"))).alias("at", "piece"))
    parts = parts.withColumn("position", F.col("before") + F.col("at"))
    ordered = F.array_sort(F.collect_list(F.struct("bloc", "n", "at", "piece")))  # the lines of one element
    records = parts.groupBy("fichier", "position").agg(
        F.trim(F.regexp_replace(F.array_join(F.transform(ordered, lambda p: p["piece"]), "\n"), r"\A\s+|\s+\z", "")).alias("record"),
        F.max("depth_total").alias("depth"), F.max("before_total").alias("elements"))

    def failure(message: str):
        return F.raise_error(F.concat(F.lit(message), F.col("fichier"))).cast("string")

    last = F.col("position") == F.col("elements")  # what stands behind the list
    checked = (
        F.when((F.col("depth") != 0) | (F.col("elements") == 0), failure("root is not a complete list: "))
        .when(last & (F.col("record") != ""), failure("text outside the list: "))
        .when(last | ((F.col("elements") == 1) & (F.col("record") == "")), F.lit(""))
        .when(json.is_valid(F.col("record")), F.col("record")).otherwise(failure("element is not JSON: ")))
    records = records.select("fichier", "position", checked.alias("record"))
    return records.filter("record <> ''").select("fichier", F.col("position").cast("int").alias("position"), "record")


def batch_checks(records: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Empty batch, and the difference to the number of records its manifest declares (``nombre_declare``, one row)."""
    rules = {"lot_vide": F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)}
    if manifest is None:
        return long_form(records, rules)
    counted = records.agg(F.count(F.lit(1)).alias("_n")).crossJoin(manifest.select("nombre_declare"))
    difference = counted.select(F.lit("ecart_nombre_declare").alias("controle"),
                                F.abs(F.col("_n") - F.col("nombre_declare")).cast("long").alias("violations"))
    return long_form(records, rules).unionByName(difference)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return assert_columns(df, columns).select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, required: Sequence[str] = ()) -> DataFrame:
    """All columns as text (codes such as 01 keep their zero); required header names are checked."""
    return assert_columns(spark.read.option("header", True).csv(path), required)


def read_table(spark: SparkSession, name: str, columns: Sequence[str], key: str) -> DataFrame:
    """Chosen columns of a serving table, in key order (a range-partitioned sort)."""
    return assert_columns(spark.table(name), columns).select(*columns).orderBy(key)


def read_jdbc(spark: SparkSession, url: str, name: str, column: str, bounds: tuple[int, int],
              partitions: int, **options: str) -> DataFrame:
    """A database table in parallel slices of a numeric column."""
    return spark.read.jdbc(url, name, column=column, lowerBound=bounds[0], upperBound=bounds[1],
                           numPartitions=partitions, properties=options)


def write_jdbc(df: DataFrame, url: str, name: str, batch_size: int = 500, **options: str) -> None:
    df.write.jdbc(url, name, mode="append", properties={"batchsize": str(batch_size), **options})


__all__ = ["ContractError", "batch_checks", "exists", "read_csv", "read_jdbc", "read_json_array", "read_json_batch",
           "read_parquet", "read_table", "write_jdbc"]
