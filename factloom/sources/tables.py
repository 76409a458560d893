"""Sources and sinks with contracts: columns, keys, one write, freeze checks, folder scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class ContractError(ValueError):
    """Input that breaks its contract."""


def read_csv(spark: SparkSession, path: str, required: list[str] | None = None, *, schema: StructType | str | None = None, sep: str | None = None, encoding: str = "UTF-8", key: list[str] | None = None) -> DataFrame:
    """A CSV file with a header, all cells trimmed strings unless a schema is given (then FAILFAST). The separator is found from the header if not given;
    missing required columns, repeated header names and repeated keys are errors."""
    first = spark.read.option("encoding", encoding).text(path).limit(1).first()
    if first is None:
        raise ContractError(f"{path} is empty")
    header = first[0].lstrip("﻿")
    sep = sep or max(",;\t|", key=header.count)
    names = [n.strip().strip('"') for n in header.split(sep)]
    if len(set(names)) < len(names):
        raise ContractError(f"{path} repeats a column name")
    if lacking := set(required or ()) - set(names):
        raise ContractError(f"{path} lacks {sorted(lacking)}")
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("multiLine", True).option("escape", '"')
    df = reader.schema(schema).option("mode", "FAILFAST").csv(path) if schema else reader.csv(path)
    df = df.toDF(*names)
    if not schema:
        df = df.select(*[F.trim(F.col(f"`{c}`")).alias(c) for c in names])
    if key:
        assert_unique(df, key)
    return df


def typed_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cells by look: True / False as booleans in <c>_bool, { or [ as variants in <c>_json; the text stays."""
    out = {}
    for c in columns:
        t = F.trim(c)
        out[f"{c}_bool"] = F.when(t == "True", True).when(t == "False", False)
        out[f"{c}_json"] = F.when(t.rlike(r"^[\[{]"), F.try_parse_json(t))
    return df.withColumns(out)


def write_csv(frames: list[DataFrame], path: str) -> None:
    """Frames with differing columns as one CSV with the union of the columns; nested values as JSON."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    nested = [f.name for f in out.schema if f.dataType.typeName() in ("array", "struct", "map")]
    out.withColumns({c: F.to_json(c) for c in nested}).write.mode("errorifexists").option("header", True).csv(path)


def write_once(df: DataFrame, path: str, *, check: bool = True) -> None:
    """Write Parquet where nothing is yet; with check, read it again and compare row by row."""
    df.write.mode("errorifexists").parquet(path)
    if check and not same_rows(df, df.sparkSession.read.parquet(path)):
        raise ContractError(f"{path} differs from what was written")


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows as often: one aggregation of row hashes, in place of two exceptAll."""
    digest = lambda df: df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit(7), *df.columns)).alias("x")).first()
    return a.columns == b.columns and digest(a) == digest(b)


def assert_unique(df: DataFrame, key: list[str]) -> None:
    row = df.groupBy(*key).count().where("count > 1").first()
    if row is not None:
        raise ContractError(f"key {row[:-1]} occurs {row[-1]} times")


def scan_folder(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, folder (first level below path), length, modified, sha256 of each file below a folder; the bytes stay on the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    root = path.rstrip("/").rsplit("/", 1)[-1]
    folder = F.regexp_extract("path", rf"/{root}/([^/]+)/[^/]", 1)
    return files.select("path", folder.alias("folder"), "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))


def folder_totals(files: DataFrame) -> DataFrame:
    """folder, n_files, bytes, n_distinct, status: files outside a folder are an ERROR."""
    status = F.when(F.col("folder") == "", "ERROR").otherwise("OK")
    return files.groupBy("folder").agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"), F.count_distinct("sha256").alias("n_distinct"), F.first(status).alias("status"))


def freeze(files: DataFrame) -> DataFrame:
    """path, sha256: the manifest that later runs are compared with."""
    return files.select("path", "sha256")


def changed_since(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """path, change (ADDED, REMOVED, CHANGED) of files against a manifest."""
    rows = manifest.select("path", F.col("sha256").alias("__o")).join(files.select("path", F.col("sha256").alias("__n")), "path", "full_outer")
    change = F.when(F.col("__o").isNull(), "ADDED").when(F.col("__n").isNull(), "REMOVED").when(F.col("__o") != F.col("__n"), "CHANGED")
    return rows.select("path", change.alias("change")).where("change is not null")


def reuse_or_parse(files: DataFrame, cache: DataFrame, parse, parser: str) -> DataFrame:
    """Parsed rows for all files: from the cache where (sha256, parser) is there, else parsed, each content once.

    parse: DataFrame of distinct files -> DataFrame(sha256, parsed).
    """
    known = cache.where(F.col("parser") == parser).select("sha256", "parsed")
    fresh = parse(files.dropDuplicates(["sha256"]).join(known, "sha256", "left_anti"))
    return files.join(known.unionByName(fresh.select("sha256", "parsed")), "sha256", "left")


def rule_table(spark: SparkSession, rules: list[tuple], columns: str) -> DataFrame:
    """Rules as a small table; a repeated label and pattern is an error."""
    if len(set(rules)) < len(rules):
        raise ContractError("a rule is stated twice")
    return spark.createDataFrame(rules, columns)


def strict_json(text: Column, schema: str) -> Column:
    """Typed JSON, null unless it parses as the schema and holds no NaN or Infinity."""
    bad = text.rlike(r"[:\[,]\s*-?(NaN|Infinity)")
    return F.when(~bad, F.from_json(text, schema, {"mode": "PERMISSIVE"}))
