"""Table functions for SQL: extractors that are called in FROM, with LATERAL or on a partitioned table."""

from __future__ import annotations

import re

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, udtf
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType


class Matches:
    """matches(text, pattern[, name]): number, start, end (code points) and the named column of each match, in order. The column's name is the third argument."""

    @staticmethod
    def analyze(text: AnalyzeArgument, pattern: AnalyzeArgument, name: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not pattern.isConstantExpression:
            raise ValueError("the pattern must be a constant")
        if pattern.value is None or re.compile(pattern.value).match(""):
            raise ValueError("the pattern must not match an empty text")
        column = (name.value if name is not None else None) or "token"
        return AnalyzeResult(StructType([StructField("number", IntegerType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField(column, StringType())]))

    def __init__(self):
        self.pattern, self.compiled = None, None

    def eval(self, text, pattern, name=None):
        if text is None:
            return
        if pattern != self.pattern:
            self.pattern, self.compiled = pattern, re.compile(pattern)
        for i, m in enumerate(self.compiled.finditer(text), 1):
            yield i, m.start(), m.end(), m[0]


class Carried:
    """carried(TABLE(...), key, order, label): rows of the table with `context`, the last label seen in the key before or at each row.

    analyze() asks Spark to deal the rows by key and sort them by order; the state is one label and is given up at each key. A key is one task's, with nothing kept but the label.
    """

    def __init__(self, result=None):
        self.label = None

    @staticmethod
    def analyze(rows: AnalyzeArgument, key: AnalyzeArgument, order: AnalyzeArgument, label: AnalyzeArgument) -> AnalyzeResult:
        names = [f.name for f in rows.dataType.fields]
        for a in (key, order, label):
            if a.value not in names:
                raise ValueError(f"the table has no column {a.value}")
        fields = [f for f in rows.dataType.fields if f.name in (key.value, order.value)]
        return AnalyzeResult(StructType([*fields, StructField("context", StringType())]), partitionBy=[PartitioningColumn(key.value)], orderBy=[OrderingColumn(order.value)])

    def eval(self, row: Row, key: str, order: str, label: str):
        if row[label] is not None:
            self.label = row[label]
        yield tuple(row[c] for c in row.__fields__ if c in (key, order)) + (self.label,)


class RunLengths:
    """run_lengths(TABLE(...) PARTITION BY ... ORDER BY ..., value): value and n of each run of equal values; the last run comes when the partition ends."""

    def __init__(self):
        self.value, self.n, self.start = None, 0, 0

    def eval(self, row: Row, value: str):
        if self.n and row[value] != self.value:
            yield self.start, self.value, self.n
            self.start, self.n = self.start + self.n, 0
        self.value, self.n = row[value], self.n + 1

    def terminate(self):
        if self.n:
            yield self.start, self.value, self.n


def register(spark: SparkSession) -> None:
    """Make the table functions known to SQL in this session."""
    spark.udtf.register("matches", udtf(Matches))
    spark.udtf.register("carried", udtf(Carried))
    spark.udtf.register("run_lengths", udtf(RunLengths, returnType=StructType([StructField("start", LongType()), StructField("value", StringType()), StructField("n", LongType())])))
