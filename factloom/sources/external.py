"""Sources and sinks outside the lake: databases, spreadsheets, rule files, delimited files of unknown encoding, and versioned publishing."""

from __future__ import annotations

import contextlib
import io
import json
import os
import sqlite3
import uuid
import zipfile
from collections.abc import Mapping
from urllib.parse import urlsplit
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from factloom.sources.tables import ContractError, same_rows, write_once

# --- databases ------------------------------------------------------------------------------------------------------------------


def jdbc_address(environment: Mapping[str, str] | None = None) -> tuple[str, dict[str, str]]:
    """JDBC address and properties from DATABASE_URL (scheme://user:password@host:port/name), else from PGHOST, PGPORT, PGDATABASE, PGUSER and PGPASSWORD."""
    env = os.environ if environment is None else environment
    if url := env.get("DATABASE_URL"):
        if url.startswith("jdbc:"):
            return url, {}
        u = urlsplit(url)
        scheme = u.scheme.split("+")[0].replace("postgres", "postgresql") if u.scheme.split("+")[0] == "postgres" else u.scheme.split("+")[0]
        own = {k: v for k, v in (("user", u.username), ("password", u.password)) if v}
        return f"jdbc:{scheme}://{u.hostname or 'localhost'}{f':{u.port}' if u.port else ''}{u.path}", own
    if "PGDATABASE" not in env and "PGHOST" not in env:
        raise ContractError("neither DATABASE_URL nor PGHOST or PGDATABASE is set")
    own = {k: env[v] for k, v in (("user", "PGUSER"), ("password", "PGPASSWORD")) if v in env}
    return f"jdbc:postgresql://{env.get('PGHOST', 'localhost')}:{env.get('PGPORT', '5432')}/{env.get('PGDATABASE', env.get('PGUSER', 'postgres'))}", own


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None, *, split_on: str | None = None, parts: int = 16) -> DataFrame:
    """A table (or `(query) alias`) of a database, for reading only. With split_on, a numeric column, it is read in `parts` ranges between the column's ends."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", "10000")
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if split_on is None:
        return reader.load()
    low, high = reader.load().agg(F.min(split_on), F.max(split_on)).first()
    if low is None:
        return reader.load()
    return reader.option("partitionColumn", split_on).option("lowerBound", str(low)).option("upperBound", str(high + 1)).option("numPartitions", str(parts)).load()


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, *, mode: str = "errorifexists", connections: int = 8) -> None:
    """df into a table, over at most `connections` connections, in batches; a table that is there is an error unless mode says otherwise."""
    writer = df.coalesce(connections).write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", "10000").mode(mode)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()


def write_sqlite(df: DataFrame, path: str, table: str, *, rows: int = 100_000) -> None:
    """df as a table of SQLite databases, one for each `rows` rows of a partition, in a folder of binary records (name, content) that any store can hold.

    Columns are numbers, booleans and strings. Each task makes its databases in memory; an empty df leaves none."""
    names = df.columns
    quoted = lambda n: '"' + n.replace('"', '""') + '"'
    make, put = f"CREATE TABLE {quoted(table)} ({', '.join(map(quoted, names))})", f"INSERT INTO {quoted(table)} VALUES ({', '.join('?' * len(names))})"

    def database(values: list[tuple]) -> pa.RecordBatch:
        with contextlib.closing(sqlite3.connect(":memory:")) as db:
            db.execute(make)
            db.executemany(put, values)
            db.commit()
            return pa.RecordBatch.from_pydict({"name": [f"{uuid.uuid4().hex}.sqlite"], "content": [db.serialize()]}, schema=pa.schema({"name": pa.string(), "content": pa.binary()}))

    def run(batches):
        values: list[tuple] = []
        for batch in batches:
            values += zip(*batch.to_pydict().values(), strict=True)
            while len(values) >= rows:
                yield database(values[:rows])
                values = values[rows:]
        if values:
            yield database(values)

    df.mapInArrow(run, "name string, content binary").write.parquet(path)


def read_sqlite(spark: SparkSession, path: str, table: str, schema: StructType) -> DataFrame:
    """The table of all databases that write_sqlite left in a folder; each is opened for reading only, by the task that has its record."""
    wanted = to_arrow_schema(schema)
    query = f"SELECT {', '.join(chr(34) + n.replace(chr(34), chr(34) * 2) + chr(34) for n in wanted.names)} FROM {chr(34)}{table.replace(chr(34), chr(34) * 2)}{chr(34)}"

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                with contextlib.closing(sqlite3.connect(":memory:")) as db:
                    db.deserialize(content.as_py())
                    db.execute("PRAGMA query_only = ON")
                    found = db.execute(query)
                    while values := found.fetchmany(10_000):
                        columns = zip(*values, strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array([None if v is None else bool(v) for v in c] if pa.types.is_boolean(f.type) else c, f.type) for c, f in zip(columns, wanted, strict=True)], schema=wanted)

    return spark.read.parquet(path).select("content").mapInArrow(run, schema)


def session(name: str = "factloom") -> SparkSession:
    """The one session of this process, made when first asked for."""
    return SparkSession.builder.appName(name).getOrCreate()


# --- spreadsheets ---------------------------------------------------------------------------------------------------------------

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _letters(n: int) -> str:
    out = ""
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def sheet_rows(content: bytes) -> list[list[str]]:
    """The cells of a workbook's first sheet as texts; missing cells are empty."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        root = ElementTree.fromstring(z.read("xl/worksheets/sheet1.xml"))
    out = []
    for row in root.iter(f"{_MAIN}row"):
        cells: list[str] = []
        for c in row.iter(f"{_MAIN}c"):
            at = 0
            for letter in (x for x in c.get("r", "") if x.isalpha()):
                at = at * 26 + ord(letter) - 64
            value = c.find(f"{_MAIN}v")
            text = "".join(t.text or "" for t in c.iter(f"{_MAIN}t")) if c.get("t") == "inlineStr" else (value.text or "") if value is not None else ""
            cells += [""] * (max(at, len(cells) + 1) - len(cells) - 1) + [shared[int(text)] if c.get("t") == "s" else text]
        out.append(cells)
    return out


def workbook(rows: list[list[str | None]]) -> bytes:
    """A workbook of one sheet of texts, the same bytes for the same rows."""
    line = lambda i, cells: f'<row r="{i}">' + "".join(f'<c r="{_letters(k)}{i}" t="inlineStr"><is><t xml:space="preserve">{escape(c)}</t></is></c>' for k, c in enumerate(cells, 1) if c is not None) + "</row>"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    relation = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{relation}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{relation}"><sheets><sheet name="rows" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{relation}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{_MAIN[1:-1]}"><sheetData>' + "".join(line(i, r) for i, r in enumerate(rows, 1)) + "</sheetData></worksheet>",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(zipfile.ZipInfo(name, (2000, 1, 1, 0, 0, 0)), '<?xml version="1.0" encoding="UTF-8"?>' + text)
    return out.getvalue()


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """path, row_no, cells (header -> text) of the first sheets of workbooks; a header that is empty or stated twice is an error. Files are parsed where they are read."""

    def run(batches):
        for batch in batches:
            out = []
            for name, content in zip(batch["path"], batch["content"], strict=True):
                rows = sheet_rows(bytes(content))
                header = [h.strip() for h in rows[0]] if rows else []
                if len(set(header)) < len(header) or "" in header:
                    raise ContractError(f"{name} has an empty or repeated header")
                out += [(name, i, dict(zip(header, r + [""] * (len(header) - len(r))))) for i, r in enumerate(rows[1:], 1)]
            yield pd.DataFrame(out, columns=["path", "row_no", "cells"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")
    return files.mapInPandas(run, "path string, row_no int, cells map<string,string>")


def workbooks(df: DataFrame, group: str, columns: list[str], order: list[str], most: int = 100_000) -> DataFrame:
    """group, content: one workbook for each group, made by the executors. More than `most` rows are beyond a sheet and an error."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        if len(rows) > most:
            raise ContractError(f"a sheet can't hold {len(rows)} rows")
        rows = rows.sort_values(order, kind="stable")
        cells = [[None if pd.isna(v) else str(v) for v in r] for r in rows[columns].itertuples(index=False)]
        return pd.DataFrame({group: [rows[group].iloc[0]], "content": [workbook([list(columns), *cells])]})

    return df.groupBy(group).applyInPandas(run, f"{group} {dict(df.dtypes)[group]}, content binary")


def write_files(df: DataFrame, path: str, name: str, content: str) -> None:
    """Each row's bytes as a file of its own, written by the executors to a folder that they all mount (file://). Other stores keep such files as rows of a table."""
    local = path.removeprefix("file://")
    if "://" in local:
        raise ContractError("single files are written to file:// paths; elsewhere keep them as rows of a table")

    def run(batches):
        for batch in batches:
            for n, data in zip(batch["name"], batch["content"], strict=True):
                os.makedirs(local, exist_ok=True)
                part = f"{local}/.{n}.{uuid.uuid4().hex}"
                with open(part, "wb") as f:
                    f.write(bytes(data))
                os.replace(part, f"{local}/{n}")
            yield batch[["name"]]

    df.select(F.col(name).alias("name"), F.col(content).alias("content")).mapInPandas(run, "name string").write.format("noop").mode("overwrite").save()


# --- rule files -----------------------------------------------------------------------------------------------------------------


def rules_from_yaml(source: str, required: dict[str, type], unique: list[str]) -> list[dict]:
    """The entries of a YAML list of mappings, checked: each has every required field of its type, and no two agree in the unique ones."""
    try:
        import yaml
    except ImportError as e:  # the reader is not part of this environment
        raise ContractError("reading YAML needs the package yaml") from e
    entries = yaml.safe_load(source) or []
    if not isinstance(entries, list):
        raise ContractError("a rule file is a list")
    seen = set()
    for i, entry in enumerate(entries):
        if not isinstance(entry, dict):
            raise ContractError(f"entry {i} is no mapping")
        for field, kind in required.items():
            if not isinstance(entry.get(field), kind):
                raise ContractError(f"entry {i}: {field} must be {kind.__name__}")
        key = tuple(entry[u] for u in unique)
        if key in seen:
            raise ContractError(f"entry {i} repeats {key}")
        seen.add(key)
    return entries


# --- delimited files ------------------------------------------------------------------------------------------------------------


# The bytes 0x80 to 0x9F that windows-1252 gives a character, which ISO-8859-1 leaves to control codes.
_CONTROLS = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "replace") != "\ufffd"]


def decoded(content: Column) -> Column:
    """struct(text, encoding) of a file's bytes: UTF-16 by its mark, UTF-8 (with or without mark) where the bytes are valid, else windows-1252."""
    head = F.hex(F.substring(content, 1, 2))
    western = F.translate(F.decode(content, "ISO-8859-1"), "".join(map(chr, _CONTROLS)), bytes(_CONTROLS).decode("cp1252"))
    out = lambda t, e: F.struct(F.ltrim(t, F.lit("\ufeff")).alias("text"), F.lit(e).alias("encoding"))
    text = content.cast("string")
    return F.when(head.isin("FFFE", "FEFF"), out(F.decode(content, "UTF-16"), "utf-16")).when(F.is_valid_utf8(text), out(text, "utf-8")).otherwise(out(western, "windows-1252"))


def read_delimited(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """path, encoding, separator, row_no, cells (header -> text) of small delimited files, each in its own encoding and with its own separator (of , ; tab |, the one
    that the header has most). Quoted cells hold no line ends."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", decoded(F.col("content")).alias("d"))
    rows = files.select("path", "d.encoding", F.split(F.regexp_replace("d.text", "\r\n?", "\n"), "\n").alias("l"))
    counts = F.array(*[F.struct(F.regexp_count(F.get("l", F.lit(0)), F.lit(p)).alias("n"), F.lit(-i).alias("i"), F.lit(s).alias("s")) for i, (s, p) in enumerate([(",", ","), (";", ";"), ("\t", "\t"), ("|", "[|]")])])
    rows = rows.withColumn("separator", F.array_max(counts)["s"])
    quote = lambda c: F.regexp_replace(F.trim(c), '^"|"$', "")
    cells = lambda line: F.transform(F.split(line, F.concat(F.lit("["), F.col("separator"), F.lit("]"))), quote)
    rows = rows.select("path", "encoding", "separator", cells(F.get("l", F.lit(0))).alias("h"), F.posexplode("l").alias("row_no", "line")).where("row_no > 0 and trim(line) <> ''")
    return rows.select("path", "encoding", "separator", "row_no", F.map_from_arrays("h", cells(F.col("line"))).alias("cells"))


# --- publishing -----------------------------------------------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _put(spark: SparkSession, path: str, text: str, overwrite: bool) -> bool:
    fs, p = _fs(spark, path)
    if not overwrite and fs.exists(p):
        return False
    try:
        stream = fs.create(p, overwrite)
    except Exception as e:  # somebody else made it in the meantime
        if "already exists" in str(e):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    return "\n".join(r[0] for r in spark.read.text(path).collect()) if fs.exists(p) else None


def publish(df: DataFrame, root: str, version: str, *, expected: str | None) -> dict:
    """df as a version below root: written once, read again and compared, with a manifest, under a lock; then the pointer `current` moves to it if it is `expected` now.

    A version that is there, a lock that is held and a pointer that has moved are errors and change nothing that readers see.
    """
    spark = df.sparkSession
    if not _put(spark, f"{root}/lock", version, False):
        raise ContractError(f"{root} is locked")
    try:
        now = read_text(spark, f"{root}/current")
        if now != expected:
            raise ContractError(f"current is {now}, not {expected}")
        write_once(df, f"{root}/{version}/data")
        row = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*df.columns)).alias("x")).first()
        manifest = {"version": version, "rows": row["n"], "digest": row["x"], "columns": df.columns}
        _put(spark, f"{root}/{version}/manifest.json", json.dumps(manifest, sort_keys=True), True)
        _put(spark, f"{root}/current", version, True)
        return manifest
    finally:
        fs, p = _fs(spark, f"{root}/lock")
        fs.delete(p, False)


def current(spark: SparkSession, root: str) -> DataFrame:
    """The version that the pointer names; its rows must be those of its manifest."""
    version = read_text(spark, f"{root}/current")
    if version is None:
        raise ContractError(f"nothing is published in {root}")
    manifest = json.loads(read_text(spark, f"{root}/{version}/manifest.json") or "{}")
    df = spark.read.parquet(f"{root}/{version}/data").select(*manifest["columns"])
    row = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*df.columns)).alias("x")).first()
    if (row["n"], row["x"]) != (manifest["rows"], manifest["digest"]):
        raise ContractError(f"{root}/{version} differs from its manifest")
    return df


def replace_table(df: DataFrame, path: str) -> None:
    """df in the place of the table at path: written beside it, read again and compared, then renamed. A reader sees the old table or the new one."""
    spark, part = df.sparkSession, f"{path}.{uuid.uuid4().hex}"
    df.write.parquet(part)
    if not same_rows(df, spark.read.parquet(part)):
        raise ContractError(f"{part} differs from what was written")
    fs, p = _fs(spark, path)
    old = _fs(spark, f"{part}.old")[1]
    if fs.exists(p):
        fs.rename(p, old)
    fs.rename(_fs(spark, part)[1], p)
    fs.delete(old, True)


# --- parsing ingested files -----------------------------------------------------------------------------------------------------


def parse_status(parsed: DataFrame, failed: Column, n: int | None = None, order: str = "path") -> tuple[DataFrame, DataFrame]:
    """Rows with status (OK or FAILED, nothing is dropped), the first n in order where n is given; and the histogram of the statuses."""
    rows = parsed.withColumn("status", F.when(F.coalesce(failed, F.lit(True)), "FAILED").otherwise("OK"))
    rows = rows.orderBy(order).limit(n) if n is not None else rows
    return rows, rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def snapshot(pages: DataFrame, documents: DataFrame, key: str, margin: Column) -> DataFrame:
    """pages with their saved document_id (null where none is saved), text outside the margin only, and status: SAVED, UNSAVED, or FAILED where there is no text.

    documents has key and document_id; a content that is saved twice has its smallest id.
    """
    ids = documents.groupBy(key).agg(F.min("document_id").alias("document_id"))
    rows = pages.join(ids, key, "left").withColumn("text", F.when(~F.coalesce(margin, F.lit(False)), F.col("text")))
    return rows.withColumn("status", F.when(F.col("text").isNull() | (F.trim("text") == ""), "FAILED").when(F.col("document_id").isNull(), "UNSAVED").otherwise("SAVED"))
