"""Registration of queries with their SQL twins, and the SQL that shapes the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.adapters import Tables

# Sums differ in their last bits between engines; rounding in two steps keeps a value that lies
# half-way between two results from falling to either side.
FINE, PLACES = 10, 6
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

NOTICES = """notices AS (
 SELECT o.o_orderkey AS resource_id,
  concat_ws(' ', o.o_orderpriority, c.c_mktsegment, c.c_name, CAST(year(o.o_orderdate) AS VARCHAR)) AS title,
  n.n_name AS ca, CASE WHEN o.o_orderkey%5=0 THEN '' ELSE p.p_name END AS info,
  o.o_orderdate AS published, o.o_orderdate + to_days(CAST(o.o_orderkey%60 AS INTEGER)) AS deadline,
  o.o_orderdate AS created_at,
  CASE o.o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Closed' ELSE 'Awarded' END AS status,
  c.c_mktsegment AS procedure,
  CASE WHEN o.o_orderkey%4=0 THEN '' ELSE concat('https://example.org/notice?id=', CAST(o.o_orderkey AS VARCHAR)) END AS pdf_url,
  CASE WHEN o.o_orderkey%5<2 THEN NULL ELSE CAST(o.o_totalprice AS DECIMAL(15,2)) END AS value,
  '' AS cycle, l.toxic AS bid
 FROM orders o JOIN customer c ON o.o_custkey=c.c_custkey JOIN nation n ON c.c_nationkey=n.n_nationkey
 LEFT JOIN part p ON p.p_partkey=o.o_orderkey%(SELECT count(*) FROM part) LEFT JOIN labels l ON l.doc_id=o.o_orderkey)"""

DOCS = """doc_content AS (
 SELECT doc_id AS resource_id, text AS pdf_text,
  CASE WHEN doc_id%10=0 THEN 'failed' ELSE 'COMPLETED' END AS processing_status,
  TIMESTAMP '2001-08-01 00:00:00' - to_minutes(n_chars%4000) AS extraction_timestamp
 FROM documents)"""

HITS = """hits AS (
 SELECT d.resource_id, list(b.text ORDER BY b.item_id) AS codes, count(*) AS n
 FROM doc_content d JOIN benchmark b ON contains(d.pdf_text, b.text) GROUP BY 1),
coded AS (
 SELECT d.*, coalesce(h.codes, CAST([] AS VARCHAR[])) AS detected_codes, coalesce(h.n, 0) AS codes_count
 FROM doc_content d LEFT JOIN hits h USING (resource_id))"""

SCORED = """scored AS (
 SELECT d.doc_id, (d.n_chars % 997) / 997.0::DOUBLE AS score, l.toxic AS y
 FROM documents d JOIN labels l USING (doc_id))"""

RAW_NOTICES = """raw_notices AS (
 SELECT title, CAST(resource_id AS VARCHAR) AS resource_id, ca, info,
  CASE WHEN resource_id%11=0 THEN '' WHEN resource_id%13=0 THEN 'bad' ELSE strftime(published, '%d/%m/%Y %H:%M:%S') END AS published,
  CASE WHEN resource_id%11=0 THEN '' WHEN resource_id%13=0 THEN 'bad' ELSE strftime(deadline, '%d/%m/%Y %H:%M:%S') END AS deadline,
  procedure, status, pdf_url,
  CASE WHEN resource_id%11=0 THEN '' WHEN resource_id%13=0 THEN 'bad' ELSE strftime(published, '%d/%m/%Y') END AS awarddate,
  CASE WHEN resource_id%11=0 THEN '' WHEN resource_id%13=0 THEN 'bad' WHEN value IS NULL THEN ''
   ELSE concat('€', format('{:,}', CAST(floor(value) AS BIGINT)), '.', lpad(CAST(CAST((value*100)%100 AS INTEGER) AS VARCHAR), 2, '0')) END AS value,
  cycle FROM notices)"""


def with_(*parts: str, select: str) -> str:
    """A statement over the shaped tables."""
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()


def plain(df: DataFrame) -> DataFrame:
    """Result columns in types that every engine prints alike: times and lists as text, decimals
    as doubles, doubles rounded to six places."""
    columns = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.round(F.round(c.cast("double"), FINE), PLACES)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            c = F.array_join(c, "|")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(kind, T.StructType):
            c = F.to_json(c)
        columns.append(c.alias(field.name))
    return df.select(*columns)


def shaped(sql: str, columns: str) -> str:
    """The statement with its columns in the declared types, doubles rounded like :func:`plain` does."""
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}
    select = []
    for column in columns.split(", "):
        name, kind = column.rsplit(" ", 1)
        cast = f'CAST("{name}" AS {kinds[kind]})'
        select.append(f'round(round({cast}, {FINE}), {PLACES}) AS "{name}"' if kind == "double" else f'{cast} AS "{name}"')
    return f"SELECT {', '.join(select)} FROM (\n{sql.strip()}\n) AS result"


def query(name: str, oracle: str | None = None):
    """Register ``build(tables) -> DataFrame`` under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: plain(build(Tables(spark, folder)))
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register
