"""Claims: most common valid codes, and the errors of a delivery.

Lines stand in for claims, parts up to size 25 for the valid procedure list, document texts for diagnosis text and
the codes found in the benchmark items for the valid diagnosis list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.codes import extracted_codes, packed_codes
from tablework.functions.dates import DATE_SHAPE
from tablework.operators.counts import entities_with_codes, frequency, null_safe_extremes, top_codes, valid_code_counts
from tablework.operators.joins import lookup_join
from tablework.operators.latest import duplicated_keys
from tablework.operators.quality import (
    claim_rules, date_rules, error_list, failing_rows, findings, invalid_codes, numbered, order_rule, report, schema_check,
    with_days,
)
from tablework.plans.registry import Tables, query

# Fixed value: the shape looked for in document texts, one capital, two small letters, an optional dot.
TEXT_CODE = r"[A-Z]{1}[a-z]{2}\.?"
AS_OF = "2000-01-01"
TOP_VALID = """SELECT CAST(l_partkey AS VARCHAR) AS code, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE p_size <= 25 GROUP BY 1 ORDER BY n DESC, code LIMIT 5"""
FOUND = rf"SELECT doc_id, unnest(regexp_extract_all(text, '{TEXT_CODE}')) AS m FROM documents"
LISTED = rf"SELECT DISTINCT replace(unnest(regexp_extract_all(text, '{TEXT_CODE}')), '.', '') AS code FROM benchmark"


def _valid_parts(t: Tables) -> DataFrame:
    return t.part.filter("p_size <= 25").select("p_partkey")


def _listed_codes(t: Tables) -> DataFrame:
    return extracted_codes(t.benchmark, "item_id", "text", TEXT_CODE).select("code").distinct()


@query(TOP_VALID)
def top_valid_codes(t: Tables) -> DataFrame:
    return top_codes(valid_code_counts(t.lineitem, "l_partkey", _valid_parts(t), "p_partkey"))


@query(f"""
    SELECT count(DISTINCT l_suppkey) AS n_entities FROM lineitem
    WHERE CAST(l_partkey AS VARCHAR) IN (SELECT code FROM ({TOP_VALID}))""")
def patients_of_top_codes(t: Tables) -> DataFrame:
    return entities_with_codes(t.lineitem, "l_suppkey", "l_partkey", top_valid_codes(t))


@query(f"""
    SELECT code, count(*) AS n FROM (SELECT replace(m, '.', '') AS code FROM ({FOUND})) JOIN ({LISTED}) USING (code)
    GROUP BY 1 ORDER BY n DESC, code LIMIT 5""")
def top_extracted_codes(t: Tables) -> DataFrame:
    found = extracted_codes(t.documents, "doc_id", "text", TEXT_CODE)
    return top_codes(valid_code_counts(found, "code", _listed_codes(t), "code"))


@query("""
    SELECT 0 AS entry, CAST(l_partkey AS VARCHAR) AS code, count(*) AS n FROM lineitem GROUP BY ALL
    UNION ALL SELECT 2, CAST(l_suppkey AS VARCHAR), count(*) FROM lineitem GROUP BY ALL
    UNION ALL SELECT 3, l_returnflag, count(*) FROM lineitem GROUP BY ALL""")
def packed_list_explode(t: Tables) -> DataFrame:
    """Each line holds the list ``part^^supplier^flag``, whose second member is empty."""
    packed = t.lineitem.select(
        "l_orderkey", F.concat_ws("^", "l_partkey", F.lit(""), "l_suppkey", "l_returnflag").alias("codes")
    )
    return packed_codes(packed, "l_orderkey", "codes").groupBy("entry", "code").agg(F.count("*").alias("n"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)""")
def dq_invalid_code(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return invalid_codes(lines, "l_partkey", _valid_parts(t), "p_partkey")


@query(f"""
    SELECT doc_id, entry, code FROM (
      SELECT doc_id, CAST(i - 1 AS INTEGER) AS entry, replace(found[i], '.', '') AS code FROM (
        SELECT doc_id, found, unnest(generate_series(1, len(found))) AS i FROM (
          SELECT doc_id, regexp_extract_all(text, '{TEXT_CODE}') AS found FROM documents)))
    WHERE code NOT IN ({LISTED})""")
def dq_invalid_extracted(t: Tables) -> DataFrame:
    found = extracted_codes(t.documents, "doc_id", "text", TEXT_CODE)
    return invalid_codes(found, "code", _listed_codes(t), "code")


def _mixed_date(column: str, style: str):
    """Dates as text; some styles write them in a shape that the rules refuse."""
    return (
        F.when(F.col(style) == 7, F.date_format(column, "yyyy/MM/dd"))
        .when(F.col(style) == 6, F.date_format(column, "yyyy-dd-MM"))
        .otherwise(F.date_format(column, "yyyy-MM-dd"))
    )


MIXED_SQL = """CASE l_linenumber WHEN 7 THEN strftime(l_shipdate, '%Y/%m/%d')
    WHEN 6 THEN strftime(l_shipdate, '%Y-%d-%m') ELSE strftime(l_shipdate, '%Y-%m-%d') END"""


@query(f"""
    SELECT 'date_service_format' AS rule, l_orderkey AS row_id, v AS value
    FROM (SELECT l_orderkey, {MIXED_SQL} AS v FROM lineitem)
    WHERE NOT regexp_matches(v, '{DATE_SHAPE}')""")
def dq_date_format(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", _mixed_date("l_shipdate", "l_linenumber").alias("date_service"))
    rules = date_rules("date_service", F.lit(AS_OF).cast("date"))
    return failing_rows(with_days(lines, "date_service"), "l_orderkey", {"date_service_format": rules["date_service_format"]})


@query(f"""
    SELECT 'date_service_before_now' AS rule, l_orderkey AS row_id, strftime(l_shipdate, '%Y-%m-%d') AS value
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '{AS_OF}'""")
def dq_future_date(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("date_service"))
    rules = date_rules("date_service", F.lit(AS_OF).cast("date"))
    return failing_rows(with_days(lines, "date_service"), "l_orderkey", rules)


@query("""
    SELECT 'date_service_after_date_received' AS rule, l_orderkey AS row_id,
           strftime(o_orderdate, '%Y-%m-%d') || ' > ' || strftime(l_shipdate, '%Y-%m-%d') AS value
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate > l_shipdate""")
def dq_chronology(t: Tables) -> DataFrame:
    """The order is the service and the shipment its receipt."""
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("date_received")
    )
    services = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_service"))
    dated = lookup_join(lines, services, ["o_orderkey"], "inner")
    days = with_days(dated, "date_service", "date_received")
    return failing_rows(days, "o_orderkey", order_rule("date_service", "date_received"))


@query(f"""
    SELECT 'l_orderkey' AS column_name, 'bigint' AS declared_type, 0 AS n_bad_type, 0 AS n_bad_null
    UNION ALL SELECT 'l_returnflag', 'int', count(*), 0 FROM lineitem
    UNION ALL SELECT 'l_linestatus', 'string', 0, count(*) FILTER (l_linestatus = 'F') FROM lineitem
    UNION ALL SELECT 'l_shipdate', 'date', count(*) FILTER (try_strptime({MIXED_SQL}, '%Y-%m-%d') IS NULL), 0
      FROM lineitem""")
def dq_schema(t: Tables) -> DataFrame:
    """Text lines against a declared schema that some columns do not keep."""
    delivered = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"), "l_returnflag",
        F.nullif("l_linestatus", F.lit("F")).alias("l_linestatus"),
        _mixed_date("l_shipdate", "l_linenumber").alias("l_shipdate"),
    )
    declared = T.StructType([
        T.StructField("l_orderkey", T.LongType(), False),
        T.StructField("l_returnflag", T.IntegerType(), False),
        T.StructField("l_linestatus", T.StringType(), False),
        T.StructField("l_shipdate", T.DateType(), True),
    ])
    return schema_check(delivered, declared)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dq_unique(t: Tables) -> DataFrame:
    return duplicated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


CLAIMS_SQL = f"""
    SELECT CASE WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS claim_id,
      l_partkey AS procedure_code,
      CASE WHEN l_linestatus = 'F' THEN lower(l_returnflag) ELSE l_returnflag END
        || lpad(CAST(l_suppkey % 100 AS VARCHAR), 2, '0') || '.1' AS diagnosis_codes,
      {MIXED_SQL} AS date_service,
      strftime(l_shipdate + to_days(CAST(l_quantity AS INTEGER) - 10), '%Y-%m-%d') AS date_received
    FROM lineitem"""


def _claims(t: Tables, *more: str) -> DataFrame:
    flag = F.when(F.col("l_linestatus") == "F", F.lower("l_returnflag")).otherwise(F.col("l_returnflag"))
    received = F.date_add(F.col("l_shipdate").cast("date"), F.col("l_quantity").cast("int") - 10)
    return t.lineitem.select(
        F.when(
            ~((F.col("l_linenumber") == 1) & (F.col("l_returnflag") == "R")),
            F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        ).alias("claim_id"),
        F.col("l_partkey").alias("procedure_code"),
        F.concat(flag, F.lpad((F.col("l_suppkey") % 100).cast("string"), 2, "0"), F.lit(".1")).alias("diagnosis_codes"),
        _mixed_date("l_shipdate", "l_linenumber").alias("date_service"),
        F.date_format(received, "yyyy-MM-dd").alias("date_received"), *more,
    )


@query(f"""
    WITH c AS ({CLAIMS_SQL}),
    d AS (SELECT *,
      CASE WHEN regexp_matches(date_service, '{DATE_SHAPE}') THEN CAST(try_strptime(date_service, '%Y-%m-%d') AS DATE)
        END AS s,
      CAST(date_received AS DATE) AS r FROM c)
    SELECT rule, count(*) AS n FROM (
      SELECT 'claim_id_present' AS rule FROM d WHERE claim_id IS NULL
      UNION ALL SELECT 'diagnosis_shape' FROM d WHERE NOT regexp_matches(diagnosis_codes, '[A-Z]{{1}}\\d{{2}}\\.?\\d*')
      UNION ALL SELECT 'date_service_format' FROM d WHERE NOT regexp_matches(date_service, '{DATE_SHAPE}')
      UNION ALL SELECT 'date_service_calendar' FROM d WHERE regexp_matches(date_service, '{DATE_SHAPE}') AND s IS NULL
      UNION ALL SELECT 'date_service_before_now' FROM d WHERE s >= DATE '{AS_OF}'
      UNION ALL SELECT 'date_received_before_now' FROM d WHERE r >= DATE '{AS_OF}'
      UNION ALL SELECT 'date_service_after_date_received' FROM d WHERE s > r
      UNION ALL SELECT 'procedure_code_valid' FROM d
        WHERE procedure_code NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)
      UNION ALL SELECT 'claim_id_unique' FROM (SELECT claim_id FROM d WHERE claim_id IS NOT NULL GROUP BY 1
        HAVING count(*) > 1))
    GROUP BY 1""")
def dq_report(t: Tables) -> DataFrame:
    """Number of findings per rule over one delivery of claims."""
    claims = _claims(t)
    as_of = F.lit(AS_OF).cast("date")
    unknown = invalid_codes(claims.select("claim_id", "procedure_code"), "procedure_code", _valid_parts(t), "p_partkey")
    repeated = duplicated_keys(claims.filter("claim_id is not null"), ["claim_id"])
    everything = report(
        failing_rows(with_days(claims, "date_service", "date_received"), "claim_id", claim_rules(as_of)),
        findings(unknown, "procedure_code_valid", "claim_id", "procedure_code"),
        findings(repeated, "claim_id_unique", "claim_id", "n_rows"),
    )
    return frequency(everything, "rule")


_ORDERED_CLAIMS = CLAIMS_SQL.replace("SELECT CASE", """SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
      l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) - 1 AS row, l_suppkey, CASE""", 1)


@query(rf"""
    WITH c AS ({_ORDERED_CLAIMS}),
    d AS (SELECT *,
      CASE WHEN regexp_matches(date_service, '{DATE_SHAPE}') THEN CAST(try_strptime(date_service, '%Y-%m-%d') AS DATE)
        END AS s, CAST(date_received AS DATE) AS r FROM c),
    x AS (SELECT row, replace(unnest(regexp_extract_all(diagnosis_codes, '[A-Z]{{1}}\d{{2}}\.?\d*')), '.', '') AS code FROM d)
    SELECT 'claim_id_present' AS rule, row, NULL AS value FROM d WHERE claim_id IS NULL
    UNION ALL SELECT 'diagnosis_shape', row, diagnosis_codes FROM d WHERE NOT regexp_matches(diagnosis_codes, '[A-Z]{{1}}\d{{2}}\.?\d*')
    UNION ALL SELECT 'date_service_type', row, date_service FROM d WHERE try_strptime(date_service, '%Y-%m-%d') IS NULL
    UNION ALL SELECT 'date_service_format', row, date_service FROM d WHERE NOT regexp_matches(date_service, '{DATE_SHAPE}')
    UNION ALL SELECT 'date_service_calendar', row, date_service FROM d WHERE regexp_matches(date_service, '{DATE_SHAPE}') AND s IS NULL
    UNION ALL SELECT 'date_service_before_now', row, date_service FROM d WHERE s >= DATE '{AS_OF}'
    UNION ALL SELECT 'date_received_before_now', row, date_received FROM d WHERE r >= DATE '{AS_OF}'
    UNION ALL SELECT 'date_service_after_date_received', row, date_service || ' > ' || date_received FROM d WHERE s > r
    UNION ALL SELECT 'procedure_code_valid', row, CAST(procedure_code AS VARCHAR) FROM d
      WHERE procedure_code NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)
    UNION ALL SELECT 'diagnosis_code_valid', row, code FROM x WHERE code NOT IN (SELECT f || lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') || '1' FROM supplier, (VALUES ('A'), ('N')) v(f))
    UNION ALL SELECT 'claim_id_unique', row, CAST(claim_id AS VARCHAR) FROM d
      WHERE claim_id IN (SELECT claim_id FROM d GROUP BY 1 HAVING count(*) > 1)""")
def dq_error_list(t: Tables) -> DataFrame:
    """All errors of one delivery of claims with the number of their row: declared types and gaps, shapes and dates,
    procedure codes, each diagnosis code that was extracted, and claim ids that repeat."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus"]
    claims = numbered(_claims(t, *order), order).drop(*order)
    delivered = claims.select("row", *[F.col(c).cast("string").alias(c) for c in claims.columns if c != "row"])
    declared = T.StructType([
        T.StructField("claim_id", T.LongType(), False), T.StructField("procedure_code", T.IntegerType()),
        T.StructField("date_service", T.DateType()), T.StructField("date_received", T.DateType())])
    rules = {k: v for k, v in claim_rules(F.lit(AS_OF).cast("date")).items() if k != "claim_id_present"}
    listed = t.supplier.select(F.explode(F.transform(F.array(F.lit("A"), F.lit("N")), lambda flag: F.concat(
        flag, F.lpad((F.col("s_suppkey") % 100).cast("string"), 2, "0"), F.lit("1")))).alias("code")).distinct()
    codes = {
        "procedure_code_valid": (
            delivered.select("row", F.col("procedure_code").alias("code")), _valid_parts(t).select(F.col("p_partkey").alias("code"))),
        "diagnosis_code_valid": (extracted_codes(delivered, "row", "diagnosis_codes"), listed),
    }
    return error_list(with_days(delivered, "date_service", "date_received"), declared, rules, codes, ["claim_id"])


@query("""
    SELECT 'p_size' AS column_name, CAST(min(p_size) AS DOUBLE) AS min_value, CAST(max(p_size) AS DOUBLE) AS max_value
      FROM part
    UNION ALL SELECT 'p_retailprice', min(p_retailprice), max(p_retailprice) FROM part
    UNION ALL SELECT 'sparse', NULL, NULL""")
def minmax_nullsafe(t: Tables) -> DataFrame:
    parts = t.part.select("p_size", "p_retailprice", F.nullif("p_size", F.lit(1)).alias("sparse"))
    return null_safe_extremes(parts, ["p_size", "p_retailprice", "sparse"])
