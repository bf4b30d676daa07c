"""Deduplication, slowly changing dimensions and fact appends on whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import business_key, hash_identifier, match_method, standardize_name
from martloom.operators.append import new_facts
from martloom.operators.dedup import duplicate_keys, first_per_key, latest_per_key
from martloom.operators.merge import Scd1, Scd2, scd1_upsert, scd2_merge
from martloom.operators.schema import columns
from martloom.queries.registry import query, read
from martloom.sources.scratch import scratch_dir, stored
from martloom.sources.sketched import append_part
from martloom.sources.tables import empty_rows

# Orders are news about their customer: an earlier batch and a later one, by order date.
CUT = date(1999, 1, 1)
FIRST, SECOND = date(1999, 1, 31), date(2001, 12, 31)
_LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINE_REST = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]
_LINE_COLUMNS = ", ".join([*_LINE_KEY, "l_shipdate", *_LINE_REST])
_LINE_ORDER = ", ".join(f"{c} DESC" for c in ["l_shipdate", *_LINE_REST])


@query(f"""
    SELECT {_LINE_COLUMNS} FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1""")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(read(spark, sf_dir, "lineitem"), _LINE_KEY, ["l_shipdate"])


@query("""
    SELECT user_id, event_id, ts, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few keys, many rows each: one row per key and task is shuffled."""
    return first_per_key(
        read(spark, sf_dir, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]
    )


@query("SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    return lines.select(*_LINE_KEY, "l_returnflag", "l_linestatus").distinct()


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def merge_source_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(read(spark, sf_dir, "lineitem"), _LINE_KEY)


# --- type 2

CUSTOMER_DIM = columns(
    customer_id="BIGINT",
    status="STRING",
    priority="STRING",
    total="DECIMAL(12,2)",
    is_current="BOOLEAN",
    effective_date="DATE",
    end_date="DATE",
    created_date="DATE",
    updated_date="DATE",
)
CUSTOMER = Scd2(keys=("customer_id",), tracked=("status", "priority"))
# A status missing in one batch and there in the other is a change only if compared NULL-safe.
_NEWS = """SELECT o_custkey AS customer_id,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderstatus END AS status,
    o_orderpriority AS priority, CAST(o_totalprice AS DECIMAL(12,2)) AS total,
    o_orderdate, o_orderkey FROM orders"""


def _latest_sql(condition: str) -> str:
    return f"""SELECT customer_id, status, priority, total FROM ({_NEWS}) WHERE {condition}
        QUALIFY row_number() OVER (PARTITION BY customer_id
                                   ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""


_BEFORE = _latest_sql(f"o_orderdate < DATE '{CUT}'")
_SINCE = _latest_sql(f"o_orderdate >= DATE '{CUT}'")


def _customer_dim_sql(differs: str, expire_only: bool) -> str:
    closed = f"(b.customer_id IS NOT NULL AND coalesce({differs}, FALSE))"
    inserted = "a.customer_id IS NULL" + ("" if expire_only else f" OR {differs}")
    return f"""
        WITH a AS ({_BEFORE}), b AS ({_SINCE})
        SELECT a.*, NOT {closed} AS is_current, DATE '{FIRST}' AS effective_date,
               CASE WHEN {closed} THEN DATE '2001-12-30' END AS end_date,
               DATE '{FIRST}' AS created_date,
               CASE WHEN {closed} THEN DATE '{SECOND}' ELSE DATE '{FIRST}' END AS updated_date
        FROM a LEFT JOIN b ON a.customer_id = b.customer_id
        UNION ALL
        SELECT b.*, TRUE, DATE '{SECOND}', NULL, DATE '{SECOND}', DATE '{SECOND}'
        FROM b LEFT JOIN a ON a.customer_id = b.customer_id WHERE {inserted}"""


CUSTOMER_DIM_SQL = _customer_dim_sql(
    "(a.status IS DISTINCT FROM b.status OR a.priority IS DISTINCT FROM b.priority)", False
)


def customer_news(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The latest news of each customer, before the cut and since; written, as merges read it often."""
    news = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderstatus")).alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total"),
        "o_orderdate",
        "o_orderkey",
    )
    is_first = F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")
    return tuple(
        stored(
            latest_per_key(news.where(part), ["customer_id"], ["o_orderdate", "o_orderkey"]).drop(
                "o_orderdate", "o_orderkey"
            )
        )
        for part in (is_first, ~is_first)
    )


def customer_dim(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    before, since = customer_news(spark, sf_dir)
    dim = empty_rows(spark, CUSTOMER_DIM)
    dim = stored(scd2_merge(dim, before, CUSTOMER, FIRST, FIRST, **options))
    return scd2_merge(dim, since, CUSTOMER, SECOND, SECOND, **options)


@query(CUSTOMER_DIM_SQL, name="scd2_merge")
def scd2_merge_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_dim(spark, sf_dir)


@query(CUSTOMER_DIM_SQL)
def scd2_merge_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for batches too big to broadcast."""
    return customer_dim(spark, sf_dir, broadcast_source=False)


@query(_customer_dim_sql("(a.status <> b.status OR a.priority <> b.priority)", True))
def scd2_merge_expire_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A changed key is closed and not reopened, and NULL against a value is no change."""
    return customer_dim(spark, sf_dir, expire_only=True, null_safe=False)


PERSON_DIM = columns(
    person_key="STRING",
    name="STRING",
    id_hash="STRING",
    is_current="BOOLEAN",
    effective_date="DATE",
    end_date="DATE",
    created_date="DATE",
    updated_date="DATE",
)
PERSON = Scd2(keys=("person_key",), tracked=("name", "id_hash"))


def _persons_sql(condition: str) -> str:
    return f"""
        SELECT coalesce(id_hash, name || '_NAME_DOB') AS person_key, name, id_hash
        FROM (SELECT trim(regexp_replace(upper(o_orderpriority || ' ' || o_orderstatus),
                                         '[^A-Z\\s]', '', 'g')) AS name,
                     CASE WHEN o_totalprice >= 100000 THEN sha256(CAST(o_custkey AS VARCHAR)) END AS id_hash,
                     o_orderdate, o_orderkey FROM orders)
        WHERE {condition}
        QUALIFY row_number() OVER (PARTITION BY coalesce(id_hash, name || '_NAME_DOB')
                                   ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""


@query(f"""
    WITH a AS ({_persons_sql(f"o_orderdate < DATE '{CUT}'")}),
         b AS ({_persons_sql(f"o_orderdate >= DATE '{CUT}'")})
    SELECT a.*, NOT coalesce(a.name <> b.name, FALSE) AS is_current, DATE '{FIRST}' AS effective_date,
           CASE WHEN a.name <> b.name THEN DATE '2001-12-30' END AS end_date,
           DATE '{FIRST}' AS created_date,
           CASE WHEN a.name <> b.name THEN DATE '{SECOND}' ELSE DATE '{FIRST}' END AS updated_date
    FROM a LEFT JOIN b ON a.person_key = b.person_key
    UNION ALL
    SELECT b.*, TRUE, DATE '{SECOND}', NULL, DATE '{SECOND}', DATE '{SECOND}'
    FROM b LEFT JOIN a ON a.person_key = b.person_key
    WHERE a.person_key IS NULL OR a.name <> b.name""")
def scd2_derived_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys made from a hashed identifier, or from a name where that is missing: few, and hot."""
    identifier = F.when(F.col("o_totalprice") >= 100000, F.col("o_custkey").cast("string"))
    name = standardize_name(F.concat_ws(" ", "o_orderpriority", "o_orderstatus"))
    id_hash = hash_identifier(identifier)
    persons = read(spark, sf_dir, "orders").select(
        business_key(id_hash, [name], match_method(identifier)).alias("person_key"),
        name.alias("name"),
        id_hash.alias("id_hash"),
        "o_orderdate",
        "o_orderkey",
    )
    is_first = F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")
    first, second = (
        stored(
            latest_per_key(persons.where(part), ["person_key"], ["o_orderdate", "o_orderkey"]).drop(
                "o_orderdate", "o_orderkey"
            )
        )
        for part in (is_first, ~is_first)
    )
    dim = stored(scd2_merge(empty_rows(spark, PERSON_DIM), first, PERSON, FIRST, FIRST))
    return scd2_merge(dim, second, PERSON, SECOND, SECOND)


# --- type 1

CONTACT_DIM = columns(
    customer_id="BIGINT",
    status="STRING",
    priority="STRING",
    total="DECIMAL(12,2)",
    is_current="BOOLEAN",
    created_date="DATE",
    updated_date="DATE",
)
CONTACT = Scd1(keys=("customer_id",), attributes=("status", "priority", "total"))


def _contacts_sql(before: str, since: str) -> str:
    picked = ", ".join(
        f"CASE WHEN b.customer_id IS NULL THEN a.{c} ELSE b.{c} END AS {c}"
        for c in ("customer_id", "status", "priority", "total")
    )
    return f"""
        WITH a AS ({before}), b AS ({since})
        SELECT {picked}, TRUE AS is_current,
               CASE WHEN a.customer_id IS NULL THEN DATE '{SECOND}' ELSE DATE '{FIRST}' END AS created_date,
               CASE WHEN b.customer_id IS NULL THEN DATE '{FIRST}' ELSE DATE '{SECOND}' END AS updated_date
        FROM a FULL JOIN b ON a.customer_id = b.customer_id"""


@query(_contacts_sql(_BEFORE, _SINCE))
def scd1_upsert_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources must have one row per key, and here do."""
    before, since = customer_news(spark, sf_dir)
    dim = stored(scd1_upsert(empty_rows(spark, CONTACT_DIM), before, CONTACT, FIRST))
    return scd1_upsert(dim, since, CONTACT, SECOND)


def _highest_sql(condition: str) -> str:
    return f"""SELECT customer_id, status, priority, total FROM ({_NEWS}) WHERE {condition}
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY total DESC, status DESC NULLS LAST,
                                   priority DESC) = 1"""


@query(_contacts_sql(
    _highest_sql(f"o_orderdate < DATE '{CUT}'"), _highest_sql(f"o_orderdate >= DATE '{CUT}'")
), name="scd1_upsert")
def scd1_upsert_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with many rows per key, of which the one with the highest total counts."""
    news = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderstatus")).alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total"),
        "o_orderdate",
    )
    is_first = F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")
    order = [F.col("total").desc_nulls_last()]
    dim = empty_rows(spark, CONTACT_DIM)
    dim = stored(scd1_upsert(dim, news.where(is_first), CONTACT, FIRST, order=order))
    return scd1_upsert(dim, news.where(~is_first), CONTACT, SECOND, order=order)


# --- facts

# The batches overlap by half a year, so the second brings lines the first has brought.
_LOADED = "l_shipdate < DATE '1999-01-01'"
_ARRIVED = "l_shipdate >= DATE '1998-07-01'"
_NEW_LINES_SQL = f"""
    SELECT DISTINCT {_LINE_COLUMNS} FROM lineitem b WHERE {_ARRIVED}
    AND NOT EXISTS (SELECT 1 FROM lineitem a WHERE a.{_LOADED}
                    AND a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber)"""


def _line_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = read(spark, sf_dir, "lineitem")
    return lines.where(_LOADED), lines.where(_ARRIVED)


@query(_NEW_LINES_SQL)
def append_new_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded, arrived = _line_batches(spark, sf_dir)
    return new_facts(arrived, loaded, _LINE_KEY)


@query(_NEW_LINES_SQL)
def append_new_facts_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for batches whose keys are too many to broadcast."""
    loaded, arrived = _line_batches(spark, sf_dir)
    return new_facts(arrived, loaded, _LINE_KEY, broadcast_keys=False)


@query(f"""
    SELECT {_LINE_COLUMNS} FROM lineitem b WHERE {_ARRIVED}
    AND NOT EXISTS (SELECT 1 FROM lineitem a WHERE a.{_LOADED}
                    AND a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber)
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
                 l_tax DESC, l_returnflag DESC, l_linestatus DESC, l_shipdate DESC) = 1""")
def append_one_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded, arrived = _line_batches(spark, sf_dir)
    return new_facts(arrived, loaded, _LINE_KEY, one_per_key=True)


_HELD_LINES = "l_orderkey % 2 = 0 AND l_orderkey <= 0.75 * (SELECT max(l_orderkey) FROM lineitem)"


@query(f"""
    SELECT DISTINCT {_LINE_COLUMNS} FROM lineitem
    WHERE l_orderkey > 0.6 * (SELECT max(l_orderkey) FROM lineitem) AND NOT ({_HELD_LINES})""")
def append_new_facts_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three parts by ranges of order keys; a batch that overlaps the last of them opens that one only."""
    path = scratch_dir(spark, "sketched")
    lines = read(spark, sf_dir, "lineitem").selectExpr(*[c.strip() for c in _LINE_COLUMNS.split(",")])
    greatest = lines.agg(F.max("l_orderkey")).first()[0] or 0
    key = F.col("l_orderkey")
    even = lines.where(key % 2 == 0)
    for part, low, high in (("1", -1, 0.25), ("2", 0.25, 0.5), ("3", 0.5, 0.75)):
        rows = even.where((key > low * greatest) & (key <= high * greatest))
        append_part(rows, path, part, ["l_orderkey"], dense=True)
    return append_part(lines.where(key > 0.6 * greatest), path, "4", ["l_orderkey"], dense=True)
