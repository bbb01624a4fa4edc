"""Cleaning expressions and cleaned claim sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from estrato.functions.dates import parse_date
from estrato.functions.text import file_extension, file_label, file_name, join_text, split_name
from estrato.operators.dedup import dedup_by
from estrato.plans import claims as plan
from estrato.plans import training
from estrato.workload.registry import Tables, best_row, query, raw
from estrato.workload.standins import columns

# Expressions over the stand-in customers; list positions of the parts are 1-based here.
BORN = (
    "CAST(coalesce(try_strptime(date_of_birth, '%m/%d/%Y'), try_strptime(date_of_birth, '%d/%m/%Y'), "
    "try_strptime(date_of_birth, '%Y-%m-%d'), try_strptime(date_of_birth, '%d-%m-%Y'), "
    "try_strptime(date_of_birth, '%Y/%m/%d')) AS DATE)"
)
LAST, FIRST = "str_split(trim(name), ', ')[1]", "str_split(trim(name), ', ')[2]"
ADDRESS = (
    "coalesce(borough, '') || ', ' || coalesce(neighborhood, '') || ', ' || coalesce(CAST(zip_code AS VARCHAR), '')"
)
NAME_OF = "regexp_extract(url, '[^/]*$')"

CUSTOMERS = f"""{raw('customers')}, customers_typed AS (
    SELECT customer_id, {BORN} AS date_of_birth, trim(name) AS name, borough, neighborhood, zip_code,
           {LAST} AS last_name, {FIRST} AS first_name, {ADDRESS} AS address FROM customers),
    customers_clean AS (SELECT * FROM customers_typed
        WHERE date_of_birth IS NOT NULL AND trim(name) <> '' AND first_name <> '' AND last_name <> '')"""
POLICIES = f"""{raw('policies')}, policies_clean AS (SELECT * FROM policies
    WHERE POLICY_NO IS NOT NULL AND CUST_ID IS NOT NULL AND PREMIUM >= 0 AND POL_EFF_DATE <= POL_EXPIRY_DATE)"""
CLAIMS = f"""{raw('claims')}, claims_clean AS (SELECT * FROM claims
        WHERE claim_no IS NOT NULL AND policy_no IS NOT NULL AND total >= 0 AND age > 0)"""
TELEMATICS = f"""{raw('telematics')}, telematics_clean AS (SELECT * FROM telematics
    WHERE chassis_no IS NOT NULL AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND speed >= 0)"""
METADATA = (
    f"{raw('metadata')}, metadata_clean AS ({best_row('metadata', columns('metadata'), ['image_name'], ['image_id'])})"
)


def customers(t: Tables):
    return plan.clean_customers(t.standin("customers"))


def policies(t: Tables):
    return plan.clean_policies(t.standin("policies"))


def claims(t: Tables):
    """All claims: a claim may have several rows, each with an amount of its own."""
    return plan.clean_claims(t.standin("claims"))


def telematics(t: Tables):
    out = plan.clean_telematics(t.standin("telematics"))
    return out.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def metadata(t: Tables, vehicles: bool = True):
    return plan.clean_metadata(t.standin("metadata"), vehicles)


def images(t: Tables):
    return t.standin("images")


query("clean_customers", f"WITH {CUSTOMERS} SELECT * FROM customers_clean")(customers)
query("clean_policies", f"WITH {POLICIES} SELECT * FROM policies_clean")(policies)
query("clean_claims", f"WITH {CLAIMS} SELECT * FROM claims_clean")(claims)
query("clean_telematics", f"WITH {TELEMATICS} SELECT * FROM telematics_clean")(telematics)
query("clean_metadata", f"WITH {METADATA} SELECT * FROM metadata_clean")(metadata)


@query("parse_mixed_dates", f"WITH {raw('customers')} SELECT customer_id, {BORN} AS date_of_birth FROM customers")
def parse_mixed_dates(t: Tables):
    return t.standin("customers").select("customer_id", parse_date(F.col("date_of_birth")).alias("date_of_birth"))


@query(
    "split_name",
    f"WITH {raw('customers')} SELECT customer_id, {LAST} AS last_name, {FIRST} AS first_name FROM customers",
)
def split_names(t: Tables):
    last, first = split_name(F.col("name"))
    return t.standin("customers").select("customer_id", last.alias("last_name"), first.alias("first_name"))


@query("compose_address", f"WITH {raw('customers')} SELECT customer_id, {ADDRESS} AS address FROM customers")
def compose_address(t: Tables):
    address = join_text(F.col("borough"), F.col("neighborhood"), F.col("zip_code"))
    return t.standin("customers").select("customer_id", address.alias("address"))


@query(
    "file_parts",
    f"SELECT page_id, {NAME_OF} AS image_name, str_split({NAME_OF}, '_')[1] AS label, "
    f"lower(regexp_extract({NAME_OF}, '\\.(\\w+)$', 1)) AS extension FROM pages",
)
def file_parts(t: Tables):
    name = file_name(F.col("url"))
    return t.pages.select(
        "page_id", name.alias("image_name"), file_label(name).alias("label"), file_extension(name).alias("extension")
    )


@query(
    "extension_counts",
    f"SELECT lower(regexp_extract({NAME_OF}, '\\.(\\w+)$', 1)) AS extension, count(*) AS n FROM pages "
    f"WHERE {NAME_OF} <> '' GROUP BY 1",
)
def extension_counts(t: Tables):
    return training.extension_counts(plan.clean_images(images(t)))


@query(
    "clean_images",
    f"SELECT url AS path, {NAME_OF} AS image_name, str_split({NAME_OF}, '_')[1] AS label FROM pages "
    f"WHERE {NAME_OF} <> ''",
)
def clean_images(t: Tables):
    return plan.clean_images(images(t), labelled=True).select("path", "image_name", "label")


@query("dedup_any", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_any(t: Tables):
    return t.lineitem.dropDuplicates(["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber")


_LINE = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


@query("dedup_latest", best_row("lineitem", _LINE, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
def dedup_latest(t: Tables):
    return dedup_by(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
