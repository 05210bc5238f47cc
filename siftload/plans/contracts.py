"""Contract status with order or phone numbers; a second table holds its distinct contracts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftload.functions import dates, text
from siftload.plans import fixed_values as fv
from siftload.plans.common import blank, c, label, without_test_customers
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = (
    "contract", "category", "account", "excluded_customers", "fixed_order", "mobile_order", "mobile_order_item", "string_map", "contract_archive",
)
NEEDS = ("fix_category", "mobile_category")
TARGET = ["CONTRACT_NUMBER", "CONTRACT_STATUS", "CONTRACT_TYPE", "ORDER_NUMBER", "CONTRACT_ID", "VERIFICATION_DATE", "ARCH_DATE"]
DERIVED = ["CONTRACT_ID", "CONTRACT_NUMBER", "VERIFICATION_DATE", "CONTRACT_STATUS"]


def order_numbers(t: Tables, p: Params) -> DataFrame:
    """Numbers per (contract, kind of contract). One table for both kinds, so a fixed contract never meets
    mobile rows and no product of the two has to be undone later."""
    items = t["mobile_order_item"].select("elob_mobileorder", c("elob_msisdnnumber").alias("number"))
    mobile = t["mobile_order"].select("elob_mobileorderid", c("elob_contract").alias("number_of")).join(
        items, c("elob_mobileorderid") == c("elob_mobileorder"), "left"
    )
    fixed = t["fixed_order"].select(
        c("elob_contract").alias("number_of"), F.lit(p.fix_category).alias("number_kind"), c("elob_ordernumber").alias("number")
    )
    return fixed.unionByName(mobile.select("number_of", F.lit(p.mobile_category).alias("number_kind"), "number"))


def build(t: Tables, p: Params) -> DataFrame:
    accounts = without_test_customers(t["account"].select("accountid", "elob_sowid"), t).select("accountid")
    archive = t["contract_archive"].where(text.fits(c("elob_comments"), fv.ARCHIVED_PATTERN)).select(
        c("elob_contract").alias("archived"), "elob_archivingdate"
    )
    categories = t.lookup("category").select("elob_categoryid", c("elob_name").alias("category_name"))
    contracts = (
        t["contract"]
        .where(c("createdon") >= dates.ntz(p.contracts_from))
        .select("contractid", "contractnumber", "customerid", "statuscode", "elob_categoryid", "elob_revisiondate")
        .join(categories, "elob_categoryid")
    )
    contracts = label(contracts, t, "statuscode", "status_label", fv.CONTRACT_STATUS, "inner")
    contracts = contracts.join(accounts, c("customerid") == c("accountid"), "left_semi")
    numbered = contracts.join(
        order_numbers(t, p), (c("contractid") == c("number_of")) & (c("elob_categoryid") == c("number_kind")), "left"
    ).join(archive, c("contractid") == c("archived"), "left")
    return numbered.select(
        c("contractnumber").alias("CONTRACT_NUMBER"),
        F.upper("status_label").alias("CONTRACT_STATUS"),
        F.upper("category_name").alias("CONTRACT_TYPE"),
        blank(c("number")).alias("ORDER_NUMBER"),
        text.guid_to_text(c("contractid")).alias("CONTRACT_ID"),
        blank(dates.date_to_text(c("elob_revisiondate"))).alias("VERIFICATION_DATE"),
        blank(dates.date_to_text(dates.add_days(c("elob_archivingdate")))).alias("ARCH_DATE"),
    ).distinct()
