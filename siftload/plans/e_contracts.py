"""Status of contracts that are signed electronically."""

from pyspark.sql import DataFrame

from siftload.functions import dates
from siftload.plans import fixed_values as fv
from siftload.plans.common import blank, c, known, label, local_minutes, user, without_test_customers
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = ("fixed_order", "string_map", "account", "excluded_customers", "sold_product", "contract", "system_user")
NEEDS = ("sites",)
TARGET = [
    "ORDER_NUMBER", "NIP", "ID_SOW", "CONTRACT_NUMBER", "CONTRACT_STATUS", "CONTRACT_TYPE", "DOC_TYPE", "SENT_TO_CUSTOMER_DATE",
    "ECONTRACT_STATUS", "CUSTOMER_SIGNED_DATE", "MODIFIED_ON",
]


def orders_of_sites(t: Tables, p: Params) -> DataFrame:
    """Numbered, not cancelled orders whose owner or second owner sits at one of the sites."""
    orders = t["fixed_order"].where(
        c("elob_ordernumber").isNotNull()
        & (c("statuscode") != fv.ORDER_CANCELLED)
        & (c("createdon") >= dates.ntz(p.fixed_orders_from))
    )
    orders = user(orders, t, "ownerid", "owner", "siteid", "businessunitid", how="inner")
    orders = user(orders, t, "elob_doublebooking", "second", "siteid")
    return orders.where(c("owner_siteid").isin(*p.sites) | c("second_siteid").isin(*p.sites))


def build(t: Tables, p: Params) -> DataFrame:
    orders = known(orders_of_sites(t, p), t, "statuscode", fv.ORDER_STATUS)
    orders = known(orders, t, "elob_operation", fv.ORDER_OPERATION_POLISH).select(
        "elob_ordernumber", "elob_customer", "elob_soldproduct", "elob_contract"
    )
    accounts = known(without_test_customers(t["account"], t), t, "elob_businesssegment", fv.SEGMENT).select(
        "accountid", "elob_nip", "elob_sowid"
    )
    parents = t["sold_product"].select(c("elob_soldproductid").alias("elob_soldproduct"))
    children = t["sold_product"].select(c("elob_parentsoldproduct").alias("elob_soldproduct"))
    contracts = t["contract"].where(c("elob_transferdocumenttype").isin(fv.ECONTRACT, fv.ECONTRACT_AUTO)).select(
        "contractid", "contractnumber", "elob_contracttype", "elob_transferdocumenttype", "elob_econtractstatus", "statuscode",
        "elob_senttocustomeron", "elob_signedbycustomeron", "modifiedon",
    )
    contracts = label(contracts, t, "elob_contracttype", "CONTRACT_TYPE", fv.CONTRACT_TYPE, "inner")
    contracts = label(contracts, t, "statuscode", "CONTRACT_STATUS", fv.CONTRACT_STATUS, "inner")
    contracts = label(contracts, t, "elob_transferdocumenttype", "DOC_TYPE", fv.TRANSFER_DOCUMENT)
    contracts = label(contracts, t, "elob_econtractstatus", "econtract_label", fv.ECONTRACT_STATUS)
    out = (
        orders.join(parents, "elob_soldproduct", "left_semi")
        .join(children, "elob_soldproduct", "left_semi")
        .join(accounts, c("elob_customer") == c("accountid"))
        .join(contracts, c("elob_contract") == c("contractid"))
    )
    return out.select(
        c("elob_ordernumber").alias("ORDER_NUMBER"),
        c("elob_nip").alias("NIP"),
        c("elob_sowid").alias("ID_SOW"),
        c("contractnumber").alias("CONTRACT_NUMBER"),
        "CONTRACT_STATUS",
        "CONTRACT_TYPE",
        "DOC_TYPE",
        local_minutes(c("elob_senttocustomeron"), dates.CONTRACT_HOUR_SHIFTS, p).alias("SENT_TO_CUSTOMER_DATE"),
        blank(c("econtract_label")).alias("ECONTRACT_STATUS"),
        local_minutes(c("elob_signedbycustomeron"), dates.CONTRACT_HOUR_SHIFTS, p).alias("CUSTOMER_SIGNED_DATE"),
        dates.date_to_text(c("modifiedon")).alias("MODIFIED_ON"),
    ).distinct()
