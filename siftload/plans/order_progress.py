"""Progress of fixed-line orders towards the electronic contract, and what stands in its way."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftload.functions import codes, dates
from siftload.plans import fixed_values as fv
from siftload.plans.common import blank, c, known, label, without_test_customers
from siftload.plans.e_contracts import orders_of_sites
from siftload.plans.params import Params
from siftload.sources.staging import staged
from siftload.sources.tables import Tables

SOURCES = (
    "fixed_order", "string_map", "account", "excluded_customers", "sold_product", "product", "contract", "work_order", "sold_product_parameter",
    "product_parameter", "product_parameter_value", "billing_account", "system_user", "business_unit",
)
NEEDS = ("sites", "service_kind_parameter")
TARGET = [
    "ID_SOW", "ORDER_NUMBER", "CREATED_ON", "MODIFIED_ON", "ORDER_STATUS", "SERVICE", "SERVICE_TYPE", "REALIZATION_TYPE", "CONTRACT_SIGNED_BY",
    "CONTRACT_IS_ECONTRACT", "CONTRACT_IS_ECONTRACT_AUTO", "CONTRACT_NUMBER", "CONTRACT_THREE_SIDED", "CONTRACT_TYPE", "TRANSFER_DOC_TYPE",
    "LAST_WORK_ORDER_NUMBER", "IS_REALIZED_BY_ECONTRACT", "BARRIERS",
]


class Facts:
    """Named conditions of an order; the rule lists are written with them."""

    def __init__(self):
        document, mode, kind = c("elob_transferdocumenttype"), c("elob_acceptancefornoncontractmode"), c("elob_contracttype")
        self.done = c("order_statuscode") == fv.ORDER_DONE
        self.running = c("order_statuscode") != fv.ORDER_DONE
        self.econtract = document == fv.ECONTRACT
        self.econtract_auto = document == fv.ECONTRACT_AUTO
        self.no_econtract = ~document.isin(fv.ECONTRACT, fv.ECONTRACT_AUTO) | document.isNull()
        self.signed = c("elob_contractsignedby").isNotNull()
        self.numbers = F.coalesce(c("has_numbers"), F.lit(False))
        self.linked = F.coalesce(c("has_linked"), F.lit(False))
        self.without_contract_mode = mode.isin(1, 0)
        self.no_such_mode = ~mode.isin(1, 0) | mode.isNull()
        self.mode_allows = mode.isNull() | (mode == 2)
        self.mode_unknown = mode.isNull()
        self.mode_other = ~mode.isin(1, 0)
        self.standard = kind.isin(*fv.STANDARD_CONTRACT_TYPES)
        self.special = ~kind.isin(*fv.STANDARD_CONTRACT_TYPES)
        self.three_sided = c("three_sided") == fv.YES
        self.two_sided = (c("three_sided") == fv.NO) | c("three_sided").isNull()
        self.no_contract = c("contractid").isNull()
        self.au = c("new_sokxordertype") == fv.WORK_ORDER_AU
        self.no_au = (c("new_sokxordertype") != fv.WORK_ORDER_AU) | c("new_sokxordertype").isNull()
        self.switched_off = (c("elob_econtract") == 0) & (c("elob_availableforecontractautomatic") == 0)


def progress(f: Facts) -> Column:
    no_values = ~f.numbers & ~f.linked
    unmet = f.numbers | f.linked | f.without_contract_mode | f.special | f.three_sided
    met = no_values & f.standard & f.two_sided & f.mode_allows & f.no_econtract & f.no_au
    met_without_contract = f.no_contract & f.no_au & no_values
    stopped_by_au = f.au & no_values & ((f.standard & f.two_sided) | f.no_contract)
    off = f.switched_off & ~f.signed
    return codes.classify([
        (f.econtract & f.running, fv.BY_ECONTRACT),
        (f.econtract & f.done, fv.DONE_BY_ECONTRACT),
        (f.econtract_auto & f.running, fv.BY_ECONTRACT_AUTO),
        (f.econtract_auto & f.done, fv.DONE_BY_ECONTRACT_AUTO),
        (f.done & f.signed, fv.SIGNED_DONE),
        (f.running & f.signed, fv.SIGNED_RUNNING),
        (f.done & unmet, fv.UNMET_DONE),
        (f.running & unmet, fv.UNMET_RUNNING),
        (f.running & met, fv.MET_RUNNING),
        (f.done & met, fv.COULD_DONE),
        (f.done & met_without_contract, fv.COULD_DONE),
        (f.running & met_without_contract, fv.MET_RUNNING),
        (f.done & stopped_by_au, fv.COULD_DONE),
        (f.running & stopped_by_au, fv.COULD_RUNNING),
        (f.done & off, fv.UNMET_DONE),
        (f.running & off, fv.UNMET_RUNNING),
    ])


def barriers(f: Facts) -> Column:
    standard_or_none = f.standard | f.no_contract
    # The third barrier's mode test reads "(other mode and no e-contract) or mode unknown".
    loose_mode = (f.mode_other & f.no_econtract) | f.mode_unknown
    return codes.classify([
        (f.special & f.two_sided & ~f.numbers & ~f.linked & ~f.signed & f.no_econtract & f.no_such_mode, fv.BARRIER_CONTRACT),
        (f.three_sided & f.standard & ~f.numbers & ~f.linked & ~f.signed & loose_mode, fv.BARRIER_THREE_SIDED),
        (f.numbers & standard_or_none & f.no_econtract & f.two_sided & ~f.linked & ~f.signed & f.no_such_mode, fv.BARRIER_NUMBERS),
        (f.linked & standard_or_none & f.two_sided & ~f.numbers & ~f.signed & f.no_econtract & f.no_such_mode, fv.BARRIER_LINKED_ORDER),
        (f.without_contract_mode & f.two_sided & ~f.numbers & ~f.linked & standard_or_none & f.no_econtract, fv.BARRIER_NO_CONTRACT),
        (f.special & f.three_sided & f.no_econtract, fv.BARRIER_OTHER),
        (f.special & f.linked & f.no_econtract, fv.BARRIER_OTHER),
        (f.special & f.numbers & f.no_econtract, fv.BARRIER_OTHER),
        (f.special & f.without_contract_mode & f.no_econtract, fv.BARRIER_OTHER),
        (f.numbers & f.linked, fv.BARRIER_OTHER_TIGHT),
        (f.numbers & f.without_contract_mode & f.no_econtract, fv.BARRIER_OTHER_TIGHT),
        (f.linked & f.without_contract_mode & f.no_econtract, fv.BARRIER_OTHER_TIGHT),
        (f.three_sided & f.linked & f.no_econtract, fv.BARRIER_OTHER),
        (f.three_sided & f.numbers & f.no_econtract, fv.BARRIER_OTHER),
        (f.three_sided & f.without_contract_mode & f.no_econtract, fv.BARRIER_OTHER),
    ])


def service_facts(t: Tables, p: Params, wanted: DataFrame) -> DataFrame:
    """Per wanted sold product (service_id), in one pass over its parameters: the answers to "is there a value?" for two parameters,
    and the labels of its service kind.

    The sets are bounded: two answers each, and the labels of three indexes. They are put together before the
    shuffle. Each answer gives a row, as a product may hold a filled and an empty parameter of one name.
    """
    name = F.lower("elob_name")
    asked = t.lookup("product_parameter").select(
        c("elob_productparametersid").alias("asked_id"),
        name.like(fv.MIGRATED_NUMBERS_PATTERN).alias("asks_numbers"),
        (name == fv.LINKED_ORDER_PATTERN).alias("asks_linked"),
        (c("elob_productparametersid") == p.service_kind_parameter).alias("asks_kind"),
    ).where("asks_numbers or asks_linked or asks_kind")
    labels = t.lookup("product_parameter_value").where(
        (c("elob_parameter") == p.service_kind_parameter) & c("elob_index").isin(*fv.SERVICE_KIND_INDEXES)
    ).select(c("elob_index").alias("label_index"), c("elob_value").alias("kind_label"))
    rows = t["sold_product_parameter"].select("elob_soldproduct", "elob_parameter", "elob_parametervalue").join(
        asked, c("elob_parameter") == c("asked_id")
    )
    rows = rows.join(wanted, c("elob_soldproduct") == c("service_id"), "left_semi")
    rows = rows.join(labels, c("asks_kind") & (c("elob_parametervalue") == c("label_index")), "left")
    filled = c("elob_parametervalue").isNotNull()
    sets = rows.groupBy(c("elob_soldproduct").alias("facts_of")).agg(
        F.collect_set(F.when(c("asks_numbers"), filled)).alias("numbers"),
        F.collect_set(F.when(c("asks_linked"), filled)).alias("linked"),
        F.collect_set("kind_label").alias("kinds"),
    )
    out = sets.select("facts_of", "linked", "kinds", F.explode_outer("numbers").alias("has_numbers"))
    out = out.select("facts_of", "kinds", "has_numbers", F.explode_outer("linked").alias("has_linked"))
    return out.select("facts_of", "has_numbers", "has_linked", F.explode_outer("kinds").alias("service_kind"))


def three_sided_contracts(t: Tables) -> DataFrame:
    """Does the billing account belong to another customer than the contract?"""
    billing = t["billing_account"].select("elob_billingaccountid", "elob_account")
    accounts = t["account"].select(c("accountid").alias("elob_account"))
    sides = t["contract"].select(c("contractid").alias("sides_of"), "customerid", "elob_billingaccount")
    joined = sides.join(billing.join(accounts, "elob_account", "left_semi"), c("elob_billingaccount") == c("elob_billingaccountid"))
    flag = F.when(c("customerid") == c("elob_account"), F.lit(fv.NO)).otherwise(F.lit(fv.YES))
    return joined.select("sides_of", flag.alias("three_sided")).distinct()


def base_orders(t: Tables, p: Params) -> DataFrame:
    """What both product families share: orders of the sites, decoded, with contract, last work order and services."""
    orders = orders_of_sites(t, p).where(c("elob_operation") != fv.OPERATION_LEFT_OUT)
    units = t.lookup("business_unit").select(c("businessunitid").alias("owner_businessunitid"))
    orders = orders.join(units, "owner_businessunitid", "left_semi").withColumnsRenamed(
        {"statuscode": "order_statuscode", "createdon": "ordered_on", "modifiedon": "order_modified_on"}
    )
    orders = label(orders, t, "order_statuscode", "ORDER_STATUS", fv.ORDER_STATUS, "inner")
    orders = known(known(orders, t, "elob_operation", fv.ORDER_OPERATION_POLISH), t, "elob_path", fv.ORDER_PATH)
    orders = label(orders, t, "elob_realizationmode", "realization", fv.ORDER_REALIZATION, "inner")
    orders = label(orders, t, "elob_contractsignedby", "signed_by", fv.CONTRACT_SIGNED_BY)
    orders = label(orders, t, "elob_econtract", "econtract_label", fv.ORDER_ECONTRACT)
    orders = label(orders, t, "elob_availableforecontractautomatic", "auto_label", fv.ORDER_ECONTRACT_AUTO)

    products = t.lookup("product").select("productid", F.lower("productnumber").alias("product_number")).where(
        c("product_number").isin(*fv.PROGRESS_PRODUCTS, fv.UPKEEP_PRODUCT)
    )
    parents = t["sold_product"].select("elob_soldproductid", "elob_product").join(products, c("elob_product") == c("productid"))
    services = t["sold_product"].select(
        c("elob_soldproductid").alias("service_id"), c("elob_parentsoldproduct").alias("service_of"), c("elob_name").alias("SERVICE")
    )
    accounts = known(without_test_customers(t["account"], t), t, "elob_businesssegment", fv.SEGMENT).select("accountid", "elob_sowid")
    contracts = t["contract"].select(
        "contractid", "contractnumber", "elob_contracttype", "elob_transferdocumenttype", "elob_acceptancefornoncontractmode"
    )
    contracts = label(contracts, t, "elob_contracttype", "contract_type", fv.CONTRACT_TYPE)
    contracts = label(contracts, t, "elob_transferdocumenttype", "transfer_type", fv.TRANSFER_DOCUMENT)
    contracts = contracts.join(three_sided_contracts(t), c("contractid") == c("sides_of"), "left")
    work = t["work_order"].select("elob_workorder2id", "elob_sokxnumber", "new_sokxordertype")
    return (
        orders.join(parents.select("elob_soldproductid", "product_number"), c("elob_soldproduct") == c("elob_soldproductid"))
        .join(accounts, c("elob_customer") == c("accountid"))
        .join(contracts, c("elob_contract") == c("contractid"), "left")
        .join(work, c("elob_lastworkworder") == c("elob_workorder2id"), "left")
        .join(services, c("elob_soldproduct") == c("service_of"))
    )


def build(t: Tables, p: Params) -> DataFrame:
    """Both product families in one pass: the upkeep family differs only in needing a service kind and in its
    two labels, so the orders are read and joined once and the distinct union is a distinct."""
    upkeep = c("product_number") == fv.UPKEEP_PRODUCT
    facts = Facts()
    upkeep_progress = codes.classify([(facts.running, fv.UPKEEP_RUNNING), (facts.done, fv.UPKEEP_DONE)])
    orders = staged(base_orders(t, p))
    rows = (
        orders.join(service_facts(t, p, orders.select("service_id").distinct()), c("service_id") == c("facts_of"), "left")
        .where(~upkeep | c("service_kind").isNotNull())
    )
    return rows.select(
        c("elob_sowid").alias("ID_SOW"),
        c("elob_ordernumber").alias("ORDER_NUMBER"),
        dates.date_to_text(c("ordered_on")).alias("CREATED_ON"),
        dates.date_to_text(c("order_modified_on")).alias("MODIFIED_ON"),
        "ORDER_STATUS",
        "SERVICE",
        blank(c("service_kind"), " ").alias("SERVICE_TYPE"),
        blank(c("realization")).alias("REALIZATION_TYPE"),
        blank(c("signed_by")).alias("CONTRACT_SIGNED_BY"),
        blank(c("econtract_label")).alias("CONTRACT_IS_ECONTRACT"),
        blank(c("auto_label")).alias("CONTRACT_IS_ECONTRACT_AUTO"),
        blank(c("contractnumber")).alias("CONTRACT_NUMBER"),
        blank(c("three_sided")).alias("CONTRACT_THREE_SIDED"),
        blank(c("contract_type")).alias("CONTRACT_TYPE"),
        blank(c("transfer_type")).alias("TRANSFER_DOC_TYPE"),
        blank(c("elob_sokxnumber")).alias("LAST_WORK_ORDER_NUMBER"),
        F.when(upkeep, upkeep_progress).otherwise(progress(facts)).alias("IS_REALIZED_BY_ECONTRACT"),
        F.when(upkeep, F.lit(fv.BARRIER_UPKEEP)).otherwise(barriers(facts)).alias("BARRIERS"),
    ).distinct()
