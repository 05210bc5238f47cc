"""Final mobile price calculations with orders, products and contract."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftload.functions import dates, numbers, text
from siftload.operators import filters
from siftload.plans import fixed_values as fv
from siftload.plans.common import blank, c, calculation_attributes, label, user, without_test_customers
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = (
    "pl", "opportunity", "account", "excluded_customers", "sales_order", "mobile_order", "mobile_order_product", "process_stage", "string_map",
    "pl_result", "pl_sales_result", "pl_parameter", "misc_field", "contract", "system_user",
)
BY_OWNER = ("pl_parameter",)
TARGET = [
    "NIP", "ID_SOW", "OWNER", "OWNER_CODE", "PROJECT_ID", "PROJECT_OWNER", "PROJECT_OWNER_CODE", "SALES_ORDER", "PIL_ID", "REVE_TOTAL",
    "REVE_INVOICES", "REVE_OPERATORS", "MARGIN", "MARGIN_TOTAL", "INFO_FULL", "INFO", "MO_ID", "MO_STATUS", "MO_STATE", "SALE_TYPE",
    "CONTRACT", "CONTRACT_TYPE", "CONTRACT_STATE", "CONTRACT_DATE", "CONTRACT_VERIFICATION", "CONTRACT_PERIOD", "PRODUCT",
    "PRODUCT_QUANTITY", "PRODUCT_DURATION", "PRODUCT_REVE_MONTHLY", "PRODUCT_REVE_MISC", "COST_VARIABLE", "COST_COMISION", "COST_OTHER",
    "MO_CREATEDON",
]
WINDOW_COLUMN = "MO_CREATEDON"


def window(p: Params):
    """Target rows a load replaces."""
    return (c(WINDOW_COLUMN) >= p.mobile_orders_from) | c(WINDOW_COLUMN).isNull()


def results(t: Tables) -> DataFrame:
    """Figures of a calculation with the comment of its sales result."""
    entries = t.rows_of("pl_parameter", "elob_pl_resultid", t["pl_sales_result"], "elob_pandl_id")
    comments = calculation_attributes(entries, fv.CALCULATION_COMMENT, "comment")
    return t["pl_result"].join(comments, c("elob_pandl_id") == c("comment_of"), "left").select(
        "elob_plresultid",
        numbers.unit_scale(c("elob_mobile_committedrevenuekpln")).cast("double").alias("REVE_TOTAL"),
        c("elob_mobile_reve_invoices").cast("double").alias("REVE_INVOICES"),
        c("elob_mobile_reve_operators").cast("double").alias("REVE_OPERATORS"),
        c("elob_mobile_contributionmargin").cast("double").alias("MARGIN"),
        c("elob_mobile_cost_variablecosts").cast("double").alias("COST_VARIABLE"),
        c("elob_mobile_cost_other").cast("double").alias("COST_OTHER"),
        c("elob_mobile_cost_comision").cast("double").alias("COST_COMISION"),
        "comment",
    )


def with_orders(rows: DataFrame, t: Tables, p: Params) -> DataFrame:
    """Adds the orders of a sale with products and contract. Orders before the cut-off go at once, sales
    without an order stay; only then are the large product and contract tables joined."""
    orders = t["mobile_order"].select(
        "elob_mobileorderid", "elob_order", "elob_contract", "elob_mobileordernumber", c("statuscode").alias("order_statuscode"),
        "elob_mobileordertype", "stageid", c("createdon").alias("ordered_on"),
    )
    rows = rows.join(orders, c("salesorderid") == c("elob_order"), "left")
    rows = rows.where(filters.or_null(c("ordered_on") >= dates.ntz(p.mobile_orders_from), c("ordered_on")))
    rows = label(rows, t, "order_statuscode", "order_status", fv.MOBILE_ORDER_STATUS)
    rows = label(rows, t, "elob_mobileordertype", "order_type", fv.MOBILE_ORDER_TYPE)
    stages = t.lookup("process_stage").select("processstageid", "stagename")
    products = t["mobile_order_product"].withColumnsRenamed({"elob_name": "product_name", "elob_mobileorder": "product_of"})
    contracts = t["contract"].select(
        "contractid", "contractnumber", c("statuscode").alias("contract_status"), "elob_contracttype", "elob_signedbycustomeron",
        "elob_revisiondate", "elob_durationtimeinmonths",
    )
    rows = (
        rows.join(stages, c("stageid") == c("processstageid"), "left")
        .join(products, c("elob_mobileorderid") == c("product_of"), "left")
        .join(contracts, c("elob_contract") == c("contractid"), "left")
    )
    rows = label(rows, t, "contract_status", "contract_state", fv.CONTRACT_STATUS)
    return label(rows, t, "elob_contracttype", "contract_type", fv.CONTRACT_TYPE)


def build(t: Tables, p: Params) -> DataFrame:
    final_or_listed = filters.listed_or(
        c("elob_markedasfinalon") >= dates.ntz(p.final_calculations_from), c("elob_pl_id"), list(p.calculations_always_kept)
    )
    calculations = t["pl"].where(
        (c("elob_pltype") == fv.MOBILE_CALCULATION) & (c("elob_finalpl") == 1) & final_or_listed
    ).select("elob_pl_id", "elob_project", "elob_plstatistic")
    old_margins = t["misc_field"].where(F.lower("field_code") == fv.OLD_MARGIN_FIELD.lower()).select(
        c("sfa_pil_id").alias("margin_of"), c("field_value").alias("old_margin")
    )
    accounts = without_test_customers(t["account"].select("accountid", "elob_nip", "elob_sowid", c("ownerid").alias("account_owner")), t)
    accounts = user(accounts, t, "account_owner", "owner", "fullname", "elob_salespersonid", how="inner")
    projects = t["opportunity"].select("opportunityid", "elob_opportunityid", "customerid", c("ownerid").alias("project_owner"))
    projects = user(projects, t, "project_owner", "seller", "fullname", "elob_salespersonid", how="inner")
    sales = t["sales_order"].select("salesorderid", c("opportunityid").alias("sold_on"), "ordernumber")

    out = (
        calculations.join(projects, c("elob_project") == c("opportunityid"))
        .join(accounts, c("customerid") == c("accountid"))
        .join(sales, c("opportunityid") == c("sold_on"), "left")
    )
    out = with_orders(out, t, p)
    out = out.join(results(t), c("elob_plstatistic") == c("elob_plresultid"), "left").join(
        old_margins, c("elob_pl_id") == c("margin_of"), "left"
    )

    def whole(column):
        return F.coalesce(column.cast("int"), F.lit(0))

    excerpt = text.strip_control_chars(F.substring(c("comment"), fv.COMMENT_FROM, fv.COMMENT_LENGTH), text.LINE_BREAKS)
    rows = out.select(
        blank(c("elob_nip")).alias("NIP"),
        c("elob_sowid").alias("ID_SOW"),
        c("owner_fullname").alias("OWNER"),
        blank(c("owner_elob_salespersonid")).alias("OWNER_CODE"),
        c("elob_opportunityid").alias("PROJECT_ID"),
        c("seller_fullname").alias("PROJECT_OWNER"),
        blank(c("seller_elob_salespersonid")).alias("PROJECT_OWNER_CODE"),
        blank(c("ordernumber")).alias("SALES_ORDER"),
        c("elob_pl_id").alias("PIL_ID"),
        "REVE_TOTAL", "REVE_INVOICES", "REVE_OPERATORS", "MARGIN",
        numbers.round_or_zero(blank(c("old_margin"))).alias("MARGIN_TOTAL"),
        F.lit("").alias("INFO_FULL"),
        text.truncate_text(blank(excerpt), fv.COMMENT_KEPT).alias("INFO"),
        blank(c("elob_mobileordernumber")).alias("MO_ID"),
        blank(c("order_status")).alias("MO_STATUS"),
        blank(c("stagename"), " ").alias("MO_STATE"),
        blank(c("order_type")).alias("SALE_TYPE"),
        blank(c("contractnumber")).alias("CONTRACT"),
        blank(c("contract_type")).alias("CONTRACT_TYPE"),
        blank(c("contract_state")).alias("CONTRACT_STATE"),
        blank(dates.date_to_text(dates.add_days(c("elob_signedbycustomeron")))).alias("CONTRACT_DATE"),
        blank(dates.date_to_text(c("elob_revisiondate"))).alias("CONTRACT_VERIFICATION"),
        whole(c("elob_durationtimeinmonths")).alias("CONTRACT_PERIOD"),
        blank(c("product_name")).alias("PRODUCT"),
        whole(c("elob_quantity")).alias("PRODUCT_QUANTITY"),
        numbers.uniform_duration(c("elob_contractduration"), c("elob_specifydurationinmonths")).alias("PRODUCT_DURATION"),
        numbers.number_or_zero(c("elob_priceperunitmonth")).alias("PRODUCT_REVE_MONTHLY"),
        numbers.number_or_zero(c("elob_upfrontpayment")).alias("PRODUCT_REVE_MISC"),
        "COST_VARIABLE", "COST_COMISION", "COST_OTHER",
        dates.date_to_text(c("ordered_on")).alias("MO_CREATEDON"),
    )
    return rows.select(*TARGET).distinct()
