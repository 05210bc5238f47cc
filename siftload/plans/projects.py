"""Projects with the price calculation that counts, its margin and revenue."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftload.functions import dates, numbers, text
from siftload.operators import ranking
from siftload.plans import fixed_values as fv
from siftload.plans.common import blank, c, label, user
from siftload.plans.params import Params
from siftload.sources.staging import staged
from siftload.sources.tables import Tables

SOURCES = (
    "opportunity", "account", "system_user", "pl", "activity_pointer", "string_map", "pl_result", "pl_sales_result", "pl_parameter", "status_history",
)
BY_OWNER = ("pl_parameter",)
TARGET = [
    "PROJECT_ID", "PROJECT_NUMBER", "ID_SOW", "CUSTOMER_NAME", "PROJECT_NAME", "PROJECT_CREATE_DATE", "PROJECT_STEP", "PROJECT_OWNER",
    "PROJECT_OWNER_LOGIN", "EST_BILING_DATE", "EST_CLOSE_DATE", "PROJECT_STATE", "PROJECT_STATUS", "MARGIN", "REVENUE", "ESTIMATED_VALUE",
    "LAST_STEP_CHANGE_DATE", "CREATED_BY", "CREATED_BY_LOGIN", "PRODUCT_CATEGORY", "CUSTOMER_BUDGET", "SALE_TYPE", "PIL_ID", "PIL_FINAL",
    "PIL_STATUS", "INITIATIVE",
]
SEGMENTS = [1, 2, 3, 4]
NO_CALCULATION = "null"


def calculations_with_status(t: Tables) -> DataFrame:
    """Price calculations and their status, staged: the plan chooses among them and then reads the chosen ones."""
    activities = t["activity_pointer"].select("activityid", c("statuscode").alias("calculation_status"))
    rows = t["pl"].select("activityid", "elob_pl_id", "elob_project", "elob_pltype", "elob_finalpl", "elob_plstatistic")
    return staged(rows.join(activities, "activityid", "left"))


def chosen_calculations(calculations: DataFrame) -> DataFrame:
    """Per project the final calculation, else the accepted, else the calculated one, in one aggregation."""
    final, draft = c("elob_finalpl") == 1, c("elob_finalpl") == 0
    ranked = [
        final,
        draft & (c("calculation_status") == fv.CALCULATION_ACCEPTED),
        draft & (c("calculation_status") == fv.CALCULATION_CALCULATED),
    ]
    best = F.coalesce(*[ranking.max_id(F.when(kind, c("elob_pl_id"))) for kind in ranked])
    return calculations.where(c("elob_project").isNotNull()).groupBy(c("elob_project").alias("project")).agg(best.alias("best_id"))


def mobile_amounts(t: Tables, wanted: DataFrame) -> DataFrame:
    """Sum and number of the two mobile revenue attributes per wanted calculation result (sold_id), in one pass.

    Joined one after the other, n invoices and m operator amounts give n * m rows; those sums follow from the
    four figures, so the rows are never made.
    """
    name = F.lower("elob_name")
    invoice, operators = name.like(fv.INVOICE_REVENUE), name.like(fv.OPERATOR_REVENUE)
    amount = numbers.to_number_or_zero(c("elob_parametervalue"))
    attributes = t.rows_of("pl_parameter", "elob_pl_resultid", wanted, "sold_id").where(invoice | operators)
    sums = attributes.groupBy(c("elob_pl_resultid").alias("amounts_of")).agg(
        F.sum(F.when(invoice, amount).otherwise(0.0)).alias("invoiced"),
        F.greatest(F.count(F.when(invoice, F.lit(1))), F.lit(1)).alias("invoices"),
        F.sum(F.when(operators, amount).otherwise(0.0)).alias("passed_on"),
        F.greatest(F.count(F.when(operators, F.lit(1))), F.lit(1)).alias("operators"),
    )
    return sums.select(
        "amounts_of",
        (c("invoices") * c("operators")).alias("amount_rows"),
        (c("invoiced") * c("operators") + c("passed_on") * c("invoices")).alias("amount_total"),
    )


def calculation_totals(t: Tables) -> DataFrame:
    """Margin and revenue of the chosen calculation per project, added up before the projects are joined."""
    calculations = calculations_with_status(t)
    figures = t["pl_result"].select(
        "elob_plresultid", "elob_pandl_id", "elob_fix_margin_on_contract", "elob_fix_total_revenue_new",
        "elob_mobile_contributionmargin", "elob_mobilediscountedcashmargin",
    )
    sold = t["pl_sales_result"].select(c("elob_pandl_id").alias("sold_id"))
    chosen = staged(
        chosen_calculations(calculations)
        .where(c("best_id").isNotNull())
        .join(calculations, c("best_id") == c("elob_pl_id"))
        .join(figures, c("elob_plstatistic") == c("elob_plresultid"), "left")
        .join(sold, c("elob_pandl_id") == c("sold_id"), "left")
    )
    wanted = chosen.select("sold_id").distinct()
    rows = chosen.join(mobile_amounts(t, wanted), c("sold_id") == c("amounts_of"), "left")
    is_fixed = c("elob_pltype") == fv.FIX_CALCULATION
    each = F.coalesce(c("amount_rows"), F.lit(1))
    mobile_revenue = F.coalesce(c("amount_total"), F.lit(0.0)) / each
    margin = numbers.margin_formula(
        c("elob_mobilediscountedcashmargin"), is_fixed, c("elob_fix_margin_on_contract"), c("elob_fix_total_revenue_new"),
        c("elob_mobile_contributionmargin"), mobile_revenue,
    )
    revenue = F.when(is_fixed, numbers.number_or_zero(c("elob_fix_total_revenue_new"))).otherwise(mobile_revenue)
    return rows.groupBy("project", "elob_pl_id", "elob_finalpl", "calculation_status", "elob_mobilediscountedcashmargin").agg(
        F.sum(margin * each).alias("margin"), F.sum(revenue * each).alias("revenue"), F.sum(each).alias("calculation_rows")
    )


def build(t: Tables, p: Params) -> DataFrame:
    totals = label(calculation_totals(t), t, "calculation_status", "calculation_label", fv.CALCULATION_STATUS)
    accounts = t["account"].where(c("elob_businesssegment").isin(*SEGMENTS)).select(
        "accountid", text.normalise_customer_id(c("elob_sowid")).alias("ID_SOW"), c("name").alias("CUSTOMER_NAME")
    )
    last_step = t["status_history"].groupBy(c("elob_projectid").alias("step_of")).agg(F.max("elob_startdate").alias("last_step"))
    projects = t["opportunity"].where(c("createdon") >= dates.ntz(p.projects_from)).join(accounts, "accountid")
    projects = user(projects, t, "ownerid", "owner", "domainname", how="inner")
    projects = user(projects, t, "createdby", "author", "fullname", "domainname", how="inner")
    for code, out, at in (
        ("elob_salesstage", "PROJECT_STEP", fv.SALES_STAGE),
        ("statecode", "PROJECT_STATE", fv.PROJECT_STATE),
        ("statuscode", "PROJECT_STATUS", fv.PROJECT_STATUS),
        ("elob_initiative", "initiative_label", fv.INITIATIVE),
        ("elob_productcategory", "PRODUCT_CATEGORY", fv.PRODUCT_CATEGORY),
        ("elob_projecttype", "SALE_TYPE", fv.PROJECT_TYPE),
    ):
        projects = label(projects, t, code, out, at)
    out = projects.join(totals, c("opportunityid") == c("project"), "left").join(
        last_step, c("opportunityid") == c("step_of"), "left"
    )

    def local(name: str):
        return dates.shift_to_zone(c(name), p.zone) if p.use_zone_rules else dates.shift_hours_fixed(c(name))

    initiative = F.coalesce(
        F.substring("initiative_label", 1, 30),
        F.when(c("elob_initiative") == fv.INITIATIVE_STORM, F.lit(fv.STORM_LABEL)),
        c("elob_initiative").cast("string"),
    )
    rows_each = F.coalesce(c("calculation_rows"), F.lit(1))
    return out.select(
        text.guid_to_text(c("opportunityid")).alias("PROJECT_ID"),
        c("elob_opportunityid").alias("PROJECT_NUMBER"),
        "ID_SOW",
        "CUSTOMER_NAME",
        c("name").alias("PROJECT_NAME"),
        dates.date_to_text(local("createdon")).alias("PROJECT_CREATE_DATE"),
        "PROJECT_STEP",
        c("owneridname").alias("PROJECT_OWNER"),
        text.strip_domain_prefix(c("owner_domainname"), 20).alias("PROJECT_OWNER_LOGIN"),
        dates.to_day(local("elob_estimatedbillingdate")).alias("EST_BILING_DATE"),
        dates.to_day(local("estimatedclosedate")).alias("EST_CLOSE_DATE"),
        "PROJECT_STATE",
        "PROJECT_STATUS",
        numbers.number_or_zero(c("margin")).alias("MARGIN"),
        numbers.number_or_zero(c("revenue")).alias("REVENUE"),
        (numbers.number_or_zero(c("estimatedvalue")) * rows_each).alias("ESTIMATED_VALUE"),
        dates.to_day(local("last_step")).alias("LAST_STEP_CHANGE_DATE"),
        c("author_fullname").alias("CREATED_BY"),
        text.strip_domain_prefix(c("author_domainname"), 20).alias("CREATED_BY_LOGIN"),
        "PRODUCT_CATEGORY",
        numbers.number_or_zero(c("budgetamount")).alias("CUSTOMER_BUDGET"),
        "SALE_TYPE",
        blank(c("elob_pl_id"), NO_CALCULATION).alias("PIL_ID"),
        c("elob_finalpl").alias("PIL_FINAL"),
        blank(c("calculation_label"), NO_CALCULATION).alias("PIL_STATUS"),
        initiative.alias("INITIATIVE"),
    )
