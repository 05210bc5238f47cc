"""Products customers hold with other operators."""

from pyspark.sql import DataFrame

from siftload.functions import dates, numbers, text
from siftload.plans.common import c, user
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = ("competitor_product", "account", "portfolio", "system_user")
NEEDS = ("potential_products",)
TARGET = [
    "CUSTOMER", "EOP", "ID_SOW", "INCOME", "OPERATOR", "PORTFOLIO", "PRODUCT", "PRODUCT_BRANCH", "QUANTITY", "POTENTIAL_COMMENT", "OS_MODYFIKUJACA",
]


def build(t: Tables, p: Params) -> DataFrame:
    wanted_name = c("elob_name").contains("-")
    if p.potential_products:
        wanted_name = wanted_name | text.is_one_of(c("elob_name"), p.potential_products)
    has_amount = c("elob_quantity").isNotNull() | (c("elob_income") != 0)
    products = t["competitor_product"].where(wanted_name & has_amount & (c("statecode") == 0)).drop("statecode")
    accounts = t["account"].where(c("statecode") == 0).select(
        "accountid", c("name").alias("CUSTOMER"), text.normalise_customer_id(c("elob_sowid")).alias("ID_SOW"), "elob_portfolio"
    )
    portfolios = t.lookup("portfolio").select("elob_portfolioid", c("elob_name").alias("PORTFOLIO"))
    out = products.join(accounts, c("elob_account") == c("accountid")).join(
        portfolios, c("elob_portfolio") == c("elob_portfolioid"), "left"
    )
    return user(out, t, "modifiedby", "editor", "fullname").select(
        "CUSTOMER",
        dates.to_day(c("elob_eop")).alias("EOP"),
        "ID_SOW",
        numbers.number_or_zero(c("elob_income"), "decimal(10,2)").alias("INCOME"),
        c("elob_operator").alias("OPERATOR"),
        "PORTFOLIO",
        c("elob_name").alias("PRODUCT"),
        text.prefix_before_dash(c("elob_name")).alias("PRODUCT_BRANCH"),
        numbers.number_or_zero(c("elob_quantity"), "decimal(10,0)").alias("QUANTITY"),
        c("elob_comments").alias("POTENTIAL_COMMENT"),
        c("editor_fullname").alias("OS_MODYFIKUJACA"),
    ).distinct()
