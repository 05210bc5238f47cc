"""Products on projects with value, fees, duration and decoded sale type."""

from pyspark.sql import DataFrame

from siftload.functions import dates, numbers, text
from siftload.plans import fixed_values as fv
from siftload.plans.common import USER_KEY, c, label
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = ("opportunity", "opportunity_product", "product", "account", "system_user", "string_map")
TARGET = [
    "PROJECT_NUMBER", "SALE_TYPE", "SERVICE", "PRODUCT_ID", "PRODUCT_NUMBER", "CONTRACT_VALUE", "MONTHLY_FEE", "UP_FRONT",
    "CONTRACT_DURATION", "QUANTITY", "CATEGORY", "SERVICE_GROUP",
]
SEGMENTS = [1, 2, 4]


def build(t: Tables, p: Params) -> DataFrame:
    accounts = t["account"].where(c("elob_businesssegment").isin(*SEGMENTS)).select("accountid")
    owners = t.lookup("system_user").select(c(USER_KEY).alias("ownerid"))
    projects = (
        t["opportunity"]
        .where(c("createdon") >= dates.ntz(p.project_products_from))
        .select("opportunityid", "elob_opportunityid", "accountid", "ownerid", "elob_productcategory")
        .join(owners, "ownerid", "left_semi")
        .join(accounts, "accountid", "left_semi")
    )
    products = t.lookup("product")
    details = products.select(
        "productid", c("name").alias("SERVICE"), c("productnumber").alias("PRODUCT_NUMBER"), c("elob_service").alias("group_id")
    )
    groups = products.select(c("productid").alias("group_key"), c("name").alias("SERVICE_GROUP"))
    sold = t["opportunity_product"].withColumnRenamed("opportunityid", "sold_on")
    out = (
        projects.join(sold, c("opportunityid") == c("sold_on"), "left")
        .join(details, "productid", "left")
        .join(groups, c("group_id") == c("group_key"), "left")
    )
    out = label(label(out, t, "elob_saletype", "sale_label", fv.SALE_TYPE), t, "elob_productcategory", "CATEGORY", fv.PRODUCT_CATEGORY)
    return out.select(
        text.guid_to_text(c("elob_opportunityid")).alias("PROJECT_NUMBER"),
        text.remap_values(c("sale_label"), fv.SALE_TYPE_RENAMES).alias("SALE_TYPE"),
        "SERVICE",
        text.guid_to_text(c("elob_soldproduct")).alias("PRODUCT_ID"),
        "PRODUCT_NUMBER",
        numbers.number_or_zero(c("baseamount"), "decimal(20,0)").alias("CONTRACT_VALUE"),
        numbers.number_or_zero(c("elob_totalmonthlyfee"), "decimal(20,0)").alias("MONTHLY_FEE"),
        numbers.number_or_zero(c("elob_finalupfrontpayment"), "decimal(20,0)").alias("UP_FRONT"),
        numbers.duration_or_free_field(c("elob_contractduration"), c("elob_specifydurationinmonths")).alias("CONTRACT_DURATION"),
        numbers.number_or_zero(c("elob_quantity"), "decimal(18,0)").alias("QUANTITY"),
        "CATEGORY",
        "SERVICE_GROUP",
    )
