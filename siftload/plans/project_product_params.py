"""Device counts of managed LAN products on projects."""

from pyspark.sql import DataFrame

from siftload.functions import dates, text
from siftload.plans import fixed_values as fv
from siftload.plans.common import c, named
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = ("opportunity", "opportunity_product", "sold_product", "sold_product_parameter")
TARGET = ["PROJECT_NUMBER", "PRODUCT_ID", "PARAMETER", "VALUE"]


def build(t: Tables, p: Params) -> DataFrame:
    projects = t["opportunity"].where(c("createdon") >= dates.ntz(p.project_products_from)).select(
        "opportunityid", text.guid_to_text(c("elob_opportunityid")).alias("PROJECT_NUMBER")
    )
    parents = named(t["sold_product"], "elob_name", fv.LAN_PRODUCT).select(c("elob_soldproductid").alias("parent"))
    children = t["sold_product"].select(c("elob_soldproductid").alias("child"), c("elob_parentsoldproduct").alias("child_of"))
    counts = named(t["sold_product_parameter"], "elob_name", fv.DEVICE_COUNT).where(c("elob_parametervalue").isNotNull()).select(
        c("elob_soldproduct").alias("counted"), c("elob_name").alias("PARAMETER"), c("elob_parametervalue").alias("VALUE")
    )
    per_parent = parents.join(children, c("parent") == c("child_of")).join(counts, c("child") == c("counted"))
    sold = t["opportunity_product"].select(c("opportunityid").alias("sold_on"), "elob_soldproduct")
    return (
        sold.join(per_parent, c("elob_soldproduct") == c("parent"))
        .join(projects, c("sold_on") == c("opportunityid"))
        .withColumn("PRODUCT_ID", text.guid_to_text(c("elob_soldproduct")))
        .select(*TARGET)
    )
