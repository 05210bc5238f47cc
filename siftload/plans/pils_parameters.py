"""Campus network entries of price calculations with their project."""

from pyspark.sql import DataFrame

from siftload.functions import text
from siftload.plans import fixed_values as fv
from siftload.plans.common import c
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = ("pl_parameter", "pl_sales_result", "pl_result", "pl", "opportunity")
TARGET = ["SFA_PIL_ID", "VALUE", "PROJECT_ID"]


def build(t: Tables, p: Params) -> DataFrame:
    entries = t["pl_parameter"].where(text.fits(c("elob_parametervalue"), fv.CAMPUS_PATTERN)).select(
        c("elob_pl_resultid").alias("SFA_PIL_ID"), c("elob_parametervalue").alias("VALUE")
    ).distinct()
    sold = t["pl_sales_result"].select(c("elob_pandl_id").alias("sold_id")).distinct()
    results = t["pl_result"].select(c("elob_pandl_id").alias("result_of"), "elob_plresultid")
    calculations = t["pl"].select("elob_plstatistic", "elob_project")
    projects = t["opportunity"].select("opportunityid", c("elob_opportunityid").alias("PROJECT_ID"))
    return (
        entries.join(sold, c("SFA_PIL_ID") == c("sold_id"), "left")
        .join(results, c("sold_id") == c("result_of"), "left")
        .join(calculations, c("elob_plresultid") == c("elob_plstatistic"), "left")
        .join(projects, c("elob_project") == c("opportunityid"), "left")
        .select(*TARGET)
        .distinct()
    )
