"""Projects with their recent mobile price calculations, or none."""

from pyspark.sql import DataFrame

from siftload.functions import dates
from siftload.operators import filters
from siftload.plans import fixed_values as fv
from siftload.plans.common import blank, c, known
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = ("account", "string_map", "opportunity", "pl", "activity_pointer")
TARGET = ["ID_SOW", "PROJECT_NUMBER", "PROJECT_CREATE_DATE", "ID_PIL_MOBILE", "PIL_CREATE_DATE"]
SEGMENTS = [1, 2]


def build(t: Tables, p: Params) -> DataFrame:
    accounts = t["account"].where(c("elob_businesssegment").isin(*SEGMENTS) & (c("statecode") == 0))
    accounts = known(accounts, t, "elob_businesssegment", fv.SEGMENT).select("accountid", c("elob_sowid").alias("ID_SOW"))
    projects = t["opportunity"].select("opportunityid", "elob_opportunityid", "customerid", "createdon")
    activities = t["activity_pointer"].select("activityid", c("createdon").alias("calculated_on"))
    calculations = (
        t["pl"]
        .where(c("elob_pltype") == fv.MOBILE_CALCULATION)
        .select("activityid", "elob_pl_id", "elob_project")
        .join(activities, "activityid", "left")
    )
    joined = projects.join(accounts, c("customerid") == c("accountid")).join(
        calculations, c("opportunityid") == c("elob_project"), "left"
    )
    recent = filters.within_days(c("calculated_on"), p.as_of, p.last_calculation_days)
    return joined.where(filters.or_null(recent, c("calculated_on"))).select(
        "ID_SOW",
        c("elob_opportunityid").alias("PROJECT_NUMBER"),
        dates.date_to_text(c("createdon")).alias("PROJECT_CREATE_DATE"),
        blank(c("elob_pl_id")).alias("ID_PIL_MOBILE"),
        dates.date_to_text(c("calculated_on")).alias("PIL_CREATE_DATE"),
    )
