"""Logins of the first four sales users of each project, set on the loaded projects."""

from pyspark.sql import DataFrame

from siftload.functions import dates, text
from siftload.operators import ranking
from siftload.plans import fixed_values as fv
from siftload.plans.common import USER_KEY, blank, c
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = ("opportunity_user", "opportunity", "system_user")
USERS = ["USER_ICT_1", "USER_ICT_2", "USER_ICT_3", "USER_ICT_4"]
TARGET = ["PROJECT_NUMBER", *USERS]


def build(t: Tables, p: Params) -> DataFrame:
    projects = t["opportunity"].where(
        c("createdon").between(dates.ntz(p.project_users_from), dates.ntz(p.project_users_to))
    ).select("opportunityid", c("elob_opportunityid").alias("PROJECT_NUMBER"))
    people = t.lookup("system_user").where(text.is_text(c("businessunitidname"), fv.USERS_BUSINESS_UNIT)).select(USER_KEY, "domainname")
    links = t["opportunity_user"].select("opportunityid", USER_KEY).join(people, USER_KEY).join(projects, "opportunityid")
    logins = links.withColumn("login", text.login_without_domain(c("domainname")))
    first = ranking.pivot_ranked(logins, ["PROJECT_NUMBER"], [c("domainname"), c(USER_KEY)], "login", USERS)
    return first.select("PROJECT_NUMBER", *[text.replace_whole_value(blank(c(u)), "/", "").alias(u) for u in USERS])
