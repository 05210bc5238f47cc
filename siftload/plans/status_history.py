"""Stage changes of projects modified in the last days."""

from pyspark.sql import DataFrame

from siftload.functions import codes, dates, text
from siftload.operators import filters
from siftload.plans import fixed_values as fv
from siftload.plans.common import c, user
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = ("status_history", "opportunity", "system_user")
# A load by a mark reads what was modified since, and some days before.
MARK = ("status_history", "modifiedon")
TARGET = [
    "id", "project_number", "status", "status_reason", "created_on", "modified_on", "status_start_date", "status_end_date", "owner", "modified_by", "behalf_of",
]


def build(t: Tables, p: Params) -> DataFrame:
    recent = t["status_history"]
    if p.history_days is not None:
        recent = recent.where(filters.within_days(c("modifiedon"), p.as_of, p.history_days))
    projects = t["opportunity"].select("opportunityid", "elob_opportunityid")
    out = recent.join(projects, c("elob_projectid") == c("opportunityid"))
    out = user(out, t, "elob_owninguserid", "owner", "domainname", how="inner")
    out = user(out, t, "modifiedby", "editor", "domainname", how="inner")
    out = user(out, t, "createdonbehalfby", "behalf", "domainname")

    def local(name: str):
        return dates.shift_to_zone(c(name), p.zone) if p.use_zone_rules else dates.shift_hours_fixed(c(name))

    def login(name: str):
        return text.strip_domain_prefix(c(name), 20, lower=True)

    return out.select(
        text.guid_to_text(c("elob_statushistoryid")).alias("id"),
        text.guid_to_text(c("elob_opportunityid")).alias("project_number"),
        codes.decode_ladder(c("elob_bpfstage"), fv.STAGES).alias("status"),
        c("elob_statusreasonname").alias("status_reason"),
        local("createdon").alias("created_on"),
        local("modifiedon").alias("modified_on"),
        local("elob_startdate").alias("status_start_date"),
        local("elob_enddate").alias("status_end_date"),
        login("owner_domainname").alias("owner"),
        login("editor_domainname").alias("modified_by"),
        login("behalf_domainname").alias("behalf_of"),
    )
