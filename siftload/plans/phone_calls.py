"""Phone calls of owners under the allowed managers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftload.functions import dates, text
from siftload.operators import filters
from siftload.plans import fixed_values as fv
from siftload.plans.common import c, label, owner_in_scope, user
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = ("activity_pointer", "phone_call", "account", "system_user", "string_map", "allowed_managers")
KEYS = ["APPOINTMENT_ID"]
UPDATE = ["TOPIC", "TOPIC_TYPE", "ID_SOW", "CUSTOMER", "STATE", "EXTENDED_STATUS", "OWNER", "MODIFIED_BY"]
INSERT_ONLY = ["MODIFICATION_DATE", "SCHEDULED_START", "SCHEDULED_END", "CREATE_DATE", "CREATED_BY"]
CONSTANTS = {"ACTIVE": 1}
NEEDS = ("service_account",)
TARGET = [
    "APPOINTMENT_ID", "TOPIC", "TOPIC_TYPE", "ID_SOW", "CUSTOMER", "MODIFICATION_DATE", "STATE", "EXTENDED_STATUS", "OWNER",
    "SCHEDULED_START", "SCHEDULED_END", "CREATE_DATE", "CREATED_BY", "MODIFIED_BY", "ACTIVE",
]


def effective_owner(p: Params):
    """The service account stands for the person who created the activity."""
    return F.when(c("ownerid") == p.service_account, c("createdby")).otherwise(c("ownerid"))


def wanted_topic():
    return filters.or_null(~text.is_text(c("subject"), fv.ORDERS_TOPIC_LEFT_OUT), c("subject"))


def full_name(prefix: str):
    return text.concat_name(c(f"{prefix}_firstname"), c(f"{prefix}_lastname"))


def build(t: Tables, p: Params) -> DataFrame:
    calls = t["activity_pointer"].where(
        (c("activitytypecode") == fv.PHONE_CALL) & (c("createdon") >= dates.ntz(p.activities_from)) & wanted_topic()
    ).select("activityid", "subject", "scheduledstart", "scheduledend", "createdon", "modifiedon", "createdby", "modifiedby", "ownerid", "statuscode")
    calls = owner_in_scope(calls, t, effective_owner(p))
    accounts = t["account"].where(filters.any_not_null(c("elob_sowid"), c("elob_nip"))).select(
        "accountid", c("name").alias("CUSTOMER"),
        F.coalesce(text.normalise_customer_id(c("elob_sowid")), c("elob_nip")).alias("ID_SOW"),
    )
    related = t["phone_call"].select("activityid", "elob_relatedaccount")
    calls = calls.join(related, "activityid").join(accounts, c("elob_relatedaccount") == c("accountid"))
    calls = label(calls, t, "statuscode", "STATE", fv.PHONE_CALL_STATUS)
    calls = user(calls, t, "createdby", "author", "firstname", "lastname")
    calls = user(calls, t, "modifiedby", "editor", "firstname", "lastname")
    return calls.select(
        text.guid_to_text(c("activityid")).alias("APPOINTMENT_ID"),
        c("subject").alias("TOPIC"),
        F.lit("").alias("TOPIC_TYPE"),
        "ID_SOW",
        "CUSTOMER",
        dates.to_day(c("modifiedon")).alias("MODIFICATION_DATE"),
        "STATE",
        F.lit("").alias("EXTENDED_STATUS"),
        text.strip_domain_prefix(c("owner_domainname"), 10).alias("OWNER"),
        dates.to_day(c("scheduledstart")).alias("SCHEDULED_START"),
        dates.to_day(c("scheduledend")).alias("SCHEDULED_END"),
        c("createdon").alias("CREATE_DATE"),
        full_name("author").alias("CREATED_BY"),
        full_name("editor").alias("MODIFIED_BY"),
    ).distinct()
