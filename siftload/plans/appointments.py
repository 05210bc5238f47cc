"""Appointments of owners under the allowed managers, with the account, project or billing account they regard."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftload.functions import dates, text
from siftload.plans import fixed_values as fv
from siftload.plans.common import c, label, owner_in_scope, user
from siftload.plans.params import Params
from siftload.plans.phone_calls import effective_owner, full_name, wanted_topic
from siftload.sources.tables import Tables

SOURCES = (
    "activity_pointer", "appointment", "account", "opportunity", "billing_account", "system_user", "string_map", "allowed_managers",
)
KEYS = ["APPOINTMENT_ID"]
UPDATE = [
    "TOPIC", "TOPIC_TYPE", "ID_SOW", "CUSTOMER", "MODIFICATION_DATE", "STATE", "EXTENDED_STATUS", "OWNER", "SCHEDULED_START",
    "SCHEDULED_END", "MODIFIED_BY", "PROJECT_NUMBER",
]
INSERT_ONLY = ["CREATE_DATE", "CREATED_BY"]
CONSTANTS = {"ACTIVE": 1}
TARGET = [
    "APPOINTMENT_ID", "TOPIC", "TOPIC_TYPE", "ID_SOW", "CUSTOMER", "MODIFICATION_DATE", "STATE", "EXTENDED_STATUS", "OWNER",
    "SCHEDULED_START", "SCHEDULED_END", "CREATE_DATE", "CREATED_BY", "MODIFIED_BY", "PROJECT_NUMBER", "ACTIVE",
]


def build(t: Tables, p: Params) -> DataFrame:
    meetings = t["activity_pointer"].where(
        (c("activitytypecode") == fv.APPOINTMENT) & (c("scheduledstart") >= dates.ntz(p.appointments_from)) & wanted_topic()
    ).select(
        "activityid", "regardingobjectid", "subject", "scheduledstart", "scheduledend", "createdon", "modifiedon", "createdby", "modifiedby",
        "ownerid", "statuscode",
    )
    meetings = owner_in_scope(meetings, t, effective_owner(p)).join(t["appointment"], "activityid")

    account = t["account"].select("accountid", "name", "elob_sowid")
    related = account.toDF("related_id", "related_name", "related_sowid")
    regarded = account.toDF("regarded_id", "regarded_name", "regarded_sowid")
    projects = t["opportunity"].select("opportunityid", c("elob_opportunityid").alias("PROJECT_NUMBER"))
    billing = t["billing_account"].select(
        "elob_billingaccountid", c("elob_name").alias("billing_name"), c("elob_billingnumber2").alias("billing_number")
    )
    about = c("regardingobjectid")
    meetings = (
        meetings.join(regarded, about == c("regarded_id"), "left")
        .join(projects, about == c("opportunityid"), "left")
        .join(billing, about == c("elob_billingaccountid"), "left")
        .join(related, c("elob_relatedaccount") == c("related_id"), "left")
    )
    meetings = label(meetings, t, "elob_subjecttype", "TOPIC_TYPE", fv.SUBJECT_TYPE)
    meetings = label(meetings, t, "statuscode", "STATE", fv.APPOINTMENT_STATUS)
    meetings = label(meetings, t, "elob_extendedstausreason", "EXTENDED_STATUS", fv.EXTENDED_REASON)
    meetings = user(meetings, t, "createdby", "author", "firstname", "lastname")
    meetings = user(meetings, t, "modifiedby", "editor", "firstname", "lastname")

    def of_account(column: str):
        return F.when(c("related_id").isNull(), c(f"regarded_{column}")).otherwise(c(f"related_{column}"))

    return meetings.withColumn("sowid", of_account("sowid")).select(
        text.guid_to_text(c("activityid")).alias("APPOINTMENT_ID"),
        c("subject").alias("TOPIC"),
        "TOPIC_TYPE",
        text.normalise_customer_id(c("sowid"), c("billing_number")).alias("ID_SOW"),
        F.coalesce(c("billing_name"), of_account("name")).alias("CUSTOMER"),
        dates.to_day(c("modifiedon")).alias("MODIFICATION_DATE"),
        "STATE",
        "EXTENDED_STATUS",
        text.strip_domain_prefix(c("owner_domainname"), 10).alias("OWNER"),
        dates.to_day(c("scheduledstart")).alias("SCHEDULED_START"),
        dates.to_day(c("scheduledend")).alias("SCHEDULED_END"),
        c("createdon").alias("CREATE_DATE"),
        full_name("author").alias("CREATED_BY"),
        full_name("editor").alias("MODIFIED_BY"),
        "PROJECT_NUMBER",
    )
