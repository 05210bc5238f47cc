"""Phone calls of marketing campaigns with queue, lead and answer."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftload.functions import dates, text
from siftload.operators import filters
from siftload.plans import fixed_values as fv
from siftload.plans.common import USER_KEY, blank, c, label, local_minutes, user
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = (
    "campaign", "system_user", "activity_pointer", "campaign_activity", "phone_call", "string_map", "campaign_answer", "queue_item", "queue", "lead", "account",
)
NEEDS = ("campaign_creators", "campaign_queues")
TARGET = [
    "nazwa_kampanii", "id_kampanii", "data_utw_kampanii", "dzialanie", "data_utworzenia", "temat_rozmowy", "data_utworzenia_rozmowy",
    "nazwa_kolejki", "data_wejscia_na_kolejke", "data_pobrania_z_kolejki", "podjete_z_kolejki_przez", "ostatnia_data_modyfikacji",
    "zmodyfikowano_przez", "obecny_wl_rozmowy_tel", "przewidywana_data_start", "przewidywana_data_konca", "stan_rozmowy",
    "status_rozmowy_tel", "data_odroczenia_sprawy", "notatka_z_rozmowy", "lead_tytul", "numer_listy_marketingowej", "id_sow_klienta",
    "nip_klienta", "klient", "odpowiedz_do_rozmowy", "tworca_rozmowy",
]


def campaign_steps(t: Tables, p: Params) -> DataFrame:
    """Campaign activities of the chosen creators: few rows, worked out before the calls are read."""
    creators = t.lookup("system_user").where(c(USER_KEY).isin(*p.campaign_creators)).select(c(USER_KEY).alias("createdby"))
    campaigns = t.lookup("campaign").join(creators, "createdby", "left_semi").select(
        "campaignid", c("name").alias("nazwa_kampanii"), c("elob_campaignid").alias("id_kampanii"),
        dates.date_to_text(c("createdon")).alias("data_utw_kampanii"),
    )
    steps = t["activity_pointer"].select(
        c("activityid").alias("step_id"), c("regardingobjectid").alias("step_of"),
        text.strip_control_chars(c("subject")).alias("dzialanie"), dates.date_to_text(c("createdon")).alias("data_utworzenia"),
    )
    known_steps = t["campaign_activity"].select(c("activityid").alias("step_id"))
    return steps.join(campaigns, c("step_of") == c("campaignid")).join(known_steps, "step_id")


def build(t: Tables, p: Params) -> DataFrame:
    calls = (
        t["activity_pointer"]
        .where((c("statuscode") != fv.PHONE_CALL_CANCELLED) & ~c("createdby").isin(*p.campaign_callers_left_out))
        .select(
            "activityid", "regardingobjectid", "subject", "createdon", "modifiedon", "scheduledstart", "scheduledend",
            "createdby", "modifiedby", "ownerid", "statuscode", "statecode",
        )
        .join(campaign_steps(t, p), c("regardingobjectid") == c("step_id"))
        .join(t["phone_call"], "activityid")
    )
    calls = user(calls, t, "ownerid", "owner", "fullname", how="inner")
    calls = user(calls, t, "createdby", "author", "fullname", how="inner")
    calls = user(calls, t, "modifiedby", "editor", "fullname", how="inner")
    calls = label(calls, t, "statuscode", "status_rozmowy_tel", fv.PHONE_CALL_STATUS_POLISH, "inner")
    calls = label(calls, t, "statecode", "stan_rozmowy", fv.PHONE_CALL_STATE, "inner")

    queued = t["queue_item"].select(c("objectid").alias("queued_id"), "queueid", "workerid", "enteredon", "workeridmodifiedon")
    calls = calls.join(queued, c("activityid") == c("queued_id"), "left")
    calls = calls.where(filters.or_null(c("queueid").isin(*p.campaign_queues), c("queueid")))
    queues = t.lookup("queue").select("queueid", c("name").alias("queue_name"))
    answers = t.lookup("campaign_answer").select("elob_marketingcampainanswersid", c("elob_answer").alias("answer"))
    leads = t["lead"].select("leadid", c("subject").alias("lead_subject"), "elob_marketinglistid")
    accounts = t["account"].select("accountid", "elob_sowid", "elob_nip", "name")
    calls = user(calls.join(queues, "queueid", "left"), t, "workerid", "worker", "fullname")
    calls = (
        calls.join(answers, c("elob_answer") == c("elob_marketingcampainanswersid"), "left")
        .join(leads, c("elob_relatedlead") == c("leadid"), "left")
        .join(accounts, c("elob_relatedaccount") == c("accountid"), "left")
    )

    def minutes(name: str):
        return local_minutes(c(name), dates.CAMPAIGN_HOUR_SHIFTS, p)

    return calls.select(
        "nazwa_kampanii", "id_kampanii", "data_utw_kampanii", "dzialanie", "data_utworzenia",
        text.strip_control_chars(c("subject")).alias("temat_rozmowy"),
        minutes("createdon").alias("data_utworzenia_rozmowy"),
        blank(c("queue_name")).alias("nazwa_kolejki"),
        minutes("enteredon").alias("data_wejscia_na_kolejke"),
        minutes("workeridmodifiedon").alias("data_pobrania_z_kolejki"),
        blank(c("worker_fullname")).alias("podjete_z_kolejki_przez"),
        minutes("modifiedon").alias("ostatnia_data_modyfikacji"),
        c("editor_fullname").alias("zmodyfikowano_przez"),
        c("owner_fullname").alias("obecny_wl_rozmowy_tel"),
        minutes("scheduledstart").alias("przewidywana_data_start"),
        minutes("scheduledend").alias("przewidywana_data_konca"),
        "stan_rozmowy", "status_rozmowy_tel",
        minutes("elob_onholddate").alias("data_odroczenia_sprawy"),
        blank(text.strip_control_chars(c("new_1"))).alias("notatka_z_rozmowy"),
        blank(c("lead_subject")).alias("lead_tytul"),
        blank(c("elob_marketinglistid")).alias("numer_listy_marketingowej"),
        blank(c("elob_sowid")).alias("id_sow_klienta"),
        blank(c("elob_nip")).alias("nip_klienta"),
        text.strip_control_chars(c("name")).alias("klient"),
        blank(c("answer")).alias("odpowiedz_do_rozmowy"),
        F.col("author_fullname").alias("tworca_rozmowy"),
    )
