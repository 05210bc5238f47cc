"""Main contacts of active accounts in the chosen portfolios."""

from pyspark.sql import DataFrame

from siftload.functions import codes, text
from siftload.plans import fixed_values as fv
from siftload.plans.common import blank, c, label, user, without_test_customers
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = ("account", "contact", "string_map", "portfolio", "system_user", "excluded_customers")
TARGET = [
    "ID", "NIP", "REGON", "SOW_ID", "SEGMENT_KLIENTA", "PORTFEL", "WLASCICIEL_KLIENTA", "MSA", "STATUS_KONTAKTU_GLOWNEGO",
    "NAZWISKO_I_IMIE_KONTAKT_GLOWNY", "IMIE_KONTAKT_GLOWNY", "NAZWISKO_KONTAKT_GLOWNY", "TELEFON_KONTAKT_GLOWNY", "EMAIL_KONTAKT_GLOWNY",
]
SEGMENTS_LEFT_OUT = [1, 2]


def build(t: Tables, p: Params) -> DataFrame:
    accounts = t["account"].where((c("statecode") == 0) & ~c("elob_businesssegment").isin(*SEGMENTS_LEFT_OUT)).drop("statecode", "name")
    accounts = without_test_customers(accounts, t)
    portfolios = t.lookup("portfolio").where(text.fits(c("elob_name"), fv.PORTFOLIO_PATTERN)).select(
        "elob_portfolioid", c("elob_name").alias("PORTFEL")
    )
    accounts = label(accounts, t, "elob_businesssegment", "SEGMENT_KLIENTA", fv.SEGMENT, "inner").join(
        portfolios, c("elob_portfolio") == c("elob_portfolioid")
    )
    accounts = user(accounts, t, "ownerid", "owner", "fullname", "parentsystemuserid", how="inner")
    accounts = user(accounts, t, "owner_parentsystemuserid", "manager", "fullname")
    out = accounts.join(t["contact"], c("primarycontactid") == c("contactid"))

    def one_line(name: str, default: str):
        return blank(text.strip_control_chars(c(name), text.LINE_BREAKS), default)

    return out.select(
        text.guid_to_text(c("contactid")).alias("ID"),
        blank(c("elob_nip")).alias("NIP"),
        blank(c("elob_regon")).alias("REGON"),
        blank(c("elob_sowid")).alias("SOW_ID"),
        "SEGMENT_KLIENTA",
        "PORTFEL",
        c("owner_fullname").alias("WLASCICIEL_KLIENTA"),
        blank(c("manager_fullname")).alias("MSA"),
        codes.decode_ladder(c("statecode"), fv.CONTACT_STATES, "").alias("STATUS_KONTAKTU_GLOWNEGO"),
        one_line("fullname", "").alias("NAZWISKO_I_IMIE_KONTAKT_GLOWNY"),
        one_line("firstname", "").alias("IMIE_KONTAKT_GLOWNY"),
        one_line("lastname", "").alias("NAZWISKO_KONTAKT_GLOWNY"),
        one_line("mobilephone", " ").alias("TELEFON_KONTAKT_GLOWNY"),
        one_line("emailaddress1", " ").alias("EMAIL_KONTAKT_GLOWNY"),
    )
