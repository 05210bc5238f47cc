"""Accepted fixed-line price calculations, one row per service with its attributes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftload.functions import codes, dates, numbers, text
from siftload.operators import eav
from siftload.plans import fixed_values as fv
from siftload.plans.common import blank, c, calculation_attributes, label, without_test_customers
from siftload.plans.params import Params
from siftload.sources.staging import staged
from siftload.sources.tables import Tables

SOURCES = (
    "pl", "activity_pointer", "pl_result", "pl_sales_result", "opportunity", "account", "excluded_customers", "string_map", "pl_parameter",
)
BY_OWNER = ("pl_parameter",)
TARGET = [
    "id_projektu", "data_utw_pil", "id_pil", "typ_pila", "status_pil", "pil_finalny", "czy_moc", "poziom_akceptacji", "kod_akceptacji",
    "sciezka_akceptacji_pil", "marza_kontrakt_proc", "wartosc_reve_nowa", "marza_uwzgl_prowizje_proc", "nazwa_uslugi_produktu",
    "utrzymanie_akwizycja", "dl_lojalki", "marza_jedn_na_produkcie", "ilosc", "abo_za_szt", "ulga_oplata_ins", "dlugosc_kontraktu",
    "oplata_ins", "rodzaj_sprzedazy", "opcja_produktu_uslugi", "ilosc_portow", "oplata_mies_serwis", "ilosc_pakietow",
    "projekt_flaga_koronawirus", "opcja_sla", "oplata_za_sla", "odsprzedaz_sprzetu_wartosc", "kanal_sprzedazy", "marza_sprzedaz_gotowka_raty",
]
SERVICE = "service"


def attributes_of(t: Tables, wanted: DataFrame) -> DataFrame:
    """Attributes of the wanted calculations, staged: a small part of the largest table, read many times."""
    return staged(
        t.rows_of("pl_parameter", "elob_pl_resultid", wanted, "wanted_id")
        .select("elob_pl_resultid", F.lower("elob_name").alias("elob_name"), "elob_parametervalue")
    )


def services(attributes: DataFrame) -> DataFrame:
    """Service rows with the suffix that ties their attributes to them."""
    named = attributes.where(eav.any_like(c("elob_name"), fv.SERVICE_PATTERNS)).select(
        c("elob_pl_resultid").alias("service_of"),
        text.suffix_after_underscore(text.remap_values(c("elob_name"), fv.SERVICE_RENAMES)).alias("service_suffix"),
        c("elob_parametervalue").alias(SERVICE),
    )
    by_suffix = eav.families_by_suffix(attributes, "elob_pl_resultid", "elob_name", "elob_parametervalue", fv.SERVICE_FAMILIES)
    columns = {family: f"v_{family}" for family in fv.SERVICE_FAMILIES}
    return eav.join_families(named, by_suffix, "service_of", "service_suffix", columns)


def build(t: Tables, p: Params) -> DataFrame:
    activities = t["activity_pointer"].where(
        (c("createdon") >= dates.ntz(p.fix_calculations_from)) & (c("statuscode") == fv.CALCULATION_ACCEPTED)
    ).select("activityid", "createdon", "statuscode")
    activities = label(activities, t, "statuscode", "status_pil", fv.CALCULATION_STATUS, "inner")
    accounts = without_test_customers(t["account"].select("accountid", "elob_sowid"), t).select("accountid")
    projects = (
        t["opportunity"]
        .select("opportunityid", "elob_opportunityid", "customerid", "elob_coronavirus")
        .join(accounts, c("customerid") == c("accountid"), "left_semi")
    )
    figures = t["pl_result"].select(
        "elob_plresultid", "elob_pandl_id", "elob_acceptance_code", "elob_acceptancepath", "elob_fix_margin_on_contract", "elob_fix_total_revenue_new"
    )
    sold = t["pl_sales_result"].select(c("elob_pandl_id").alias("sold_id"))
    calculations = staged(
        t["pl"]
        .select("activityid", "elob_pl_id", "elob_project", "elob_pltype", "elob_finalpl", "elob_plstatistic", "elob_acceptancelevel")
        .join(activities, "activityid")
        .join(projects, c("elob_project") == c("opportunityid"))
        .join(figures, c("elob_plstatistic") == c("elob_plresultid"))
        .join(sold, c("elob_pandl_id") == c("sold_id"))
    )
    attributes = attributes_of(t, calculations.select(c("sold_id").alias("wanted_id")))
    out = calculations.join(services(attributes), c("sold_id") == c("service_of"), "left")
    for name, column, like in (
        (fv.COMMISSION_MARGIN, "commission", True),
        (fv.COMPETENCE_PARAMETER, "competence", False),
        (fv.SALES_CHANNEL, "channel", False),
        (fv.CASH_MARGIN, "cash_margin", False),
    ):
        out = out.join(calculation_attributes(attributes, name, column, like), c("sold_id") == c(f"{column}_of"), "left")

    def family_number(name: str):
        return numbers.to_number_or_zero(c(f"v_{name}")).alias(name)

    def family_text(name: str, default: str = ""):
        return blank(c(f"v_{name}"), default).alias(name)

    return out.select(
        c("elob_opportunityid").alias("id_projektu"),
        dates.date_to_text(c("createdon")).alias("data_utw_pil"),
        numbers.cast_numeric(c("elob_pl_id"), "int").alias("id_pil"),
        codes.decode_ladder(c("elob_pltype"), fv.CALCULATION_TYPES, "").alias("typ_pila"),
        "status_pil",
        codes.decode_ladder(c("elob_finalpl"), fv.FINAL_FLAGS, "").alias("pil_finalny"),
        codes.presence_flag(c("competence_of"), fv.YES, fv.NO).alias("czy_moc"),
        c("elob_acceptancelevel").cast("int").alias("poziom_akceptacji"),
        c("elob_acceptance_code").alias("kod_akceptacji"),
        blank(c("elob_acceptancepath")).alias("sciezka_akceptacji_pil"),
        numbers.number_or_zero(c("elob_fix_margin_on_contract")).alias("marza_kontrakt_proc"),
        numbers.number_or_zero(c("elob_fix_total_revenue_new")).alias("wartosc_reve_nowa"),
        numbers.to_number_or_zero(c("commission")).alias("marza_uwzgl_prowizje_proc"),
        blank(c(SERVICE)).alias("nazwa_uslugi_produktu"),
        text.like_label(c(SERVICE), fv.SERVICE_KEEP_OR_NEW).alias("utrzymanie_akwizycja"),
        text.like_label(c(SERVICE), fv.LOYALTY_PERIODS).alias("dl_lojalki"),
        family_number("marza_jedn_na_produkcie"),
        family_number("ilosc"),
        family_number("abo_za_szt"),
        family_number("ulga_oplata_ins"),
        family_number("dlugosc_kontraktu"),
        family_number("oplata_ins"),
        family_text("rodzaj_sprzedazy"),
        family_text("opcja_produktu_uslugi"),
        family_number("ilosc_portow"),
        family_number("oplata_mies_serwis"),
        numbers.to_number_or_zero(c("v_ilosc_pakietow"), "int").alias("ilosc_pakietow"),
        codes.decode_ladder(c("elob_coronavirus"), fv.FINAL_FLAGS).alias("projekt_flaga_koronawirus"),
        family_text("opcja_sla", "0"),
        family_number("oplata_za_sla"),
        family_text("odsprzedaz_sprzetu_wartosc", "0"),
        blank(c("channel")).alias("kanal_sprzedazy"),
        blank(c("cash_margin")).alias("marza_sprzedaz_gotowka_raty"),
    )
