"""Fixed-line contracts with customer, order, address, project and price calculations in one wide row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftload.functions import codes, dates, numbers, text
from siftload.operators import lookup, ranking
from siftload.plans import fixed_values as fv
from siftload.plans.common import blank, c, code_map, labels, named, user, without_test_customers
from siftload.plans.params import Params
from siftload.sources.staging import staged
from siftload.sources.tables import Tables

SOURCES = (
    "contract", "status_history", "category", "account", "excluded_customers", "string_map", "opportunity", "pl", "pl_result", "pl_sales_result",
    "pl_parameter", "fixed_order", "sold_product", "sold_product_parameter", "product_parameter", "product_parameter_value", "order_parameter",
    "address", "city", "street", "zip_connection", "building", "product_process", "system_user", "contributor", "contract_archive",
    "activity_pointer", "work_order",
)
NEEDS = ("fix_category", "service_kind_parameter")
BY_OWNER = ("pl_parameter",)
TARGET = [
    "IDSOW_KLIENTA", "NIP_KLIENTA", "SEGMENT_KLIENTA", "WLASCICIEL_KLIENTA", "LOGIN_WLASCICIELA_KLIENTA", "KOD_BSCS", "NUMER_UMOWY",
    "WLASCICIEL_UMOWY", "LOGIN_WLASCICIELA_UM", "KOD_BSCS_WL_UM", "STATUS_UMOWY", "TYP_UMOWY", "KATEGORIA_UMOWY", "PODKATEGORIA_UMOWY",
    "DATA_PODPISANIA_UMOWY", "DATA_WERYFIKACJI_UMOWY", "DATA_Z_SH", "OST_DATA_MODYF_UMOWY", "REPREZENTANT", "LOGIN_REP", "KOD_BSCS_REP",
    "PROJEKT_POWIAZANY_BEZP_Z_UM", "ID_PIL_FIX_FINAL_Z_PPBZU", "MARZA_Z_PILFINAL_Z_PPBZU", "MARZA_UWZGL_PROW_FINAL_Z_PPBZU",
    "REVE_Z_PILA_FINAL_Z_PPBZU", "MAPA_KOMPETENCJI_OG", "NR_ZAM_SOKX", "STATUS_ZAMOWIENIA_SOKX", "NUMER_ZGODY", "OFERTA_NIESTANDARDOWA",
    "WLASCICIEL_ZAMOWIENIA", "LOGIN_WLASCICIELA_ZAM", "KOD_BSCS_WL_ZAM", "OPERACJA", "PRODUKT_NA_ZAM", "RODZAJ_USLUGI", "ID_PROJEKTU",
    "INICJATYWA", "WLASCICIEL_PROJEKTU", "LOGIN_WL_PROJEKTU", "KOD_BSCS_WL_PRO", "ID_PIL_FINALNEGO", "MARZA_Z_PIL",
    "MARZA_UWGLEDNIAJACA_PROWIZJE", "REVE_Z_PILA", "MAPA_KOMPETENCJI_OG1", "UM_BARKOD", "DATA_ARCH_UM", "STATUS_TIGER", "STAWKI_NA_UMOWIE",
    "DB_KOD", "DB_NAZWISKO", "ID_PILA_FINALNEGO_Z_PROJEKTU", "NUMER_DOLACZONEGO_PILA_BCASE", "TYP_PILA", "FINALNY_PIL", "MARZA",
    "CALKOWITA_WARTOSC_PRZYCHODU", "MAPA_KOMPETENCJI_OG2", "FLAGA_KORONAWIRUS", "PROJEKT_POWIAZANY_BEZP_Z_UM_FK", "LOGIN_WL_PILA_FIN_Z_PROJEKTU",
    "LOGIN_WL_DOLACZONEGO_PILA_BCS", "NR_OST_ZLEC_AU", "DATA_WYS_ZLEC_AU", "ODP_ZE_ZLEC_AU", "DATA_ODP_NA_ZLEC_AU", "LOKALIZACJA_KOD_POCZTOWY",
    "LOKALIZACJA_MIASTO", "LOKALIZACJA_ULICA", "LOKALIZACJA_NR_BUDYNKU", "PROCES_ZAM_SOKX", "SCIEZKA_ZAM_SOKX", "DATA_ZAKONCZENIA_TESTOW",
    "ADMINISTRACJA", "LOGIN_ADMINISTRACJA",
]
LOGIN_LENGTH = 100
CODES = (
    fv.SEGMENT, fv.CONTRACT_STATUS, fv.CONTRACT_TYPE, fv.CONTRACT_RATE_TYPE, fv.ORDER_STATUS, fv.ORDER_OPERATION, fv.ORDER_PATH, fv.INITIATIVE,
    fv.WORK_ORDER_DECISION, fv.ARCHIVE_STATUS,
)


def is_final_fix() -> Column:
    return (c("elob_finalpl") == 1) & (c("elob_pltype") == fv.FIX_CALCULATION)


def wanted_calculations(t: Tables, contracts: DataFrame, projects: DataFrame) -> DataFrame:
    """Calculations that some contract can show: final fixed-line ones of its projects, its own and its attached one."""
    def keys(df: DataFrame, name: str, out: str) -> DataFrame:
        return df.select(c(name).alias(out)).where(c(out).isNotNull()).distinct()

    return (
        t["pl"].select("activityid", "elob_pl_id", "elob_project", "elob_pltype", "elob_finalpl", "elob_plstatistic")
        .join(keys(projects, "project", "by_project"), is_final_fix() & (c("elob_project") == c("by_project")), "left")
        .join(keys(contracts, "elob_plnumber", "by_own"), c("activityid") == c("by_own"), "left")
        .join(keys(contracts, "elob_attachedplnumber", "by_attached"), c("elob_pl_id") == c("by_attached"), "left")
        .where(c("by_project").isNotNull() | c("by_own").isNotNull() | c("by_attached").isNotNull())
        .drop("by_project", "by_own", "by_attached")
    )


def calculations(t: Tables, chosen: DataFrame) -> DataFrame:
    """The chosen calculations with figures and attributes: the one shape the plan joins in four roles.

    The attributes are read once, and only those of the chosen calculations are kept. The commission margin can have
    several values, each of which is a row; of the two offer attributes only the presence counts.
    """
    results = staged(
        t["pl_result"]
        .select("elob_plresultid", "elob_pandl_id", "elob_fix_margin_on_contract", "elob_fix_total_revenue_new")
        .join(chosen.select("elob_plstatistic").distinct(), c("elob_plresultid") == c("elob_plstatistic"), "left_semi")
    )
    ids = results.select("elob_pandl_id").distinct()
    sold = t["pl_sales_result"].select(c("elob_pandl_id").alias("sold_id")).join(ids, c("sold_id") == c("elob_pandl_id"), "left_semi").distinct()
    names = (fv.READY_OFFER_PARAMETER, fv.COMPETENCE_PARAMETER_PLAIN, fv.COMMISSION_MARGIN)
    attributes = staged(
        named(t.rows_of("pl_parameter", "elob_pl_resultid", ids, "elob_pandl_id"), "elob_name", *names)
        .select("elob_pl_resultid", F.lower("elob_name").alias("attribute"), c("elob_parametervalue").alias("value"))
    )
    offers = attributes.groupBy(c("elob_pl_resultid").alias("offers_of")).agg(
        F.max(c("attribute") == fv.READY_OFFER_PARAMETER).alias("ready_offer"),
        F.max(c("attribute") == fv.COMPETENCE_PARAMETER_PLAIN).alias("competence_map"),
    )
    commission = named(attributes, "attribute", fv.COMMISSION_MARGIN).select(
        c("elob_pl_resultid").alias("commission_of"), c("value").alias("commission")
    ).distinct()
    figures = (
        results.join(sold, c("elob_pandl_id") == c("sold_id"), "left")
        .join(commission, c("sold_id") == c("commission_of"), "left")
        .join(offers, c("sold_id") == c("offers_of"), "left")
    )
    return chosen.join(figures, c("elob_plstatistic") == c("elob_plresultid"), "left")


CALCULATION_FIELDS = {
    "elob_pl_id": "id", "elob_pltype": "type", "elob_finalpl": "final", "elob_fix_margin_on_contract": "margin",
    "elob_fix_total_revenue_new": "revenue", "commission": "commission", "ready_offer": "offer", "competence_map": "map",
}


def as_role(df: DataFrame, prefix: str, *keys: str, commission: bool = True) -> DataFrame:
    fields = {k: v for k, v in CALCULATION_FIELDS.items() if commission or v != "commission"}
    return df.select(
        *[c(k).alias(f"{prefix}_{k}") for k in keys], *[c(k).alias(f"{prefix}_{v}") for k, v in fields.items()]
    ).distinct()


def final_fix_role(priced: DataFrame, prefix: str) -> DataFrame:
    """Final fixed-line calculations by project."""
    return as_role(priced.where(is_final_fix()), prefix, "elob_project")


def offer_label(prefix: str) -> Column:
    has_offer, has_map = (F.coalesce(c(f"{prefix}_{x}"), F.lit(False)) for x in ("offer", "map"))
    return codes.classify([(has_map, fv.COMPETENCE_MAP), (has_offer, fv.READY_OFFER)])


def both_offers_label(first: str, second: str) -> Column:
    """A single offer of the two calculations names the row, and so does a single map; all four together count as a map."""
    offers, maps = (sum(F.coalesce(c(f"{r}_{x}"), F.lit(False)).cast("int") for r in (first, second)) for x in ("offer", "map"))
    return codes.classify([
        ((offers == 1) & (maps == 0), fv.READY_OFFER),
        ((maps == 1) & (offers == 0) | (offers + maps == 4), fv.COMPETENCE_MAP),
    ])


def preferred_type() -> Column:
    """Kind of the project's calculation, else Fix for an attached fixed one: an attached mobile one has no label."""
    attached = F.when(c("own_type").isNull() & (c("attached_type") == fv.FIX_CALCULATION), F.lit(fv.CALCULATION_TYPES[1]))
    return F.coalesce(codes.decode_ladder(c("own_type"), fv.CALCULATION_TYPES), attached, F.lit(""))


def latest_decisions(t: Tables, words: lookup.CodeMap) -> DataFrame:
    """Latest work order of the asking kind per order."""
    asked = t["work_order"].where(c("new_sokxordertype") == fv.WORK_ORDER_AU)
    latest = ranking.first_per_group(asked, ["elob_sokxorderworkorderid"], [c("createdon").desc(), c("elob_sokxnumber"), c("elob_workorder2id")])
    latest = labels(latest, words, decision=("elob_sokxwodecision", fv.WORK_ORDER_DECISION))
    return latest.select(
        c("elob_sokxorderworkorderid").alias("decided_for"), c("elob_sokxnumber").alias("au_number"),
        c("elob_executiondate").alias("au_sent"), c("elob_decisiondate").alias("au_decided"), "decision",
    )


def addresses(t: Tables) -> DataFrame:
    city = t.lookup("city").select(c("elob_cityid").alias("elob_city"), c("elob_name").alias("city_name"))
    street = t.lookup("street").select(c("elob_streetid").alias("elob_street"), c("elob_name").alias("street_name"))
    zips = t.lookup("zip_connection").select(c("elob_zipconnectionsid").alias("elob_zipconnections"), c("elob_name").alias("zip_name"))
    building = t.lookup("building").select(c("elob_buildingid").alias("elob_buildingnumberdict"), c("elob_number").alias("listed_number"))
    out = t["address"].join(city, "elob_city", "left").join(street, "elob_street", "left").join(zips, "elob_zipconnections", "left")
    number = F.when(c("elob_buildingnumberdict").isNull(), c("elob_buildingnumber")).otherwise(c("listed_number"))
    return out.join(building, "elob_buildingnumberdict", "left").select(
        "elob_addressid", "city_name", "street_name", "zip_name", number.alias("building_number")
    )


def service_kinds(t: Tables, p: Params) -> DataFrame:
    """Kind of a sold product through the indexed value list of its parameter; null where the list has none."""
    chosen = t["sold_product_parameter"].where(c("elob_parameter") == p.service_kind_parameter).select(
        c("elob_soldproduct").alias("kind_of"), "elob_parameter", "elob_parametervalue"
    )
    defined = t.lookup("product_parameter").select(c("elob_productparametersid").alias("kind_parameter"))
    values = t.lookup("product_parameter_value").select(
        c("elob_parameter").alias("value_of"), c("elob_index").alias("value_index"), c("elob_value").alias("service_kind")
    )
    labels = defined.join(values, c("kind_parameter") == c("value_of"))
    at = (c("elob_parameter") == c("kind_parameter")) & (c("elob_parametervalue") == c("value_index"))
    return chosen.join(labels, at, "left").select("kind_of", "service_kind").distinct()


def wanted_orders(t: Tables, wanted: DataFrame) -> DataFrame:
    """Numbered orders of the wanted contracts."""
    return t["fixed_order"].where(c("elob_ordernumber").isNotNull()).join(
        wanted, c("elob_contract") == c("contractid"), "left_semi"
    ).select(
        "elob_sokxorder2id", "elob_ordernumber", c("elob_contract").alias("order_of"), "elob_project", "elob_soldproduct", "elob_location",
        c("statuscode").alias("order_statuscode"), "elob_operation", "elob_path", "elob_process", c("ownerid").alias("order_owner"),
        "elob_salesadministrationuser", "elob_doublebooking", "elob_testcompletiondate",
    )


def orders(t: Tables, p: Params, words: lookup.CodeMap, priced: DataFrame, rows: DataFrame) -> DataFrame:
    """The wanted orders (``rows``) with project, address, parameters, service kind and latest decision."""
    order_ids = rows.select("elob_sokxorder2id").distinct()
    parameters = staged(
        named(t["order_parameter"], "elob_name", fv.CONSENT_NUMBER, fv.SPECIAL_OFFER)
        .join(order_ids, c("elob_sokxorder") == c("elob_sokxorder2id"), "left_semi")
        .select("elob_sokxorder", "elob_name", "elob_value")
    )
    processes = t.lookup("product_process").select(c("elob_productprocessid").alias("elob_process"), c("elob_name").alias("process_name"))
    rows = rows.join(processes, "elob_process", "left")
    rows = user(rows, t, "order_owner", "seller", "fullname", "domainname", "elob_salespersonid")
    rows = user(rows, t, "elob_salesadministrationuser", "admin", "fullname", "domainname")
    rows = user(rows, t, "elob_doublebooking", "second", "fullname", "elob_salespersonid")

    projects = t["opportunity"].select(
        "opportunityid", c("elob_opportunityid").alias("project_number"), "elob_initiative", c("ownerid").alias("project_owner"),
        c("elob_coronavirus").alias("project_flag"),
    )
    rows = rows.join(projects, c("elob_project") == c("opportunityid"), "left")
    rows = labels(
        rows, words, order_status=("order_statuscode", fv.ORDER_STATUS), operation=("elob_operation", fv.ORDER_OPERATION),
        path=("elob_path", fv.ORDER_PATH), initiative=("elob_initiative", fv.INITIATIVE),
    )
    rows = user(rows, t, "project_owner", "leader", "fullname", "domainname", "elob_salespersonid")
    rows = rows.join(final_fix_role(priced, "final"), c("opportunityid") == c("final_elob_project"), "left")

    sold = t["sold_product"].select("elob_soldproductid", c("elob_name").alias("product_name"))
    kinds = service_kinds(t, p)
    services = t["sold_product"].select(c("elob_soldproductid").alias("service_id"), c("elob_parentsoldproduct").alias("service_of"))
    kind_of_parent = (
        services.where(c("service_of").isNotNull())
        .join(kinds, c("service_id") == c("kind_of"), "left")
        .select("service_of", blank(c("service_kind")).alias("service_kind"))
        .distinct()
    )

    def parameter(name: str, out: str) -> DataFrame:
        found = named(parameters, "elob_name", name)
        return found.select(c("elob_sokxorder").alias(f"{out}_of"), c("elob_value").alias(out)).distinct()

    key = c("elob_sokxorder2id")
    return (
        rows.join(sold, c("elob_soldproduct") == c("elob_soldproductid"), "left")
        .join(kind_of_parent, c("elob_soldproductid") == c("service_of"), "left")
        .join(addresses(t), c("elob_location") == c("elob_addressid"), "left")
        .join(parameter(fv.CONSENT_NUMBER, "consent"), key == c("consent_of"), "left")
        .join(parameter(fv.SPECIAL_OFFER, "special"), key == c("special_of"), "left")
        .join(latest_decisions(t, words), key == c("decided_for"), "left")
    )


def build(t: Tables, p: Params) -> DataFrame:
    words = code_map(t, *CODES)
    contracts = staged(t["contract"].where(
        (c("elob_categoryid") == p.fix_category)
        & dates.from_year(c("elob_revisiondate"), p.verified_from_year)
        & c("statuscode").isin(*fv.ACTIVE_CONTRACT_STATUSES)
    ).select(
        "contractid", "contractnumber", "customerid", c("ownerid").alias("contract_owner"), c("statuscode").alias("contract_statuscode"), "elob_contracttype",
        "elob_contractratetype", "elob_categoryid", "elob_subcategory", "elob_signedbycustomeron", "elob_revisiondate",
        c("modifiedon").alias("contract_modified"), "elob_plnumber", "elob_attachedplnumber",
    ))
    # The earliest active entry of a contract joined back on its own time adds no row and no other column.
    first_active = t["status_history"].where(c("elob_statusreasonid").isin(*fv.ACTIVE_CONTRACT_REASONS)).groupBy(
        c("elob_contractid").alias("history_of")
    ).agg(F.min("createdon").alias("active_since"))
    categories = t.lookup("category").select("elob_categoryid", c("elob_name").alias("category_name"))
    subcategories = categories.toDF("elob_subcategory", "subcategory_name")
    accounts = without_test_customers(
        t["account"].select("accountid", "elob_sowid", "elob_nip", "elob_businesssegment", c("ownerid").alias("account_owner")), t
    )
    accounts = user(accounts, t, "account_owner", "keeper", "fullname", "domainname", "elob_salespersonid", how="inner")

    out = (
        contracts.join(categories, "elob_categoryid")
        .join(subcategories, "elob_subcategory", "left")
        .join(first_active, c("contractid") == c("history_of"))
        .join(accounts, c("customerid") == c("accountid"))
    )
    out = labels(
        out, words, segment=("elob_businesssegment", fv.SEGMENT), contract_status=("contract_statuscode", fv.CONTRACT_STATUS),
        contract_type=("elob_contracttype", fv.CONTRACT_TYPE), contract_rate=("elob_contractratetype", fv.CONTRACT_RATE_TYPE),
    )
    out = user(out, t, "contract_owner", "holder", "fullname", "domainname", "elob_salespersonid", how="inner")

    wanted = contracts.select("contractid")
    direct = staged(t["opportunity"].join(wanted, c("elob_contract") == c("contractid"), "left_semi").select(
        c("elob_contract").alias("direct_of"), c("opportunityid").alias("direct_key"), c("elob_opportunityid").alias("direct_number"),
        c("elob_coronavirus").alias("direct_flag"),
    ))
    ordered = staged(wanted_orders(t, wanted))
    projects = direct.select(c("direct_key").alias("project")).unionByName(ordered.select(c("elob_project").alias("project")))
    chosen = staged(wanted_calculations(t, contracts, projects))
    priced = staged(calculations(t, chosen))
    direct = direct.join(final_fix_role(priced, "linked"), c("direct_key") == c("linked_elob_project"), "left")

    owners = t["activity_pointer"].select(c("activityid").alias("owned"), c("ownerid").alias("calculation_owner"))
    owned = user(priced.join(owners, c("activityid") == c("owned"), "left"), t, "calculation_owner", "pricer", "domainname")
    own = as_role(owned, "own", "activityid", "pricer_domainname", commission=False)
    attached = as_role(owned, "attached", "activityid", "pricer_domainname", commission=False)

    helpers = t["contributor"].select(c("elob_contract").alias("helped"), "representativeid").distinct()
    helpers = user(helpers, t, "representativeid", "helper", "fullname", "domainname", "elob_salespersonid")
    archive = labels(t["contract_archive"], words, archive_status=("elob_tigerstatus", fv.ARCHIVE_STATUS)).select(
        c("elob_contract").alias("archived"), "elob_archivingdate", "elob_barcode", "archive_status"
    ).distinct()

    key = c("contractid")
    out = (
        out.join(direct, key == c("direct_of"), "left")
        .join(orders(t, p, words, priced, ordered), key == c("order_of"), "left")
        .join(helpers, key == c("helped"), "left")
        .join(archive, key == c("archived"), "left")
        .join(own, c("elob_plnumber") == c("own_activityid"), "left")
        .join(attached, c("elob_attachedplnumber") == c("attached_id"), "left")
    )

    def login(name: str) -> Column:
        return text.strip_domain_prefix(c(name), LOGIN_LENGTH)

    def day(column: Column) -> Column:
        return dates.date_to_text(column)

    number = numbers.number_or_zero
    special_code = numbers.cast_numeric(c("special"), "int")
    rows = out.select(
        c("elob_sowid").alias("IDSOW_KLIENTA"),
        blank(c("elob_nip")).alias("NIP_KLIENTA"),
        c("segment").alias("SEGMENT_KLIENTA"),
        c("keeper_fullname").alias("WLASCICIEL_KLIENTA"),
        login("keeper_domainname").alias("LOGIN_WLASCICIELA_KLIENTA"),
        blank(c("keeper_elob_salespersonid")).alias("KOD_BSCS"),
        c("contractnumber").alias("NUMER_UMOWY"),
        c("holder_fullname").alias("WLASCICIEL_UMOWY"),
        blank(login("holder_domainname")).alias("LOGIN_WLASCICIELA_UM"),
        blank(c("holder_elob_salespersonid")).alias("KOD_BSCS_WL_UM"),
        c("contract_status").alias("STATUS_UMOWY"),
        c("contract_type").alias("TYP_UMOWY"),
        c("category_name").alias("KATEGORIA_UMOWY"),
        c("subcategory_name").alias("PODKATEGORIA_UMOWY"),
        blank(day(dates.add_days(c("elob_signedbycustomeron")))).alias("DATA_PODPISANIA_UMOWY"),
        day(c("elob_revisiondate")).alias("DATA_WERYFIKACJI_UMOWY"),
        day(c("active_since")).alias("DATA_Z_SH"),
        day(c("contract_modified")).alias("OST_DATA_MODYF_UMOWY"),
        blank(c("helper_fullname")).alias("REPREZENTANT"),
        blank(login("helper_domainname")).alias("LOGIN_REP"),
        blank(c("helper_elob_salespersonid")).alias("KOD_BSCS_REP"),
        blank(c("direct_number")).alias("PROJEKT_POWIAZANY_BEZP_Z_UM"),
        blank(c("linked_id")).alias("ID_PIL_FIX_FINAL_Z_PPBZU"),
        number(c("linked_margin")).alias("MARZA_Z_PILFINAL_Z_PPBZU"),
        numbers.to_number_or_zero(c("linked_commission")).alias("MARZA_UWZGL_PROW_FINAL_Z_PPBZU"),
        number(c("linked_revenue")).alias("REVE_Z_PILA_FINAL_Z_PPBZU"),
        offer_label("linked").alias("MAPA_KOMPETENCJI_OG"),
        blank(c("elob_ordernumber")).alias("NR_ZAM_SOKX"),
        F.when(c("order_statuscode").isNull(), F.lit(" ")).otherwise(c("order_status")).alias("STATUS_ZAMOWIENIA_SOKX"),
        blank(text.str_replace(c("consent"), "    ", "")).alias("NUMER_ZGODY"),
        codes.decode_ladder(special_code, {fv.OFFER_NO: fv.UPPER_FLAGS[0], fv.OFFER_YES: fv.UPPER_FLAGS[1]}, " ").alias("OFERTA_NIESTANDARDOWA"),
        blank(c("seller_fullname")).alias("WLASCICIEL_ZAMOWIENIA"),
        blank(login("seller_domainname")).alias("LOGIN_WLASCICIELA_ZAM"),
        blank(c("seller_elob_salespersonid")).alias("KOD_BSCS_WL_ZAM"),
        F.when(c("elob_operation").isNull(), F.lit(" ")).otherwise(c("operation")).alias("OPERACJA"),
        blank(c("product_name")).alias("PRODUKT_NA_ZAM"),
        blank(c("service_kind")).alias("RODZAJ_USLUGI"),
        blank(c("project_number")).alias("ID_PROJEKTU"),
        blank(c("initiative")).alias("INICJATYWA"),
        blank(c("leader_fullname")).alias("WLASCICIEL_PROJEKTU"),
        blank(login("leader_domainname"), " ").alias("LOGIN_WL_PROJEKTU"),
        blank(c("leader_elob_salespersonid")).alias("KOD_BSCS_WL_PRO"),
        blank(c("final_id")).alias("ID_PIL_FINALNEGO"),
        number(c("final_margin")).alias("MARZA_Z_PIL"),
        numbers.to_number_or_zero(c("final_commission")).alias("MARZA_UWGLEDNIAJACA_PROWIZJE"),
        number(c("final_revenue")).alias("REVE_Z_PILA"),
        offer_label("final").alias("MAPA_KOMPETENCJI_OG1"),
        blank(text.sentinel_to_null(c("elob_barcode"))).alias("UM_BARKOD"),
        blank(day(dates.add_days(c("elob_archivingdate")))).alias("DATA_ARCH_UM"),
        blank(c("archive_status")).alias("STATUS_TIGER"),
        blank(c("contract_rate")).alias("STAWKI_NA_UMOWIE"),
        blank(c("second_elob_salespersonid")).alias("DB_KOD"),
        blank(c("second_fullname")).alias("DB_NAZWISKO"),
        blank(c("own_id")).alias("ID_PILA_FINALNEGO_Z_PROJEKTU"),
        blank(c("elob_attachedplnumber")).alias("NUMER_DOLACZONEGO_PILA_BCASE"),
        preferred_type().alias("TYP_PILA"),
        codes.decode_ladder(F.coalesce(c("own_final"), c("attached_final")), fv.UPPER_FLAGS, "").alias("FINALNY_PIL"),
        number(F.coalesce(c("own_margin"), c("attached_margin"))).alias("MARZA"),
        number(F.coalesce(c("own_revenue"), c("attached_revenue"))).alias("CALKOWITA_WARTOSC_PRZYCHODU"),
        both_offers_label("own", "attached").alias("MAPA_KOMPETENCJI_OG2"),
        codes.decode_ladder(c("project_flag"), fv.UPPER_FLAGS, "").alias("FLAGA_KORONAWIRUS"),
        codes.decode_ladder(c("direct_flag"), fv.UPPER_FLAGS, "").alias("PROJEKT_POWIAZANY_BEZP_Z_UM_FK"),
        blank(login("own_pricer_domainname")).alias("LOGIN_WL_PILA_FIN_Z_PROJEKTU"),
        blank(login("attached_pricer_domainname")).alias("LOGIN_WL_DOLACZONEGO_PILA_BCS"),
        blank(c("au_number")).alias("NR_OST_ZLEC_AU"),
        blank(day(c("au_sent"))).alias("DATA_WYS_ZLEC_AU"),
        blank(c("decision")).alias("ODP_ZE_ZLEC_AU"),
        blank(day(c("au_decided"))).alias("DATA_ODP_NA_ZLEC_AU"),
        blank(c("zip_name")).alias("LOKALIZACJA_KOD_POCZTOWY"),
        c("city_name").alias("LOKALIZACJA_MIASTO"),
        text.replace_whole_value(blank(c("street_name"), " "), "'", "").alias("LOKALIZACJA_ULICA"),
        c("building_number").alias("LOKALIZACJA_NR_BUDYNKU"),
        blank(c("process_name")).alias("PROCES_ZAM_SOKX"),
        blank(c("path")).alias("SCIEZKA_ZAM_SOKX"),
        blank(day(c("elob_testcompletiondate"))).alias("DATA_ZAKONCZENIA_TESTOW"),
        blank(c("admin_fullname")).alias("ADMINISTRACJA"),
        blank(login("admin_domainname")).alias("LOGIN_ADMINISTRACJA"),
    )
    return rows.distinct()
