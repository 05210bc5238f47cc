"""Names, codes, labels and patterns that sources and targets prescribe.

Everything here is data that has to equal the sources' or targets' own spelling for right results.
Ids of single customers, people, sites and queues are not here; they are parameters or small tables.
"""

from __future__ import annotations

from typing import NamedTuple


class Code(NamedTuple):
    """Address of a code list in the shared dictionary."""

    entity: int | None
    attribute: str
    lang: int


ENGLISH, POLISH = 1033, 1045
ACCOUNT, OPPORTUNITY, CONTRACT, APPOINTMENT, PHONE_CALL = 1, 3, 1010, 4201, 4210
ARCHIVE, MOBILE_ORDER, SALE, PRICE_CALCULATION, FIXED_ORDER, WORK_ORDER = 10024, 10034, 10036, 10046, 10069, 10080

SEGMENT = Code(ACCOUNT, "elob_businesssegment", ENGLISH)
SALES_STAGE = Code(OPPORTUNITY, "elob_salesstage", ENGLISH)
PROJECT_STATE = Code(OPPORTUNITY, "statecode", POLISH)
PROJECT_STATUS = Code(OPPORTUNITY, "statuscode", POLISH)
INITIATIVE = Code(OPPORTUNITY, "elob_initiative", ENGLISH)
PRODUCT_CATEGORY = Code(OPPORTUNITY, "elob_productcategory", POLISH)
PROJECT_TYPE = Code(OPPORTUNITY, "elob_projecttype", POLISH)
CONTRACT_STATUS = Code(CONTRACT, "statuscode", POLISH)
CONTRACT_TYPE = Code(CONTRACT, "elob_contracttype", POLISH)
CONTRACT_RATE_TYPE = Code(CONTRACT, "elob_contractratetype", POLISH)
TRANSFER_DOCUMENT = Code(CONTRACT, "elob_transferdocumenttype", POLISH)
ECONTRACT_STATUS = Code(CONTRACT, "elob_econtractstatus", POLISH)
ARCHIVE_STATUS = Code(ARCHIVE, "elob_tigerstatus", POLISH)
MOBILE_ORDER_STATUS = Code(MOBILE_ORDER, "statuscode", ENGLISH)
MOBILE_ORDER_TYPE = Code(MOBILE_ORDER, "elob_mobileordertype", ENGLISH)
SALE_TYPE = Code(SALE, "elob_saletype", POLISH)
CALCULATION_STATUS = Code(PRICE_CALCULATION, "statuscode", POLISH)
ORDER_STATUS = Code(FIXED_ORDER, "statuscode", ENGLISH)
ORDER_OPERATION = Code(FIXED_ORDER, "elob_operation", ENGLISH)
ORDER_OPERATION_POLISH = Code(FIXED_ORDER, "elob_operation", POLISH)
ORDER_PATH = Code(FIXED_ORDER, "elob_path", ENGLISH)
ORDER_REALIZATION = Code(FIXED_ORDER, "elob_realizationmode", POLISH)
ORDER_ECONTRACT = Code(FIXED_ORDER, "elob_econtract", POLISH)
ORDER_ECONTRACT_AUTO = Code(FIXED_ORDER, "elob_availableforecontractautomatic", POLISH)
CONTRACT_SIGNED_BY = Code(None, "elob_contractsignedby", ENGLISH)
WORK_ORDER_DECISION = Code(WORK_ORDER, "elob_sokxwodecision", POLISH)
SUBJECT_TYPE = Code(APPOINTMENT, "elob_subjecttype", ENGLISH)
APPOINTMENT_STATUS = Code(APPOINTMENT, "statuscode", ENGLISH)
EXTENDED_REASON = Code(APPOINTMENT, "elob_extendedstausreason", ENGLISH)
PHONE_CALL_STATUS = Code(PHONE_CALL, "statuscode", ENGLISH)
PHONE_CALL_STATUS_POLISH = Code(PHONE_CALL, "statuscode", POLISH)
PHONE_CALL_STATE = Code(PHONE_CALL, "statecode", POLISH)

# Codes that conditions test for.
FIX_CALCULATION, MOBILE_CALCULATION = 1, 2
CALCULATION_ACCEPTED, CALCULATION_CALCULATED = 2, 743940000
ORDER_DONE, ORDER_CANCELLED, OPERATION_LEFT_OUT = 743940001, 100000001, 4
ECONTRACT, ECONTRACT_AUTO = 743940002, 743940003
STANDARD_CONTRACT_TYPES = [1, 3]
WORK_ORDER_AU = 2
ACTIVE_CONTRACT_STATUSES = [6, 100000002, 743940004, 743940000]
ACTIVE_CONTRACT_REASONS = ["6", "100000002", "743940004", "743940000"]
PHONE_CALL_CANCELLED = 3
INITIATIVE_STORM = 2
SERVICE_KIND_INDEXES = ["19", "4", "11"]
OFFER_NO, OFFER_YES = 63, 62

# Labels.
YES, NO = "Tak", "Nie"
CALCULATION_TYPES = {2: "Mobile", 1: "Fix"}
FINAL_FLAGS = {1: "Tak", 0: "Nie"}
UPPER_FLAGS = {1: "TAK", 0: "NIE"}
CONTACT_STATES = {0: "Aktywny", 1: "Nieaktywny"}
STAGES = {0: "Suspecting", 1: "Prospecting", 2: "Analyzing", 3: "Negotiating", 4: "Closing"}
STORM_LABEL = "Cybersecurity Storm"
SALE_TYPE_RENAMES = {"Nowa Sprzedaż": "Nowa sprzedaż", " ": ""}
COMPETENCE_MAP, READY_OFFER = "MOc", "OG"
SERVICE_KEEP_OR_NEW = {"%utrzymanie": "Utrzymanie", "%akwizycja": "Akwizycja"}
LOYALTY_PERIODS = {
    "%umowa na 12%": "12",
    "%umowa na 24%": "24",
    "%kontrakt na 24%": "24",
    "%kontrakt na 12%": "12",
    "%kontrakt na 12/24%": "12/24(?)",
}

# Names and patterns of rows and attributes.
ORDERS_TOPIC_LEFT_OUT = "e-zamawiaja"
PORTFOLIO_PATTERN = "KKB%"
ARCHIVED_PATTERN = "ZARCHIWIZOWANO%"
CAMPUS_PATTERN = "Sie%kampusow%"
LAN_PRODUCT = "zarządzanie siecią lan"
DEVICE_COUNT = "liczba urządzeń utm"
USERS_BUSINESS_UNIT = "ICT Sales"
UPKEEP_PRODUCT = "is.a.148"
PROGRESS_PRODUCTS = [
    "id.a.36", "id.a.438", "id.a.439", "id.a.440", "id.a.441", "id.a.479", "sd.a.53", "sd.a.68",
    "sd.a.78", "sd.a.79", "sd.a.7", "sd.a.80", "sd.a.81", "sd.a.86", "sd.a.87", "sd.a.88",
]
MIGRATED_NUMBERS_PATTERN = "migrowane numery od oa (wykaz)%"
LINKED_ORDER_PATTERN = "numer zlecenia powiązanego"
CONSENT_NUMBER, SPECIAL_OFFER, CONTRACT_TERM = "numer zgody", "oferta niestandardowa", "czas trwania umowy"
SUBSCRIPTION_FEE_PATTERN = "opłata abonamentowa netto%kwota pln%"
INSTALLATION_FEE_PATTERN = "opłata instalacyjna netto%kwota pln%"
CALCULATION_COMMENT = "komentarz do metryczki"
COMMENT_FROM, COMMENT_LENGTH, COMMENT_KEPT = 176, 500, 450
MARGIN_FIELD = "MOBILE_M2M|TOTAL|CF|TOTAL_CF_ZL_DISCOUNTED_CASH_FLOW_DPV"
OLD_MARGIN_FIELD = "MOBILE_M2M|TOTAL|CF|TOTAL_CF_ZL_DISCOUNTED_CASH_FLOW_DPV_old"
SETTLEMENT_FIELDS = [
    "MOBILE|SIMfree|rozliczenie|deklaracja_wykorzystanie",
    "MOBILE|WSKAZNIKI|WARTOSC|KWOTA_PROWIZJI_KLUCZ_LUB_KORPO",
]
SETTLEMENT_TERMINAL_PATTERN = "MOBILE|SIMfree|rozliczenie|BSCS_terminal_%"
SETTLEMENT_DECLARED_PATTERN = "MOBILE|SIMfree|rozliczenie|deklaracja_wykorzystanie%"
SETTLEMENT_RESALE = "odsprzedaż zł"
NO_AMOUNT = "#N/A"
INVOICE_REVENUE, OPERATOR_REVENUE = "mobile_reve_invoices", "mobile_reve_operators"
COMMISSION_MARGIN = "fix_margin_80"
COMPETENCE_PARAMETER, COMPETENCE_PARAMETER_PLAIN = "mapa kompetencji usługa", "mapa kompetencji usluga"
READY_OFFER_PARAMETER = "oferta gotowa"
SALES_CHANNEL, CASH_MARGIN = "kanał sprzedaży", "fix_marigin_cash_and_installment"
SERVICE_RENAMES = {"fix_service_ons_1": "fix_service_ons_355", "fix_service_ons_2": "fix_service_ons_356"}
SERVICE_PATTERNS = [
    "fix_service_(%", "fix_option_miejski%", "fix_service_ons%", "fix_service_fixvoice%", "fix_option_other%", "fix_service_ssl%",
    "fix_option_itdf%", "fix_option_managed%", "fix_option_pabx%", "fix_option_printer%", "fix_option_map_of_competences%",
]
# Parameter family to the patterns of its names; the target column of a family has the same name.
SERVICE_FAMILIES = {
    "marza_jedn_na_produkcie": ["fix_unitary_margin%"],
    "abo_za_szt": ["fix_subscription_%"],
    "ilosc": ["fix_quantity%"],
    "ulga_oplata_ins": ["fix_installation_discount_%"],
    "dlugosc_kontraktu": ["fix_contract_length%"],
    "oplata_ins": [
        "fix_installation_1%", "fix_installation_2%", "fix_installation_3%", "fix_installation_4%", "fix_installation_5%",
        "fix_installation_6%", "fix_installation_7%", "fix_installation_8", "fix_installation_9%",
    ],
    "rodzaj_sprzedazy": ["fix_new_sales_retention__%"],
    "opcja_produktu_uslugi": [
        "fix_type_miejski eth%", "fix_service_level%", "fix_support_1%", "fix_support_2%", "fix_support_3%", "fix_support_4%",
        "fix_support_5%", "fix_support_6%", "fix_support_7%", "fix_support_8%", "fix_support_9%",
    ],
    "ilosc_portow": ["fix_number_ports%", "fix_number_of_ports%"],
    "oplata_mies_serwis": ["fix_support_subscription%"],
    "ilosc_pakietow": ["fix_number_services_%"],
    "opcja_sla": ["fix_sla_option_%"],
    "oplata_za_sla": ["fix_sla_charges_%"],
    "odsprzedaz_sprzetu_wartosc": ["fix_sum_payments_%"],
}

# Labels of the order progress and of its barriers.
UPKEEP_RUNNING, UPKEEP_DONE = "W trakcie - Utrzymanie", "Zrealizowano - Utrzymanie"
BY_ECONTRACT, DONE_BY_ECONTRACT = "Realizacja e-umową", "Zrealizowano e-umową"
BY_ECONTRACT_AUTO, DONE_BY_ECONTRACT_AUTO = "Realizacja e-umową automat", "Zrealizowano e-umową automat"
SIGNED_RUNNING, SIGNED_DONE = "W trakcie - Maximus", "Zrealizowano - Maximus"
UNMET_RUNNING, UNMET_DONE = "W trakcie - Brak warunków", "Zrealizowano - Brak warunków"
MET_RUNNING, COULD_DONE = "W trakcie - Warunki na e-umowę są", "Zrealizowano - Była możliwość realizacji e-umową"
COULD_RUNNING = "W trakcie - Była możliwość realizacji e-umową"
BARRIER_CONTRACT, BARRIER_THREE_SIDED = "Bariera - Umowa niestandardowa", "Bariera - umowa trójstronna"
BARRIER_NUMBERS, BARRIER_LINKED_ORDER = "Bariera - Migrowane numery", "Bariera - Numer zlecenia powiązanego"
BARRIER_NO_CONTRACT, BARRIER_OTHER, BARRIER_OTHER_TIGHT = "Bariera - Tryb bezumowny", "Bariera - Inne", "Bariera -Inne"
BARRIER_UPKEEP = "Bariera - Kontynuacja/wznowienie umowy"
