"""Business tables of the plans as projections of the given tables.

Every source table of the plans is derived row by row from one given table, in SQL that both engines
read, so the plans run at any scale on data that grows with it. All names and ids are invented.
"""

from __future__ import annotations

from collections.abc import Sequence

from checks.base import Star
from siftload.sources.tables import Tables


def div(x: str, n: int) -> str:
    return f"CAST(floor({x} / {n}) AS BIGINT)"


def pick(x: str, values: Sequence[str | None]) -> str:
    """CASE over the remainder of ``x``; the values are SQL texts, None is null."""
    arms = " ".join(f"WHEN {i} THEN {v if v is not None else 'NULL'}" for i, v in enumerate(values))
    return f"CASE {x} % {len(values)} {arms} END"


def named(x: str, names: Sequence[str]) -> str:
    return pick(x, [f"'{n}'" for n in names])


DICTIONARY_CODES = {
    (1, "elob_BusinessSegment", 1033): [1, 2, 3, 4],
    (3, "elob_salesstage", 1033): [0, 1, 2, 3, 4],
    (3, "StateCode", 1045): [0, 1, 2],
    (3, "statuscode", 1045): [0, 1, 2, 3],
    (3, "elob_initiative", 1033): [1, 3],
    (3, "elob_productcategory", 1045): [0, 1, 2, 3],
    (3, "elob_projecttype", 1045): [0, 1, 2],
    (1010, "statuscode", 1045): [6, 100000002, 743940004, 743940000, 1],
    (1010, "elob_ContractType", 1045): [1, 2, 3],
    (1010, "elob_contractratetype", 1045): [0, 1],
    (1010, "elob_transferdocumenttype", 1045): [743940002, 743940003, 1],
    (1010, "elob_econtractstatus", 1045): [0, 1, 2],
    (10024, "elob_tigerstatus", 1045): [0, 1],
    (10034, "StatusCode", 1033): [0, 1, 2],
    (10034, "elob_mobileordertype", 1033): [0, 1],
    (10046, "statuscode", 1045): [1, 2, 743940000],
    (10069, "statuscode", 1033): [743940001, 1, 2, 100000001],
    (10069, "elob_operation", 1033): [1, 2, 4],
    (10069, "elob_operation", 1045): [1, 2, 3],
    (10069, "elob_path", 1033): [1, 2],
    (10069, "elob_Realizationmode", 1045): [1, 2],
    (10069, "elob_econtract", 1045): [0, 1],
    (10069, "elob_availableforecontractautomatic", 1045): [0],
    (10069, "elob_contractsignedby", 1033): [1, 2],
    (10070, "elob_contractsignedby", 1033): [2, 3],
    (10080, "elob_sokxwodecision", 1045): [0, 1],
    (4201, "elob_subjecttype", 1033): [0, 1],
    (4201, "statuscode", 1033): [0, 1, 2],
    (4201, "elob_extendedstausreason", 1033): [0, 1],
    (4210, "statuscode", 1033): [0, 1, 2],
    (4210, "StatusCode", 1045): [0, 1, 2, 3],
    (4210, "statecode", 1045): [0, 1],
}
LABELLED_CODES = {(10036, "elob_saletype", 1045): {0: "Nowa Sprzedaż", 1: " ", 2: "Utrzymanie"}}

PARAMETER_NAMES = [
    "fix_service_(lan)", "fix_unitary_margin", "fix_subscription", "fix_quantity", "fix_service_ons_1", "fix_installation_discount",
    "fix_contract_length", "fix_installation", "fix_new_sales_retention_", "fix_type_miejski eth", "fix_number_ports",
    "fix_support_subscription", "fix_number_services", "fix_sla_option", "fix_sla_charges", "fix_sum_payments", "fix_option_pabx",
]
GENERAL_NAMES = [
    "mobile_reve_invoices", "mobile_reve_operators", "komentarz do metryczki", "fix_margin_80", "Oferta Gotowa",
    "Mapa kompetencji usluga", "Mapa kompetencji usługa", "kanał sprzedaży", "fix_marigin_cash_and_installment",
]
SERVICE_TEXTS = ["LAN - utrzymanie", "LAN - akwizycja", "umowa na 24 m", "kontrakt na 12 m", "Siec kampusowa"]
PRODUCT_NUMBERS = ["ID.A.36", "IS.A.148", "SD.A.7", "SD.A.88", "XX.1"]

E, O, L, S, C, N = "event_id", "o_orderkey", "l_orderkey", "s_suppkey", "c_custkey", "n_nationkey"
LINE_ID = "(l_orderkey * 10000000 + l_partkey * 8 + l_linenumber)"
LATER = "o_orderdate + INTERVAL 22 YEAR"
LINE_LATER = "l_shipdate + INTERVAL 22 YEAR"


def _string_map() -> str:
    rows = [f"({e}, '{a}', {g}, {v}, '{a} {v}')" for (e, a, g), codes in DICTIONARY_CODES.items() for v in codes]
    rows += [f"({e}, '{a}', {g}, {v}, '{label}')" for (e, a, g), labels in LABELLED_CODES.items() for v, label in labels.items()]
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS m(objecttypecode, attributename, langid, attributevalue, value)"


def _keyed_by_nation(**columns: str) -> str:
    return f"SELECT {', '.join(f'{sql} AS {name}' for name, sql in columns.items())} FROM {{nation}}"


CRM: dict[str, str] = {
    "string_map": _string_map(),
    "account": f"""SELECT concat('A', {C}) AS accountid, concat('Acc;', chr(10), c_name) AS name,
        CASE WHEN {C} % 7 = 0 THEN NULL ELSE concat('N', {C}) END AS elob_nip, CASE WHEN {C} % 5 = 0 THEN NULL ELSE concat('G', {C}) END AS elob_regon,
        {pick(C, [f"concat('R', {C}, 'R002')", f"concat('R', {C}, 'R', {C} + 10000)", None, f"concat('K', {C})", f"concat('K', {C})"])} AS elob_sowid,
        CAST(1 + {div(C, 5)} % 5 AS INT) AS elob_businesssegment, concat('P', c_nationkey) AS elob_portfolio, concat('U', {C} % 97) AS ownerid,
        CASE WHEN {C} % 11 = 0 THEN 1 ELSE 0 END AS statecode, CASE WHEN {C} % 13 = 0 THEN NULL ELSE concat('T', {C}) END AS primarycontactid FROM {{customer}}""",
    "contact": f"""SELECT concat('T', {C}) AS contactid, concat('Full', chr(10), chr(13), c_name) AS fullname, CASE WHEN {C} % 4 = 0 THEN NULL ELSE concat('First', chr(13), {C}) END AS firstname,
        concat('Last', c_nationkey) AS lastname, CASE WHEN {C} % 3 = 0 THEN NULL ELSE concat('+48', chr(10), {C}) END AS mobilephone,
        CASE WHEN {C} % 6 = 0 THEN NULL ELSE concat('c', {C}, '@example.com') END AS emailaddress1, CAST({C} % 3 AS INT) AS statecode FROM {{customer}}""",
    "system_user": f"""SELECT concat('U', {S}) AS systemuserid, concat('First', {S}, ' Last', s_nationkey) AS fullname, concat('First', {S}) AS firstname,
        CASE WHEN {S} % 17 = 0 THEN NULL ELSE concat('Last', s_nationkey) END AS lastname, concat('TP', chr(92), 'Login_', {S}) AS domainname,
        CASE WHEN {S} % 4 = 0 THEN NULL ELSE concat('SP', {S}) END AS elob_salespersonid, concat('U', {div(S, 5)}) AS parentsystemuserid,
        concat('Boss ', {div(S, 5)}) AS parentsystemuseridname, concat('S', {S} % 5) AS siteid, concat('B', {S} % 27) AS businessunitid,
        {named(S, ["ICT Sales", "Other"])} AS businessunitidname FROM {{supplier}}""",
    "business_unit": _keyed_by_nation(businessunitid=f"concat('B', {N})"),
    "excluded_customers": f"SELECT CASE WHEN {S} % 2 = 0 THEN concat('K', {S} * 8 + 3) ELSE concat('k', {S} * 8 + 3, ' ') END AS elob_sowid FROM {{supplier}}",
    "allowed_managers": f"SELECT CASE WHEN {N} % 2 = 0 THEN concat('Boss ', {N} * 3) ELSE concat('BOSS ', {N} * 3, '  ') END AS full_name FROM {{nation}}",
    "portfolio": _keyed_by_nation(elob_portfolioid=f"concat('P', {N})", elob_name=f"concat({named(N, ['KKB ', 'KKB-', 'XKB '])}, n_name)"),
    "opportunity": f"""SELECT concat('O', {O}) AS opportunityid, concat('PRJ-', {O}) AS elob_opportunityid, concat('Project ', {O}) AS name, {LATER} + INTERVAL 23 HOUR AS createdon,
        concat('U', {O} % 89) AS createdby, concat('U', {O} % 97) AS ownerid, concat('Owner ', {O} % 97) AS owneridname, concat('A', o_custkey) AS customerid, concat('A', o_custkey) AS accountid,
        CASE WHEN {O} % 4 = 0 THEN NULL ELSE o_totalprice END AS budgetamount, CASE WHEN {O} % 6 = 0 THEN NULL ELSE o_totalprice END AS estimatedvalue,
        {LATER} + INTERVAL 30 DAY AS estimatedclosedate, CASE WHEN {O} % 5 = 0 THEN NULL ELSE {LATER} + INTERVAL 22 HOUR END AS elob_estimatedbillingdate,
        CAST({O} % 6 AS INT) AS elob_salesstage, CAST({O} % 4 AS INT) AS statecode, CAST({O} % 5 AS INT) AS statuscode, CAST({pick(O, ['0', '1', '2', '3', None])} AS INT) AS elob_initiative,
        CAST({O} % 5 AS INT) AS elob_productcategory, CAST({O} % 4 AS INT) AS elob_projecttype, CAST({pick(O, ['0', '1', None])} AS INT) AS elob_coronavirus,
        CASE WHEN {O} % 2 = 0 THEN concat('C', {O}) END AS elob_contract FROM {{orders}}""",
    "pl": f"""SELECT concat('L', {O}) AS activityid, CAST({O} + 90000 AS STRING) AS elob_pl_id, concat('O', {div(O, 2)}) AS elob_project, CASE WHEN {O} % 5 < 3 THEN 1 ELSE 2 END AS elob_pltype,
        CASE WHEN {O} % 3 = 0 THEN 1 ELSE 0 END AS elob_finalpl, CASE WHEN {O} % 19 = 0 THEN NULL ELSE concat('S', {O}) END AS elob_plstatistic,
        CASE WHEN {O} % 7 = 0 THEN NULL ELSE {LATER} END AS elob_markedasfinalon, CAST({O} % 4 AS INT) AS elob_acceptancelevel FROM {{orders}}""",
    "pl_result": f"""SELECT concat('S', {O}) AS elob_plresultid, concat('Z', {O}) AS elob_pandl_id, CASE WHEN {O} % 8 = 0 THEN NULL ELSE CAST({O} % 50 AS DECIMAL(12, 2)) END AS elob_fix_margin_on_contract,
        CASE WHEN {O} % 9 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(14, 2)) END AS elob_fix_total_revenue_new, CAST({O} % 30 AS DECIMAL(12, 2)) AS elob_mobile_contributionmargin,
        CASE WHEN {O} % 6 = 0 THEN NULL WHEN {O} % 6 = 1 THEN CAST(0 AS DECIMAL(12, 2)) ELSE CAST({O} % 1000 AS DECIMAL(12, 2)) END AS elob_mobilediscountedcashmargin,
        CAST({O} % 77 AS DECIMAL(12, 2)) AS elob_mobile_committedrevenuekpln, CAST({O} % 70 AS DECIMAL(12, 2)) AS elob_mobile_reve_invoices, CAST({O} % 71 AS DECIMAL(12, 2)) AS elob_mobile_reve_operators,
        CAST({O} % 72 AS DECIMAL(12, 2)) AS elob_mobile_cost_variablecosts, CAST({O} % 73 AS DECIMAL(12, 2)) AS elob_mobile_cost_other, CAST({O} % 74 AS DECIMAL(12, 2)) AS elob_mobile_cost_comision,
        concat('AC', {O} % 5) AS elob_acceptance_code, CASE WHEN {O} % 3 = 0 THEN NULL ELSE concat('path ', {O} % 4) END AS elob_acceptancepath FROM {{orders}}""",
    "pl_sales_result": f"SELECT CASE WHEN {O} % 11 = 0 THEN concat('X', {O}) ELSE concat('Z', {O}) END AS elob_pandl_id FROM {{orders}}",
    "pl_parameter": f"""SELECT concat('Z', {L}) AS elob_pl_resultid, concat({named('l_partkey', PARAMETER_NAMES)}, '_', l_suppkey % 2 + 1) AS elob_name,
        CASE WHEN l_partkey % {len(PARAMETER_NAMES)} IN (0, 4, 16) THEN {named('l_suppkey', SERVICE_TEXTS)} ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS elob_parametervalue FROM {{lineitem}}
        UNION ALL SELECT concat('Z', {L}), {named('l_suppkey', GENERAL_NAMES)}, CASE WHEN l_suppkey % {len(GENERAL_NAMES)} = 2 THEN concat(repeat('intro ', 29), '& ', chr(39), 'a', chr(39), chr(10), l_partkey) ELSE CAST(l_linenumber AS STRING) END FROM {{lineitem}}""",
    "settlement_value": f"""SELECT CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST({L} AS STRING) END AS sfa_pil_id, concat('MOBILE|', l_returnflag, '|', l_linestatus) AS field_code,
        {pick('l_partkey', ["concat(CAST(CAST(l_quantity AS INT) AS STRING), ' 234,50 zł')", "'#N/A'", "'abc'", None, "concat('''', l_suppkey)"])} AS field_value, concat('k', l_suppkey) AS field_key FROM {{lineitem}}""",
    "misc_field": f"""SELECT sfa_pil_id, field_code, CASE WHEN field_code LIKE '%DISCOUNTED_CASH_FLOW%' AND field_value LIKE 'odsp%' THEN '' ELSE field_value END AS field_value, field_key FROM (SELECT CAST({O} + 90000 AS STRING) AS sfa_pil_id,
        {named(div(O, 7), ['MOBILE|SIMfree|rozliczenie|deklaracja_wykorzystanie', 'MOBILE|SIMfree|rozliczenie|BSCS_terminal_1', 'MOBILE|WSKAZNIKI|WARTOSC|KWOTA_PROWIZJI_KLUCZ_LUB_KORPO', 'MOBILE|SIMfree|rozliczenie|deklaracja_wykorzystanie_2', 'MOBILE_M2M|TOTAL|CF|TOTAL_CF_ZL_DISCOUNTED_CASH_FLOW_DPV', 'MOBILE_M2M|TOTAL|CF|TOTAL_CF_ZL_DISCOUNTED_CASH_FLOW_DPV_old'])} AS field_code,
        {pick(div(O, 12), ["'odsprzedaż zł'", f"CAST({O} AS STRING)", "'#N/A'", f"concat({O}, '.25')"])} AS field_value, concat('m', {O}) AS field_key FROM {{orders}}) m""",
    "activity_pointer": f"""SELECT concat('L', {O}) AS activityid, 10046 AS activitytypecode, CAST(NULL AS STRING) AS regardingobjectid, 'PIL' AS subject, {LATER} AS scheduledstart, {LATER} AS scheduledend,
        {LATER} AS createdon, {LATER} AS modifiedon, 'U1' AS createdby, 'U1' AS createdonbehalfby, 'U1' AS modifiedby, 'U1' AS modifiedonbehalfby, concat('U', {O} % 83) AS ownerid,
        CAST({pick(O, ['1', '2', '743940000', '2'])} AS INT) AS statuscode, 0 AS statecode FROM {{orders}}
        UNION ALL SELECT concat('E', {E}), {pick(E, ['4201', '4210', '4402'])}, {pick(div(E, 3), ["concat('A', user_id)", "concat('O', user_id)", "concat('BA', user_id)", f"concat('CA', {E} % 100)"])},
        {pick(E, [None, "'e-zamawiaja'", "concat(event_type, ';', props)", "concat(event_type, chr(12), '^')", "event_type"])}, ts, ts + INTERVAL 1 HOUR,
        {pick(E, ['ts - INTERVAL 40 MONTH', 'ts - INTERVAL 36 MONTH', 'ts - INTERVAL 30 MONTH', 'ts - INTERVAL 52 MONTH', 'ts - INTERVAL 12 MONTH'])}, ts - INTERVAL 11 MONTH, concat('U', user_id % 89),
        CASE WHEN {E} % 3 = 0 THEN NULL ELSE concat('U', user_id % 50) END, concat('U', {E} % 60), CASE WHEN {E} % 5 = 0 THEN NULL ELSE concat('U', user_id % 40) END, concat('U', {E} % 97),
        CAST({E} % 4 AS INT), CAST({E} % 2 AS INT) FROM {{events}}
        UNION ALL SELECT concat('CA', {S}), 4402, concat('CMP', {S}), concat('action ', {S}), {LATER}, {LATER}, {LATER}, {LATER}, 'U1', 'U1', 'U1', 'U1', 'U1', 1, 0 FROM {{supplier}} JOIN {{orders}} ON {O} = {S}""",
    "appointment": f"""SELECT concat('E', {E}) AS activityid, CASE WHEN {E} % 5 = 0 THEN NULL ELSE concat('A', user_id) END AS elob_relatedaccount, CAST({div(E, 3)} % 3 AS INT) AS elob_subjecttype,
        CAST({E} % 4 AS INT) AS elob_extendedstausreason FROM {{events}}""",
    "phone_call": f"""SELECT concat('E', {E}) AS activityid, CASE WHEN {E} % 7 = 0 THEN NULL ELSE concat('A', user_id) END AS elob_relatedaccount, concat('LD', {E} % 150) AS elob_relatedlead,
        concat('AN', {E} % 30) AS elob_answer, CASE WHEN {E} % 4 = 0 THEN NULL ELSE ts - INTERVAL 38 MONTH END AS elob_onholddate, CASE WHEN {E} % 3 = 0 THEN NULL ELSE concat(props, ';', chr(10)) END AS new_1 FROM {{events}}""",
    "billing_account": f"""SELECT concat('BA', {C}) AS elob_billingaccountid, CASE WHEN {C} % 9 = 0 THEN NULL ELSE concat('Bill ', c_name) END AS elob_name,
        CASE WHEN {C} % 4 = 0 THEN NULL ELSE concat('BN', {C}) END AS elob_billingnumber2, concat('A', {C} + {C} % 2) AS elob_account FROM {{customer}}""",
    "campaign": f"SELECT concat('CMP', {S}) AS campaignid, concat('Campaign ', {S}) AS name, concat('KMP-', {S}) AS elob_campaignid, concat('U', {S} % 4) AS createdby, {LATER} AS createdon FROM {{supplier}} JOIN {{orders}} ON {O} = {S}",
    "campaign_activity": f"SELECT concat('CA', {S}) AS activityid FROM {{supplier}}",
    "campaign_answer": _keyed_by_nation(elob_marketingcampainanswersid=f"concat('AN', {N})", elob_answer="n_name"),
    "queue": "SELECT concat('Q', r_regionkey) AS queueid, r_name AS name FROM {region}",
    "queue_item": f"""SELECT CASE WHEN {E} % 5 = 0 THEN concat('none', {E}) ELSE concat('E', {E}) END AS objectid, {named(E, ['Q1', 'Q2', 'Q1'])} AS queueid, concat('U', {E} % 30) AS workerid,
        ts - INTERVAL 34 MONTH AS enteredon, CASE WHEN {E} % 6 = 0 THEN NULL ELSE ts - INTERVAL 33 MONTH END AS workeridmodifiedon FROM {{events}}""",
    "lead": f"SELECT concat('LD', {S}) AS leadid, CASE WHEN {S} % 5 = 0 THEN NULL ELSE concat('Lead ', {S}) END AS subject, concat('ML', {S}) AS elob_marketinglistid FROM {{supplier}}",
    "contract": f"""SELECT concat('C', {O}) AS contractid, concat('CN-', {O}) AS contractnumber, concat('A', o_custkey) AS customerid, concat('U', {O} % 71) AS ownerid, {LATER} AS createdon, {LATER} + INTERVAL 5 DAY AS modifiedon,
        CAST({pick(div(O, 3), ['6', '100000002', '743940004', '743940000', '1', '77'])} AS INT) AS statuscode, concat('CAT', {O} % 3) AS elob_categoryid, CASE WHEN {O} % 4 = 0 THEN NULL ELSE concat('CAT', {O} % 7) END AS elob_subcategory,
        CAST(1 + {div(O, 2)} % 4 AS INT) AS elob_contracttype, CASE WHEN {div(O, 4)} % 9 = 0 THEN NULL ELSE {LATER} + INTERVAL 1 DAY END AS elob_revisiondate,
        CASE WHEN {O} % 4 = 0 THEN NULL ELSE {LATER} + INTERVAL 23 HOUR END AS elob_signedbycustomeron, CASE WHEN {O} % 8 = 0 THEN NULL ELSE {LATER} + INTERVAL 9 HOUR END AS elob_senttocustomeron,
        CAST({pick(div(O, 3), ['743940002', '743940003', '1', None, None, None, None])} AS INT) AS elob_transferdocumenttype, CAST({O} % 4 AS INT) AS elob_econtractstatus, CAST({pick(O, ['0', '1', '2', None, None, None, None])} AS INT) AS elob_acceptancefornoncontractmode,
        CASE WHEN {O} % 3 = 0 THEN NULL ELSE concat('BA', o_custkey) END AS elob_billingaccount, CASE WHEN {div(O, 5)} % 3 = 1 THEN NULL ELSE concat('L', {O} + 4 + {div(O, 7)} % 3) END AS elob_plnumber,
        CASE WHEN {O} % 4 = 1 THEN NULL ELSE CAST({O} + 90001 AS STRING) END AS elob_attachedplnumber, CAST({div(O, 4)} % 3 AS INT) AS elob_contractratetype, CAST({pick(O, ['12', '24', None])} AS INT) AS elob_durationtimeinmonths FROM {{orders}}""",
    "contract_archive": f"""SELECT CASE WHEN {div(O, 5)} % 3 = 0 THEN concat('X', {O}) ELSE concat('C', {O}) END AS elob_contract, CASE WHEN {O} % 5 = 0 THEN NULL ELSE {LATER} + INTERVAL 40 DAY END AS elob_archivingdate,
        {pick(div(O, 7), ["'null'", None, f"concat('BC', {O})"])} AS elob_barcode, {named(div(O, 3), ['ZARCHIWIZOWANO w teczce', 'inne'])} AS elob_comments, CAST({div(O, 11)} % 3 AS INT) AS elob_tigerstatus FROM {{orders}}""",
    "contract_opportunity": "SELECT concat('O', l_orderkey) AS opportunityid, concat('C', l_partkey) AS contractid FROM {lineitem}",
    "category": _keyed_by_nation(elob_categoryid=f"concat('CAT', {N})", elob_name=f"concat('cat ', {N})"),
    "contributor": f"SELECT CASE WHEN {O} % 2 = 0 THEN concat('X', {O}) ELSE concat('C', {O}) END AS elob_contract, concat('U', {O} % 50) AS representativeid FROM {{orders}}",
    "fixed_order": f"""SELECT concat('F', {O}) AS elob_sokxorder2id, CASE WHEN {O} % 10 = 0 THEN NULL ELSE concat('ORD-', {O}) END AS elob_ordernumber, {LATER} AS createdon, {LATER} + INTERVAL 3 DAY AS modifiedon,
        CAST({pick(div(O, 3), ['743940001', '1', '2', '100000001'])} AS INT) AS statuscode, CAST(1 + {O} % 4 AS INT) AS elob_operation, CAST(1 + {div(O, 7)} % 3 AS INT) AS elob_path,
        CASE WHEN {O} % 5 = 4 THEN NULL ELSE concat('C', {O}) END AS elob_contract, CASE WHEN {O} % 6 = 0 THEN NULL ELSE concat('O', {O}) END AS elob_project, concat('A', o_custkey) AS elob_customer, concat('SPR', {O}) AS elob_soldproduct,
        CAST({pick(div(O, 5), [None, None, '1', '2', None, None, '3', None])} AS INT) AS elob_contractsignedby, CAST({O} % 2 AS INT) AS elob_econtract, CAST({div(O, 2)} % 2 AS INT) AS elob_availableforecontractautomatic,
        CAST(1 + {O} % 2 AS INT) AS elob_realizationmode, CASE WHEN {O} % 7 = 0 THEN NULL ELSE concat('W', {O}) END AS elob_lastworkworder, concat('PP', {O} % 30) AS elob_process, CASE WHEN {O} % 8 = 0 THEN NULL ELSE concat('AD', {O}) END AS elob_location,
        concat('U', {O} % 97) AS ownerid, CASE WHEN {div(O, 3)} % 3 = 0 THEN NULL ELSE concat('U', {O} % 31) END AS elob_doublebooking, CASE WHEN {O} % 4 = 0 THEN NULL ELSE concat('U', {O} % 37) END AS elob_salesadministrationuser,
        CASE WHEN {O} % 5 = 0 THEN NULL ELSE {LATER} + INTERVAL 12 DAY END AS elob_testcompletiondate FROM {{orders}}""",
    "order_parameter": f"""SELECT concat('F', {L}) AS elob_sokxorder, {named('l_partkey', ['Numer zgody', 'Oferta niestandardowa', 'czas trwania umowy', 'Opłata abonamentowa netto - kwota PLN', 'Opłata instalacyjna netto (kwota PLN)', 'inne'])} AS elob_name,
        {pick('l_partkey', ["concat('Z    ', l_suppkey)", "CAST(62 + l_suppkey % 3 AS STRING)", "CAST(l_suppkey % 5 AS STRING)", "CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE concat(l_suppkey, '.5') END", "CAST(l_linenumber AS STRING)", "'x'"])} AS elob_value,
        concat('D', l_partkey % 6) AS elob_parameterdefinition FROM {{lineitem}}""",
    "parameter_definition": _keyed_by_nation(elob_parameterdefinitionid=f"concat('D', {N})"),
    "value_definition": _keyed_by_nation(elob_parameterdefinition=f"concat('D', {N} % 6)", elob_index=f"CAST({div(N, 6)} AS STRING)", elob_value=f"concat({N}, ' mies')"),
    "work_order": f"""SELECT concat('W', {O}) AS elob_workorder2id, concat('F', {O}) AS elob_sokxorderworkorderid, concat('WO-', {O}) AS elob_sokxnumber, CAST({pick(div(O, 11), ['1', '2', '3', None])} AS INT) AS new_sokxordertype,
        CAST({O} % 3 AS INT) AS elob_sokxwodecision, {LATER} + INTERVAL 2 DAY AS elob_decisiondate, CASE WHEN {O} % 3 = 0 THEN NULL ELSE {LATER} + INTERVAL 8 DAY END AS elob_executiondate, {LATER} AS createdon FROM {{orders}}
        UNION ALL SELECT concat('WL', {LINE_ID}), concat('F', {L}), concat('WO-', {LINE_ID}), CAST(1 + l_partkey % 3 AS INT), CAST(l_suppkey % 3 AS INT), {LINE_LATER}, {LINE_LATER} + INTERVAL 8 DAY, {LINE_LATER} FROM {{lineitem}}""",
    "status_history": f"""SELECT concat('H', {LINE_ID}) AS elob_statushistoryid, concat('O', {L}) AS elob_projectid, concat('C', {L}) AS elob_contractid, {named('l_linenumber', ['6', '100000002', '743940004', '743940000', '1'])} AS elob_statusreasonid,
        concat('reason ', l_linenumber) AS elob_statusreasonname, CAST(l_linenumber % 6 AS INT) AS elob_bpfstage, {LINE_LATER} AS createdon, {LINE_LATER} + INTERVAL 1 HOUR AS modifiedon, {LINE_LATER} AS elob_startdate,
        CASE WHEN l_linenumber = 3 THEN NULL ELSE {LINE_LATER} + INTERVAL 9 DAY END AS elob_enddate, concat('U', l_suppkey) AS elob_owninguserid, concat('U', l_partkey % 90) AS modifiedby,
        CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE concat('U', l_partkey % 80) END AS createdonbehalfby FROM {{lineitem}}""",
    "sold_product": f"""SELECT concat('SPR', {O}) AS elob_soldproductid, CAST(NULL AS STRING) AS elob_parentsoldproduct, concat('PR', {O} % 200) AS elob_product, {named(O, ['zarządzanie siecią lan', 'Zarządzanie siecią LAN', 'inne', 'ethernet'])} AS elob_name FROM {{orders}}
        UNION ALL SELECT concat('SPC', {LINE_ID}), concat('SPR', {L}), concat('PR', l_partkey), concat('svc ', l_linenumber) FROM {{lineitem}}""",
    "sold_product_parameter": f"""SELECT concat('SPC', {LINE_ID}) AS elob_soldproduct, concat('PPM', l_suppkey % 11) AS elob_parameter, {named('l_suppkey', ['liczba urządzeń UTM', 'inne', 'rodzaj'])} AS elob_name,
        {pick('l_partkey', ["'19'", "'4'", "'11'", "'7'", None])} AS elob_parametervalue FROM {{lineitem}}""",
    "product_parameter": _keyed_by_nation(elob_productparametersid=f"concat('PPM', {N})", elob_name=named(N, ["Migrowane numery od OA (wykaz) A", "Numer zlecenia powiązanego", "rodzaj"])),
    "product_parameter_value": _keyed_by_nation(elob_parameter=f"concat('PPM', CASE WHEN {N} % 15 IN (4, 11) THEN 2 ELSE {N} % 3 END)", elob_index=f"CAST({N} AS STRING)", elob_value=f"concat('rodzaj ', {N})"),
    "product_process": _keyed_by_nation(elob_productprocessid=f"concat('PP', {N})", elob_name=f"concat('process ', {N})"),
    "opportunity_product": f"""SELECT concat('O', {L}) AS opportunityid, concat('PR', l_partkey) AS productid, concat('SPR', {L}) AS elob_soldproduct, CAST(l_extendedprice AS DECIMAL(14, 2)) AS baseamount,
        CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_quantity AS DECIMAL(14, 2)) END AS elob_totalmonthlyfee, CAST(l_suppkey AS DECIMAL(14, 2)) AS elob_finalupfrontpayment, CAST({pick('l_partkey', ['100', '12', '24', None, '120'])} AS INT) AS elob_contractduration,
        CAST(l_suppkey % 40 AS INT) AS elob_specifydurationinmonths, CAST(l_quantity AS DECIMAL(10, 2)) AS elob_quantity, CAST(l_linenumber % 4 AS INT) AS elob_saletype FROM {{lineitem}}""",
    "product": f"""SELECT concat('PR', p_partkey) AS productid, p_name AS name, {named('p_partkey', PRODUCT_NUMBERS)} AS productnumber, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE concat('PR', {div('p_partkey', 2)}) END AS elob_service FROM {{part}}""",
    "opportunity_user": "SELECT concat('O', l_orderkey) AS opportunityid, concat('U', l_suppkey) AS systemuserid FROM {lineitem}",
    "competitor_product": f"""SELECT concat('A', p_partkey) AS elob_account, {pick('p_partkey', ["concat(p_brand, ' - ', p_name)", "'Orchard Energy'", "p_name", "'a-b'"])} AS elob_name, concat('note ', p_type) AS elob_comments,
        CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN CAST(0 AS DECIMAL(14, 4)) ELSE CAST(p_retailprice AS DECIMAL(14, 4)) END AS elob_income, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size AS DECIMAL(14, 4)) END AS elob_quantity,
        concat('operator ', p_size) AS elob_operator, o_orderdate + INTERVAL 25 YEAR AS elob_eop, concat('U', p_partkey % 120) AS modifiedby, CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END AS statecode FROM {{part}} JOIN {{orders}} ON {O} = p_partkey""",
    "sales_order": f"SELECT concat('SO', {O}) AS salesorderid, CASE WHEN {O} % 3 = 0 THEN concat('X', {O}) ELSE concat('O', {O}) END AS opportunityid, concat('SN-', {O}) AS ordernumber FROM {{orders}}",
    "mobile_order": f"""SELECT concat('MO', {O}) AS elob_mobileorderid, concat('SO', {O}) AS elob_order, concat('C', {O}) AS elob_contract, concat('MN-', {O}) AS elob_mobileordernumber, CAST({O} % 4 AS INT) AS statuscode,
        CAST({O} % 3 AS INT) AS elob_mobileordertype, concat('PS', {O} % 30) AS stageid, {LATER} AS createdon FROM {{orders}}""",
    "mobile_order_product": f"""SELECT concat('MO', {L}) AS elob_mobileorder, concat('tariff ', l_linenumber) AS elob_name, CAST(l_quantity AS DECIMAL(10, 2)) AS elob_quantity, CAST({pick('l_partkey', ['100', '12', '24', None, '120'])} AS INT) AS elob_contractduration,
        CAST(l_suppkey % 40 AS INT) AS elob_specifydurationinmonths, CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(12, 2)) END AS elob_priceperunitmonth, CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_tax AS DECIMAL(12, 2)) END AS elob_upfrontpayment FROM {{lineitem}}""",
    "mobile_order_item": f"SELECT concat('MO', {L}) AS elob_mobileorder, CASE WHEN l_linenumber = 3 THEN NULL ELSE concat('48', l_partkey) END AS elob_msisdnnumber FROM {{lineitem}}",
    "process_stage": _keyed_by_nation(processstageid=f"concat('PS', {N})", stagename=f"concat('stage ', {N})"),
    "address": f"""SELECT concat('AD', {O}) AS elob_addressid, concat('CI', {O} % 27) AS elob_city, CASE WHEN {O} % 4 = 0 THEN NULL ELSE concat('ST', {O} % 25) END AS elob_street, concat('ZP', {O} % 25) AS elob_zipconnections,
        CASE WHEN {O} % 2 = 0 THEN NULL ELSE concat('BD', {O} % 25) END AS elob_buildingnumberdict, concat({O} % 90, 'a') AS elob_buildingnumber FROM {{orders}}""",
    "city": _keyed_by_nation(elob_cityid=f"concat('CI', {N})", elob_name=f"concat('City ', {N})"),
    "street": _keyed_by_nation(elob_streetid=f"concat('ST', {N})", elob_name=named(N, ["Long", "O''Neil", "''"]).replace("''' ", "'' ")),
    "zip_connection": _keyed_by_nation(elob_zipconnectionsid=f"concat('ZP', {N})", elob_name=f"concat('00-', {N})"),
    "building": _keyed_by_nation(elob_buildingid=f"concat('BD', {N})", elob_number=f"concat({N}, 'B')"),
}
CRM["street"] = _keyed_by_nation(elob_streetid=f"concat('ST', {N})", elob_name=pick(N, ["concat('O', chr(39), 'Neil')", "chr(39)", "n_name"]))


def _sources(sql: str) -> list[str]:
    return [t for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events") if "{" + t + "}" in sql]


def crm_tables(star: Star, names: Sequence[str]) -> Tables:
    tables = Tables()
    for name in names:
        sql = CRM[name]
        tables.register(name, star.spark.sql(sql, **{t: getattr(star, t) for t in _sources(sql)}))
    return tables


def crm_sql(names: Sequence[str], query: str) -> str:
    """The query behind the business tables as named subqueries.

    The answer is materialized, too: DuckDB doesn't come to an end with some of these joins when a row limit
    is put around them, and takes a fraction of a second when the limit reads a finished table.
    """
    parts = []
    for name in names:
        sql = CRM[name]
        for t in _sources(sql):
            sql = sql.replace("{" + t + "}", t)
        parts.append(f"{name} AS MATERIALIZED ({sql})")
    parts.append(f"answer AS MATERIALIZED ({query.strip()})")
    return f"WITH {', '.join(parts)} SELECT * FROM answer"
