"""Plans on rows written by hand: matched and unmatched keys, nulls, blanks, other case, borders of dates. All names are invented."""

from datetime import datetime
from decimal import Decimal

import pytest

from siftload.plans import PLANS
from siftload.plans import fixed_values as fv
from siftload.plans.params import Params
from siftload.sources.tables import Tables

PARAMS = Params(
    as_of="2024-06-30 12:00:00", potential_products=("Orchard",), fix_category="FIX", mobile_category="MOB", sites=("S1",),
    campaign_creators=("U1",), campaign_queues=("Q1",), campaign_callers_left_out=("U9",),
)


@pytest.fixture
def extract(frame):
    def build(key, **tables):
        rows = PLANS[key].build(Tables({name: frame(rows, schema) for name, (rows, schema) in tables.items()}), PARAMS)
        return sorted((tuple(r) for r in rows.collect()), key=str)

    return build


def entry(code, value, meaning):
    return (code.entity, code.attribute.upper(), code.lang, value, meaning)


DICTIONARY = "objecttypecode int, attributename string, langid int, attributevalue int, value string"


def test_pils_parameters(extract):
    got = extract(
        "pils_parameters",
        pl_parameter=([("R1", "Sieć w 3 kampusow"), ("R1", "Sieć w 3 kampusow"), ("R2", "sie KAMPUSOW x"), ("R3", "other"), ("R4", None)], "elob_pl_resultid string, elob_parametervalue string"),
        pl_sales_result=([("R1",)], "elob_pandl_id string"),
        pl_result=([("R1", "S1"), ("R9", "S9")], "elob_pandl_id string, elob_plresultid string"),
        pl=([("S1", "O1"), ("S1", "O2")], "elob_plstatistic string, elob_project string"),
        opportunity=([("O1", "P-1")], "opportunityid string, elob_opportunityid string"),
    )
    assert got == [("R1", "Sieć w 3 kampusow", "P-1"), ("R1", "Sieć w 3 kampusow", None), ("R2", "sie KAMPUSOW x", None)]


def test_projects_contracts(extract):
    start = datetime.fromisoformat(PARAMS.project_contracts_from)
    got = extract(
        "projects_contracts",
        contract_opportunity=([("O1", "C1"), ("O1", "C2"), ("O2", "C1"), ("O3", "C1"), (None, "C1"), ("O1", None)], "opportunityid string, contractid string"),
        opportunity=([("O1", "P-1", start), ("O2", "P-2", datetime(2019, 12, 31, 23, 59)), ("O3", "P-3", None)], "opportunityid string, elob_opportunityid string, createdon timestamp_ntz"),
        contract=([("C1", "U/1"), ("C3", "U/3")], "contractid string, contractnumber string"),
    )
    assert got == [("P-1", "U/1")]


def test_project_last_pils(extract):
    got = extract(
        "project_last_pils",
        account=([("A1", "K1", 1, 0), ("A2", "K2", 3, 0), ("A3", "K3", 2, 1)], "accountid string, elob_sowid string, elob_businesssegment int, statecode int"),
        string_map=([entry(fv.SEGMENT, 1, "one"), entry(fv.SEGMENT, 2, "two")], DICTIONARY),
        opportunity=([("O1", "P-1", "A1", datetime(2024, 1, 1)), ("O2", "P-2", "A1", datetime(2024, 2, 2)), ("O3", "P-3", "A2", datetime(2024, 1, 1)), ("O4", "P-4", "A3", datetime(2024, 1, 1))], "opportunityid string, elob_opportunityid string, customerid string, createdon timestamp_ntz"),
        pl=([("L1", "901", "O1", 2), ("L2", "902", "O1", 2), ("L3", "903", "O2", 1)], "activityid string, elob_pl_id string, elob_project string, elob_pltype int"),
        activity_pointer=([("L1", datetime(2024, 6, 1)), ("L2", datetime(2023, 1, 1))], "activityid string, createdon timestamp_ntz"),
    )
    assert got == [("K1", "P-1", "2024-01-01", "901", "2024-06-01"), ("K1", "P-2", "2024-02-02", "", None)]


def test_status_history(extract):
    at = datetime(2024, 6, 20, 10, 0)
    row = lambda i, modified, editor: (i, "O1", "reason", 1, at, modified, at, None, "U1", editor, None)
    got = extract(
        "status_history",
        status_history=([row("H1", at, "U2"), row("H2", datetime(2024, 5, 1), "U2"), row("H3", at, "U9"), row("H4", None, "U2")],
            "elob_statushistoryid string, elob_projectid string, elob_statusreasonname string, elob_bpfstage int, createdon timestamp_ntz, modifiedon timestamp_ntz, elob_startdate timestamp_ntz, elob_enddate timestamp_ntz, elob_owninguserid string, modifiedby string, createdonbehalfby string"),
        opportunity=([("O1", "P 1")], "opportunityid string, elob_opportunityid string"),
        system_user=([("U1", "TP\\AnnA"), ("U2", "TP\\Bob")], "systemuserid string, domainname string"),
    )
    moved = datetime(2024, 6, 20, 12, 0)
    assert got == [("H1", "P1", fv.STAGES.get(1), "reason", moved, moved, moved, None, "anna", "bob", None)]


def test_fix_orders_value(extract):
    after, before = datetime(2020, 9, 1), datetime(2020, 8, 31)
    got = extract(
        "fix_orders_value",
        fixed_order=([("F1", "Z1", after), ("F2", "Z2", before), ("F3", None, after), ("F4", "Z4", after), ("F5", "Z5", after)], "elob_sokxorder2id string, elob_ordernumber string, createdon timestamp_ntz"),
        order_parameter=([
            ("F1", "Opłata abonamentowa netto - kwota PLN", "10", None), ("F1", "CZAS TRWANIA UMOWY", "2", "D1"), ("F2", "Opłata abonamentowa netto (kwota PLN)", "11", None),
            ("F4", "Czas trwania umowy", "1", "D1"), ("F5", "opłata instalacyjna netto kwota pln", "5", None), ("F5", "czas trwania umowy", "9", "D1"),
        ], "elob_sokxorder string, elob_name string, elob_value string, elob_parameterdefinition string"),
        parameter_definition=([("D1",)], "elob_parameterdefinitionid string"),
        value_definition=([("D1", "1", "12"), ("D1", "2", "24")], "elob_parameterdefinition string, elob_index string, elob_value string"),
    )
    assert [r[:4] for r in got] == [("Z1", "10", "", "24"), ("Z5", "", "5", "")]
    assert str(got[0][4])[:10] == "2020-09-01"


def test_pils_values(extract):
    fields = "sfa_pil_id string, field_code string, field_value string, field_key string"
    got = extract(
        "pils_values",
        settlement_value=([("7", "A|B|C|D", "1 234,50 zł", "k"), ("x", "A", "abc", "k"), ("8", "A", "#N/A", "k"), ("9", "A|B", None, "k"), ("10", None, "'5", "k")], fields),
        misc_field=([("1", fv.SETTLEMENT_FIELDS[0].upper(), "2.25", "m"), ("2", "MOBILE|SIMfree|rozliczenie|BSCS_terminal_9", "3", "m"), ("3", "MOBILE|SIMfree|rozliczenie|deklaracja_wykorzystanie_7", "Odsprzedaż ZŁ", "m"), ("4", "MOBILE|SIMfree|rozliczenie|deklaracja_wykorzystanie_7", "no", "m"), ("5", "other", "1", "m")], fields),
    )
    numbers = {r[0]: r[3] for r in got}
    assert numbers == {7: 1234.5, 0: 0.0, 10: 5.0, 1: 2.25, 2: 3.0, 3: 0.0}
    assert next(r[5:] for r in got if r[0] == 7) == ("A", "B", "C", "D")


def test_project_product_params(extract):
    got = extract(
        "project_product_params",
        opportunity=([("O1", "P 1", datetime(2018, 1, 1)), ("O2", "P2", datetime(2017, 12, 31))], "opportunityid string, elob_opportunityid string, createdon timestamp_ntz"),
        opportunity_product=([("O1", "S1"), ("O2", "S1"), ("O1", "S9"), ("O1", None)], "opportunityid string, elob_soldproduct string"),
        sold_product=([("S1", None, "Zarządzanie siecią LAN"), ("S2", "S1", "part"), ("S3", "S1", "part"), ("S9", None, "other"), ("S8", "S9", "part")], "elob_soldproductid string, elob_parentsoldproduct string, elob_name string"),
        sold_product_parameter=([("S2", "Liczba urządzeń UTM", "4"), ("S3", "liczba urządzeń utm", None), ("S8", "liczba urządzeń utm", "5")], "elob_soldproduct string, elob_name string, elob_parametervalue string"),
    )
    assert got == [("P1", "S1", "Liczba urządzeń UTM", "4")]


def test_potential(extract):
    product = "elob_account string, elob_name string, elob_comments string, elob_income decimal(10,2), elob_quantity decimal(10,0), elob_operator string, elob_eop timestamp_ntz, modifiedby string, statecode int"
    day = datetime(2024, 5, 5, 7, 0)
    got = extract(
        "potential",
        competitor_product=([
            ("A1", "Net - fast", "c", Decimal(5), None, "Op", day, "U1", 0), ("A1", "ORCHARD ", None, None, Decimal(2), None, None, "U9", 0), ("A1", "plain", "c", Decimal(5), Decimal(1), "Op", day, "U1", 0),
            ("A1", "a-b", "c", Decimal(0), None, "Op", day, "U1", 0), ("A1", "a-b", "c", Decimal(1), None, "Op", day, "U1", 1), ("A2", "a-b", "c", Decimal(1), None, "Op", day, "U1", 0),
        ], product),
        account=([("A1", "Firm", "R17R9999", "F1", 0), ("A2", "Gone", "R18R001", "F1", 1)], "accountid string, name string, elob_sowid string, elob_portfolio string, statecode int"),
        portfolio=([("F1", "KKB 1")], "elob_portfolioid string, elob_name string"),
        system_user=([("U1", "Ann")], "systemuserid string, fullname string"),
    )
    assert sorted((r[2], r[6], r[7], r[10]) for r in got) == [("17", "Net - fast", "Net", "Ann"), ("17", "ORCHARD ", "", None)]
    assert sorted((r[3], r[8]) for r in got) == [(Decimal("0.00"), Decimal(2)), (Decimal("5.00"), Decimal(0))]


def test_contacts(extract):
    got = extract(
        "contacts",
        account=([("A1", "1", None, "K1", 3, "F1", "U1", 0, "T1"), ("A2", "2", "r", "k9 ", 3, "F1", "U1", 0, "T1"), ("A3", "3", "r", "K3", 1, "F1", "U1", 0, "T1"), ("A4", "4", "r", None, 3, "F1", "U1", 0, "T1"), ("A5", "5", "r", "K5", 3, "F2", "U1", 0, "T1")],
            "accountid string, elob_nip string, elob_regon string, elob_sowid string, elob_businesssegment int, elob_portfolio string, ownerid string, statecode int, primarycontactid string"),
        excluded_customers=([("K9",)], "elob_sowid string"),
        portfolio=([("F1", "kkb x"), ("F2", "other")], "elob_portfolioid string, elob_name string"),
        string_map=([entry(fv.SEGMENT, 3, "three")], DICTIONARY),
        system_user=([("U1", "Ann", "U2"), ("U2", "Boss", None)], "systemuserid string, fullname string, parentsystemuserid string"),
        contact=([("T1", "Full\nName", "Fi\rrst", None, None, "x@example.com", 0)], "contactid string, fullname string, firstname string, lastname string, mobilephone string, emailaddress1 string, statecode int"),
    )
    assert len(got) == 1
    assert got[0][:8] == ("T1", "1", "", "K1", "three", "kkb x", "Ann", "Boss")
    assert got[0][9:] == ("FullName", "First", "", " ", "x@example.com")


def test_project_products(extract):
    start = datetime.fromisoformat(PARAMS.project_products_from)
    got = extract(
        "project_products",
        opportunity=([
            ("O1", "P 1", start, "A1", "U1", 2), ("O2", "P2", datetime(2017, 12, 31, 23, 59), "A1", "U1", 2), ("O3", "P3", start, "A1", "U9", 2),
            ("O4", "P4", start, "A2", "U1", 2), ("O5", "P5", start, "A1", "U1", None),
        ], "opportunityid string, elob_opportunityid string, createdon timestamp_ntz, accountid string, ownerid string, elob_productcategory int"),
        opportunity_product=([
            ("O1", "PR1", "S P1", Decimal("10.60"), None, Decimal("3.00"), 100, 18, Decimal("2.00"), 0),
            ("O1", "PR9", "X", None, None, None, 24, 5, None, 1), ("O4", "PR1", "Y", None, None, None, 24, 5, None, 1),
        ], "opportunityid string, productid string, elob_soldproduct string, baseamount decimal(14,2), elob_totalmonthlyfee decimal(14,2), elob_finalupfrontpayment decimal(14,2), elob_contractduration int, elob_specifydurationinmonths int, elob_quantity decimal(10,2), elob_saletype int"),
        product=([("PR1", "svc", "N1", "PR2"), ("PR2", "group", None, None)], "productid string, name string, productnumber string, elob_service string"),
        account=([("A1", 1), ("A2", 3)], "accountid string, elob_businesssegment int"),
        system_user=([("U1",)], "systemuserid string"),
        string_map=([entry(fv.SALE_TYPE, 0, "Nowa Sprzedaż"), entry(fv.SALE_TYPE, 1, " "), entry(fv.PRODUCT_CATEGORY, 2, "cat")], DICTIONARY),
    )
    assert got == [
        ("P1", "", None, "X", None, 0, 0, 0, 24, 0, "cat", None),
        ("P1", "Nowa sprzedaż", "svc", "SP1", "N1", 11, 0, 3, 18, 2, "cat", "group"),
        ("P5", None, None, None, None, 0, 0, 0, 0, 0, None, None),
    ]


def test_e_contracts(extract):
    start = datetime.fromisoformat(PARAMS.fixed_orders_from)

    def order(number, status=1, created=start, owner="U1", second=None, operation=1, customer="A1", product="SP1", contract="C1"):
        return (number, status, created, owner, second, operation, customer, product, contract)

    got = extract(
        "e_contracts",
        fixed_order=([
            order("N1"), order("N2", owner="U2", second="U1"), order("N3", owner="U2"), order(None), order("N4", created=datetime(2019, 6, 30, 23, 59)),
            order("N5", status=fv.ORDER_CANCELLED), order("N6", operation=9), order("N7", product="SP2"), order("N8", contract="C2"), order("N9", customer="A2"),
            order("N10", owner="U7", second="U1"),
        ], "elob_ordernumber string, statuscode int, createdon timestamp_ntz, ownerid string, elob_doublebooking string, elob_operation int, elob_customer string, elob_soldproduct string, elob_contract string"),
        string_map=([
            entry(fv.ORDER_STATUS, 1, "new"), entry(fv.ORDER_STATUS, fv.ORDER_CANCELLED, "off"), entry(fv.ORDER_OPERATION_POLISH, 1, "op"), entry(fv.SEGMENT, 1, "one"),
            entry(fv.CONTRACT_TYPE, 1, "kind"), entry(fv.CONTRACT_STATUS, 6, "active"), entry(fv.TRANSFER_DOCUMENT, fv.ECONTRACT, "e-doc"),
        ], DICTIONARY),
        account=([("A1", "1", "K1", 1), ("A2", "2", "k9 ", 1)], "accountid string, elob_nip string, elob_sowid string, elob_businesssegment int"),
        excluded_customers=([("K9",)], "elob_sowid string"),
        sold_product=([("SP1", None), ("CH1", "SP1"), ("CH2", "SP1"), ("SP2", None)], "elob_soldproductid string, elob_parentsoldproduct string"),
        contract=([
            ("C1", "U/1", 1, fv.ECONTRACT, 7, 6, datetime(2019, 12, 31, 23, 30), None, datetime(2020, 5, 5, 23)),
            ("C2", "U/2", 1, 1, 7, 6, None, None, None),
        ], "contractid string, contractnumber string, elob_contracttype int, elob_transferdocumenttype int, elob_econtractstatus int, statuscode int, elob_senttocustomeron timestamp_ntz, elob_signedbycustomeron timestamp_ntz, modifiedon timestamp_ntz"),
        system_user=([("U1", "S1", "B1"), ("U2", "S2", "B1")], "systemuserid string, siteid string, businessunitid string"),
    )
    rest = ("1", "K1", "U/1", "active", "kind", "e-doc", "2020-01-01 00:30", "", "", "2020-05-05")
    assert got == [("N1", *rest), ("N2", *rest)]


def test_campaigns(extract):
    day = datetime(2020, 2, 3)

    def pointer(id, about, subject="call\n", created=day, by="U2", status=1):
        return (id, about, subject, created, datetime(2020, 10, 25, 0, 1), datetime(2021, 10, 31), None, by, "U1", "U2", status, 0)

    got = extract(
        "campaigns",
        campaign=([("K1", "Camp", "KMP-1", "U1", day), ("K2", "Other", "KMP-2", "U2", day)], "campaignid string, name string, elob_campaignid string, createdby string, createdon timestamp_ntz"),
        system_user=([("U1", "Ann"), ("U2", "Bob"), ("U9", "Out")], "systemuserid string, fullname string"),
        activity_pointer=([
            pointer("CA1", "K1", "ac\ntion"), pointer("CA2", "K2"), pointer("E1", "CA1", created=datetime(2020, 10, 25)), pointer("E2", "CA2"),
            pointer("E3", "CA1", status=fv.PHONE_CALL_CANCELLED), pointer("E4", "CA1", by="U9"), pointer("E5", "CA1"), pointer("E6", "CA1", "plain"),
            pointer("E7", "CA1"), pointer("E8", None),
        ], "activityid string, regardingobjectid string, subject string, createdon timestamp_ntz, modifiedon timestamp_ntz, scheduledstart timestamp_ntz, scheduledend timestamp_ntz, createdby string, modifiedby string, ownerid string, statuscode int, statecode int"),
        campaign_activity=([("CA1",), ("CA2",)], "activityid string"),
        phone_call=([("E1", "A1", "LD1", "AN1", None, "no\nte")] + [(e, None, None, None, None, None) for e in ("E2", "E3", "E4", "E5", "E6", "E8")],
            "activityid string, elob_relatedaccount string, elob_relatedlead string, elob_answer string, elob_onholddate timestamp_ntz, new_1 string"),
        string_map=([entry(fv.PHONE_CALL_STATUS_POLISH, 1, "open"), entry(fv.PHONE_CALL_STATUS_POLISH, 3, "off"), entry(fv.PHONE_CALL_STATE, 0, "state")], DICTIONARY),
        campaign_answer=([("AN1", "yes")], "elob_marketingcampainanswersid string, elob_answer string"),
        queue_item=([("E1", "Q1", "U1", datetime(2019, 1, 1, 10), None), ("E5", "Q2", "U1", day, day)], "objectid string, queueid string, workerid string, enteredon timestamp_ntz, workeridmodifiedon timestamp_ntz"),
        queue=([("Q1", "Queue"), ("Q2", "Other")], "queueid string, name string"),
        lead=([("LD1", "lead", "ML1")], "leadid string, subject string, elob_marketinglistid string"),
        account=([("A1", "K1", None, "Acc\nName")], "accountid string, elob_sowid string, elob_nip string, name string"),
    )
    step = ("Camp", "KMP-1", "2020-02-03", "action", "2020-02-03")
    later = ("2020-10-25 01:01", "Ann", "Bob", "2021-10-31 02:00", "", "state", "open", "")
    assert got == [
        # A time on the border of two summer-time ranges belongs to the first; one outside all of them is shifted by two hours.
        (*step, "call", "2020-10-25 02:00", "Queue", "2019-01-01 12:00", "", "Ann", *later, "note", "lead", "ML1", "K1", "", "AccName", "yes", "Bob"),
        (*step, "plain", "2020-02-03 02:00", "", "", "", "", *later, "", "", "", "", "", None, "", "Bob"),
    ]


def test_projects(extract):
    start = datetime.fromisoformat(PARAMS.projects_from)

    def project(id, created=start, author="U2", account="A1", value=100.0, initiative=None):
        return (
            id, f"P-{id}", f"Project {id}", created, author, "U1", "Ann Owner", account, None, value, datetime(2024, 3, 1, 23), None, 1, 0, 1,
            initiative, 2, 3,
        )

    mobile, draft, final = 2, 0, 1
    got = extract(
        "projects",
        opportunity=([
            project("O1", created=datetime(2020, 1, 1, 22, 30), initiative=1), project("O2", value=None), project("O3", initiative=fv.INITIATIVE_STORM),
            project("O4", created=datetime(2018, 12, 31, 23, 59)), project("O5", account="A2"), project("O6", author="U9"), project("O7", initiative=7),
        ], "opportunityid string, elob_opportunityid string, name string, createdon timestamp_ntz, createdby string, ownerid string, owneridname string, accountid string, budgetamount double, estimatedvalue double, estimatedclosedate timestamp_ntz, elob_estimatedbillingdate timestamp_ntz, elob_salesstage int, statecode int, statuscode int, elob_initiative int, elob_productcategory int, elob_projecttype int"),
        account=([("A1", "R12R3456", "Acme", 4), ("A2", "K2", "Other", 5)], "accountid string, elob_sowid string, name string, elob_businesssegment int"),
        system_user=([("U1", "Ann", "TP\\ann"), ("U2", "Bob", "TP\\bob")], "systemuserid string, fullname string, domainname string"),
        pl=([
            ("L1", "901", "O1", mobile, final, "S1"), ("L9", "999", "O1", fv.FIX_CALCULATION, draft, "S2"), ("L2", "99", "O2", fv.FIX_CALCULATION, draft, "S2"),
            ("L3", "101", "O2", fv.FIX_CALCULATION, draft, "S3"), ("L4", "990", "O2", fv.FIX_CALCULATION, draft, "S3"), ("L7", "907", "O7", mobile, draft, "S3"),
            ("L8", "908", None, mobile, final, "S3"),
        ], "activityid string, elob_pl_id string, elob_project string, elob_pltype int, elob_finalpl int, elob_plstatistic string"),
        activity_pointer=([
            ("L9", fv.CALCULATION_ACCEPTED), ("L2", fv.CALCULATION_ACCEPTED), ("L3", fv.CALCULATION_ACCEPTED), ("L4", fv.CALCULATION_CALCULATED), ("L7", -1),
        ], "activityid string, statuscode int"),
        string_map=([
            entry(fv.SALES_STAGE, 1, "stage"), entry(fv.PROJECT_STATE, 0, "state"), entry(fv.INITIATIVE, 1, "i" * 40), entry(fv.PRODUCT_CATEGORY, 2, "cat"),
            entry(fv.CALCULATION_STATUS, fv.CALCULATION_ACCEPTED, "accepted"),
        ], DICTIONARY),
        pl_result=([
            ("S1", "Z1", None, None, Decimal("50.00"), Decimal("0.00")), ("S2", "Z2", Decimal("10.00"), Decimal("200.00"), None, None),
            ("S3", "Z3", Decimal("90.00"), Decimal("900.00"), None, Decimal("7.00")),
        ], "elob_plresultid string, elob_pandl_id string, elob_fix_margin_on_contract decimal(12,2), elob_fix_total_revenue_new decimal(14,2), elob_mobile_contributionmargin decimal(12,2), elob_mobilediscountedcashmargin decimal(12,2)"),
        pl_sales_result=([("Z1",), ("Z2",), ("Z3",)], "elob_pandl_id string"),
        pl_parameter=([
            ("Z1", "Mobile_Reve_Invoices", "10"), ("Z1", "mobile_reve_invoices", "20"), ("Z1", "mobile_reve_operators", "1"), ("Z1", "mobile_reve_operators", "2"),
            ("Z1", "mobile_reve_operators", "3"), ("Z1", "other", "500"), ("Z2", "mobile_reve_invoices", "5"),
        ], "elob_pl_resultid string, elob_name string, elob_parametervalue string"),
        status_history=([("O1", datetime(2024, 1, 1)), ("O1", datetime(2024, 2, 1, 22)), ("O2", None)], "elob_projectid string, elob_startdate timestamp_ntz"),
    )
    column = dict(zip(PLANS["projects"].columns, zip(*got)))
    # The two attributes of a mobile calculation multiply: 2 invoices by 3 operators are 6 rows, which the sums count.
    assert column["PROJECT_ID"] == ("O1", "O2", "O3", "O7")
    assert column["PIL_ID"] == ("901", "99", "null", "null")  # final before accepted before calculated; ids compare as text
    assert column["REVENUE"] == (102.0, 200.0, 0.0, 0.0)
    assert column["MARGIN"] == (51.0, 20.0, 0.0, 0.0)
    assert column["ESTIMATED_VALUE"] == (600.0, 0.0, 100.0, 100.0)
    assert column["PIL_FINAL"] == (final, draft, None, None)
    assert column["PIL_STATUS"] == ("null", "accepted", "null", "null")
    assert column["INITIATIVE"] == ("i" * 30, None, fv.STORM_LABEL, "7")
    assert column["PROJECT_CREATE_DATE"] == ("2020-01-02", "2019-01-01", "2019-01-01", "2019-01-01")
    assert [str(day)[:10] for day in column["LAST_STEP_CHANGE_DATE"]] == ["2024-02-02", "None", "None", "None"]
    assert {str(day)[:10] for day in column["EST_CLOSE_DATE"]} == {"2024-03-02"}
    for name, value in {
        "ID_SOW": "12", "CUSTOMER_NAME": "Acme", "PROJECT_STEP": "stage", "PROJECT_STATE": "state", "PROJECT_STATUS": None, "EST_BILING_DATE": None,
        "PROJECT_OWNER": "Ann Owner", "PROJECT_OWNER_LOGIN": "ann", "CREATED_BY": "Bob", "CREATED_BY_LOGIN": "bob", "PRODUCT_CATEGORY": "cat",
        "CUSTOMER_BUDGET": 0.0, "SALE_TYPE": None,
    }.items():
        assert set(column[name]) == {value}, name


def test_contracts(extract):
    start = datetime.fromisoformat(PARAMS.contracts_from)

    def contract(id, kind="FIX", created=start, customer="A1", status=6, verified=None):
        return (id, f"U/{id}", customer, status, kind, created, verified)

    got = extract(
        "contracts",
        contract=([
            contract("C 1", verified=datetime(2024, 5, 5, 23, 59)), contract("C2", "MOB"), contract("C3", "OTH"), contract("C4", created=datetime(2022, 12, 31, 23, 59)),
            contract("C5", customer="A2"), contract("C6", status=77), contract("C7", "none"), contract("C8"), contract("C9", customer=None),
        ], "contractid string, contractnumber string, customerid string, statuscode int, elob_categoryid string, createdon timestamp_ntz, elob_revisiondate timestamp_ntz"),
        category=([("FIX", "fixed"), ("MOB", "mobile"), ("OTH", "other")], "elob_categoryid string, elob_name string"),
        account=([("A1", "K1"), ("A2", "k9 ")], "accountid string, elob_sowid string"),
        excluded_customers=([("K9",)], "elob_sowid string"),
        fixed_order=([("C 1", "N1"), ("C 1", "N2"), ("C 1", "N2"), ("C2", "N9"), (None, "N0")], "elob_contract string, elob_ordernumber string"),
        mobile_order=([("M1", "C 1"), ("M2", "C2"), ("M3", "C2")], "elob_mobileorderid string, elob_contract string"),
        mobile_order_item=([("M1", "481"), ("M2", "482"), ("M2", None)], "elob_mobileorder string, elob_msisdnnumber string"),
        string_map=([entry(fv.CONTRACT_STATUS, 6, "Active")], DICTIONARY),
        contract_archive=([
            ("C 1", datetime(2024, 1, 31, 12), "ZARCHIWIZOWANO w teczce"), ("C 1", datetime(2023, 1, 1), "inne"), ("C3", None, "ZARCHIWIZOWANO w teczce"),
        ], "elob_contract string, elob_archivingdate timestamp_ntz, elob_comments string"),
    )
    # A fixed contract shows its orders, a mobile one its numbers, neither those of the other kind.
    assert got == [
        ("U/C 1", "ACTIVE", "FIXED", "N1", "C1", "2024-05-05", "2024-02-01"),
        ("U/C 1", "ACTIVE", "FIXED", "N2", "C1", "2024-05-05", "2024-02-01"),
        ("U/C2", "ACTIVE", "MOBILE", "", "C2", "", ""),
        ("U/C2", "ACTIVE", "MOBILE", "482", "C2", "", ""),
        ("U/C3", "ACTIVE", "OTHER", "", "C3", "", ""),
        ("U/C8", "ACTIVE", "FIXED", "", "C8", "", ""),
    ]
